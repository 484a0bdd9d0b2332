"""Schemas of landing files, bronze tables and monitoring tables, required columns and domains."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)


def _struct(*columns: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in columns])


_LINEAGE = (
    ("_source_file", T.StringType(), True),
    ("_ingest_timestamp", T.TimestampType(), True),
    ("_ingest_date", T.DateType(), True),
)

BRONZE: dict[str, T.StructType] = {
    "orders": _struct(
        ("id_unidade", T.LongType(), False),
        ("id_pedido", T.StringType(), False),
        ("tipo_pedido", T.StringType(), True),
        ("data_pedido", T.DateType(), True),
        ("vlr_pedido", MONEY, True),
        ("endereco_entrega", T.StringType(), True),
        ("taxa_entrega", MONEY, True),
        ("status", T.StringType(), True),
        *_LINEAGE,
    ),
    "order_items": _struct(
        ("id_pedido", T.StringType(), False),
        ("id_item_pedido", T.StringType(), False),
        ("id_produto", T.LongType(), True),
        ("qtd", T.LongType(), True),
        ("vlr_item", MONEY, True),
        ("observacao", T.StringType(), True),
        *_LINEAGE,
    ),
    "products": _struct(
        ("id_produto", T.LongType(), False),
        ("nome_produto", T.StringType(), True),
        ("_ingest_timestamp", T.TimestampType(), True),
    ),
    "units": _struct(
        ("id_unidade", T.LongType(), False),
        ("nome_unidade", T.StringType(), True),
        ("id_estado", T.LongType(), True),
        ("_ingest_timestamp", T.TimestampType(), True),
    ),
    "states": _struct(
        ("id_estado", T.LongType(), False),
        ("id_pais", T.LongType(), True),
        ("nome_estado", T.StringType(), True),
        ("_ingest_timestamp", T.TimestampType(), True),
    ),
    "countries": _struct(
        ("id_pais", T.LongType(), False),
        ("nome_pais", T.StringType(), True),
        ("_ingest_timestamp", T.TimestampType(), True),
    ),
}

MONITORING: dict[str, T.StructType] = {
    "data_quality_log": _struct(
        ("check_id", T.StringType(), False),
        ("check_name", T.StringType(), False),
        ("check_category", T.StringType(), False),
        ("layer", T.StringType(), False),
        ("table_name", T.StringType(), True),
        ("check_sql", T.StringType(), True),
        ("result", T.StringType(), False),
        ("expected_value", T.StringType(), True),
        ("actual_value", T.StringType(), True),
        ("details", T.StringType(), True),
        ("execution_date", T.DateType(), False),
        ("execution_timestamp", T.TimestampType(), False),
        ("dag_run_id", T.StringType(), True),
        ("duration_seconds", T.DoubleType(), True),
    ),
    "pipeline_metrics": _struct(
        ("metric_id", T.StringType(), False),
        ("dag_id", T.StringType(), False),
        ("dag_run_id", T.StringType(), True),
        ("task_id", T.StringType(), True),
        ("metric_name", T.StringType(), False),
        ("metric_value", T.DoubleType(), False),
        ("metric_unit", T.StringType(), True),
        ("execution_date", T.DateType(), False),
        ("execution_timestamp", T.TimestampType(), False),
        ("details", T.StringType(), True),
    ),
    "free_tier_usage": _struct(
        ("snapshot_id", T.StringType(), False),
        ("snapshot_date", T.DateType(), False),
        ("snapshot_timestamp", T.TimestampType(), False),
        ("gcs_storage_bytes", T.LongType(), True),
        ("gcs_storage_gb", T.DoubleType(), True),
        ("gcs_limit_gb", T.DoubleType(), True),
        ("gcs_usage_pct", T.DoubleType(), True),
        ("bq_storage_bytes", T.LongType(), True),
        ("bq_storage_gb", T.DoubleType(), True),
        ("bq_limit_gb", T.DoubleType(), True),
        ("bq_usage_pct", T.DoubleType(), True),
        ("bq_query_bytes_month", T.LongType(), True),
        ("bq_query_tb_month", T.DoubleType(), True),
        ("bq_query_limit_tb", T.DoubleType(), True),
        ("bq_query_usage_pct", T.DoubleType(), True),
        ("details", T.StringType(), True),
    ),
}

PARTITIONS: dict[str, str] = {
    "bronze.orders": "_ingest_date",
    "bronze.order_items": "_ingest_date",
    "monitoring.data_quality_log": "execution_date",
    "monitoring.pipeline_metrics": "execution_date",
    "monitoring.free_tier_usage": "snapshot_date",
}


@dataclass(frozen=True)
class FileSpec:
    """One kind of landing file: which columns it must carry and how each is read."""

    base_name: str
    table: str
    renames: dict[str, str]
    required: tuple[str, ...]
    key: str
    domain: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return list(self.renames)

    @property
    def types(self) -> dict[str, T.DataType]:
        target = BRONZE[self.table]
        return {source: target[name].dataType for source, name in self.renames.items()}


ORDERS_FILE = FileSpec(
    base_name="pedido.csv",
    table="orders",
    renames={
        "Id_Unidade": "id_unidade",
        "Id_Pedido": "id_pedido",
        "Tipo_Pedido": "tipo_pedido",
        "Data_Pedido": "data_pedido",
        "Vlr_Pedido": "vlr_pedido",
        "Endereco_Entrega": "endereco_entrega",
        "Taxa_Entrega": "taxa_entrega",
        "Status": "status",
    },
    required=("Id_Unidade", "Id_Pedido", "Data_Pedido", "Vlr_Pedido", "Status"),
    key="Id_Pedido",
    domain={"Status": ("Finalizado", "Pendente", "Cancelado")},
)

ITEMS_FILE = FileSpec(
    base_name="item_pedido.csv",
    table="order_items",
    renames={
        "Id_Pedido": "id_pedido",
        "Id_Item_Pedido": "id_item_pedido",
        "Id_Produto": "id_produto",
        "Qtd": "qtd",
        "Vlr_Item": "vlr_item",
        "Observacao": "observacao",
    },
    required=("Id_Pedido", "Id_Item_Pedido", "Id_Produto", "Qtd", "Vlr_Item"),
    key="Id_Item_Pedido",
)

FILE_SPECS = (ORDERS_FILE, ITEMS_FILE)


@dataclass(frozen=True)
class ReferenceSpec:
    """One reference table: its landing file, its source table and its bronze columns."""

    table: str
    source_table: str
    renames: dict[str, str]

    @property
    def file_name(self) -> str:
        return f"{self.source_table}.csv"

    @property
    def key(self) -> str:
        return next(iter(self.renames.values()))


REFERENCE_SPECS = (
    ReferenceSpec("countries", "pais", {"Id_Pais": "id_pais", "Nome_Pais": "nome_pais"}),
    ReferenceSpec("states", "estado", {"Id_Estado": "id_estado", "Id_Pais": "id_pais", "Nome_Estado": "nome_estado"}),
    ReferenceSpec(
        "units", "unidade", {"Id_Unidade": "id_unidade", "Nome_Unidade": "nome_unidade", "Id_Estado": "id_estado"}
    ),
    ReferenceSpec("products", "produto", {"Id_Produto": "id_produto", "Nome_Produto": "nome_produto"}),
)
