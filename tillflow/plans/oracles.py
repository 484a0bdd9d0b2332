"""Plain SQL for the registered queries, to be run by another engine over the same tables.

Money is kept in whole cents and rounded by integer division, so that the expected values do not depend on
how an engine rounds fractions. The SQL is the literal form of each query: distinct counts, unpartitioned
ranks, joins before aggregation.
"""

from __future__ import annotations

import re

from tillflow.operators.quality import CHECK_SQL
from tillflow.operators.series import ALERT_RULES


def _average(total: str, count: str) -> str:
    """total / count of cents, rounded half up, as a number with two decimals. Both are not negative."""
    return f"CAST((2 * ({total}) + ({count})) // (2 * NULLIF({count}, 0)) AS DOUBLE) / 100"


def _percent(part: str, whole: str) -> str:
    return f"CAST((20000 * ({part}) + ({whole})) // (2 * NULLIF({whole}, 0)) AS DOUBLE) / 100"


def _count_average(total: str, count: str) -> str:
    return _average(f"100 * ({total})", count)


def _one_decimal(cents: str) -> str:
    """A value in hundredths shown with one decimal."""
    return f"CAST((2 * ({cents}) + 10) // 20 AS DOUBLE) / 10"


_ORDER_TYPE = (
    "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'Loja Online' "
    "WHEN o_orderpriority = '5-LOW' THEN 'Loja Fisica' ELSE 'Balcao' END"
)
_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'Finalizado' WHEN 'O' THEN 'Pendente' WHEN 'P' THEN 'Cancelado' END"
_ONLINE = "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"
_FEE = f"CASE WHEN {_ONLINE} THEN 500 + o_orderkey % 2001 WHEN o_orderpriority = '5-LOW' THEN 0 END"
_ADDRESS = (
    f"CASE WHEN {_ONLINE} THEN CASE WHEN o_orderkey % 10 = 0 THEN '   ' "
    "ELSE '  Rua ' || CAST(o_custkey AS VARCHAR) || '  ' END END"
)
_TWICE = "o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'"


def _bronze_orders(status: str, days: int) -> str:
    return f"""
      SELECT o_custkey AS id_unidade, CAST(o_orderkey AS VARCHAR) AS id_pedido, {_ORDER_TYPE} AS tipo_pedido,
             CAST(o_orderdate AS DATE) AS data_pedido, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS value_cents,
             {_ADDRESS} AS endereco_entrega, {_FEE} AS fee_cents, {status} AS status,
             'raw/csv_sales/' || strftime(o_orderdate, '%Y/%m/%d') || '/pedido.csv' AS source_file,
             CAST(CAST(o_orderdate AS DATE) + {days} AS TIMESTAMP) AS ingested_at,
             CAST(o_orderdate AS DATE) + {days} AS ingest_date
      FROM orders"""


CTES: dict[str, str] = {
    "b_countries": "SELECT r_regionkey AS id_pais, '  ' || r_name || ' ' AS nome_pais FROM region",
    "b_states": "SELECT n_nationkey AS id_estado, n_regionkey AS id_pais, '  ' || n_name || ' ' AS nome_estado FROM nation",
    "b_units": "SELECT c_custkey AS id_unidade, '  ' || c_name || ' ' AS nome_unidade, c_nationkey AS id_estado FROM customer",
    "b_products": "SELECT p_partkey AS id_produto, '  ' || p_name || ' ' AS nome_produto FROM part",
    "b_orders": f"{_bronze_orders(_STATUS, 1)} UNION ALL {_bronze_orders(chr(39) + 'Cancelado' + chr(39), 3)} WHERE {_TWICE}",
    "b_items": """
      SELECT CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'lost-' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS id_pedido,
             CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id_item_pedido,
             l_partkey AS id_produto, CAST(l_quantity AS BIGINT) AS qtd,
             CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS price_cents,
             CASE l_linenumber % 3 WHEN 1 THEN '  ' WHEN 2 THEN ' obs ' || CAST(l_linenumber AS VARCHAR) || ' ' END AS observacao,
             'raw/csv_sales/' || strftime(l_shipdate, '%Y/%m/%d') || '/item_pedido.csv' AS source_file,
             CAST(l_shipdate AS DATE) AS ingest_date
      FROM lineitem""",
    "s_orders": """
      SELECT id_pedido AS order_id, id_unidade AS unit_id,
             CASE tipo_pedido WHEN 'Loja Online' THEN 'ONLINE' WHEN 'Loja Fisica' THEN 'PHYSICAL' ELSE 'UNKNOWN' END AS order_type,
             status AS order_status, data_pedido AS order_date, value_cents, fee_cents, value_cents - fee_cents AS subtotal_cents,
             nullif(trim(endereco_entrega), '') AS delivery_address,
             source_file, ingested_at, ingest_date
      FROM b_orders
      WHERE ingested_at = (SELECT max(later.ingested_at) FROM b_orders AS later WHERE later.id_pedido = b_orders.id_pedido)""",
    "s_items": """
      SELECT id_item_pedido AS order_item_id, id_pedido AS order_id, id_produto AS product_id, qtd AS quantity, price_cents,
             qtd * price_cents AS line_cents, nullif(trim(observacao), '') AS observation,
             source_file, ingest_date
      FROM (SELECT *, row_number() OVER (PARTITION BY id_item_pedido
                    ORDER BY ingest_date DESC, source_file DESC, id_pedido DESC, id_produto DESC, qtd DESC, price_cents DESC) AS nth
            FROM b_items WHERE id_pedido IN (SELECT id_pedido FROM b_orders)) AS numbered
      WHERE nth = 1""",
    "s_units": """
      SELECT id_unidade AS unit_id, trim(nome_unidade) AS unit_name, b_states.id_estado AS state_id, trim(nome_estado) AS state_name,
             b_countries.id_pais AS country_id, trim(nome_pais) AS country_name
      FROM b_units LEFT JOIN b_states ON b_units.id_estado = b_states.id_estado
                   LEFT JOIN b_countries ON b_states.id_pais = b_countries.id_pais""",
    "d_days": """
      SELECT strftime(day, '%Y%m%d') AS date_key, CAST(day AS DATE) AS full_date
      FROM (SELECT unnest(generate_series(first, last, INTERVAL 1 DAY)) AS day FROM (
        SELECT date_trunc('year', min(order_date)) AS first, date_trunc('year', max(order_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS last
        FROM s_orders) AS ends) AS spine""",
    "f_sales": """
      SELECT order_id, strftime(order_date, '%Y%m%d') AS date_key, order_date, unit_id AS unit_key, order_type, order_status,
             value_cents, fee_cents, subtotal_cents,
             (SELECT count(*) FROM s_items WHERE s_items.order_id = s_orders.order_id) AS total_items,
             (SELECT count(DISTINCT product_id) FROM s_items WHERE s_items.order_id = s_orders.order_id) AS distinct_products,
             COALESCE((SELECT sum(quantity) FROM s_items WHERE s_items.order_id = s_orders.order_id), 0) AS total_quantity,
             delivery_address, ingest_date
      FROM s_orders""",
    "f_items": """
      SELECT order_item_id AS item_id, s_items.order_id, strftime(order_date, '%Y%m%d') AS date_key, order_date, unit_id AS unit_key,
             product_id AS product_key, quantity, price_cents, line_cents, order_type, order_status, observation, s_items.ingest_date
      FROM s_items JOIN s_orders ON s_items.order_id = s_orders.order_id""",
    "m_daily": f"""
      SELECT date_key, full_date AS order_date, year(full_date) AS year, month(full_date) AS month,
             monthname(full_date) AS month_name, strftime(full_date, '%Y-%m') AS year_month,
             dayname(full_date) AS day_of_week_name, dayofweek(full_date) IN (0, 6) AS is_weekend,
             count(DISTINCT order_id) AS total_orders,
             count(DISTINCT order_id) FILTER (order_type = 'ONLINE') AS online_orders,
             count(DISTINCT order_id) FILTER (order_type = 'PHYSICAL') AS physical_orders,
             CAST(sum(value_cents) AS BIGINT) AS revenue_cents,
             CAST(COALESCE(sum(value_cents) FILTER (order_type = 'ONLINE'), 0) AS BIGINT) AS online_cents,
             CAST(COALESCE(sum(value_cents) FILTER (order_type = 'PHYSICAL'), 0) AS BIGINT) AS physical_cents,
             {_average("sum(value_cents)", "count(value_cents)")} AS avg_order_value,
             CAST(sum(fee_cents) AS BIGINT) AS fee_cents,
             {_average("sum(fee_cents)", "count(fee_cents)")} AS avg_delivery_fee,
             CAST(sum(total_items) AS BIGINT) AS total_items_sold,
             {_count_average("sum(total_items)", "count(*)")} AS avg_items_per_order,
             count(DISTINCT unit_key) AS active_units,
             count(DISTINCT order_id) FILTER (order_status = 'Finalizado') AS completed_orders,
             count(DISTINCT order_id) FILTER (order_status = 'Cancelado') AS canceled_orders,
             count(DISTINCT order_id) FILTER (order_status = 'Pendente') AS pending_orders
      FROM d_days JOIN f_sales USING (date_key) GROUP BY date_key, full_date""",
    "m_units": f"""
      SELECT unit_id AS unit_key, unit_id, unit_name, state_name, country_name,
             count(DISTINCT order_id) AS total_orders,
             count(DISTINCT order_id) FILTER (order_type = 'ONLINE') AS online_orders,
             count(DISTINCT order_id) FILTER (order_type = 'PHYSICAL') AS physical_orders,
             CAST(sum(value_cents) AS BIGINT) AS revenue_cents,
             (2 * sum(value_cents) + count(value_cents)) // (2 * count(value_cents)) AS average_cents,
             CAST(sum(total_items) AS BIGINT) AS total_items_sold,
             {_count_average("sum(total_items)", "count(*)")} AS avg_items_per_order,
             count(DISTINCT order_id) FILTER (order_status = 'Finalizado') AS completed_orders,
             count(DISTINCT order_id) FILTER (order_status = 'Cancelado') AS canceled_orders,
             min(order_date) AS first_order_date, max(order_date) AS last_order_date,
             date_diff('day', min(order_date), max(order_date)) + 1 AS days_active,
             rank() OVER (ORDER BY sum(value_cents) DESC) AS revenue_rank,
             rank() OVER (ORDER BY count(DISTINCT order_id) DESC) AS order_volume_rank
      FROM s_units JOIN f_sales ON s_units.unit_id = f_sales.unit_key
      GROUP BY unit_id, unit_name, state_name, country_name""",
    "m_products": f"""
      SELECT id_produto AS product_key, id_produto AS product_id, trim(nome_produto) AS product_name,
             count(DISTINCT order_id) AS total_orders, count(DISTINCT item_id) AS total_line_items,
             CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
             {_count_average("sum(quantity)", "count(*)")} AS avg_quantity_per_order,
             CAST(sum(line_cents) AS BIGINT) AS revenue_cents,
             {_average("sum(price_cents)", "count(*)")} AS avg_unit_price,
             {_average("sum(line_cents)", "count(*)")} AS avg_line_value,
             count(DISTINCT unit_key) AS units_selling_product,
             (20000 * count(DISTINCT unit_key) + (SELECT count(*) FROM s_units)) // (2 * (SELECT count(*) FROM s_units)) AS penetration,
             min(order_date) AS first_sold_date, max(order_date) AS last_sold_date,
             rank() OVER (ORDER BY sum(line_cents) DESC) AS revenue_rank,
             rank() OVER (ORDER BY sum(quantity) DESC) AS volume_rank
      FROM b_products JOIN f_items ON b_products.id_produto = f_items.product_key
      GROUP BY id_produto, nome_produto""",
    "binned_orders": """
      SELECT least((v - low) * 10 // (high - low), 9) AS bin, low, high
      FROM (SELECT value_cents AS v, min(value_cents) OVER () AS low, max(value_cents) OVER () AS high
            FROM f_sales WHERE order_status <> 'Cancelado') AS kept""",
    "raw_orders": f"""
      SELECT CAST(o_custkey AS VARCHAR) AS unit_text, CAST(o_orderkey AS VARCHAR) AS order_text, {_ORDER_TYPE} AS type_text,
             CASE WHEN o_orderkey % 83 = 0 OR strftime(o_orderdate, '%Y-%m') = '1996-02' THEN 'invalid-date'
                  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_text,
             CASE WHEN o_orderkey % 97 = 0 THEN 'not_a_number' WHEN o_orderkey % 89 = 0 THEN NULL
                  ELSE CAST(CAST(o_totalprice AS DECIMAL(10, 2)) AS VARCHAR) END AS value_text,
             {_ADDRESS} AS address_text, {_FEE} AS fee_cents,
             CASE WHEN o_orderkey % 79 = 0 THEN 'Entregue' ELSE {_STATUS} END AS status_text,
             'raw/csv_sales/' || strftime(o_orderdate, '%Y/%m') || '/pedido.csv' AS source_file, o_orderkey AS row_position
      FROM orders
      UNION ALL
      SELECT CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), {_ORDER_TYPE},
             CASE WHEN o_orderkey % 83 = 0 OR strftime(o_orderdate, '%Y-%m') = '1996-02' THEN 'invalid-date'
                  ELSE strftime(o_orderdate, '%Y-%m-%d') END,
             CASE WHEN o_orderkey % 97 = 0 THEN 'not_a_number' WHEN o_orderkey % 89 = 0 THEN NULL
                  ELSE CAST(CAST(o_totalprice AS DECIMAL(10, 2)) AS VARCHAR) END,
             {_ADDRESS}, {_FEE}, 'Cancelado',
             'raw/csv_sales/' || strftime(o_orderdate, '%Y/%m') || '/pedido.csv', o_orderkey + 1000000000000000
      FROM orders WHERE {_TWICE}""",
    "checked_orders": """
      SELECT *, TRY_CAST(unit_text AS BIGINT) AS unit_id, TRY_CAST(date_text AS DATE) AS order_day,
             TRY_CAST(value_text AS DECIMAL(10, 2)) AS order_value,
             TRY_CAST(unit_text AS BIGINT) IS NULL OR order_text IS NULL OR TRY_CAST(date_text AS DATE) IS NULL
               OR TRY_CAST(value_text AS DECIMAL(10, 2)) IS NULL OR status_text IS NULL AS incomplete,
             status_text IN ('Finalizado', 'Pendente', 'Cancelado') AS known
      FROM raw_orders""",
    "numbered_orders": """
      SELECT *, row_number() OVER (PARTITION BY source_file, order_text, NOT incomplete AND known ORDER BY row_position) AS nth
      FROM checked_orders""",
    "file_counts": """
      SELECT source_file, count(*) AS rows_read, count(*) FILTER (incomplete) AS null_required,
             count(*) FILTER (NOT incomplete AND NOT known) AS invalid_status,
             count(*) FILTER (NOT incomplete AND known AND nth > 1) AS duplicates,
             count(*) FILTER (NOT incomplete AND known AND nth = 1) AS rows_kept
      FROM numbered_orders GROUP BY source_file""",
    "day_counts": """
      SELECT order_date, count(*) AS n FROM f_sales
      WHERE order_date BETWEEN DATE '2001-07-16' - 30 AND DATE '2001-07-16' GROUP BY order_date""",
    "samples": """
      SELECT event_id, ts, user_id AS host, event_type AS name, CAST(ROUND(value * 100) AS BIGINT) AS cents FROM events""",
    "files": """
      SELECT CASE WHEN name IN ('view', 'click') THEN 'objects' ELSE 'warehouse' END AS store,
             cents * 1024 // 100 AS length, ts AS modified FROM samples""",
    "jobs": """
      SELECT ts AS creation_time, CASE name WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'RUNNING' ELSE 'DONE' END AS state,
             cents * 1073741824 // 100 AS bytes FROM samples""",
    "store_usage": """
      SELECT store, CAST(sum(length) AS BIGINT) AS storage_bytes,
             ROUND(CAST(sum(length) AS DOUBLE) / 1073741824, 3) AS storage_gb,
             CASE store WHEN 'objects' THEN CAST(0.05 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS limit_gb,
             ROUND(CAST(sum(length) AS DOUBLE) / 1073741824 / CASE store WHEN 'objects' THEN CAST(0.05 AS DOUBLE)
                   ELSE CAST(0.5 AS DOUBLE) END * 100, 1) AS usage_pct
      FROM files GROUP BY store""",
    "steps": """
      SELECT *, date_trunc('hour', ts) AS window_start,
             lag(cents) OVER (PARTITION BY host, name ORDER BY ts, event_id) AS before
      FROM samples""",
    "rates": """
      SELECT host, name, window_start,
             CAST(COALESCE(sum(CASE WHEN before IS NULL THEN NULL WHEN cents >= before THEN cents - before ELSE cents END), 0) AS BIGINT)
               AS step_cents
      FROM steps GROUP BY host, name, window_start""",
    "minutes": """
      SELECT host, name, date_trunc('minute', ts) AS minute, arg_max(cents, (ts, event_id)) > 4000 AS beyond
      FROM samples GROUP BY host, name, date_trunc('minute', ts)""",
    "alert_minutes": """
      SELECT host, CASE name WHEN 'view' THEN 'cpu_pct' WHEN 'click' THEN 'memory_pct' WHEN 'error' THEN 'disk_pct'
                             WHEN 'signup' THEN 'exporter_up' ELSE 'targets_up' END AS name,
             date_trunc('minute', ts) AS minute, arg_max(cents, (ts, event_id)) AS cents
      FROM samples GROUP BY host, name, date_trunc('minute', ts)""",
    "starts": """
      SELECT *, beyond AND NOT COALESCE(lag(beyond) OVER (PARTITION BY host, name ORDER BY minute)
                AND minute - lag(minute) OVER (PARTITION BY host, name ORDER BY minute) <= INTERVAL 5 MINUTE, false) AS started
      FROM minutes""",
    "islands": """
      SELECT *, sum(CAST(started AS INTEGER)) OVER (PARTITION BY host, name ORDER BY minute) AS island FROM starts""",
    "last_values": """
      SELECT host, name, cents FROM samples
      QUALIFY row_number() OVER (PARTITION BY host, name ORDER BY ts DESC, event_id DESC) = 1""",
    "dotted": """
      SELECT event_id, CASE event_type
               WHEN 'view' THEN 'airflow.dag.dag_' || user_id || '.load.duration'
               WHEN 'click' THEN 'airflow.dagrun.duration.dag_' || user_id || '.run_1.success'
               WHEN 'error' THEN 'airflow.ti.finish.dag_' || user_id || '.load.failed'
               WHEN 'signup' THEN 'airflow.queue_' || user_id
               ELSE 'airflow.scheduler.tasks.running' END AS dotted, event_type, user_id
      FROM events""",
}


def _needs(sql: str) -> list[str]:
    """The CTEs a statement names, each after those it needs itself."""
    found: list[str] = []
    for name in CTES:
        if re.search(rf"\b{name}\b", sql) and CTES[name] != sql:
            for inner in [*_needs(CTES[name]), name]:
                if inner not in found:
                    found.append(inner)
    return found


def _statement(sql: str) -> str:
    # b_orders names the source table orders; a CTE never names itself
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in _needs(sql))
    return f"WITH {ctes}\n{sql}" if ctes else sql


def _money(cents: str, name: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100 AS {name}"


_DAILY_COLUMNS = f"""
  date_key, order_date, year, month, month_name, year_month, day_of_week_name, is_weekend, total_orders, online_orders,
  physical_orders, {_money("revenue_cents", "total_revenue")}, {_money("online_cents", "online_revenue")},
  {_money("physical_cents", "physical_revenue")}, avg_order_value, {_money("fee_cents", "total_delivery_fees")}, avg_delivery_fee,
  total_items_sold, avg_items_per_order, active_units, completed_orders, canceled_orders, pending_orders,
  {_percent("online_orders", "total_orders")} AS online_pct, {_percent("canceled_orders", "total_orders")} AS cancellation_rate"""

_SALES_COLUMNS = f"""
  order_id, date_key, order_date, unit_key, order_type, order_status, {_money("value_cents", "order_value")},
  {_money("fee_cents", "delivery_fee")}, {_money("subtotal_cents", "items_subtotal")}, total_items, distinct_products,
  CAST(total_quantity AS BIGINT) AS total_quantity, delivery_address, ingest_date AS _ingest_date"""

_ITEM_COLUMNS = f"""
  item_id, order_id, date_key, order_date, unit_key, product_key, quantity, {_money("price_cents", "unit_price")},
  {_money("line_cents", "total_item_value")}, order_type, order_status, observation, ingest_date AS _ingest_date"""

_LOADED = "TIMESTAMP '2002-01-01 00:00:00'"
_VALID = f"{_LOADED} AS _valid_from, '9999-12-31 23:59:59' AS _valid_to, true AS is_current"
_DAY = "DATE '2001-07-16'"
_RATE = "(20000 * canceled_orders + total_orders) // (2 * total_orders)"
_ONLINE_PCT = "(20000 * online_orders + total_orders) // (2 * total_orders)"

_RESULT = "check_name, check_category, layer, table_name, check_sql, result, expected_value, actual_value, details"


def _check(name: str, category: str, table: str, result: str, expected: str, actual: str, details: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, '{category}' AS check_category, 'gold' AS layer, '{table}' AS table_name, "
        f"'{CHECK_SQL[category]}' AS check_sql, {result} AS result, '{expected}' AS expected_value, {actual} AS actual_value, "
        f"{details} AS details FROM ({source}) AS measured"
    )


CHECKS: dict[str, str] = {
    "dq_freshness": _check(
        "freshness_fact_sales", "freshness", "fact_sales",
        "CASE WHEN n > 0 THEN 'pass' ELSE 'fail' END", ">0", "CAST(n AS VARCHAR)",
        "'{\"date_checked\":\"2001-07-16\"}'", f"SELECT count(*) AS n FROM f_sales WHERE order_date = {_DAY}",
    ),
    "dq_completeness": _check(
        "completeness_all_units", "completeness", "fact_sales",
        "CASE WHEN n >= 6 THEN 'pass' WHEN n >= 5.4 THEN 'warn' ELSE 'fail' END", "6", "CAST(n AS VARCHAR)",
        "'{\"missing_units\":' || CAST(6 - n AS VARCHAR) || '}'",
        f"SELECT count(DISTINCT unit_key) AS n FROM f_sales WHERE order_date = {_DAY}",
    ),
    "dq_accuracy": _check(
        "accuracy_cross_layer_totals", "accuracy", "fact_sales",
        "CASE WHEN silver IS NULL AND gold IS NULL THEN 'warn' WHEN abs(silver - gold) < 1 THEN 'pass' "
        "WHEN abs(silver - gold) < 100 THEN 'warn' ELSE 'fail' END", "diff < 0.01",
        "CAST(abs(silver - gold) * 0.01 AS VARCHAR)",
        "'{\"silver_total\":\"' || COALESCE(CAST(silver * 0.01 AS VARCHAR), 'N/A') || '\",\"gold_total\":\"' || COALESCE(CAST(gold * 0.01 AS VARCHAR), 'N/A') || '\"}'",
        "SELECT CAST((SELECT sum(line_cents) FROM s_items) AS DECIMAL(28, 0)) AS silver, "
        "CAST((SELECT sum(subtotal_cents) FROM f_sales) AS DECIMAL(28, 0)) AS gold",
    ),
    "dq_uniqueness": _check(
        "uniqueness_order_id", "uniqueness", "fact_sales",
        "CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END", "0 duplicates", "CAST(n AS VARCHAR) || ' duplicates found'",
        "'{\"sample_duplicates\":[]}'",
        "SELECT count(*) AS n FROM (SELECT order_id FROM f_sales GROUP BY order_id HAVING count(*) > 1 LIMIT 10) AS repeated",
    ),
    "dq_referential": _check(
        "referential_integrity_product", "referential", "fact_order_items",
        "CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END", "0 orphans", "CAST(n AS VARCHAR) || ' orphan records'", "'{}'",
        "SELECT count(*) AS n FROM f_items LEFT JOIN b_products ON product_key = id_produto WHERE id_produto IS NULL",
    ),
    "dq_uniqueness_faulty": _check(
        "uniqueness_order_id", "uniqueness", "fact_sales",
        "CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END", "0 duplicates", "CAST(n AS VARCHAR) || ' duplicates found'",
        "'{\"sample_duplicates\":[\"' || array_to_string(ids, '\",\"') || '\"]}'",
        "SELECT count(*) AS n, list_slice(list_sort(list(order_id)), 1, 5) AS ids FROM f_sales WHERE CAST(order_id AS BIGINT) % 7 = 0",
    ),
    "dq_referential_faulty": _check(
        "referential_integrity_product", "referential", "fact_order_items",
        "CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END", "0 orphans", "CAST(n AS VARCHAR) || ' orphan records'", "'{}'",
        "SELECT count(*) AS n FROM f_items LEFT JOIN (SELECT id_produto FROM b_products WHERE id_produto % 10 <> 3) AS known "
        "ON product_key = id_produto WHERE id_produto IS NULL",
    ),
    "dq_volume_anomaly": _check(
        "volume_anomaly_detection", "volume", "fact_sales",
        "CASE WHEN z <= 2 THEN 'pass' ELSE 'warn' END", "z_score <= 2.0",
        "CASE WHEN z IS NULL THEN 'insufficient data' ELSE printf('z_score = %.2f', z) END",
        "'{\"avg_orders\":\"' || COALESCE(CAST(ROUND(mean, 4) AS VARCHAR), 'N/A') || '\",\"today_orders\":\"' || COALESCE(CAST(today AS VARCHAR), 'N/A') || '\"}'",
        "SELECT *, abs(today - mean) / NULLIF(deviation, 0) AS z FROM (SELECT "
        f"avg(n) FILTER (order_date < {_DAY}) AS mean, stddev_samp(n) FILTER (order_date < {_DAY}) AS deviation, "
        f"max(n) FILTER (order_date = {_DAY}) AS today FROM day_counts) AS moments",
    ),
}
_ALL_CHECKS = " UNION ALL ".join(sql for name, sql in CHECKS.items() if not name.endswith("_faulty"))

_COUNTED = {
    "bronze.orders": "b_orders", "bronze.order_items": "b_items", "bronze.products": "b_products", "bronze.units": "b_units",
    "bronze.states": "b_states", "bronze.countries": "b_countries", "silver.orders": "s_orders", "silver.order_items": "s_items",
    "silver.products": "b_products", "silver.units": "s_units", "silver.states": "b_states", "silver.countries": "b_countries",
    "gold.dim_date": "d_days", "gold.dim_product": "b_products", "gold.dim_unit": "s_units", "gold.dim_geography": "b_states",
    "gold.fact_sales": "f_sales", "gold.fact_order_items": "f_items", "gold.agg_daily_sales": "m_daily",
    "gold.agg_unit_performance": "m_units", "gold.agg_product_performance": "m_products",
}

_EVENTS_END = "TIMESTAMP '2024-01-31 00:00:00'"
_SOME_ORDERS = (
    "order_date BETWEEN DATE '1996-03-15' AND DATE '1998-09-30' AND order_type IN ('ONLINE', 'PHYSICAL') "
    "AND order_status IN ('Finalizado', 'Pendente')"
)


def _trend(where: str = "") -> str:
    return f"""SELECT order_date, {_money("revenue_cents", "total_revenue")}, {_money("online_cents", "online_revenue")},
      {_money("physical_cents", "physical_revenue")} FROM m_daily {where}"""


def _product_table(where: str = "") -> str:
    return f"""SELECT revenue_rank, product_name, {_money("revenue_cents", "total_revenue")}, total_quantity_sold, total_orders,
      avg_unit_price, {_one_decimal("penetration")} AS unit_penetration_pct FROM m_products {where}"""


def _fee_trend(where: str = "") -> str:
    return f"""SELECT order_date, {_average("sum(fee_cents)", "count(fee_cents)")} AS avg_delivery_fee,
      {_money("sum(fee_cents)", "total_delivery_fees")} FROM f_sales {where} GROUP BY order_date"""


def _metric_row(name: str, value: str, unit: str) -> str:
    return (
        "SELECT 'daily_pipeline' AS dag_id, 'run_1' AS dag_run_id, 'notify_completion' AS task_id, "
        f"'{name}' AS metric_name, CAST({value} AS DOUBLE) AS metric_value, '{unit}' AS metric_unit, {_DAY} AS execution_date, "
        "TIMESTAMP '2002-01-01 12:00:00' AS execution_timestamp, '{}' AS details"
    )


def _silent(title: str, metric: str, no_data: str) -> str:
    return f"""
      SELECT host, name, '{title}' AS alert, last_seen, '{no_data}' AS state
      FROM (SELECT host, name, max(ts) AS last_seen FROM (
        SELECT host, ts, CASE name WHEN 'view' THEN 'cpu_pct' WHEN 'click' THEN 'memory_pct' WHEN 'error' THEN 'disk_pct'
                                   WHEN 'signup' THEN 'exporter_up' ELSE 'targets_up' END AS name FROM samples) AS named
        WHERE name = '{metric}' GROUP BY host, name) AS latest
      WHERE epoch({_EVENTS_END}) - floor(epoch(last_seen)) > 300"""


def _alert(title: str, metric: str, comparison: str, threshold: int, hold: int) -> str:
    sign = ">" if comparison == "gt" else "<"
    return f"""
      SELECT host, name, min(minute) AS breach_start, max(minute) AS breach_end, count(*) AS evaluations,
             date_diff('minute', min(minute), max(minute)) AS held_minutes, '{title}' AS alert
      FROM (SELECT *, sum(CAST(breaks AS INTEGER)) OVER (PARTITION BY host ORDER BY minute) AS stretch
            FROM (SELECT *, NOT cents {sign} {threshold * 100}
                            OR COALESCE(minute - lag(minute) OVER (PARTITION BY host ORDER BY minute) > INTERVAL 5 MINUTE, true) AS breaks
                  FROM alert_minutes WHERE name = '{metric}') AS marked) AS numbered
      WHERE cents {sign} {threshold * 100} GROUP BY host, name, stretch
      HAVING date_diff('minute', min(minute), max(minute)) >= {hold}"""


SELECTS: dict[str, str] = {
    # ingestion
    "validate_coercion": f"""SELECT order_text AS Id_Pedido, row_position, unit_id AS Id_Unidade, order_day AS Data_Pedido,
      CAST(order_value AS DOUBLE) AS Vlr_Pedido, {_money("fee_cents", "Taxa_Entrega")} FROM checked_orders""",
    "validated_orders": f"""SELECT unit_id AS Id_Unidade, order_text AS Id_Pedido, type_text AS Tipo_Pedido, order_day AS Data_Pedido,
      CAST(order_value AS DOUBLE) AS Vlr_Pedido, address_text AS Endereco_Entrega, {_money("fee_cents", "Taxa_Entrega")},
      status_text AS Status, source_file, row_position FROM numbered_orders WHERE NOT incomplete AND known AND nth = 1""",
    "validated_items": """
      SELECT CAST(l_orderkey AS VARCHAR) AS Id_Pedido,
             CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS Id_Item_Pedido, l_partkey AS Id_Produto,
             CAST(l_quantity AS BIGINT) AS Qtd, CAST(CAST(l_extendedprice AS DECIMAL(10, 2)) AS DOUBLE) AS Vlr_Item,
             CAST(NULL AS VARCHAR) AS Observacao, 'raw/csv_sales/' || strftime(l_shipdate, '%Y/%m') || '/item_pedido.csv' AS source_file,
             date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) * 1000000000000 + l_partkey AS row_position
      FROM lineitem WHERE l_orderkey % 71 <> 0 AND l_orderkey % 73 <> 0 AND l_orderkey % 67 <> 0
      QUALIFY row_number() OVER (PARTITION BY strftime(l_shipdate, '%Y/%m'), l_orderkey, l_linenumber
                                 ORDER BY CAST(l_shipdate AS DATE), l_partkey) = 1""",
    "validation_report": """
      SELECT *, concat_ws('; ',
               CASE WHEN null_required > 0 THEN 'Dropped ' || null_required || ' rows with null required fields' END,
               CASE WHEN invalid_status > 0 THEN 'Dropped ' || invalid_status || ' rows with invalid Status' END,
               CASE WHEN duplicates > 0 THEN 'Removed ' || duplicates || ' duplicate orders' END) AS messages
      FROM file_counts""",
    "rejected_files": "SELECT source_file, 'No valid rows after validation' AS error FROM file_counts WHERE rows_kept = 0",
    "quarantine_report": """
      SELECT source_file, 'No valid rows after validation' AS error,
             replace(source_file, 'raw/csv_sales/', 'quarantine/') AS quarantine_path,
             replace(replace(source_file, 'raw/csv_sales/', 'quarantine/'), '.csv', '_error.json') AS report_path,
             '{"source_file":"' || source_file || '","error":"No valid rows after validation","timestamp":"2002-01-01T12:00:00+00:00"}'
               AS report
      FROM file_counts WHERE rows_kept = 0""",
    "bronze_orders_lineage": f"""SELECT unit_id AS id_unidade, order_text AS id_pedido, type_text AS tipo_pedido,
      order_day AS data_pedido, CAST(order_value AS DOUBLE) AS vlr_pedido, address_text AS endereco_entrega,
      {_money("fee_cents", "taxa_entrega")}, status_text AS status, source_file AS _source_file,
      TIMESTAMP '2002-01-01 12:00:00' AS _ingest_timestamp, DATE '2002-01-01' AS _ingest_date
      FROM numbered_orders WHERE NOT incomplete AND known AND nth = 1""",
    "bronze_reference": """
      SELECT table_name, CAST(id AS BIGINT) AS id, name, TIMESTAMP '2002-01-01 12:00:00' AS _ingest_timestamp FROM (
        SELECT 'countries' AS table_name, id_pais AS id, nome_pais AS name FROM b_countries
        UNION ALL SELECT 'states', id_estado, nome_estado FROM b_states
        UNION ALL SELECT 'units', id_unidade, nome_unidade FROM b_units
        UNION ALL SELECT 'products', id_produto, nome_produto FROM b_products) AS every""",
    "insert_if_absent": """
      SELECT id_unidade, nome_unidade, CAST(id_estado AS BIGINT) AS id_estado FROM b_units
      WHERE id_unidade NOT IN (SELECT id_unidade FROM b_orders WHERE year(data_pedido) = 1995)""",
    "bronze_summary": f"SELECT count(*) AS row_count, {_money('sum(value_cents)', 'total_value')} FROM b_orders",
    "bronze_latest": f"""
      SELECT id_unidade, id_pedido, tipo_pedido, data_pedido, {_money("value_cents", "vlr_pedido")}, endereco_entrega,
             {_money("fee_cents", "taxa_entrega")}, status, source_file AS _source_file, ingested_at AS _ingest_timestamp,
             ingest_date AS _ingest_date
      FROM b_orders ORDER BY ingested_at DESC, id_pedido LIMIT 5""",
    # silver
    "silver_products": f"SELECT id_produto AS product_id, trim(nome_produto) AS product_name, {_LOADED} AS _updated_at FROM b_products",
    "silver_states": f"""SELECT CAST(id_estado AS BIGINT) AS state_id, CAST(id_pais AS BIGINT) AS country_id,
      trim(nome_estado) AS state_name, {_LOADED} AS _updated_at FROM b_states""",
    "silver_countries": f"""SELECT CAST(id_pais AS BIGINT) AS country_id, trim(nome_pais) AS country_name, {_LOADED} AS _updated_at
      FROM b_countries""",
    "silver_units": f"""SELECT unit_id, unit_name, CAST(state_id AS BIGINT) AS state_id, state_name,
      CAST(country_id AS BIGINT) AS country_id, country_name, {_LOADED} AS _updated_at FROM s_units""",
    "silver_orders": f"""
      SELECT order_id, unit_id, order_type, order_status, order_date, year(order_date) AS order_year, month(order_date) AS order_month,
             day(order_date) AS order_day, dayname(order_date) AS order_day_of_week, {_money("value_cents", "order_value")},
             {_money("fee_cents", "delivery_fee")}, {_money("subtotal_cents", "items_subtotal")}, delivery_address,
             source_file AS _source_file, ingested_at AS _ingest_timestamp, ingest_date AS _ingest_date
      FROM s_orders""",
    "silver_order_items": f"""
      SELECT order_item_id, order_id, product_id, quantity, {_money("price_cents", "unit_price")},
             {_money("line_cents", "total_item_value")}, observation, source_file AS _source_file,
             CAST(ingest_date AS TIMESTAMP) AS _ingest_timestamp, ingest_date AS _ingest_date
      FROM s_items""",
    "items_enriched": f"""
      SELECT order_item_id AS item_id, s_items.order_id, order_date, {_money("price_cents", "unit_price")}, quantity,
             trim(nome_produto) AS product_name, unit_name, state_name, year(order_date) AS year, month(order_date) AS month,
             dayname(order_date) AS day_of_week
      FROM s_items LEFT JOIN s_orders ON s_items.order_id = s_orders.order_id
        LEFT JOIN b_products ON product_id = id_produto LEFT JOIN s_units ON s_orders.unit_id = s_units.unit_id""",
    # gold
    "dim_date": """
      SELECT date_key, full_date, year(full_date) AS year, quarter(full_date) AS quarter,
             CAST(year(full_date) AS VARCHAR) || '-Q' || CAST(quarter(full_date) AS VARCHAR) AS year_quarter,
             month(full_date) AS month, monthname(full_date) AS month_name, strftime(full_date, '%Y-%m') AS year_month,
             CAST(strftime(full_date, '%U') AS BIGINT) AS week_of_year, weekofyear(full_date) AS iso_week,
             day(full_date) AS day_of_month, dayofweek(full_date) + 1 AS day_of_week_num, dayname(full_date) AS day_of_week_name,
             strftime(full_date, '%a') AS day_of_week_abbrev, dayofyear(full_date) AS day_of_year,
             dayofweek(full_date) IN (0, 6) AS is_weekend, dayofweek(full_date) BETWEEN 1 AND 5 AS is_weekday,
             date_diff('day', CAST(date_trunc('month', full_date) AS DATE), full_date) + 1 AS day_in_month,
             last_day(full_date) AS last_day_of_month, CAST(date_trunc('month', full_date) AS DATE) AS first_day_of_month
      FROM d_days""",
    "dim_product": f"SELECT id_produto AS product_key, id_produto AS product_id, trim(nome_produto) AS product_name, {_VALID} FROM b_products",
    "dim_unit": f"""SELECT unit_id AS unit_key, unit_id, unit_name, CAST(state_id AS BIGINT) AS state_id, state_name,
      CAST(country_id AS BIGINT) AS country_id, country_name, {_VALID} FROM s_units""",
    "dim_geography": """
      SELECT CAST(id_estado AS BIGINT) AS geography_key, CAST(id_estado AS BIGINT) AS state_id, trim(nome_estado) AS state_name,
             CAST(b_countries.id_pais AS BIGINT) AS country_id, trim(nome_pais) AS country_name
      FROM b_states JOIN b_countries ON b_states.id_pais = b_countries.id_pais""",
    "fact_sales": f"SELECT {_SALES_COLUMNS} FROM f_sales",
    "fact_order_items": f"SELECT {_ITEM_COLUMNS} FROM f_items",
    "agg_daily_sales": f"SELECT {_DAILY_COLUMNS} FROM m_daily",
    "agg_unit_performance": f"""
      SELECT unit_key, unit_id, unit_name, state_name, country_name, total_orders, online_orders, physical_orders,
             {_money("revenue_cents", "total_revenue")}, {_money("average_cents", "avg_order_value")}, total_items_sold,
             avg_items_per_order, completed_orders, canceled_orders, {_money(_RATE, "cancellation_rate")},
             {_money(_ONLINE_PCT, "online_pct")}, first_order_date, last_order_date, days_active, revenue_rank, order_volume_rank
      FROM m_units""",
    "agg_product_performance": f"""
      SELECT product_key, product_id, product_name, total_orders, total_line_items, total_quantity_sold, avg_quantity_per_order,
             {_money("revenue_cents", "total_revenue")}, avg_unit_price, avg_line_value, units_selling_product,
             {_money("penetration", "unit_penetration_pct")}, first_sold_date, last_sold_date, revenue_rank, volume_rank
      FROM m_products""",
    # executive overview
    "exec_total_revenue": f"SELECT {_money('sum(revenue_cents)', 'total_revenue')} FROM m_daily",
    "exec_total_orders": "SELECT CAST(sum(total_orders) AS BIGINT) AS total_orders FROM m_daily",
    "exec_avg_order_value": f"SELECT {_average('sum(revenue_cents)', 'sum(total_orders)')} AS avg_order_value FROM m_daily",
    "exec_cancellation_rate": f"SELECT {_percent('sum(canceled_orders)', 'sum(total_orders)')} AS cancellation_rate FROM m_daily",
    "exec_revenue_trend": _trend(),
    "exec_orders_by_channel": """
      SELECT 'Online' AS channel, CAST(sum(online_orders) AS BIGINT) AS orders FROM m_daily
      UNION ALL SELECT 'Physical', CAST(sum(physical_orders) AS BIGINT) FROM m_daily""",
    "exec_revenue_by_weekday": f"""SELECT day_of_week_name, {_money("sum(revenue_cents)", "total_revenue")},
      CAST(sum(total_orders) AS BIGINT) AS total_orders FROM m_daily GROUP BY day_of_week_name""",
    "exec_weekend_vs_weekday": f"""SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS period_type,
      {_money("sum(revenue_cents)", "total_revenue")} FROM m_daily GROUP BY is_weekend""",
    "latest_days": f"""SELECT order_date, total_orders, {_money("revenue_cents", "total_revenue")}, avg_order_value,
      {_percent("online_orders", "total_orders")} AS online_pct, {_percent("canceled_orders", "total_orders")} AS cancellation_rate
      FROM m_daily ORDER BY order_date DESC LIMIT 5""",
    # units
    "units_top_revenue": f"""SELECT unit_name, {_money("revenue_cents", "total_revenue")} FROM m_units
      ORDER BY revenue_cents DESC, unit_key LIMIT 10""",
    "units_ranking": f"""SELECT revenue_rank, unit_name, state_name, total_orders, {_money("revenue_cents", "total_revenue")},
      {_money("average_cents", "avg_order_value")}, {_one_decimal(_RATE)} AS cancellation_rate, {_one_decimal(_ONLINE_PCT)} AS online_pct
      FROM m_units""",
    "units_online_pct": f"""SELECT unit_name, {_one_decimal(_ONLINE_PCT)} AS online_pct FROM m_units
      ORDER BY {_ONLINE_PCT} DESC, unit_key LIMIT 10""",
    "units_cancellation_rate": f"""SELECT unit_name, {_one_decimal(_RATE)} AS cancellation_rate FROM m_units
      WHERE {_RATE} > 0 ORDER BY {_RATE} DESC, unit_key LIMIT 10""",
    "units_revenue_by_state": f"""SELECT state_name, {_money("sum(revenue_cents)", "total_revenue")},
      CAST(sum(total_orders) AS BIGINT) AS total_orders, count(*) AS unit_count FROM m_units GROUP BY state_name""",
    "units_avg_order_value": f"""SELECT unit_name, {_money("average_cents", "avg_order_value")} FROM m_units
      ORDER BY average_cents DESC, unit_key LIMIT 10""",
    # products
    "prod_top_revenue": f"""SELECT product_name, {_money("revenue_cents", "total_revenue")} FROM m_products
      ORDER BY revenue_cents DESC, product_key LIMIT 10""",
    "prod_top_volume": """SELECT product_name, total_quantity_sold FROM m_products
      ORDER BY total_quantity_sold DESC, product_key LIMIT 10""",
    "prod_full_table": _product_table(),
    "prod_unit_penetration": f"""SELECT product_name, {_one_decimal("penetration")} AS unit_penetration_pct FROM m_products
      ORDER BY penetration DESC, product_key LIMIT 15""",
    "prod_price_vs_revenue": f"""SELECT product_name, avg_unit_price, {_money("revenue_cents", "total_revenue")}, total_quantity_sold
      FROM m_products""",
    # orders
    "orders_delivery_fee_trend": _fee_trend(),
    "orders_value_histogram": """
      SELECT bin + 1 AS bin, CAST((2 * (10 * low + (high - low) * bin) + 10) // 20 AS DOUBLE) / 100 AS range_from,
             CAST((2 * (10 * low + (high - low) * (bin + 1)) + 10) // 20 AS DOUBLE) / 100 AS range_to, count(*) AS order_count
      FROM binned_orders GROUP BY bin, low, high""",
    "orders_status_breakdown": "SELECT order_status, count(*) AS order_count FROM f_sales GROUP BY order_status",
    "orders_items_per_order": f"SELECT {_count_average('sum(total_items)', 'count(*)')} AS avg_items_per_order FROM f_sales",
    "orders_revenue_by_channel": f"""SELECT order_type, {_money("sum(value_cents)", "total_revenue")}, count(*) AS order_count,
      {_average("sum(value_cents)", "count(*)")} AS avg_order_value FROM f_sales GROUP BY order_type""",
    "orders_top_orders": f"""SELECT order_id, order_date, order_type, order_status, total_items, {_money("value_cents", "order_value")},
      {_money("fee_cents", "delivery_fee")} FROM f_sales ORDER BY value_cents DESC, order_id LIMIT 20""",
    # samples
    "star_join_top10": f"""
      SELECT strftime(full_date, '%Y-%m') AS year_month, state_name, unit_name, count(DISTINCT order_id) AS total_orders,
             {_money("sum(value_cents)", "total_revenue")}, {_average("sum(value_cents)", "count(*)")} AS avg_order_value
      FROM f_sales JOIN d_days USING (date_key) JOIN s_units ON unit_key = unit_id GROUP BY 1, 2, 3
      ORDER BY sum(value_cents) DESC, 1, 3, 2 LIMIT 10""",
    "revenue_by_month": f"""SELECT strftime(full_date, '%Y-%m') AS year_month, count(*) AS total_orders,
      {_money("sum(value_cents)", "total_revenue")} FROM f_sales JOIN d_days USING (date_key) GROUP BY 1""",
    "fact_detail_sample": f"""SELECT full_date, unit_name, order_id, {_money("value_cents", "order_value")}
      FROM f_sales JOIN d_days USING (date_key) JOIN s_units ON unit_key = unit_id ORDER BY full_date, order_id LIMIT 10""",
    "item_breakdown": f"""SELECT order_id, item_id, trim(nome_produto) AS product_name, quantity, {_money("price_cents", "unit_price")},
      {_money("line_cents", "total_item_value")} FROM f_items LEFT JOIN b_products ON product_key = id_produto""",
    "product_unit_matrix": """SELECT id_produto AS product_key, trim(nome_produto) AS product_name,
      count(DISTINCT unit_key) AS unit_count FROM f_items JOIN b_products ON product_key = id_produto GROUP BY 1, 2""",
    "fee_by_channel": f"""SELECT order_type, {_average("sum(fee_cents)", "count(fee_cents)")} AS avg_delivery_fee,
      {_money("sum(fee_cents)", "total_delivery_fees")} FROM f_sales GROUP BY order_type""",
    # filters and charts
    "filter_date_range": _trend("WHERE order_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"),
    "filter_in_list": f"""SELECT order_id, order_date, order_type, order_status, {_money("value_cents", "order_value")}
      FROM f_sales WHERE {_SOME_ORDERS}""",
    "filter_state": f"""SELECT unit_name, {_money("revenue_cents", "total_revenue")} FROM m_units
      WHERE state_name IN ('NATION_1', 'NATION_2', 'NATION_3') ORDER BY revenue_cents DESC, unit_key LIMIT 10""",
    "filter_product": _product_table("WHERE product_name IN ('small ring', 'red widget')"),
    "filter_relative_range": _trend("WHERE order_date BETWEEN DATE '2001-06-16' AND DATE '2001-07-16'"),
    "filtered_fee_trend": _fee_trend(f"WHERE {_SOME_ORDERS}"),
    "chart_wrapper": f"""SELECT day_of_week_name, max(total_revenue) AS total_revenue FROM (
      SELECT day_of_week_name, {_money("sum(revenue_cents)", "total_revenue")} FROM m_daily GROUP BY day_of_week_name) AS inner_query
      GROUP BY day_of_week_name ORDER BY total_revenue DESC LIMIT 50""",
    "chart_line": f"SELECT * FROM ({_trend()}) AS inner_query ORDER BY order_date LIMIT 10000",
    # quality
    **CHECKS,
    "dq_all": _ALL_CHECKS,
    "dq_failures": f"SELECT * FROM ({_ALL_CHECKS}) AS results WHERE result = 'fail'",
    "dq_log_rows": f"""SELECT CAST(12 AS BIGINT) AS check_id_length, {_RESULT}, {_DAY} AS execution_date,
      TIMESTAMP '2002-01-01 12:00:00' AS execution_timestamp, 'run_1' AS dag_run_id, CAST(0 AS DOUBLE) AS duration_seconds
      FROM ({_ALL_CHECKS}) AS results""",
    "dq_latest": f"""SELECT check_name, result, actual_value, TIMESTAMP '2002-01-01 12:00:00' AS execution_timestamp
      FROM ({_ALL_CHECKS}) AS results ORDER BY check_name LIMIT 10""",
    "dq_boolean": """
      SELECT 'fee_within_value' AS check_name, 'accuracy' AS check_category, 'gold' AS layer, 'fact_sales' AS table_name,
             'SELECT count_if(order_value < delivery_fee) = 0 FROM {sales}' AS check_sql, verdict AS result,
             'True' AS expected_value, verdict AS actual_value, '{}' AS details
      FROM (SELECT CASE WHEN count(*) FILTER (value_cents < fee_cents) = 0 THEN 'pass' ELSE 'fail' END AS verdict FROM f_sales) AS c""",
    "dq_gate": f"SELECT count(*) AS row_count, count(*) >= 2 AS ready FROM f_sales WHERE order_date = {_DAY}",
    "dq_silver_gate": """
      SELECT 'orders_not_empty' AS check_name, count(*) > 0 AS passed FROM s_orders
      UNION ALL SELECT 'order_items_not_empty', count(*) > 0 FROM s_items
      UNION ALL SELECT 'no_null_order_ids', count(*) = 0 FROM s_orders WHERE order_id IS NULL""",
    "dq_gold_gate": """
      SELECT 'fact_sales_not_empty' AS check_name, count(*) > 0 AS passed FROM f_sales
      UNION ALL SELECT 'dims_populated', count(*) > 0 FROM b_products
      UNION ALL SELECT 'no_orphan_units', count(*) = 0 FROM f_sales LEFT JOIN s_units ON unit_key = unit_id WHERE unit_id IS NULL""",
    "dq_layer_gate": """
      SELECT 'bronze.orders' AS table_name, count(*) > 0 AS passed FROM b_orders
      UNION ALL SELECT 'gold.fact_sales', count(*) > 0 FROM f_sales""",
    "dq_reference": """
      SELECT name || '_row_count' AS check_name, actual, expected, CASE WHEN actual >= expected THEN 'OK' ELSE 'WARN' END AS status
      FROM (SELECT 'products' AS name, count(*) AS actual, CAST(30 AS BIGINT) AS expected FROM b_products
            UNION ALL SELECT 'units', count(*), 50 FROM b_units
            UNION ALL SELECT 'states', count(*), 27 FROM b_states
            UNION ALL SELECT 'countries', count(*), 1 FROM b_countries) AS counted
      UNION ALL
      SELECT 'orphan_units', count(*), 0, CASE WHEN count(*) = 0 THEN 'OK' ELSE 'WARN' END
      FROM b_units LEFT JOIN b_states USING (id_estado) WHERE b_states.id_pais IS NULL""",
    "dq_orphans": """
      SELECT 'unit' AS kind, id_unidade AS id, nome_unidade AS name FROM b_units
      WHERE NOT EXISTS (SELECT 1 FROM b_states WHERE b_states.id_estado = b_units.id_estado)
      UNION ALL
      SELECT 'state', CAST(id_estado AS BIGINT), nome_estado FROM b_states
      WHERE NOT EXISTS (SELECT 1 FROM b_countries WHERE b_countries.id_pais = b_states.id_pais)""",
    "dq_orphans_faulty": """
      SELECT 'unit' AS kind, id_unidade AS id, nome_unidade AS name FROM b_units WHERE id_estado % 5 = 2
         OR NOT EXISTS (SELECT 1 FROM b_states WHERE b_states.id_estado = b_units.id_estado)
      UNION ALL
      SELECT 'state', CAST(id_estado AS BIGINT), nome_estado FROM b_states WHERE id_estado % 5 <> 2
        AND NOT EXISTS (SELECT 1 FROM b_countries WHERE b_countries.id_pais = b_states.id_pais AND id_pais <> 1)""",
    "dq_day_gate": "SELECT 'days_covered' AS check_name, count(*) = 0 AS passed FROM f_sales WHERE date_key NOT IN (SELECT date_key FROM d_days)",
    "dq_rates": """
      SELECT 'null_rate' AS check_name, ROUND(CAST(nulls AS DOUBLE) / (n * 4), 6) AS rate,
             CASE WHEN CAST(nulls AS DOUBLE) / (n * 4) > 0.05 THEN 'fail' ELSE 'pass' END AS result
      FROM (SELECT count(*) AS n, 4 * count(*) - count(data_pedido) - count(value_cents) - count(fee_cents) - count(status) AS nulls
            FROM b_orders) AS cells
      UNION ALL
      SELECT 'duplicate_rate', ROUND(1 - CAST(keys AS DOUBLE) / n, 6),
             CASE WHEN 1 - CAST(keys AS DOUBLE) / n > 0.01 THEN 'fail' ELSE 'pass' END
      FROM (SELECT count(*) AS n, count(DISTINCT id_pedido) AS keys FROM b_orders) AS ids""",
    "dq_bronze_age": """
      SELECT latest AS latest_ingest, date_diff('second', latest, TIMESTAMP '2001-08-03 12:00:00') // 3600 AS age_hours,
             date_diff('second', latest, TIMESTAMP '2001-08-03 12:00:00') > 86400 AS stale
      FROM (SELECT max(ingested_at) AS latest FROM b_orders) AS newest""",
    # maintenance
    "detect_gaps": """
      SELECT full_date AS missing_date FROM d_days
      WHERE full_date BETWEEN DATE '2001-08-02' - 2404 AND DATE '2001-08-01'
        AND full_date NOT IN (SELECT order_date FROM f_sales)""",
    "validate_backfill": """
      SELECT missing_date FROM (
        SELECT full_date AS missing_date FROM d_days
        WHERE full_date BETWEEN DATE '2001-08-02' - 2404 AND DATE '2001-08-01' AND full_date NOT IN (SELECT order_date FROM f_sales)
        ORDER BY 1 LIMIT 7) AS gaps
      WHERE missing_date NOT IN (SELECT data_pedido FROM b_orders)""",
    "retention_rows": """
      SELECT 'bronze.orders' AS table_name, count(*) FILTER (ingest_date < DATE '2001-08-02' - 90) AS expired_rows,
             count(*) FILTER (ingest_date >= DATE '2001-08-02' - 90) AS kept_rows FROM b_orders
      UNION ALL
      SELECT 'bronze.order_items', count(*) FILTER (ingest_date < DATE '2001-08-02' - 90),
             count(*) FILTER (ingest_date >= DATE '2001-08-02' - 90) FROM b_items""",
    "retention_files": f"""
      SELECT count(*) FILTER (old) AS deleted_count, CAST(COALESCE(sum(length) FILTER (old), 0) AS BIGINT) AS deleted_bytes,
             count(*) FILTER (NOT old) AS skipped_count, true AS dry_run
      FROM (SELECT length, modified < {_EVENTS_END} - INTERVAL 10 DAY AS old FROM files) AS aged""",
    "storage_usage": "SELECT * FROM store_usage",
    "usage_alert": "SELECT * FROM store_usage WHERE usage_pct > 80",
    "storage_alert": """SELECT ROUND(CAST(sum(length) AS DOUBLE) / 1073741824, 2) AS storage_gb,
      ROUND(CAST(sum(length) AS DOUBLE) / 1073741824, 2) > 8 AS alert FROM files""",
    "usage_snapshot": f"""
      SELECT CAST({_EVENTS_END} AS DATE) AS snapshot_date, {_EVENTS_END} AS snapshot_timestamp,
             o.storage_bytes AS gcs_storage_bytes, o.storage_gb AS gcs_storage_gb, o.limit_gb AS gcs_limit_gb, o.usage_pct AS gcs_usage_pct,
             w.storage_bytes AS bq_storage_bytes, w.storage_gb AS bq_storage_gb, w.limit_gb AS bq_limit_gb, w.usage_pct AS bq_usage_pct,
             CAST(0 AS BIGINT) AS bq_query_bytes_month, CAST(0 AS DOUBLE) AS bq_query_tb_month,
             CAST(1 AS DOUBLE) AS bq_query_limit_tb, CAST(0 AS DOUBLE) AS bq_query_usage_pct,
             '{{"source":"data_retention"}}' AS details
      FROM (SELECT * FROM store_usage WHERE store = 'objects') AS o, (SELECT * FROM store_usage WHERE store = 'warehouse') AS w""",
    "layer_comparison": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {before}) AS bronze_rows, (SELECT count(*) FROM {after}) AS silver_rows, "
        f"(SELECT count(*) FROM {after}) - (SELECT count(*) FROM {before}) AS change"
        for name, before, after in (
            ("orders", "b_orders", "s_orders"),
            ("order_items", "b_items", "s_items"),
            ("products", "b_products", "b_products"),
            ("units", "b_units", "s_units"),
        )
    ),
    "table_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {cte}" for name, cte in _COUNTED.items()
    ),
    "run_metrics": " UNION ALL ".join(
        (
            _metric_row("pipeline_status", "1", "boolean"),
            _metric_row("duration", "90", "seconds"),
            _metric_row(
                "rows_processed",
                "(SELECT count(*) FROM s_orders) + (SELECT count(*) FROM f_sales) + (SELECT count(*) FROM m_daily)",
                "rows",
            ),
        )
    ),
    "event_metrics": """
      SELECT 'dag_' || user_id AS dag_id, 'run_' || event_id AS dag_run_id, event_type AS task_id,
             CASE event_type WHEN 'error' THEN 'task_failure' WHEN 'click' THEN 'sla_miss' ELSE 'quality_failure' END AS metric_name,
             CASE event_type WHEN 'view' THEN CAST(2 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS metric_value,
             CASE event_type WHEN 'view' THEN 'checks' ELSE 'event' END AS metric_unit,
             CAST(ts AS DATE) AS execution_date, ts AS execution_timestamp,
             CASE event_type WHEN 'error' THEN '{"error":"' || replace(props, '"', '\\"') || '"}'
                             WHEN 'click' THEN '{"tasks":["click"]}' ELSE '{"failed_checks":["freshness","view"]}' END AS details
      FROM events WHERE event_type IN ('error', 'click', 'view')""",
    "data_age_hours": """
      SELECT last AS last_order_date, date_diff('second', CAST(last AS TIMESTAMP), TIMESTAMP '2001-08-03 12:00:00') // 3600 AS hours_since_last_data,
             date_diff('second', CAST(last AS TIMESTAMP), TIMESTAMP '2001-08-03 12:00:00') // 3600 > 48 AS alert
      FROM (SELECT max(order_date) AS last FROM f_sales) AS newest""",
    "job_usage": f"""
      SELECT CAST(creation_time AS DATE) AS query_date, CAST(sum(bytes) AS DOUBLE) / 1000000000000 AS tb_processed,
             ROUND(CAST(sum(bytes) AS DOUBLE) * 5 / 1000000000000, 2) AS estimated_cost
      FROM jobs WHERE creation_time >= {_EVENTS_END} - INTERVAL 30 DAY GROUP BY 1""",
    "query_volume": f"""
      SELECT ROUND(CAST(sum(bytes) AS DOUBLE) / 1073741824, 2) AS query_gb,
             ROUND(CAST(sum(bytes) AS DOUBLE) / 1073741824, 2) > 800 AS alert
      FROM jobs WHERE state = 'DONE' AND creation_time > {_EVENTS_END} - INTERVAL 20 DAY""",
    # streams
    "stream_dedup": f"SELECT event_id, ts, user_id, event_type, {_money('CAST(ROUND(value * 100) AS BIGINT)', 'value')} FROM events",
    "stream_two_hour_rollup": """
      SELECT w AS window_start, w + INTERVAL 2 HOUR AS window_end,
             'window_' || strftime(w, '%H') || strftime(w + INTERVAL 2 HOUR, '%H') AS window_label, event_type,
             count(*) AS event_count, CAST(sum(CAST(ROUND(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS total
      FROM (SELECT *, time_bucket(INTERVAL 2 HOUR, ts, TIMESTAMP '2000-01-01 00:00:00') AS w FROM events) AS bucketed
      GROUP BY w, event_type""",
    # metric series
    "metric_rate": f"SELECT host, name, window_start, {_money('step_cents', 'increase')}, CAST(step_cents AS DOUBLE) / 100 / 3600 AS rate FROM rates",
    "metric_rate_by_label": f"""SELECT name, window_start, {_money("sum(step_cents)", "increase")},
      CAST(sum(step_cents) AS DOUBLE) / 100 / 3600 AS rate FROM rates GROUP BY name, window_start""",
    "metric_cpu_pct": """SELECT window_start, 100 - CAST(sum(step_cents) AS DOUBLE) / 100 / count(*) / 3600 * 100 AS cpu_pct
      FROM rates WHERE name = 'view' GROUP BY window_start""",
    "metric_gauge_pct": """
      SELECT host, (1 - (CAST(a.cents AS DOUBLE) / 100) / (CAST(t.cents AS DOUBLE) / 100)) * 100 AS used_pct
      FROM (SELECT * FROM last_values WHERE name = 'view') AS a JOIN (SELECT * FROM last_values WHERE name = 'click') AS t USING (host)""",
    "metric_sustained_breach": """
      SELECT host, name, min(minute) AS breach_start, max(minute) AS breach_end, count(*) AS evaluations,
             date_diff('minute', min(minute), max(minute)) AS held_minutes
      FROM islands WHERE beyond GROUP BY host, name, island HAVING date_diff('minute', min(minute), max(minute)) >= 5""",
    "metric_alerts": " UNION ALL ".join(_alert(*rule[:5]) for rule in ALERT_RULES),
    "metric_no_data": " UNION ALL ".join(_silent(rule[0], rule[1], rule[5]) for rule in ALERT_RULES),
    "metric_targets_up": """SELECT CAST(sum(cents) AS DOUBLE) / 100 AS targets_up, sum(cents) < 200 AS alert
      FROM last_values WHERE name = 'signup'""",
    "metric_name_labels": """
      SELECT event_id, dotted,
             CASE event_type WHEN 'view' THEN 'airflow_dag_task_duration_seconds'
                             WHEN 'click' THEN 'airflow_dagrun_duration_success_seconds'
                             WHEN 'error' THEN 'airflow_task_instance_finished_total'
                             WHEN 'signup' THEN 'airflow_queue_' || user_id ELSE 'airflow_scheduler_tasks_running' END AS metric,
             CASE event_type WHEN 'view' THEN '{"dag_id":"dag_' || user_id || '","task_id":"load"}'
                             WHEN 'click' THEN '{"dag_id":"dag_' || user_id || '","run_id":"run_1"}'
                             WHEN 'error' THEN '{"dag_id":"dag_' || user_id || '","task_id":"load","state":"failed"}'
                             WHEN 'signup' THEN '{"airflow_metric":"queue_' || user_id || '"}' ELSE '{}' END AS labels
      FROM dotted""",
    "metric_slo": f"""
      SELECT hour, p95_duration, success_pct, failures, p95_duration > 600 AS slow, success_pct < 95 AS unreliable, failures > 5 AS failing
      FROM (SELECT date_trunc('hour', ts) AS hour,
                   CAST(quantile_disc(cents, 0.95) FILTER (name = 'view') AS DOUBLE) / 100 AS p95_duration,
                   {_percent("count(*) FILTER (name = 'signup')", "count(*) FILTER (name IN ('signup', 'error'))")} AS success_pct,
                   count(*) FILTER (name = 'error') AS failures
            FROM samples GROUP BY 1) AS hours""",
    "metric_heartbeat": f"""
      SELECT host, name, max(ts) AS last_seen, CAST(epoch({_EVENTS_END}) - floor(epoch(max(ts))) AS BIGINT) AS age_seconds,
             epoch({_EVENTS_END}) - floor(epoch(max(ts))) > 300 AS alert
      FROM samples GROUP BY host, name""",
}


# What the landing files give: the rows that are valid, but for the month whose files lack a column.
for _name in ("orders", "items"):
    _file = "pedido" if _name == "orders" else "item_pedido"
    SELECTS[f"landing_{_name}"] = f"""SELECT * EXCLUDE (row_position) FROM ({SELECTS[f"validated_{_name}"]}) AS landed
      WHERE source_file <> 'raw/csv_sales/1999/01/{_file}.csv'"""

SELECTS["stream_landing_orders"] = f"""SELECT * FROM ({SELECTS["bronze_orders_lineage"]}) AS landed
  WHERE _source_file <> 'raw/csv_sales/1999/01/pedido.csv'"""
SELECTS["stream_quarantine"] = """SELECT source_file, 'No valid rows after validation' AS error, rows_read AS lines_kept FROM file_counts
  WHERE rows_kept = 0 OR source_file = 'raw/csv_sales/1999/01/pedido.csv'"""
# An item waits twenty days for its order, and orders are remembered for sixty.
SELECTS["stream_late_items"] = """SELECT * FROM (
  WITH seen AS (SELECT id_pedido, ingested_at + CASE WHEN CAST(id_pedido AS BIGINT) % 7 = 0 THEN INTERVAL 90 DAYS ELSE INTERVAL 0 DAYS END AS moment FROM b_orders),
  sent AS (SELECT id_item_pedido, id_pedido, CAST(ingest_date AS TIMESTAMP) AS moment FROM b_items),
  ends AS (SELECT least((SELECT max(moment) FROM seen), (SELECT max(moment) FROM sent)) - INTERVAL 1 HOUR AS watermark),
  decided AS (
    SELECT DISTINCT sent.id_item_pedido, sent.id_pedido, 'released' AS state FROM sent JOIN seen ON sent.id_pedido = seen.id_pedido
      AND seen.moment BETWEEN sent.moment - INTERVAL 60 DAYS AND sent.moment + INTERVAL 20 DAYS
    UNION ALL
    SELECT DISTINCT id_item_pedido, id_pedido, 'expired' FROM sent, ends WHERE sent.moment + INTERVAL 20 DAYS < watermark AND NOT EXISTS (
      SELECT 1 FROM seen WHERE seen.id_pedido = sent.id_pedido AND seen.moment BETWEEN sent.moment - INTERVAL 60 DAYS AND sent.moment + INTERVAL 20 DAYS))
  SELECT * FROM decided
  UNION ALL SELECT DISTINCT id_item_pedido, id_pedido, 'waiting' FROM sent AS s
    WHERE NOT EXISTS (SELECT 1 FROM decided WHERE decided.id_item_pedido = s.id_item_pedido AND decided.id_pedido = s.id_pedido)) AS states"""
SELECTS["stream_sustained_breach"] = SELECTS["metric_sustained_breach"]
SELECTS["active_units_by_month"] = "SELECT strftime(order_date, '%Y-%m') AS year_month, count(DISTINCT unit_id) AS active_units FROM s_orders GROUP BY 1"
# What a refresh or another storage gives is what the full rebuild gives.
SELECTS |= {
    "refresh_silver_orders": SELECTS["silver_orders"],
    "refresh_silver_items": SELECTS["silver_order_items"],
    "refresh_fact_sales": SELECTS["fact_sales"],
    "refresh_fact_order_items": SELECTS["fact_order_items"],
    "refresh_daily_sales": SELECTS["agg_daily_sales"],
    "fact_sales_by_order": SELECTS["fact_sales"],
    "fact_order_items_by_order": SELECTS["fact_order_items"],
}


def oracle_sql() -> dict[str, str]:
    return {name: _statement(sql) for name, sql in SELECTS.items()}
