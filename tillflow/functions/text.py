"""Text cells of landing files turned into typed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The tokens that a CSV reader with pandas' defaults takes as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


# The time of an ISO timestamp; its date is taken as it is written.
_TIME_OF_DAY = r"(?<=^\d{4}-\d\d-\d\d)[T ]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?(Z|[+-]\d\d:?\d\d)?$"


def present(cell: Column) -> Column:
    """The cell, or null where its text stands for a missing value."""
    return F.when(~cell.isin(*NULL_TOKENS), cell)


def typed(cell: Column, kind: T.DataType) -> Column:
    """Read a text cell as ``kind``; text that does not fit becomes null, as do the missing-value tokens.

    Numbers go through exact decimals, never through doubles. A whole number may be written with a
    fraction of zeros ("3.0"). A timestamp gives its day.
    """
    if isinstance(kind, T.DateType):
        day = F.regexp_replace(F.trim(cell), _TIME_OF_DAY, "")
        return F.try_to_date(day, "yyyy-MM-dd")
    if isinstance(kind, T.DecimalType):
        return cell.try_cast(kind)
    if isinstance(kind, T.LongType):
        number = cell.try_cast(T.DecimalType(25, 6))
        return F.when(number == F.floor(number), number).try_cast("bigint")
    return present(cell)


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))
