"""Column expressions shared by the plans. All of them stay inside the JVM."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.registry import AUDIT_COLUMNS

_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1
_NUMBER = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d{1,3})?)\s*$"


def int_or_null(df: DataFrame, name: str) -> Column:
    """`name` as int: fractions are cut, anything malformed or out of range is NULL.

    Bad values are filtered out before the cast. try_cast would raise and catch
    an exception for each of them, which costs more than the rest of the scan.
    """
    value = df[name]
    if isinstance(df.schema[name].dataType, T.StringType):
        value = F.nullif(F.regexp_extract(value, _NUMBER, 1), F.lit("")).cast("double")
    fits = (value > F.lit(_INT_MIN - 1)) & (value < F.lit(_INT_MAX + 1))
    return F.when(fits, value).cast("int").alias(name)


def audit_columns(as_of: datetime.datetime | Column | None = None) -> list[Column]:
    """Created and updated stamps: `as_of`, or the start of the query."""
    if as_of is None:
        stamp = F.current_timestamp()
    else:
        stamp = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return [stamp.alias(name) for name in AUDIT_COLUMNS]


def row_bytes(df: DataFrame) -> Column:
    """Approximate bytes one row takes in a hash table: text length plus fixed cost per field."""
    size = F.lit(32).cast("bigint")
    for field in df.schema.fields:
        size = size + F.lit(16)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(df[field.name]), F.lit(0))
    return size
