"""Stamps that outlive a run: what an earlier table says about rows of the next one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.joins import SHARES
from millrace.registry import AUDIT_COLUMNS, ENTITIES
from millrace.session import TABLE_CODEC, materialize

#: Columns that say which thing a row is about; the others say how it is.
NATURAL_KEYS = {
    "customers": ("Customer_ID",),
    "addresses": ("Customer_ID",),
    "products": ("Product_Name", "Product_Type_ID", "Brand_ID", "Category_ID"),
    "transactions": ("Transaction_ID",),
}

#: Columns that number rows rather than describe them.
NUMBERS = {"products": ("Product_ID",)}


def carry_stamps(rows: DataFrame, before: DataFrame, key: str, keep_missing: bool = False) -> DataFrame:
    """`rows` of a core table with the stamps of the table `before` them where these still hold.

    A row that is in `before` as it is keeps both stamps. One that differs, but whose natural key is there,
    keeps Created_Date and has its own Updated_Date; a new key has its own stamps. Where a key has several
    rows, the earliest creation counts. `keep_missing` also keeps the rows of `before` whose key is gone.

    Rows are compared column by column, with NULLs equal to each other. `before` is reduced to distinct contents and
    keys before it is joined, so a row of `rows` never multiplies and one that repeats often can be split by
    adaptive execution; where no content holds many rows, none needs that, and the contents stay where they were
    grouped. All rows are moved once, to meet their contents; what that gives is written to scratch, and of
    the rows it leaves without a stamp first the keys alone meet those of `before`, so that these rows are moved
    again only where many of them have a key that is there.
    """
    created, updated = AUDIT_COLUMNS
    columns = ENTITIES[key].columns
    natural = NATURAL_KEYS[key]
    content = [c for c in columns if c not in AUDIT_COLUMNS and c not in NUMBERS.get(key, ())]

    def same(names) -> list:
        return [F.col(f"r.{c}").eqNullSafe(F.col(f"b.{c}")) for c in names]

    stamps = [F.min(created).alias("_created"), F.max(updated).alias("_updated")]
    if set(natural) == set(content) or not _spread_evenly(rows, before, content):
        contents, met = before.groupBy(*content).agg(*stamps).alias("b"), same(content)
    else:
        names = [f"_key{i}" for i in range(len(content) + 1)]
        keyed = before.withColumns(dict(zip(names, _stand_ins(before, content))))
        contents = keyed.groupBy(*names).agg(*stamps).alias("b")
        met = [key == F.col(f"b.{name}") for key, name in zip(_stand_ins(rows, content, "r."), names)]
    equal = rows.alias("r").join(contents, met, "left").select("r.*", "b._created", "b._updated")
    stamp = F.coalesce("_updated", updated)
    if set(natural) == set(content):  # a content that is not there is a key that is not there
        done = equal.withColumn(created, F.coalesce("_created", created)).withColumn(updated, stamp).select(*columns)
    else:
        equal = materialize(equal, "carried", TABLE_CODEC)
        old, fresh = equal.where(F.col("_created").isNotNull()), equal.where(F.col("_created").isNull())
        keys = before.groupBy(*natural).agg(F.min(created).alias("_first"))
        shared = fresh.select(*natural).distinct().alias("r").join(keys.alias("b"), same(natural)).select("b.*")
        fresh = fresh.alias("r").join(materialize(shared, "shared", TABLE_CODEC).alias("b"), same(natural), "left").select("r.*", "b._first")
        old = old.withColumn(created, F.col("_created")).withColumn(updated, stamp).select(*columns)
        fresh = fresh.withColumn(created, F.coalesce("_first", created)).withColumn(updated, stamp).select(*columns)
        done = old.union(fresh)
    if keep_missing:
        there = rows.select(*natural).distinct()
        gone = before.alias("r").join(there.alias("b"), same(natural), "left_anti")
        done = done.union(gone.select(*columns))
    return done


def _spread_evenly(rows: DataFrame, before: DataFrame, content: list[str]) -> bool:
    """Whether both tables hold the same types and no content more of the rows than half a task's share.

    Rows are counted in as many buckets of contents as make a usual one a small part of that; a content
    that holds more can't hide in a bucket, and only the fullest one's number is gathered.
    """
    if any(rows.schema[c].dataType != before.schema[c].dataType for c in content):
        return False
    shares = SHARES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = rows.groupBy(F.pmod(F.xxhash64(*content), F.lit(4 * shares)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    most, whole = buckets.agg(F.max("n"), F.sum("n")).first()
    return most is None or most * shares <= whole


def _stand_ins(df: DataFrame, names: list[str], place: str = "") -> list[Column]:
    """Values that are equal exactly where those of `names` are, with NULLs equal to each other and NaNs too.

    None of them is NULL or a floating number, for which joins would hash something else than groups do. Where
    a number can't be taken as it is, its 64 bit hash does, as no two values of eight bytes share one.
    """
    values, missing = [], F.lit(0)
    for i, name in enumerate(names):
        column, kind = F.col(f"{place}{name}"), df.schema[name].dataType
        if isinstance(kind, T.StringType):
            values.append(F.coalesce(column, F.lit("")))
        elif isinstance(kind, T.IntegralType):
            values.append(F.coalesce(column, F.lit(0).cast(kind)))
        elif isinstance(kind, (T.FractionalType, T.DateType, T.TimestampType, T.TimestampNTZType)) and not isinstance(kind, T.DecimalType):
            values.append(F.xxhash64(column))
        else:
            values.append(F.struct(column))
        missing = missing + F.when(column.isNull(), F.lit(1 << i)).otherwise(F.lit(0))
    return [*values, missing]
