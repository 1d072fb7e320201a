"""Surrogate keys without a single-partition window.

A window with no partition key sends every row to one task. Here rows are
range-partitioned by the key order instead, numbered inside each range, and
shifted by the number of rows in the ranges before it. Only the table of shifts
(one row per range and group) is ever gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialize

# monotonically_increasing_id() keeps the partition above this bit and the row below it.
_ROW_BITS = 33

CHUNK_ROWS = 1 << 16
TASK_ROWS = 1 << 22


def dense_key(
    df: DataFrame,
    order: Sequence[str],
    key: str,
    key_type: str = "bigint",
    within: Sequence[str] = (),
) -> DataFrame:
    """Append `key` = 1..N in the order of `order`, starting over for each value of `within`.

    The rows of `df` must differ in `within` + `order`, which makes the ids a
    function of the data alone. `within` must be free of NULLs and must have few
    values, since each of them takes a row of the shift table.
    """
    placed = materialize(
        df.orderBy(*within, *order).withColumn("_place", F.monotonically_increasing_id()), "keys"
    ).withColumn("_range", F.shiftright("_place", _ROW_BITS))
    before = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        placed.groupBy(*within, "_range")
        .agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .select(
            *within,
            "_range",
            (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        )
    )
    return (
        placed.join(F.broadcast(shifts), [*within, "_range"])
        .withColumn(key, (F.col("_place") + F.col("_shift")).cast(key_type))
        .drop("_place", "_range", "_shift")
    )


def extend_key(
    df: DataFrame, order: Sequence[str], key: str, known: DataFrame, within: Sequence[str]
) -> DataFrame:
    """The rows of `known` (`within`, `order` and `key`) and those of `df` it lacks, numbered from its highest key on.

    Keys of `known` never change. New rows are found by an anti join in which NULLs equal each other, and
    numbered as `dense_key` does; only the highest key of each value of `within` is gathered.
    """
    columns = [*within, *order]
    fresh, held = df.select(*columns).alias("f"), known.select(*columns).alias("h")
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"h.{c}")) for c in columns]
    added = dense_key(fresh.join(held, same, "left_anti"), order, key, within=within)
    highest = known.groupBy(*within).agg(F.max(key).alias("_highest"))
    shifted = added.join(F.broadcast(highest), list(within), "left")
    number = (F.col(key) + F.coalesce("_highest", F.lit(0))).alias(key)
    return known.select(*columns, F.col(key).cast("bigint")).unionByName(shifted.select(*columns, number))


def occurrence_key(
    groups: DataFrame,
    order: Sequence[str],
    repeats: str,
    key: str,
    key_type: str = "bigint",
) -> DataFrame:
    """Emit each row of `groups` `repeats` times, numbering all copies 1..total in `order`.

    Equal to a row number over the ungrouped rows. A group gets a contiguous
    span of ids by a running total; the span is cut into chunks, the chunks are
    spread over tasks, and only then expanded, so that a group holding a third
    of all rows is written by as many tasks as its size calls for.
    """
    ranged = materialize(
        groups.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "keys"
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.sum(repeats).alias("_rows"))
    shifts = totals.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    running = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("_shift") + F.sum(repeats).over(running)
    spans = (
        ranged.join(F.broadcast(shifts), "_range")
        .withColumn("_last", last)
        .withColumn("_first", F.col("_last") - F.col(repeats) + 1)
    )

    total = ranged.agg(F.sum(repeats)).first()[0] or 0
    cores = groups.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-total // TASK_ROWS), min(cores, -(-total // CHUNK_ROWS)), 1)
    chunks = (
        spans.withColumn("_start", F.explode(F.sequence("_first", "_last", F.lit(CHUNK_ROWS).cast("bigint"))))
        .withColumn("_stop", F.least(F.col("_start") + (CHUNK_ROWS - 1), F.col("_last")))
        .drop(repeats, "_range", "_shift", "_first", "_last")
        .repartition(int(tasks), "_start")
    )
    expanded = F.explode(F.sequence("_start", "_stop"))
    if key_type != "bigint":
        expanded = F.explode(F.sequence(F.col("_start").cast(key_type), F.col("_stop").cast(key_type)))
    return chunks.withColumn(key, expanded).drop("_start", "_stop")
