"""Attaching lookups to records, with the broadcast decision made on measured sizes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import row_bytes

# Session setting for the largest table that is broadcast, and its default.
BROADCAST_SETTING = "spark.millrace.broadcastBytes"
BROADCAST_BYTES = 64 * 1024 * 1024

# Shares of the records per shuffle partition; a key that holds more than one share is split.
SHARES = 2
# Keys a sketch follows per share, which keeps its error below half a share.
_FOLLOWED = 8


@dataclass(frozen=True)
class Match:
    """Join `table` to the records where each record column equals its table column.

    The matched table columns are dropped from the result; the others are kept.
    """

    table: DataFrame
    on: Mapping[str, str]  # record column -> table column


def measure(tables: Sequence[DataFrame]) -> list[int]:
    """Bytes held by each table, counted in one job."""
    sizes = [table.select(F.lit(i).alias("table"), row_bytes(table).alias("bytes")) for i, table in enumerate(tables)]
    sums = reduce(DataFrame.union, sizes).groupBy("table").agg(F.sum("bytes").alias("bytes"))
    found = {row["table"]: row["bytes"] for row in sums.collect()}
    return [found.get(i, 0) for i in range(len(tables))]


def _hash(columns: Sequence[Column]) -> Column:
    """One number for a key; NULL if a part of it is, as such a key matches nothing."""
    missing = reduce(Column.__or__, [column.isNull() for column in columns])
    return F.when(~missing, F.xxhash64(*columns))


def hot_keys(records: DataFrame, keys: Sequence[Sequence[str]]) -> list[dict[int, int]]:
    """For each list of key columns, the hashes of its hot keys and the number of salts each calls for.

    A key is hot if it holds more than one share of the records, of which there are `SHARES` per
    shuffle partition; it gets a salt for each share. All lists are counted in one pass over
    the key columns by frequency sketches, merged from all tasks. No more keys than shares can be hot,
    which bounds what reaches the driver and is broadcast.
    """
    partitions = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = min(SHARES * partitions, 50_000)
    followed = min(_FOLLOWED * shares, 1_000_000)
    sketches = [
        F.call_function("approx_top_k", _hash([F.col(f"`{c}`") for c in columns]), F.lit(shares), F.lit(followed)).alias(f"k{i}")
        for i, columns in enumerate(keys)
    ]
    found = records.agg(F.count(F.lit(1)).alias("n"), *sketches).first()
    return [
        {top["item"]: -(-top["count"] * shares // found["n"]) for top in found[f"k{i}"]
         if top["item"] is not None and top["count"] * shares > found["n"]}
        for i in range(len(keys))
    ]


def attach(
    records: DataFrame,
    matches: Sequence[Match],
    how: str = "left",
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Join every match to `records` in turn.

    `how` is left or inner; joins that keep unmatched table rows would depend on
    how the table is dealt out. Tables are broadcast, which costs no shuffle, as
    long as all of them together stay within `broadcast_bytes`, the session's
    setting unless given. A further one is joined on its key and a salt. Hot keys are
    found by counting first (`hot_keys`) and get as many salts as their records call for,
    and only their table rows are copied; records without a key, which can't
    match, are spread over all tasks. The salt is taken from the whole record, so that a lost task
    is repeated alike; equal records share one, and adaptive skew handling splits those.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how}")
    if broadcast_bytes is None:
        broadcast_bytes = int(records.sparkSession.conf.get(BROADCAST_SETTING, str(BROADCAST_BYTES)))
    left, large = broadcast_bytes, []
    for i, size in enumerate(measure([m.table for m in matches])):
        if size <= left:
            left -= size
        else:
            large.append(i)
    hot = dict(zip(large, hot_keys(records, [list(matches[i].on) for i in large]) if large else []))
    for i, match in enumerate(matches):
        records = _join_salted(records, match, how, hot[i]) if i in hot else _join_broadcast(records, match, how)
    return records


def _renamed(match: Match) -> tuple[DataFrame, dict[str, str]]:
    """The table with its key columns out of the way, and their names by record column."""
    keys = {column: f"_key{i}" for i, column in enumerate(match.on.values())}
    return match.table.withColumnsRenamed(keys), {column: keys[target] for column, target in match.on.items()}


def _join_broadcast(records: DataFrame, match: Match, how: str) -> DataFrame:
    table, keys = _renamed(match)
    conditions = [F.col(f"`{column}`") == F.col(key) for column, key in keys.items()]
    return records.join(F.broadcast(table), conditions, how).drop(*keys.values())


def _join_salted(records: DataFrame, match: Match, how: str, hot: dict[int, int]) -> DataFrame:
    spark = records.sparkSession
    table, keys = _renamed(match)
    salts = F.broadcast(spark.createDataFrame(list(hot.items()), "_hash bigint, _salts int"))
    number = F.coalesce("_salts", F.lit(1))
    # a table's key is hashed as the type of the record's column, as equal numbers of two types differ in theirs
    own = [F.col(f"`{column}`") for column in keys]
    others = [F.col(key).try_cast(records.schema[column].dataType) for column, key in keys.items()]
    copies = table.withColumn("_hash", _hash(others)).join(salts, "_hash", "left")
    copies = copies.withColumn("_copy", F.explode(F.sequence(F.lit(0), number - 1))).drop("_hash", "_salts")

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = F.xxhash64(*[records[f"`{c}`"] for c in records.columns])
    # the table holds no negative salts, and needs none for keys that are NULL
    salt = F.when(F.col("_hash").isNull(), -1 - F.pmod(spread, F.lit(4 * partitions))).otherwise(F.pmod(spread, number))
    salted = records.withColumn("_hash", _hash(own)).join(salts, "_hash", "left")
    salted = salted.withColumn("_salt", salt.cast("int")).drop("_hash", "_salts")
    conditions = [F.col(f"`{column}`") == F.col(key) for column, key in keys.items()]
    joined = salted.join(copies, [*conditions, F.col("_salt") == F.col("_copy")], how)
    return joined.drop(*keys.values(), "_salt", "_copy")
