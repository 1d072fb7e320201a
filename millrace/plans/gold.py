"""Publishing the silver tables as the gold layer."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.registry import TABLES
from millrace.sources.tables import Store, write_all


def publish_gold(
    store: Store,
    keys: Iterable[str] = tuple(TABLES),
    database: str | None = None,
    views: bool = False,
    counts: dict[str, int] | None = None,
) -> list[str]:
    """Publish tables in their contract column order; returns the published names.

    `counts` is given the rows of each exported table, counted while they are written.

    By default every table is exported to its gold path. `database` creates or
    replaces catalog tables over the gold paths as well, and `views` registers
    temporary views over silver, which moves no data.
    """
    jobs, names = [], []
    for key in keys:
        spec = TABLES[key]
        rows = store.read_silver(key).select(*spec.columns)
        names.append(spec.table)
        if views:
            rows.createOrReplaceTempView(spec.table)
        elif database:
            jobs.append(partial(_save_table, rows, f"{database}.{spec.table}", store.gold(key)))
        else:
            jobs.append(partial(_export, store, key, rows, counts))
    write_all(store.spark, jobs)
    return names


def _export(store: Store, key: str, rows: DataFrame, counts: dict[str, int] | None) -> None:
    """Write one table to its gold path, observing how many rows pass."""
    if counts is None:
        store.write_gold(key, rows)
        return
    seen = Observation()
    store.write_gold(key, rows.observe(seen, F.count(F.lit(1)).alias("n")))
    counts[TABLES[key].table] = seen.get["n"]


def _save_table(rows: DataFrame, name: str, location: str | None) -> None:
    writer = rows.write.mode("overwrite").format("parquet")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def create_table(
    spark: SparkSession, name: str, path: str, columns: Sequence[str] | None = None, location: str | None = None
) -> DataFrame:
    """Create or replace the catalog table `name` from the Parquet data at `path`, and return it.

    It gets `columns` in that order, or all, and lies at `location`, or where the catalog puts it.
    """
    rows = spark.read.parquet(path)
    _save_table(rows.select(*columns) if columns else rows, name, location)
    return spark.table(name)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n) for each table, as one query."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, counts)
