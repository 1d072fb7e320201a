"""Which landing files have been merged, by the file each record came from.

Every merged record keeps the path of its landing file, so the ledger is the data itself: it can
neither run ahead of a lost job nor fall behind a finished one, and batches and streams share it.
Reading it scans one column that holds a run of equal values per file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.landing import landing_files, read_landing
from millrace.session import remove
from millrace.sources.tables import LINEAGE, Store

_FILE = f"{LINEAGE} string"

#: What silver covers: the landing file, the highest Product_ID when it was added, and the build or batch that did.
_COVERED = f"{_FILE}, last_product bigint, part string"

#: Name of the part that a whole build covers.
WHOLE = "whole"


def merged_files(store: Store, batch: bool = True, stream: bool = True) -> DataFrame:
    """The distinct landing files held by the batch part of bronze, its stream part, or both."""
    parts = [path for path, wanted in ((store.bronze, batch), (store.bronze_stream, stream)) if wanted and store.exists(path)]
    tables = [store.spark.read.parquet(path) for path in parts]
    held = [t.select(LINEAGE) for t in tables if LINEAGE in t.columns]
    if not held:
        return store.spark.createDataFrame([], _FILE)
    return reduce(DataFrame.union, held).distinct().filter(F.col(LINEAGE).isNotNull())


def pending_files(store: Store, landing: str, pattern: str | None = None, batch: bool = True, stream: bool = True) -> list[str]:
    """The landing files not merged yet: the listing without the ledger, by an anti join.

    Paths are gathered as Spark's own file listing does; no record is read.
    """
    listing = landing_files(store.spark, landing, pattern).select(F.col("file").alias(LINEAGE))
    return sorted(r[0] for r in listing.join(merged_files(store, batch, stream), LINEAGE, "left_anti").collect())


def read_pending(store: Store, landing: str, infer: bool, pattern: str | None, batch: bool, stream: bool) -> DataFrame:
    """The records of the files not merged yet, each with its file; an empty table if there are none."""
    if not merged_files(store, batch, stream).isEmpty():
        files = pending_files(store, landing, pattern, batch, stream)
        if not files:
            return read_landing(store.spark, landing, infer, pattern, lineage=True).limit(0)
        return read_landing(store.spark, files, infer, pattern, lineage=True)
    return read_landing(store.spark, landing, infer, pattern, lineage=True)


def covered_files(store: Store) -> DataFrame:
    """(landing file, last_product, part) of all that the core tables of silver cover; empty without a finished build."""
    if not store.exists(store.covered):
        return store.spark.createDataFrame([], _COVERED)
    return store.spark.read.schema(_COVERED).parquet(store.covered)


def cover(store: Store, files: DataFrame, last_product: int, part: str) -> None:
    """Record that silver covers the landing files of `files`, as a build or a batch is done."""
    rows = files.select(LINEAGE, F.lit(last_product).cast("bigint").alias("last_product"))
    store.replace(f"{store.covered}/part={part}", rows)


def uncover(store: Store) -> None:
    """Forget what silver covers, as its tables are about to be replaced."""
    remove(store.spark, store.covered)
