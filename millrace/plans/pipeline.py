"""Bronze to silver to gold, as plain calls."""

from __future__ import annotations

import datetime
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.plans.entities import (
    Stamp,
    build_addresses,
    build_customers,
    build_products,
    build_transactions,
)
from millrace.plans.gold import publish_gold
from millrace.plans.history import carry_stamps
from millrace.plans.lookups import build_lookups
from millrace.registry import BY_PATH, LANDING_PATTERN, LOOKUPS, TABLES
from millrace.session import materialize, scratch_run
from millrace.sources.ledger import WHOLE, cover, covered_files, read_pending, uncover
from millrace.sources.tables import LINEAGE, Store, write_all


def merge_landing(
    store: Store, landing: str | None = None, infer: bool = False, num_files: int | None = None, only_new: bool = False,
    pattern: str | None = None,
) -> DataFrame:
    """Merge the landing CSV files into the bronze table and return it.

    A merge starts the batch part of bronze anew; with `only_new` it adds the files that no merge has
    held before. Files that a stream has merged are left out either way, so each file is in bronze once,
    in whatever order batches and streams run. A file is known by its path: one that is written
    again under its old name is no new file. `pattern` says which names are landing files.
    """
    pattern = pattern or (None if landing else LANDING_PATTERN)
    records = read_pending(store, landing or store.landing, infer, pattern, batch=only_new, stream=True)
    store.write_bronze(records, num_files, append=only_new)
    return store.read_bronze()


def build_silver(
    store: Store, mode: str = BY_PATH, as_of: Stamp = None, key_type: str = "bigint", keep: bool = False
) -> None:
    """Build the eleven lookups and the four core tables from bronze; scratch data goes with the last write.

    Batches added before (`add_to_silver`) are replaced too, as bronze holds their records. A build that
    fails has to be repeated before batches are added again.

    The core tables depend on the lookups but not on each other. `key_type` is that of Product_ID.
    `keep` carries over what the silver tables already hold: lookup ids stay and new names get higher
    ones, and stamps change only for rows that changed.
    """
    with scratch_run(store.spark, store.base):
        _build_silver(store, mode, datetime.datetime.now() if as_of is None else as_of, key_type, keep)


def _build_silver(store: Store, mode: str, as_of: Stamp, key_type: str, keep: bool) -> None:
    bronze = store.read_bronze(lineage=True)
    known = {key: store.read_silver(key) for key in LOOKUPS if store.exists(store.silver(key))} if keep else {}
    if set(known) not in (set(), set(LOOKUPS)):
        raise ValueError(f"only some lookups are there: {sorted(known)}")
    uncover(store)
    lookups = _write_lookups(store, bronze, mode, known)
    builders = _builders(mode, key_type)
    write_all(
        store.spark,
        [partial(_write_entity, store, key, builder, bronze, lookups, as_of, keep) for key, builder in builders.items()],
    )
    if LINEAGE in bronze.columns:
        last = store.read_silver("products").agg(F.max("Product_ID")).first()[0] or 0
        cover(store, bronze.select(LINEAGE).distinct(), last, WHOLE)


def _write_lookups(store: Store, records: DataFrame, mode: str, known: dict[str, DataFrame]) -> dict[str, DataFrame]:
    built = build_lookups(records, mode=mode, known=known or None)
    write_all(store.spark, [partial(store.write_silver, key, table) for key, table in built.items()])
    return {key: store.read_silver(key) for key in LOOKUPS}


def _builders(mode: str, key_type: str) -> dict:
    return {
        "addresses": partial(build_addresses, mode=mode),
        "customers": build_customers,
        "products": partial(build_products, mode=mode, key_type=key_type),
        "transactions": build_transactions,
    }


def add_to_silver(
    store: Store, records: DataFrame, batch: str, mode: str = BY_PATH, as_of: Stamp = None, key_type: str = "bigint"
) -> bool:
    """Add bronze `records` of landing files that silver lacks; False if it has them all.

    Only these records are read. Known names keep their lookup ids and new ones get higher ones; products
    are numbered within the batch, from the highest Product_ID on; stamps of earlier rows stay. `batch` names
    a folder of each core table: a batch that is lost half-way and comes again replaces what it
    left, and the files it covers are recorded last. A landing file has to be in one batch as a whole.
    With `by_name`, a new parent of a known name gives no further rows to records of earlier batches.
    """
    if LINEAGE not in records.columns:
        raise ValueError(f"bronze doesn't say which landing file a record is from: no column {LINEAGE}")
    with scratch_run(store.spark, store.base):
        done = covered_files(store).where(F.col("part") != batch)
        files = materialize(records.select(LINEAGE).distinct().join(done, LINEAGE, "left_anti"), "files")
        if files.isEmpty():
            return False
        built = [key for key in LOOKUPS if store.exists(store.silver(key))]
        if built and not store.exists(store.covered):
            raise ValueError("silver has tables but no finished build: run build_silver first")
        uncovered = records.join(files, LINEAGE, "left_semi")
        known = {key: store.read_silver(key) for key in built}
        if set(known) not in (set(), set(LOOKUPS)):
            raise ValueError(f"only some lookups are there: {built}")
        if not known:
            cover(store, files.limit(0), 0, WHOLE)
        lookups = _write_lookups(store, uncovered, mode, known)
        stamp = datetime.datetime.now() if as_of is None else as_of
        last = done.agg(F.max("last_product")).first()[0] or 0
        numbers: dict[str, int] = {}

        def write(key: str, builder) -> None:
            rows = builder(uncovered, lookups, as_of=stamp)
            if key == "products":
                seen = Observation()
                shifted = (F.col("Product_ID") + F.lit(last)).cast(key_type)
                rows = rows.withColumn("Product_ID", shifted).observe(seen, F.max("Product_ID").alias("last"))
            store.write_silver_batch(key, rows, batch)
            if key == "products":
                numbers["last"] = seen.get["last"]

        write_all(store.spark, [partial(write, key, builder) for key, builder in _builders(mode, key_type).items()])
        cover(store, files, numbers["last"], batch)
        return True


def _write_entity(store, key, builder, bronze, lookups, as_of, keep) -> None:
    rows = builder(bronze, lookups, as_of=as_of)
    if keep and store.exists(store.silver(key)):
        rows = carry_stamps(rows, store.read_silver(key), key)
    store.write_silver(key, rows)


def run_pipeline(
    spark: SparkSession,
    base: str,
    landing: str | None = None,
    mode: str = BY_PATH,
    as_of: Stamp = None,
    infer: bool = False,
    key_type: str = "bigint",
    keep: bool = False,
    pattern: str | None = None,
) -> DataFrame:
    """Landing files to gold below `base`; returns the row count of every gold table.

    `keep` merges only new landing files and keeps ids and stamps of an earlier run. `pattern` says which names are
    landing files.
    """
    store = Store(spark, base)
    merge_landing(store, landing, infer, only_new=keep, pattern=pattern)
    build_silver(store, mode, as_of, key_type, keep)
    counts: dict[str, int] = {}
    publish_gold(store, counts=counts)
    return spark.createDataFrame(list(counts.items()), "table_name string, n long")
