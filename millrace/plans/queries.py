"""The registered queries: each operator applied to whole star-schema tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.distinct import distinct_rows
from millrace.operators.joins import BROADCAST_SETTING
from millrace.plans.entities import (
    build_addresses,
    build_customers,
    build_products,
    build_transactions,
    customer_dim,
    product_dim,
)
from millrace.plans.gold import publish_gold, row_counts
from millrace.plans.history import carry_stamps
from millrace.plans.lookups import build_lookups
from millrace.plans.pipeline import merge_landing, run_pipeline
from millrace.registry import AUDIT_COLUMNS, BY_NAME, BY_PATH, ENTITIES, LANDING_TYPES, LOOKUPS, TABLES
from millrace.session import materialize, scratch_path
from millrace.sources.landing import PACKED_GLOB, landing_manifest, read_landing, read_landing_checked, reconcile
from millrace.sources.star import retail_records
from millrace.sources.tables import Store, write_csv
from millrace.streaming.landing import stream_landing
from millrace.streaming.silver import stream_silver

Query = Callable[[SparkSession, str], DataFrame]

BATCHES = 10

ENTITY_SOURCES = {
    "addresses": ("Customer_ID", "Address", "Zipcode", "City", "State/Province", "Country"),
    "customers": ("Customer_ID", "Name", "Email", "Phone", "Age", "Gender", "Income", "Customer_Segment"),
    "products": ("products", "Product_Type", "Product_Category", "Product_Brand"),
    "transactions": ("Transaction_ID", "Customer_ID", "Time", "Total_Amount", "Total_Purchases",
                     "Shipping_Method", "Payment_Method", "Order_Status"),
}


def _as_of(month: int = 1) -> Column:
    return F.lit(f"2024-{month:02}-01 00:00:00").cast("timestamp_ntz")


def _plain_names(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("State/Province", "State_Province")


def raw_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail_records(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


def distinct_state_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_names(distinct_rows(retail_records(spark, sf_dir), ["State/Province", "Country"]))


def lookup(spark: SparkSession, sf_dir: str, key: str, mode: str) -> DataFrame:
    return build_lookups(retail_records(spark, sf_dir), [key], mode)[key]


def entity(
    spark: SparkSession, sf_dir: str, key: str, builder: Callable[..., DataFrame], mode: str = BY_PATH, **options
) -> DataFrame:
    """One core table. The record columns it needs are joined together once, for lookups and table alike."""
    records = materialize(retail_records(spark, sf_dir).select(*ENTITY_SOURCES[key]), "bronze")
    return builder(records, build_lookups(records, ENTITIES[key].lookups, mode), **options)


def core(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return entity(spark, sf_dir, **options).drop(*AUDIT_COLUMNS)


def gold_entity(
    spark: SparkSession, sf_dir: str, key: str, builder: Callable[..., DataFrame], mode: str = BY_PATH, **options
) -> DataFrame:
    """One core table taken through silver to gold, stamps included."""
    store = Store(spark, scratch_path(spark, "gold"))
    store.write_silver(key, entity(spark, sf_dir, key, builder, mode, as_of=_as_of(), **options))
    publish_gold(store, [key])
    return store.read_gold(key)


def _land(records: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Landing CSV files, packed: as plain text they would be most of what a query writes."""
    write_csv(records, path, partition_by, packed=True)


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """The records as landing CSV files; returns their folder."""
    path = scratch_path(spark, "landing")
    _land(retail_records(spark, sf_dir), path)
    return path


def _typed_time(df: DataFrame) -> DataFrame:
    return _plain_names(df.withColumn("Time", F.col("Time").cast("timestamp_ntz"))).select(
        *[name.replace("/", "_") for name in LANDING_TYPES]
    )


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, scratch_path(spark, "bronze"))
    store.write_bronze(retail_records(spark, sf_dir))
    return _plain_names(store.read_bronze())


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed_time(read_landing(spark, _landed(spark, sf_dir), pattern=PACKED_GLOB))


def landing_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, scratch_path(spark, "merge"))
    return _typed_time(merge_landing(store, _landed(spark, sf_dir), pattern=PACKED_GLOB))


def landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, scratch_path(spark, "stream"))
    return _typed_time(stream_landing(store, scratch_path(spark, "progress"), _landed(spark, sf_dir), pattern=PACKED_GLOB))


def landing_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest over landing folders batch=1..10, with an eleventh expected but never written."""
    return _batches(spark, sf_dir)[1]


def landing_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same landing folders, merged and compared with bronze."""
    path, manifest = _batches(spark, sf_dir)
    return reconcile(manifest, merge_landing(Store(spark, scratch_path(spark, "merge")), path, pattern=PACKED_GLOB))


def _batches(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    path = scratch_path(spark, "landing")
    records = retail_records(spark, sf_dir)
    _land(records.withColumn("batch", F.col("Transaction_ID") % BATCHES + 1), path, partition_by="batch")
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"batch=(\d+)", 1)
    return path, landing_manifest(spark, path, [str(i) for i in range(1, BATCHES + 2)], folder, PACKED_GLOB)


def gold_row_counts(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """The whole pipeline, from landing CSV files to counted gold tables."""
    return run_pipeline(spark, scratch_path(spark, "lakehouse"), _landed(spark, sf_dir), mode, _as_of(), pattern=PACKED_GLOB)


def catalog_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookups published as views over silver, counted through the catalog."""
    store = Store(spark, scratch_path(spark, "lakehouse"))
    for key, table in build_lookups(retail_records(spark, sf_dir)).items():
        store.write_silver(key, table)
    views = {name: spark.table(name) for name in publish_gold(store, LOOKUPS, views=True)}
    for name in views:
        spark.catalog.dropTempView(name)
    return row_counts(views)


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookups published as catalog tables: (table_name, id, name, parent_id) of all their rows."""
    path = scratch_path(spark, "lakehouse")
    store = Store(spark, path)
    database = "gold_" + path.rpartition("-")[2]
    for key, table in build_lookups(retail_records(spark, sf_dir)).items():
        store.write_silver(key, table)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}/catalog'")
    try:
        tables = {name: spark.table(f"{database}.{name}") for name in publish_gold(store, LOOKUPS, database)}
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")  # their files lie outside of it and stay
    return reduce(DataFrame.union, [
        tables[spec.table].select(
            F.lit(spec.table).alias("table_name"),
            F.col(spec.id).cast("bigint").alias("id"),
            F.col(spec.name).alias("name"),
            (F.col(LOOKUPS[spec.parent].id) if spec.parent else F.lit(None)).cast("bigint").alias("parent_id"),
        )
        for spec in LOOKUPS.values()
    ])


def shuffled(spark: SparkSession, sf_dir: str, query: Query) -> DataFrame:
    """A query planned as if no lookup were small enough to be broadcast."""
    before = spark.conf.get(BROADCAST_SETTING, None)
    spark.conf.set(BROADCAST_SETTING, "0")
    try:
        return query(spark, sf_dir)
    finally:
        if before is None:
            spark.conf.unset(BROADCAST_SETTING)
        else:
            spark.conf.set(BROADCAST_SETTING, before)


def landing_batch_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the records merged as a batch, the other half as a stream."""
    records, half = retail_records(spark, sf_dir), F.col("Transaction_ID") % 2 == 0
    store, halves = Store(spark, scratch_path(spark, "both")), []
    for part in (half, ~half):
        halves.append(scratch_path(spark, "landing"))
        _land(records.where(part), halves[-1])
    merge_landing(store, halves[0], pattern=PACKED_GLOB)
    return _typed_time(stream_landing(store, scratch_path(spark, "progress"), halves[1], pattern=PACKED_GLOB))


def landing_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records from a landing folder with a folder for each day."""
    path = scratch_path(spark, "landing")
    days = (F.col("Transaction_ID") % BATCHES).cast("string")
    _land(retail_records(spark, sf_dir).withColumn("day", days), path, partition_by="day")
    return _typed_time(merge_landing(Store(spark, scratch_path(spark, "dated")), path, pattern=PACKED_GLOB))


def landing_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder that keeps growing, merged as a batch, a stream, a batch of new files, again from the start, and as a stream."""
    path, progress = scratch_path(spark, "landing"), scratch_path(spark, "progress")
    records, store = retail_records(spark, sf_dir), Store(spark, scratch_path(spark, "ledger"))
    steps = (
        partial(merge_landing, store, path, pattern=PACKED_GLOB),
        partial(stream_landing, store, progress, path, pattern=PACKED_GLOB),
        partial(merge_landing, store, path, only_new=True, pattern=PACKED_GLOB),
    )
    for part, step in enumerate(steps):
        _land(records.where(F.col("Transaction_ID") % len(steps) == part), f"{path}/part={part}")
        step()
    merge_landing(store, path, pattern=PACKED_GLOB)
    return _typed_time(stream_landing(store, progress, path, pattern=PACKED_GLOB))


def landing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, n): the records that fit, and by column those set aside because a value isn't of its type."""
    path, number = scratch_path(spark, "landing"), F.col("Transaction_ID")
    age = F.when(number % 50 == 0, F.lit("forty")).otherwise(F.col("Age").cast("string"))
    amount = F.when(number % 35 == 0, F.lit("1,5")).otherwise(F.col("Total_Amount").cast("string"))
    _land(retail_records(spark, sf_dir).withColumn("Age", age).withColumn("Total_Amount", amount), path)
    records, rejects = read_landing_checked(spark, path, PACKED_GLOB)
    kinds = records.select(F.lit("record").alias("kind")).union(rejects.select("reason"))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def lookup_second_run(spark: SparkSession, sf_dir: str, key: str, first: str) -> DataFrame:
    """A lookup built from the records that meet `first`, and then from all of them: the ids of the first run stay."""
    records = retail_records(spark, sf_dir)
    known = build_lookups(records.where(first), [key])
    return build_lookups(records, [key], known=known)[key]


def customers_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of two runs a month apart: the second has more of them, and new mail addresses for some."""
    number = F.col("Customer_ID")
    names = [*ENTITY_SOURCES["customers"]]
    records = materialize(retail_records(spark, sf_dir).select(*names), "bronze")
    first = records.where(number % 3 != 0)
    lookups = build_lookups(first, ENTITIES["customers"].lookups)
    before = customer_dim(first, lookups, as_of=_as_of())
    moved = records.withColumn("Email", F.when(number % 5 == 0, F.concat(F.lit("new."), "Email")).otherwise(F.col("Email")))
    lookups = build_lookups(moved, ENTITIES["customers"].lookups, known=lookups)
    return carry_stamps(customer_dim(moved, lookups, as_of=_as_of(month=2)), before, "customers")


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline over half of the records, and again when the other half has landed: only that is merged."""
    base, path = scratch_path(spark, "lakehouse"), scratch_path(spark, "landing")
    records = retail_records(spark, sf_dir)
    for part in range(2):
        _land(records.where(F.col("Transaction_ID") % 2 == part), f"{path}/part={part}")
        counts = run_pipeline(spark, base, path, BY_PATH, _as_of(month=part + 1), keep=True, pattern=PACKED_GLOB)
    return counts


def silver_incremental(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """A core table built by two silver streams: half of the records landed as a batch, then the others as a stream."""
    path, progress = scratch_path(spark, "landing"), scratch_path(spark, "progress")
    records, store = retail_records(spark, sf_dir), Store(spark, scratch_path(spark, "lakehouse"))
    steps = (
        partial(merge_landing, store, path, pattern=PACKED_GLOB),
        partial(stream_landing, store, f"{progress}/landing", path, pattern=PACKED_GLOB),
    )
    for part, step in enumerate(steps):
        _land(records.where(F.col("Transaction_ID") % len(steps) == part), f"{path}/part={part}")
        step()
        stream_silver(store, f"{progress}/silver", as_of=_as_of(month=part + 1))
    return store.read_silver(key)


QUERIES: dict[str, Query] = {
    "raw_row_count": raw_row_count,
    "distinct_state_country": distinct_state_country,
    **{f"lookup_{key}": partial(lookup, key=key, mode=BY_NAME) for key in LOOKUPS},
    "lookup_city_keyed": partial(lookup, key="city", mode=BY_PATH),
    "address_core": partial(core, key="addresses", builder=partial(build_addresses, mode=BY_NAME), mode=BY_NAME),
    "address_core_keyed": partial(core, key="addresses", builder=build_addresses),
    "customers_core": partial(core, key="customers", builder=build_customers),
    "customer_dim": partial(core, key="customers", builder=customer_dim),
    "products_core": partial(core, key="products", builder=partial(build_products, mode=BY_NAME), mode=BY_NAME),
    "products_core_keyed": partial(core, key="products", builder=build_products),
    "product_dim": partial(core, key="products", builder=product_dim),
    "transactions_core": partial(core, key="transactions", builder=build_transactions),
    "bronze_roundtrip": bronze_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "landing_merge": landing_merge,
    "landing_stream": landing_stream,
    "landing_batch_then_stream": landing_batch_then_stream,
    "landing_partitioned": landing_partitioned,
    "landing_ledger": landing_ledger,
    "landing_rejects": landing_rejects,
    "lookup_brand_second_run": partial(lookup_second_run, key="brand", first="Product_Brand >= 'Brand#3'"),
    "lookup_city_second_run": partial(lookup_second_run, key="city", first="Country <> 'AMERICA'"),
    "customers_second_run": customers_second_run,
    "landing_manifest": landing_audit,
    "landing_reconciliation": landing_reconciliation,
    "gold_customers": partial(gold_entity, key="customers", builder=build_customers),
    "gold_products": partial(gold_entity, key="products", builder=build_products),
    "gold_addresses": partial(gold_entity, key="addresses", builder=build_addresses),
    "gold_transactions": partial(gold_entity, key="transactions", builder=build_transactions),
    "gold_lookup_views": catalog_row_counts,
    "gold_catalog_tables": catalog_tables,
    "gold_row_counts": partial(gold_row_counts, mode=BY_NAME),
    "gold_row_counts_keyed": partial(gold_row_counts, mode=BY_PATH),
    "gold_row_counts_incremental": gold_incremental,
    "silver_incremental": partial(silver_incremental, key="products"),
    "silver_incremental_customers": partial(silver_incremental, key="customers"),
}

QUERIES |= {
    f"{name}_shuffled": partial(shuffled, query=QUERIES[name])
    for name in ("address_core", "address_core_keyed", "customers_core", "products_core", "products_core_keyed", "transactions_core")
}
