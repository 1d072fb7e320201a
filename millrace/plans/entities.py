"""The four core tables, and their deduplicated variants.

Each builder reads only the record columns it needs and attaches lookups with
left joins, so a record whose name is NULL or unknown keeps its row and gets a
NULL id. With `by_path` there is one row per record. With `by_name` addresses
match on the city name and products on the type name alone, so a name that
exists under k parents yields k rows.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import audit_columns, int_or_null
from millrace.operators.joins import Match, attach
from millrace.operators.keys import dense_key, occurrence_key
from millrace.plans.lookups import lookup_paths
from millrace.registry import AUDIT_COLUMNS, BY_NAME, BY_PATH, ENTITIES, LOOKUPS, check_mode

Stamp = datetime.datetime | Column | None


def _flat(lookups: dict[str, DataFrame], key: str) -> Match:
    spec = LOOKUPS[key]
    return Match(lookups[key], {spec.source: spec.name})


def _nested(lookups: dict[str, DataFrame], key: str, mode: str) -> Match:
    """Match on the own name, or on the names of the whole path."""
    spec = LOOKUPS[key]
    if check_mode(mode) == BY_NAME:
        return Match(lookups[key], {spec.source: spec.name})
    on = {level.source: level.name for level in _levels(key)}
    return Match(lookup_paths(lookups, key), on)


def _levels(key: str | None) -> list:
    levels = []
    while key:
        levels.append(LOOKUPS[key])
        key = LOOKUPS[key].parent
    return levels


def build_addresses(
    records: DataFrame, lookups: dict[str, DataFrame], mode: str = BY_PATH, as_of: Stamp = None
) -> DataFrame:
    base = records.select(
        int_or_null(records, "Customer_ID"),
        F.col("Address").alias("Street_Address"),
        int_or_null(records, "Zipcode"),
        *LOOKUPS["city"].ancestry,
    )
    placed = attach(base, [_nested(lookups, "city", mode)])
    return placed.select("*", *audit_columns(as_of)).select(*ENTITIES["addresses"].columns)


def build_customers(records: DataFrame, lookups: dict[str, DataFrame], as_of: Stamp = None) -> DataFrame:
    base = records.select(
        int_or_null(records, "Customer_ID"),
        "Name",
        "Email",
        F.col("Phone").cast("string").alias("Phone"),
        int_or_null(records, "Age"),
        "Gender",
        "Income",
        "Customer_Segment",
    )
    known = attach(base, [_flat(lookups, "income_level"), _flat(lookups, "segment")])
    return known.withColumnRenamed("Segment_ID", "Customer_Segment_ID").select(
        "*", *audit_columns(as_of)
    ).select(*ENTITIES["customers"].columns)


def _product_groups(records: DataFrame, lookups: dict[str, DataFrame], mode: str) -> DataFrame:
    """Distinct product descriptions with their ids and the number of records of each.

    Products keep nothing that differs between records of one description, so
    records are counted first and only the distinct descriptions are joined.
    """
    kind = _nested(lookups, "product_type", mode)
    groups = records.groupBy(F.col("products").alias("Product_Name"), *kind.on, "Product_Brand").agg(
        F.count(F.lit(1)).alias("_repeats")
    )
    return attach(groups, [kind, _flat(lookups, "brand")]).select(
        "Product_Name", "Product_Type_ID", "Brand_ID", "Category_ID", "_repeats"
    )


_PRODUCT_ORDER = ("Product_Name", "Product_Type_ID", "Brand_ID", "Category_ID")


def build_products(
    records: DataFrame,
    lookups: dict[str, DataFrame],
    mode: str = BY_PATH,
    as_of: Stamp = None,
    key_type: str = "bigint",
) -> DataFrame:
    """One row per record, numbered by product name.

    Product_ID counts occurrences, so it passes the range of an int beyond two
    billion records; `key_type="int"` is for consumers that need the narrow type.
    """
    groups = _product_groups(records, lookups, mode)
    keyed = occurrence_key(groups, _PRODUCT_ORDER, "_repeats", "Product_ID", key_type)
    return keyed.select("*", *audit_columns(as_of)).select(*ENTITIES["products"].columns)


def build_transactions(records: DataFrame, lookups: dict[str, DataFrame], as_of: Stamp = None) -> DataFrame:
    base = records.select(
        int_or_null(records, "Transaction_ID"),
        int_or_null(records, "Customer_ID"),
        F.col("Time").alias("Transaction_DateTime"),
        "Total_Amount",
        int_or_null(records, "Total_Purchases"),
        "Shipping_Method",
        "Payment_Method",
        "Order_Status",
    )
    known = attach(base, [_flat(lookups, key) for key in ENTITIES["transactions"].lookups])
    return known.withColumnRenamed("Status_ID", "Order_Status_ID").select(
        "*", *audit_columns(as_of)
    ).select(*ENTITIES["transactions"].columns)


def customer_dim(records: DataFrame, lookups: dict[str, DataFrame], as_of: Stamp = None) -> DataFrame:
    """One row per distinct customer description."""
    # repeats go before the lookups are joined; casts may make more rows equal
    sources = ["Customer_ID", "Name", "Email", "Phone", "Age", "Gender", "Income", "Customer_Segment"]
    return (
        build_customers(records.select(*sources).distinct(), lookups, as_of)
        .drop(*AUDIT_COLUMNS)
        .distinct()
        .select("*", *audit_columns(as_of))
    )


def product_dim(
    records: DataFrame, lookups: dict[str, DataFrame], mode: str = BY_PATH, as_of: Stamp = None
) -> DataFrame:
    """One row per distinct product, with Product_ID numbering products rather than records."""
    products = _product_groups(records, lookups, mode).drop("_repeats").distinct()
    keyed = dense_key(products, _PRODUCT_ORDER, "Product_ID")
    return keyed.select("*", *audit_columns(as_of)).select(*ENTITIES["products"].columns)
