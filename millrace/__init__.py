"""Retail lakehouse normalization: landing CSV -> bronze -> silver -> gold, on Spark."""

from millrace.plans.entities import (
    build_addresses,
    build_customers,
    build_products,
    build_transactions,
    customer_dim,
    product_dim,
)
from millrace.plans.gold import publish_gold, row_counts
from millrace.plans.lookups import build_lookups
from millrace.plans.pipeline import add_to_silver, build_silver, merge_landing, run_pipeline
from millrace.sources.landing import landing_manifest, read_landing
from millrace.sources.tables import Store, write_csv
from millrace.streaming.landing import stream_landing
from millrace.streaming.silver import stream_silver

__all__ = [
    "Store",
    "add_to_silver",
    "build_addresses",
    "build_customers",
    "build_lookups",
    "build_products",
    "build_silver",
    "build_transactions",
    "customer_dim",
    "landing_manifest",
    "merge_landing",
    "product_dim",
    "publish_gold",
    "read_landing",
    "row_counts",
    "run_pipeline",
    "stream_landing",
    "stream_silver",
    "write_csv",
]
