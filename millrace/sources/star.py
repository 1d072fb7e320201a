"""The retail record as a view over a star schema of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.registry import LANDING_TYPES

STAR_TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double, "
    "l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
}


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal an input with fewer splits than cores out to all cores by `key`; leave a larger one alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def retail_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landing-shaped record per order line, with the columns of the landing files.

    Customers and orders are joined before the lines, so the wide customer
    columns are moved once per order and meet the lines only in the last join.
    Of a part only what the record needs goes along, without its key and size.
    City and product type names are made to repeat across their parents, and
    some incomes, payment and shipping methods are NULL.
    """
    line, order, customer, nation, region, part = (
        spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet") for name, schema in STAR_TABLES.items()
    )
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    buyers = customer.join(places, customer.c_nationkey == places.n_nationkey)
    placed = order.join(buyers, order.o_custkey == buyers.c_custkey)
    line = spread(line, "l_orderkey")
    part = part.withColumn("shelf", F.col("p_size") % 5)
    part = part.withColumn("misc", (F.col("shelf") == 0) & (F.col("p_partkey") % 2 == 0)).drop("p_size")
    items = line.join(part, line.l_partkey == part.p_partkey)
    joined = items.join(placed, items.l_orderkey == placed.o_orderkey)

    balance = F.col("c_acctbal")
    values = {
        "Transaction_ID": F.col("l_orderkey"),
        "Customer_ID": F.col("c_custkey"),
        "Name": F.col("c_name"),
        "Email": F.concat(F.lower("c_name"), F.lit("@example.com")),
        "Phone": F.col("c_custkey").cast("string"),
        "Address": F.concat(F.lit("Street "), F.col("c_nationkey").cast("string")),
        "City": F.concat_ws(
            "_", F.lit("City"), (F.col("c_nationkey") % 20).cast("string"), (F.col("c_custkey") % 5).cast("string")
        ),
        "State/Province": F.col("n_name"),
        "Zipcode": F.concat(
            F.when(F.col("c_custkey") % 7 == 0, "ZIP-").otherwise(""), (F.col("c_custkey") + 10000).cast("string")
        ),
        "Country": F.col("r_name"),
        "Age": (F.col("c_custkey") % 50 + 20).cast("double"),
        "Gender": F.when(F.col("c_custkey") % 2 == 0, "Female").otherwise("Male"),
        "Income": F.when(balance >= 7000, "High").when(balance >= 3000, "Medium").when(balance >= 0, "Low"),
        "Customer_Segment": F.col("c_mktsegment"),
        "Time": F.col("l_shipdate"),
        "Total_Purchases": F.col("l_quantity"),
        "Total_Amount": F.col("l_extendedprice"),
        "Product_Category": F.when(F.col("misc"), "MISC").otherwise(F.col("p_type")),
        "Product_Brand": F.col("p_brand"),
        "Product_Type": F.concat_ws("-", "p_type", F.col("shelf").cast("string")),
        "Shipping_Method": F.nullif("l_returnflag", F.lit("N")),
        "Payment_Method": F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")),
        "Order_Status": F.col("o_orderstatus"),
        "products": F.col("p_name"),
    }
    return joined.select(*[values[name].alias(name) for name in LANDING_TYPES])
