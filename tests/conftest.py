import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from millrace.registry import LANDING_TYPES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("millrace-tests")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DEFAULTS = {
    "Transaction_ID": 1.0, "Customer_ID": 1.0, "Name": "Ann", "Email": "ann@example.com", "Phone": "555",
    "Address": "1 Main", "City": "Spring", "State/Province": "East", "Zipcode": "12345", "Country": "A",
    "Age": 30.0, "Gender": "Female", "Income": "Low", "Customer_Segment": "New", "Time": "22:03:55",
    "Total_Purchases": 3.0, "Total_Amount": 9.5, "Product_Category": "Home", "Product_Brand": "Acme",
    "Product_Type": "Mug", "Shipping_Method": "Standard", "Payment_Method": "Visa",
    "Order_Status": "Shipped", "products": "Blue mug",
}


@pytest.fixture(scope="session")
def records(spark):
    """Build landing records from the values that matter to a test."""
    schema = ", ".join(f"`{name}` {kind}" for name, kind in LANDING_TYPES.items())

    def build(*rows):
        full = [{**DEFAULTS, **row} for row in rows]
        return spark.createDataFrame([tuple(row[name] for name in LANDING_TYPES) for row in full], schema)

    return build


@pytest.fixture(scope="session")
def csv_file():
    """Write a small landing CSV by hand."""

    def write(path, *rows, columns=tuple(LANDING_TYPES)):
        lines = [",".join(columns)]
        for row in rows:
            values = {**DEFAULTS, **row}
            lines.append(",".join("" if values.get(c) is None else str(values.get(c, "")) for c in columns))
        path.write_text("\n".join(lines) + "\n")

    return write


def rows(df):
    """All rows as sorted tuples, for comparing small results."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
