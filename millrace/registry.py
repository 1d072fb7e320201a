"""The data model, as data: landing columns, the 15 tables, where each one lives.

Every other module asks this one for names, so no path or column list is spelled twice.
"""

from __future__ import annotations

from dataclasses import dataclass

BY_NAME = "by_name"
BY_PATH = "by_path"


@dataclass(frozen=True)
class LookupSpec:
    """A dimension table: one row per distinct name (and parent), with a dense id."""

    key: str  # short name, as used in code
    table: str  # published name
    path: str  # location below the silver layer
    source: str  # landing column holding the name
    id: str
    name: str
    id_type: str = "bigint"
    parent: str | None = None  # key of the parent lookup

    @property
    def columns(self) -> tuple[str, ...]:
        own = (self.id, self.name)
        return own + (LOOKUPS[self.parent].id,) if self.parent else own

    @property
    def schema(self) -> str:
        own = f"{self.id} {self.id_type}, {self.name} string"
        above = LOOKUPS[self.parent] if self.parent else None
        return f"{own}, {above.id} {above.id_type}" if above else own

    @property
    def ancestry(self) -> tuple[str, ...]:
        """Landing columns from this level up to the root of its hierarchy."""
        above = LOOKUPS[self.parent].ancestry if self.parent else ()
        return (self.source, *above)


@dataclass(frozen=True)
class EntitySpec:
    """A core table: foreign keys and attributes per record."""

    key: str
    table: str
    path: str
    columns: tuple[str, ...]
    lookups: tuple[str, ...]


# Table names, locations and column names form the published contract.

LANDING_TYPES = {
    "Transaction_ID": "double",
    "Customer_ID": "double",
    "Name": "string",
    "Email": "string",
    "Phone": "string",
    "Address": "string",
    "City": "string",
    "State/Province": "string",
    "Zipcode": "string",
    "Country": "string",
    "Age": "double",
    "Gender": "string",
    "Income": "string",
    "Customer_Segment": "string",
    "Time": "string",
    "Total_Purchases": "double",
    "Total_Amount": "double",
    "Product_Category": "string",
    "Product_Brand": "string",
    "Product_Type": "string",
    "Shipping_Method": "string",
    "Payment_Method": "string",
    "Order_Status": "string",
    "products": "string",
}

LANDING_FILES = tuple(f"retail_data_{i}.csv" for i in range(1, 11))

LANDING_PATH = "bronze/data/raw"
LANDING_PATTERN = "retail_data_*.csv"
BRONZE_PATH = "bronze/data/retail_data_parquet"
SILVER_PATH = "silver/data"
GOLD_PATH = "gold/data/duckdb"

AUDIT_COLUMNS = ("Created_Date", "Updated_Date")

LOOKUPS = {
    spec.key: spec
    for spec in (
        LookupSpec("country", "countries", "lookup/country", "Country", "Country_ID", "Country_Name"),
        LookupSpec("state_provinces", "states_provinces", "lookup/state_provinces", "State/Province",
                   "State_ID", "State_Name", "int", "country"),
        LookupSpec("city", "cities", "lookup/city", "City", "City_ID", "City_Name", "int", "state_provinces"),
        LookupSpec("category", "categories", "lookup/category", "Product_Category",
                   "Category_ID", "Category_Name"),
        LookupSpec("brand", "brands", "lookup/brand", "Product_Brand", "Brand_ID", "Brand_Name"),
        LookupSpec("product_type", "product_types", "lookup/product_type", "Product_Type",
                   "Product_Type_ID", "Product_Type_Name", "int", "category"),
        LookupSpec("segment", "segments", "lookup/segment", "Customer_Segment", "Segment_ID", "Segment_Name"),
        LookupSpec("income_level", "income_levels", "lookup/income_level", "Income",
                   "Income_Level_ID", "Income_Level"),
        LookupSpec("shipping_methods", "shipping_methods", "lookup/shipping_methods", "Shipping_Method",
                   "Shipping_Method_ID", "Method_Name"),
        LookupSpec("payment_methods", "payment_methods", "lookup/payment_methods", "Payment_Method",
                   "Payment_Method_ID", "Method_Name"),
        LookupSpec("order_status", "order_status", "lookup/order_status", "Order_Status",
                   "Status_ID", "Status_Name"),
    )
}

ENTITIES = {
    spec.key: spec
    for spec in (
        EntitySpec(
            "customers", "customers", "core_entity/customers",
            ("Customer_ID", "Name", "Email", "Phone", "Age", "Gender",
             "Income_Level_ID", "Customer_Segment_ID", *AUDIT_COLUMNS),
            ("income_level", "segment"),
        ),
        EntitySpec(
            "products", "products", "core_entity/products",
            ("Product_ID", "Product_Name", "Product_Type_ID", "Brand_ID", "Category_ID", *AUDIT_COLUMNS),
            ("product_type", "category", "brand"),
        ),
        EntitySpec(
            "addresses", "addresses", "core_entity/address",
            ("Customer_ID", "Street_Address", "City_ID", "Zipcode", *AUDIT_COLUMNS),
            ("city", "state_provinces", "country"),
        ),
        EntitySpec(
            "transactions", "transactions", "core_entity/transactions",
            ("Transaction_ID", "Customer_ID", "Transaction_DateTime", "Total_Amount", "Total_Purchases",
             "Shipping_Method_ID", "Payment_Method_ID", "Order_Status_ID", *AUDIT_COLUMNS),
            ("shipping_methods", "payment_methods", "order_status"),
        ),
    )
}

TABLES = {**LOOKUPS, **ENTITIES}


def check_mode(mode: str) -> str:
    if mode not in (BY_NAME, BY_PATH):
        raise ValueError(f"mode must be {BY_NAME!r} or {BY_PATH!r}, not {mode!r}")
    return mode


def with_ancestors(keys) -> list[str]:
    """The given lookups and every parent they need, in registry order."""
    wanted = set()
    for key in keys:
        while key:
            wanted.add(key)
            key = LOOKUPS[key].parent
    return [key for key in LOOKUPS if key in wanted]
