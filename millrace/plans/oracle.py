"""The registered queries in plain SQL, written independently of the DataFrame code."""

from __future__ import annotations

from millrace.registry import LOOKUPS

RAW = """
SELECT l.l_orderkey AS Transaction_ID, cu.c_custkey AS Customer_ID, cu.c_name AS Name,
  lower(cu.c_name) || '@example.com' AS Email, CAST(cu.c_custkey AS VARCHAR) AS Phone,
  'Street ' || CAST(cu.c_nationkey AS VARCHAR) AS Address,
  'City_' || CAST(cu.c_nationkey % 20 AS VARCHAR) || '_' || CAST(cu.c_custkey % 5 AS VARCHAR) AS City,
  n.n_name AS State_Province,
  CASE WHEN cu.c_custkey % 7 = 0 THEN 'ZIP-' ELSE '' END || CAST(10000 + cu.c_custkey AS VARCHAR) AS Zipcode,
  r.r_name AS Country, CAST(20 + cu.c_custkey % 50 AS DOUBLE) AS Age,
  CASE WHEN cu.c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS Gender,
  CASE WHEN cu.c_acctbal < 0 THEN NULL WHEN cu.c_acctbal < 3000 THEN 'Low'
       WHEN cu.c_acctbal < 7000 THEN 'Medium' ELSE 'High' END AS Income,
  cu.c_mktsegment AS Customer_Segment, l.l_shipdate AS Time,
  l.l_quantity AS Total_Purchases, l.l_extendedprice AS Total_Amount,
  CASE WHEN p.p_size % 5 = 0 AND p.p_partkey % 2 = 0 THEN 'MISC' ELSE p.p_type END AS Product_Category,
  p.p_brand AS Product_Brand, p.p_type || '-' || CAST(p.p_size % 5 AS VARCHAR) AS Product_Type,
  nullif(l.l_returnflag, 'N') AS Shipping_Method,
  nullif(o.o_orderpriority, '4-NOT SPECIFIED') AS Payment_Method,
  o.o_orderstatus AS Order_Status, p.p_name AS products
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer cu ON o.o_custkey = cu.c_custkey
JOIN nation n ON cu.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey"""


def _flat(column: str, id: str, name: str) -> str:
    return f"""
SELECT CAST(row_number() OVER (ORDER BY v) AS BIGINT) AS {id}, v AS {name}
FROM (SELECT DISTINCT {column} AS v FROM raw WHERE {column} IS NOT NULL) d"""


STATE = """
SELECT CAST(row_number() OVER (ORDER BY State_Province, Country) AS INT) AS State_ID,
       State_Province AS State_Name, Country_ID
FROM (SELECT DISTINCT State_Province, Country FROM raw
      WHERE State_Province IS NOT NULL AND Country IS NOT NULL) d
JOIN country ON Country = Country_Name"""

CITY_BY_NAME = """
SELECT CAST(row_number() OVER (ORDER BY City, State_ID) AS INT) AS City_ID, City AS City_Name, State_ID
FROM (SELECT DISTINCT City, State_Province FROM raw
      WHERE City IS NOT NULL AND State_Province IS NOT NULL) d
JOIN state_provinces ON State_Province = State_Name"""

CITY_BY_PATH = """
SELECT CAST(row_number() OVER (ORDER BY City, State_ID) AS INT) AS City_ID, City AS City_Name, State_ID
FROM (SELECT DISTINCT City, State_Province, Country FROM raw
      WHERE City IS NOT NULL AND State_Province IS NOT NULL AND Country IS NOT NULL) d
JOIN (SELECT * FROM state_provinces JOIN country USING (Country_ID)) s
  ON State_Province = State_Name AND Country = Country_Name"""

TYPE = """
SELECT CAST(row_number() OVER (ORDER BY Product_Type, Product_Category) AS INT) AS Product_Type_ID,
       Product_Type AS Product_Type_Name, Category_ID
FROM (SELECT DISTINCT Product_Type, Product_Category FROM raw
      WHERE Product_Type IS NOT NULL AND Product_Category IS NOT NULL) d
JOIN category ON Product_Category = Category_Name"""

ADDRESS_BY_NAME = """
SELECT CAST(Customer_ID AS INT) AS Customer_ID, Address AS Street_Address, City_ID,
       TRY_CAST(Zipcode AS INT) AS Zipcode
FROM raw LEFT JOIN city ON City = City_Name"""

ADDRESS_BY_PATH = """
SELECT CAST(Customer_ID AS INT) AS Customer_ID, Address AS Street_Address, c.City_ID,
       TRY_CAST(Zipcode AS INT) AS Zipcode
FROM raw LEFT JOIN (SELECT city.*, State_Name, Country_Name
                    FROM city JOIN state_provinces USING (State_ID) JOIN country USING (Country_ID)) c
  ON City = City_Name AND State_Province = State_Name AND Country = Country_Name"""

CUSTOMERS = """
SELECT CAST(Customer_ID AS INT) AS Customer_ID, Name, Email, Phone, CAST(Age AS INT) AS Age, Gender,
       Income_Level_ID, Segment_ID AS Customer_Segment_ID
FROM raw LEFT JOIN income_level ON Income = Income_Level
         LEFT JOIN segment ON Customer_Segment = Segment_Name"""

PRODUCTS_BY_NAME = """
SELECT CAST(row_number() OVER (ORDER BY products NULLS FIRST, Product_Type_ID NULLS FIRST,
                               Brand_ID NULLS FIRST, pt.Category_ID NULLS FIRST) AS BIGINT) AS Product_ID,
       products AS Product_Name, Product_Type_ID, Brand_ID, pt.Category_ID
FROM raw LEFT JOIN product_type pt ON Product_Type = Product_Type_Name
         LEFT JOIN brand ON Product_Brand = Brand_Name
         LEFT JOIN (SELECT Category_Name FROM category) k ON Product_Category = Category_Name"""

PRODUCTS_BY_PATH = """
SELECT CAST(row_number() OVER (ORDER BY products NULLS FIRST, Product_Type_ID NULLS FIRST,
                               Brand_ID NULLS FIRST, pt.Category_ID NULLS FIRST) AS BIGINT) AS Product_ID,
       products AS Product_Name, pt.Product_Type_ID, Brand_ID, pt.Category_ID
FROM raw LEFT JOIN (SELECT t.*, Category_Name FROM product_type t JOIN category USING (Category_ID)) pt
           ON Product_Type = Product_Type_Name AND Product_Category = Category_Name
         LEFT JOIN brand ON Product_Brand = Brand_Name"""

PRODUCT_DIM = """
SELECT CAST(row_number() OVER (ORDER BY Product_Name NULLS FIRST, Product_Type_ID NULLS FIRST,
                               Brand_ID NULLS FIRST, Category_ID NULLS FIRST) AS BIGINT) AS Product_ID, *
FROM (SELECT DISTINCT Product_Name, Product_Type_ID, Brand_ID, Category_ID FROM products) b"""

TRANSACTIONS = """
SELECT CAST(Transaction_ID AS INT) AS Transaction_ID, CAST(Customer_ID AS INT) AS Customer_ID,
       Time AS Transaction_DateTime, Total_Amount, CAST(Total_Purchases AS INT) AS Total_Purchases,
       Shipping_Method_ID, Payment_Method_ID, Status_ID AS Order_Status_ID
FROM raw LEFT JOIN shipping_methods s ON Shipping_Method = s.Method_Name
         LEFT JOIN payment_methods p ON Payment_Method = p.Method_Name
         LEFT JOIN order_status ON Order_Status = Status_Name"""

LANDED = """
SELECT * REPLACE (CAST(Transaction_ID AS DOUBLE) AS Transaction_ID, CAST(Customer_ID AS DOUBLE) AS Customer_ID)
FROM raw"""

MANIFEST = """
SELECT CAST(Transaction_ID % 10 + 1 AS VARCHAR) AS source, CAST(count(*) AS BIGINT) AS rows, 'present' AS status
FROM raw GROUP BY ALL
UNION ALL SELECT '11', CAST(0 AS BIGINT), 'missing'"""

RECONCILED = """
SELECT count(DISTINCT Transaction_ID % 10) AS files, count(*) AS landing_rows, count(*) AS bronze_rows,
       'complete' AS status
FROM raw"""

FLAT = {
    key: _flat(spec.source, spec.id, spec.name) for key, spec in LOOKUPS.items() if spec.parent is None
}

NAMED = {"raw": RAW, **FLAT, "state_provinces": STATE, "city": CITY_BY_NAME, "product_type": TYPE,
         "addresses": ADDRESS_BY_NAME, "customers": CUSTOMERS, "products": PRODUCTS_BY_NAME,
         "transactions": TRANSACTIONS}
PATHED = {**NAMED, "city": CITY_BY_PATH, "addresses": ADDRESS_BY_PATH, "products": PRODUCTS_BY_PATH}


def _with(views: dict[str, str], body: str) -> str:
    """`body` behind the views; materialized, since most of them are read more than once."""
    return "WITH " + ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in views.items()) + "\n" + body


def _only(views: dict[str, str], *names: str) -> dict[str, str]:
    return {name: sql for name, sql in views.items() if name in ("raw", *names)}


GEO = ("country", "state_provinces", "city")
GOODS = ("category", "product_type", "brand")
PEOPLE = ("income_level", "segment")
METHODS = ("shipping_methods", "payment_methods", "order_status")

_STAMPS = ("TIMESTAMP '2024-01-01 00:00:00' AS Created_Date", "TIMESTAMP '2024-01-01 00:00:00' AS Updated_Date")


def _stamped(view: str) -> str:
    return f"SELECT *, {', '.join(_STAMPS)} FROM {view}"


def _counts(views: dict[str, str], names: dict[str, str]) -> str:
    return _with(views, "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, CAST(count(*) AS BIGINT) AS n FROM {view}"
        for view, table in names.items()
    ))


def _values(views: dict[str, str]) -> str:
    return _with(views, "\nUNION ALL ".join(
        f"SELECT '{spec.table}' AS table_name, CAST({spec.id} AS BIGINT) AS id, {spec.name} AS name, "
        f"CAST({LOOKUPS[spec.parent].id if spec.parent else 'NULL'} AS BIGINT) AS parent_id FROM {key}"
        for key, spec in LOOKUPS.items()
    ))


_REJECTED = """
SELECT kind, CAST(count(*) AS BIGINT) AS n
FROM (SELECT CASE WHEN Transaction_ID % 50 = 0 THEN 'Age' WHEN Transaction_ID % 35 = 0 THEN 'Total_Amount' ELSE 'record' END AS kind
      FROM raw) k
GROUP BY kind"""

# ids of the first run's names, then those of the names it lacked
_BRANDS_TWICE = """
SELECT CAST(row_number() OVER (ORDER BY v < 'Brand#3', v) AS BIGINT) AS Brand_ID, v AS Brand_Name
FROM (SELECT DISTINCT Product_Brand AS v FROM raw WHERE Product_Brand IS NOT NULL) d"""


def _numbered_twice(columns: str, id: str) -> str:
    """Distinct places with ids by name, those outside of the first run's countries behind."""
    order = ", ".join(["Country = 'AMERICA'", *columns.split(", ")])
    return f"SELECT {columns}, row_number() OVER (ORDER BY {order}) AS {id} FROM (SELECT DISTINCT {columns} FROM raw) d"


_CITIES_TWICE = f"""
SELECT CAST(City_ID AS INT) AS City_ID, City AS City_Name, CAST(State_ID AS INT) AS State_ID
FROM ({_numbered_twice("City, State_Province, Country", "City_ID")}) c
JOIN ({_numbered_twice("State_Province, Country", "State_ID")}) s USING (State_Province, Country)"""

_CUSTOMERS_TWICE = """
SELECT DISTINCT * REPLACE (CASE WHEN Customer_ID % 5 = 0 THEN 'new.' || Email ELSE Email END AS Email),
       CASE WHEN Customer_ID % 3 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS Created_Date,
       CASE WHEN Customer_ID % 3 = 0 OR Customer_ID % 5 = 0 THEN TIMESTAMP '2024-02-01 00:00:00'
            ELSE TIMESTAMP '2024-01-01 00:00:00' END AS Updated_Date
FROM customers"""

# names by the half they come up in first: even transactions land before odd ones
_HALF = "Transaction_ID % 2"


def _flat_halves(column: str, id: str, name: str) -> str:
    return f"""
SELECT CAST(row_number() OVER (ORDER BY half, v) AS BIGINT) AS {id}, v AS {name}
FROM (SELECT {column} AS v, min({_HALF}) AS half FROM raw WHERE {column} IS NOT NULL GROUP BY v) d"""


_TYPE_HALVES = f"""
SELECT CAST(row_number() OVER (ORDER BY half, Product_Type, Product_Category) AS INT) AS Product_Type_ID,
       Product_Type AS Product_Type_Name, Category_ID
FROM (SELECT Product_Type, Product_Category, min({_HALF}) AS half FROM raw
      WHERE Product_Type IS NOT NULL AND Product_Category IS NOT NULL GROUP BY ALL) d
JOIN category ON Product_Category = Category_Name"""

HALVES = {
    **PATHED,
    **{key: _flat_halves(spec.source, spec.id, spec.name) for key, spec in LOOKUPS.items() if spec.parent is None},
    "product_type": _TYPE_HALVES,
    "customers": CUSTOMERS.replace("FROM raw", f", {_HALF} AS half\nFROM raw"),
    "products": PRODUCTS_BY_PATH.replace("(ORDER BY products", f"(ORDER BY {_HALF}, products").replace(
        "pt.Category_ID\nFROM raw", f"pt.Category_ID, {_HALF} AS half\nFROM raw"),
}


def _stamped_halves(view: str) -> str:
    stamp = "CASE half WHEN 0 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END"
    return f"SELECT * EXCLUDE half, {stamp} AS Created_Date, {stamp} AS Updated_Date FROM {view}"


_LOOKUP_NAMES = {key: spec.table for key, spec in LOOKUPS.items()}
_ALL_NAMES = {**_LOOKUP_NAMES, **{name: name for name in ("customers", "products", "addresses", "transactions")}}

ORACLE: dict[str, str] = {
    "raw_row_count": _with({"raw": RAW}, "SELECT CAST(count(*) AS BIGINT) AS n FROM raw"),
    "distinct_state_country": _with(
        {"raw": RAW},
        "SELECT DISTINCT State_Province, Country FROM raw WHERE State_Province IS NOT NULL AND Country IS NOT NULL",
    ),
    **{f"lookup_{key}": _with(_only(NAMED, *GEO, *GOODS, key), f"SELECT * FROM {key}") for key in LOOKUPS},
    "lookup_city_keyed": _with(_only(PATHED, *GEO), "SELECT * FROM city"),
    "address_core": _with(_only(NAMED, *GEO), ADDRESS_BY_NAME),
    "address_core_keyed": _with(_only(PATHED, *GEO), ADDRESS_BY_PATH),
    "customers_core": _with(_only(NAMED, *PEOPLE), CUSTOMERS),
    "customer_dim": _with(_only(NAMED, *PEOPLE, "customers"), "SELECT DISTINCT * FROM customers"),
    "products_core": _with(_only(NAMED, *GOODS), PRODUCTS_BY_NAME),
    "products_core_keyed": _with(_only(PATHED, *GOODS), PRODUCTS_BY_PATH),
    "product_dim": _with(_only(PATHED, *GOODS, "products"), PRODUCT_DIM),
    "transactions_core": _with(_only(NAMED, *METHODS), TRANSACTIONS),
    "bronze_roundtrip": _with({"raw": RAW}, "SELECT * FROM raw"),
    "csv_roundtrip": _with({"raw": RAW}, LANDED),
    "landing_merge": _with({"raw": RAW}, LANDED),
    "landing_stream": _with({"raw": RAW}, LANDED),
    "landing_batch_then_stream": _with({"raw": RAW}, LANDED),
    "landing_partitioned": _with({"raw": RAW}, LANDED),
    "landing_ledger": _with({"raw": RAW}, LANDED),
    "landing_rejects": _with({"raw": RAW}, _REJECTED),
    "lookup_brand_second_run": _with({"raw": RAW}, _BRANDS_TWICE),
    "lookup_city_second_run": _with({"raw": RAW}, _CITIES_TWICE),
    "customers_second_run": _with(_only(NAMED, *PEOPLE, "customers"), _CUSTOMERS_TWICE),
    "landing_manifest": _with({"raw": RAW}, MANIFEST),
    "landing_reconciliation": _with({"raw": RAW}, RECONCILED),
    "gold_customers": _with(_only(PATHED, *PEOPLE, "customers"), _stamped("customers")),
    "gold_products": _with(_only(PATHED, *GOODS, "products"), _stamped("products")),
    "gold_addresses": _with(_only(PATHED, *GEO, "addresses"), _stamped("addresses")),
    "gold_transactions": _with(_only(PATHED, *METHODS, "transactions"), _stamped("transactions")),
    "gold_catalog_tables": _values(_only(PATHED, *LOOKUPS)),
    "gold_lookup_views": _counts(_only(PATHED, *LOOKUPS), _LOOKUP_NAMES),
    "gold_row_counts": _counts(NAMED, _ALL_NAMES),
    "gold_row_counts_keyed": _counts(PATHED, _ALL_NAMES),
    "gold_row_counts_incremental": _counts(PATHED, _ALL_NAMES),
    "silver_incremental": _with(_only(HALVES, *GOODS, "products"), _stamped_halves("products")),
    "silver_incremental_customers": _with(_only(HALVES, *PEOPLE, "customers"), _stamped_halves("customers")),
}

ORACLE |= {
    f"{name}_shuffled": ORACLE[name]
    for name in ("address_core", "address_core_keyed", "customers_core", "products_core", "products_core_keyed", "transactions_core")
}
