import datetime

import pytest
from conftest import rows

from millrace.plans.entities import (
    build_addresses,
    build_customers,
    build_products,
    build_transactions,
    customer_dim,
    product_dim,
)
from millrace.plans.lookups import build_lookups
from millrace.registry import AUDIT_COLUMNS, BY_NAME, BY_PATH, ENTITIES

AS_OF = datetime.datetime(2024, 1, 1)


def needed(raw, entity, mode=BY_PATH):
    return build_lookups(raw, ENTITIES[entity].lookups, mode)


def plain(df):
    return rows(df.drop(*AUDIT_COLUMNS))


def test_a_city_name_in_two_states(records):
    raw = records({"State/Province": "East"}, {"State/Province": "West"})
    by_name = build_addresses(raw, needed(raw, "addresses", BY_NAME), BY_NAME)
    by_path = build_addresses(raw, needed(raw, "addresses"), BY_PATH)
    assert by_name.count() == 4
    assert plain(by_path) == [(1, "1 Main", 1, 12345), (1, "1 Main", 2, 12345)]


def test_a_product_type_in_two_categories(records):
    raw = records({"Product_Category": "Home"}, {"Product_Category": "Gift"})
    lookups = needed(raw, "products")
    assert build_products(raw, lookups, BY_NAME).count() == 4
    assert plain(build_products(raw, lookups, BY_PATH)) == [(1, "Blue mug", 1, 1, 1), (2, "Blue mug", 2, 1, 2)]


def test_by_name_takes_the_category_of_the_type_row(records):
    raw = records({"Product_Category": "Home"})
    lookups = needed(raw, "products")
    odd = records({"Product_Category": "Garden"})
    assert plain(build_products(odd, lookups, BY_NAME)) == [(1, "Blue mug", 1, 1, 1)]
    assert plain(build_products(odd, lookups, BY_PATH)) == [(1, "Blue mug", None, 1, None)]


def test_records_are_not_deduplicated_but_dims_are(records):
    raw = records({}, {}, {})
    lookups = build_lookups(raw)
    assert build_customers(raw, lookups).count() == 3
    assert customer_dim(raw, lookups, AS_OF).count() == 1
    assert [r[0] for r in plain(build_products(raw, lookups))] == [1, 2, 3]
    assert plain(product_dim(raw, lookups)) == [(1, "Blue mug", 1, 1, 1)]


def test_null_and_unknown_names_keep_the_record(records):
    known = records({"Income": "Low"})
    raw = records({"Income": None}, {"Income": "Vast"}, {"Income": "Low"})
    out = build_customers(raw, needed(known, "customers"))
    assert sorted(str(r.Income_Level_ID) for r in out.collect()) == ["1", "None", "None"]


def test_malformed_and_huge_numbers_become_null(records):
    raw = records(
        {"Zipcode": "SW1A", "Transaction_ID": 6852899987.0},
        {"Zipcode": "12345.0", "Transaction_ID": 12.7},
        {"Zipcode": " 77 ", "Transaction_ID": None},
        {"Zipcode": "99999999999", "Transaction_ID": float("nan")},
    )
    lookups = build_lookups(raw)
    zips = [r[3] for r in plain(build_addresses(raw, lookups))]
    assert zips.count(None) == 2 and set(zips) == {None, 12345, 77}
    ids = [r.Transaction_ID for r in build_transactions(raw, lookups).collect()]
    assert ids.count(None) == 3 and 12 in ids


def test_products_are_numbered_by_name_with_nulls_first(records):
    raw = records({"products": "b"}, {"products": None}, {"products": "a"}, {"products": "b"})
    out = build_products(raw, needed(raw, "products"))
    assert [(r.Product_ID, r.Product_Name) for r in out.orderBy("Product_ID").collect()] == [
        (1, None), (2, "a"), (3, "b"), (4, "b")
    ]


@pytest.mark.parametrize("key_type", ["bigint", "int"])
def test_product_key_type(records, key_type):
    raw = records({})
    out = build_products(raw, needed(raw, "products"), key_type=key_type)
    assert dict(out.dtypes)["Product_ID"] == key_type


def test_column_order_types_and_stamps(records):
    raw = records({})
    lookups = build_lookups(raw)
    built = {
        "addresses": build_addresses(raw, lookups, as_of=AS_OF),
        "customers": build_customers(raw, lookups, as_of=AS_OF),
        "products": build_products(raw, lookups, as_of=AS_OF),
        "transactions": build_transactions(raw, lookups, as_of=AS_OF),
    }
    for key, df in built.items():
        assert tuple(df.columns) == ENTITIES[key].columns
        row = df.collect()[0]
        assert row.Created_Date == row.Updated_Date == AS_OF
    assert dict(built["customers"].dtypes)["Age"] == "int"
    assert dict(built["customers"].dtypes)["Income_Level_ID"] == "bigint"
    assert dict(built["addresses"].dtypes)["City_ID"] == "int"
    assert dict(built["transactions"].dtypes)["Total_Amount"] == "double"


def test_default_stamp_is_one_moment(records):
    raw = records({})
    row = build_transactions(raw, needed(raw, "transactions")).collect()[0]
    assert row.Created_Date == row.Updated_Date is not None
    assert row.Transaction_DateTime == "22:03:55"
