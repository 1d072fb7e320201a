import pytest
from conftest import rows

from millrace.operators.distinct import distinct_names, distinct_rows
from millrace.plans.lookups import _with_parent_id, build_lookups
from millrace.registry import BY_NAME, BY_PATH, LOOKUPS


def test_flat_lookup_is_dense_sorted_and_bigint(records):
    table = build_lookups(records(*[{"Product_Brand": b} for b in ("Zed", "Acme", "Mid", "Acme")]), ["brand"])["brand"]
    assert rows(table) == [(1, "Acme"), (2, "Mid"), (3, "Zed")]
    assert table.dtypes == [("Brand_ID", "bigint"), ("Brand_Name", "string")]


def test_a_state_name_shared_by_two_countries(records):
    raw = records(
        {"City": "Cordova", "State/Province": "North", "Country": "A"},
        {"City": "Brook", "State/Province": "North", "Country": "B"},
    )
    assert build_lookups(raw, ["city"], BY_NAME)["city"].count() == 4
    by_path = build_lookups(raw, ["city"], BY_PATH)
    assert rows(by_path["state_provinces"]) == [(1, "North", 1), (2, "North", 2)]
    assert rows(by_path["city"]) == [(1, "Brook", 2), (2, "Cordova", 1)]


def test_child_tables_have_int_ids_and_the_parents_type(records):
    tables = build_lookups(records({}), ["city", "product_type"])
    assert tables["state_provinces"].dtypes == [("State_ID", "int"), ("State_Name", "string"), ("Country_ID", "bigint")]
    assert tables["city"].dtypes == [("City_ID", "int"), ("City_Name", "string"), ("State_ID", "int")]
    assert tables["product_type"].dtypes == [
        ("Product_Type_ID", "int"), ("Product_Type_Name", "string"), ("Category_ID", "bigint")
    ]


def test_a_row_with_any_missing_level_makes_no_child(records):
    raw = records({"Country": None}, {"City": "Lone", "State/Province": None}, {"City": None, "State/Province": "West"})
    tables = build_lookups(raw, ["city"])
    assert rows(tables["country"]) == [(1, "A")]
    assert rows(tables["state_provinces"]) == [(1, "West", 1)]
    assert rows(tables["city"]) == []


def test_by_name_uses_a_city_recorded_without_country(records):
    raw = records({"Country": None, "City": "Far"}, {"City": "Spring"})
    assert [r[1] for r in rows(build_lookups(raw, ["city"], BY_NAME)["city"])] == ["Far", "Spring"]
    assert [r[1] for r in rows(build_lookups(raw, ["city"], BY_PATH)["city"])] == ["Spring"]


def test_all_null_column_gives_an_empty_typed_table(records):
    tables = build_lookups(records({"Shipping_Method": None}, {"Shipping_Method": None}))
    assert tables["shipping_methods"].count() == 0
    assert tables["shipping_methods"].dtypes == [("Shipping_Method_ID", "bigint"), ("Method_Name", "string")]
    assert tables["payment_methods"].count() == 1


def test_names_are_matched_byte_for_byte(records):
    raw = records(*[{"Payment_Method": m} for m in ("Visa", "visa", "Visa ")])
    assert build_lookups(raw, ["payment_methods"])["payment_methods"].count() == 3


def test_only_requested_lookups_and_their_parents_are_built(records):
    assert list(build_lookups(records({}), ["state_provinces", "brand"])) == ["country", "state_provinces", "brand"]


def test_ids_do_not_depend_on_partitioning(records):
    raw = records(*[{"City": f"C{i % 17}", "State/Province": f"S{i % 5}", "Country": f"N{i % 2}"} for i in range(80)])
    for mode in (BY_NAME, BY_PATH):
        once, again = (build_lookups(raw.repartition(n), ["city", "brand"], mode) for n in (1, 9))
        for key in once:
            assert rows(once[key]) == rows(again[key]), key


def test_one_scan_of_the_records_serves_all_lookups(records):
    paths = {key: spec.ancestry for key, spec in LOOKUPS.items()}
    plan = distinct_names(records({}), paths)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_distinct_rows_drops_incomplete_pairs(records):
    raw = records({}, {}, {"Country": None}, {"State/Province": "West"})
    assert rows(distinct_rows(raw, ["State/Province", "Country"])) == [("East", "A"), ("West", "A")]


def test_unknown_mode(records):
    with pytest.raises(ValueError):
        build_lookups(records({}), mode="by_guess")


def test_flat_lookups_take_no_part_in_the_parent_join(spark):
    rows_in = [("brand", f"B{i}", None, None, i + 1) for i in range(50)]
    rows_in += [("country", "A", None, None, 1), ("state_provinces", "East", "A", None, 1)]
    numbered = spark.createDataFrame(rows_in, "lookup string, name string, parent string, grandparent string, id bigint")
    joined = _with_parent_id(numbered, ["brand", "country", "state_provinces"])
    assert {(r.lookup, r.parent_id) for r in joined.collect()} == {("brand", None), ("country", None), ("state_provinces", 1)}
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join LeftOuter"):].split("Filter")
    assert "state_provinces" in join[1] and "country" in join[2]


def test_a_fourth_level_is_refused(records):
    with pytest.raises(ValueError):
        distinct_names(records({}), {"street": ("Address", "City", "State/Province", "Country")})
