import pathlib

import pytest
from conftest import SF_DIR, rows
from pyspark.sql import functions as F

from millrace import session
from millrace.plans.gold import create_table, publish_gold
from millrace.plans.pipeline import build_silver, run_pipeline
from millrace.registry import AUDIT_COLUMNS, BY_NAME, BY_PATH, ENTITIES, LOOKUPS, TABLES
from millrace.session import object_store_conf, scratch_path
from millrace.sources.star import retail_records
from millrace.sources.tables import Store, write_csv


@pytest.fixture(scope="module", params=[BY_NAME, BY_PATH])
def built(request, spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    landing = str(base / "landing")
    write_csv(retail_records(spark, SF_DIR), landing)
    counts = {r.table_name: r.n for r in run_pipeline(spark, str(base), landing, request.param).collect()}
    return request.param, Store(spark, str(base)), counts


def test_all_fifteen_tables_are_published_in_contract_order(built):
    _, store, counts = built
    assert set(counts) == {spec.table for spec in TABLES.values()}
    for key, spec in TABLES.items():
        assert tuple(store.read_gold(key).columns) == spec.columns


def test_counts_relate_to_the_records(built):
    mode, store, counts = built
    total = store.read_bronze().count()
    assert counts["customers"] == counts["transactions"] == total
    for table in ("addresses", "products"):
        assert counts[table] == total if mode == BY_PATH else counts[table] > total


def test_ids_are_dense_and_unique(built):
    _, store, _ = built
    for key in [*LOOKUPS, "products"]:
        column = "Product_ID" if key == "products" else LOOKUPS[key].id
        got = store.read_gold(key).agg(F.min(column), F.max(column), F.count_distinct(column), F.count("*")).first()
        assert got[0] == 1 and got[1] == got[2] == got[3], key


def test_every_foreign_key_exists(built):
    mode, store, _ = built
    links = [
        ("states_provinces", "Country_ID", "country"), ("cities", "State_ID", "state_provinces"),
        ("product_types", "Category_ID", "category"), ("addresses", "City_ID", "city"),
        ("customers", "Income_Level_ID", "income_level"), ("customers", "Customer_Segment_ID", "segment"),
        ("products", "Product_Type_ID", "product_type"), ("products", "Brand_ID", "brand"),
        ("products", "Category_ID", "category"), ("transactions", "Shipping_Method_ID", "shipping_methods"),
        ("transactions", "Payment_Method_ID", "payment_methods"),
        ("transactions", "Order_Status_ID", "order_status"),
    ]
    if mode == BY_NAME:
        links = [link for link in links if link[0] in ("cities", "addresses", "products")]
    by_table = {spec.table: key for key, spec in TABLES.items()}
    for table, column, parent in links:
        child = store.read_gold(by_table[table]).where(F.col(column).isNotNull())
        above = store.read_gold(parent)
        assert child.count(), table
        assert child.join(above, child[column] == above[LOOKUPS[parent].id], "left_anti").count() == 0, table


def test_a_second_run_gives_the_same_rows(built, spark, tmp_path):
    mode, store, _ = built
    again = Store(spark, str(tmp_path))
    again.write_bronze(store.read_bronze().repartition(11))
    build_silver(again, mode)
    for key in TABLES:
        first, second = (s.read_silver(key).drop(*AUDIT_COLUMNS) for s in (store, again))
        assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty(), key


def test_entities_share_one_stamp(built):
    _, store, _ = built
    stamps = {r[0] for key in ENTITIES for r in store.read_gold(key).select("Created_Date").distinct().collect()}
    assert len(stamps) == 1 and None not in stamps


def test_gold_as_views_and_as_catalog_tables(built, spark):
    _, store, counts = built
    names = publish_gold(store, LOOKUPS, views=True)
    assert {n: spark.table(n).count() for n in names} == {n: counts[n] for n in names}
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    for _ in range(2):
        publish_gold(store, ["brand", "city"], database="shop")
    assert rows(spark.table("shop.brands")) == rows(store.read_gold("brand"))
    assert {t.name for t in spark.catalog.listTables("shop") if not t.isTemporary} == {"brands", "cities"}


def test_scratch_lies_below_the_configured_folder(spark):
    assert scratch_path(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_run_removes_its_scratch_data_and_leaves_that_of_others(built, spark):
    mode, store, _ = built
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir"), "millrace")
    lost = shared / "run-lost" / "keys"
    lost.mkdir(parents=True, exist_ok=True)
    before = sorted(shared.iterdir())
    build_silver(store, mode)
    assert sorted(shared.iterdir()) == before and lost.exists()


def test_scratch_of_a_run_lies_below_the_data_if_no_folder_is_set(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_shared", lambda spark: None)
    with session.scratch_run(spark, str(tmp_path)) as folder:
        assert folder.startswith(f"{tmp_path}/_scratch/")
        assert session.materialize(spark.range(3)).count() == 3 and pathlib.Path(folder).exists()
    assert not pathlib.Path(folder).exists()


def test_any_parquet_path_becomes_a_table(built, spark, tmp_path):
    _, store, _ = built
    spark.sql("CREATE DATABASE IF NOT EXISTS anywhere")
    every = create_table(spark, "anywhere.brands", store.gold("brand"))
    assert every.columns == store.read_gold("brand").columns
    for _ in range(2):
        names = create_table(spark, "anywhere.names", store.gold("brand"), ["Brand_Name"], str(tmp_path / "names"))
    assert rows(names) == rows(store.read_gold("brand").select("Brand_Name"))
    assert spark.read.parquet(str(tmp_path / "names")).columns == ["Brand_Name"]


def test_product_ids_may_be_int(built, spark, tmp_path):
    mode, store, _ = built
    narrow = Store(spark, str(tmp_path))
    narrow.write_bronze(store.read_bronze().limit(50))
    build_silver(narrow, mode, key_type="int")
    assert dict(narrow.read_silver("products").dtypes)["Product_ID"] == "int"


def test_object_store_settings_hold_no_secret():
    conf = object_store_conf("http://store:9000", ssl=False)
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert not [key for key in conf if "secret" in key or "access.key" in key]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_core_tables_scan_narrow_and_do_not_shuffle(built, spark):
    from millrace.plans.entities import build_transactions

    _, store, _ = built
    lookups = {key: store.read_silver(key) for key in LOOKUPS}
    plan = _plan(build_transactions(store.read_bronze(), lookups))
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 3
    assert "Email" not in plan and "products" not in plan


def test_pipeline_over_inferred_types(spark, tmp_path, csv_file):
    """Numbers, dates and numeric-looking names get other types by inference; the result is the same."""
    landing = tmp_path / "landing"
    landing.mkdir()
    csv_file(
        landing / "a.csv",
        {"Transaction_ID": 7, "City": 12, "Product_Type": 5, "Time": "2024-05-01 10:00:00"},
        {"Transaction_ID": 6852899987, "City": 9, "Product_Type": 40, "Time": "2024-05-02 11:00:00"},
    )
    seen = []
    for infer in (False, True):
        base = tmp_path / str(infer)
        run_pipeline(spark, str(base), str(landing), infer=infer).collect()
        store = Store(spark, str(base))
        seen.append({
            key: rows(store.read_gold(key).drop("Transaction_DateTime", *AUDIT_COLUMNS)) for key in TABLES
        })
    assert seen[0] == seen[1]
    assert [r[1] for r in seen[0]["city"]] == ["12", "9"]
    assert sorted(r[0] is None for r in seen[0]["transactions"]) == [False, True]
