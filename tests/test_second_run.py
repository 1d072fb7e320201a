"""What outlives a run: the ledger of landing files, ids, stamps, rejects, and tables under replacement."""

import datetime
import os
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.keys import extend_key
from millrace.plans.history import carry_stamps
from millrace.plans.lookups import build_lookups
from millrace.plans import history, pipeline
from millrace.plans.pipeline import add_to_silver, build_silver, merge_landing
from millrace.registry import ENTITIES
from millrace.sources.landing import read_landing_checked
from millrace.sources.ledger import covered_files, merged_files, pending_files
from millrace.sources.tables import LINEAGE, Store
from millrace.streaming.landing import stream_landing
from millrace.streaming.silver import stream_silver


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "lake"))


def land(csv_file, store, number, *ids):
    folder = store.landing
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"retail_data_{number}.csv")
    csv_file(Path(path), *[{"Transaction_ID": i} for i in ids])


def ids(df):
    return sorted(int(r[0]) for r in df.select("Transaction_ID").collect())


def test_batches_and_streams_over_the_default_folder_merge_each_file_once(store, csv_file, tmp_path):
    progress = str(tmp_path / "progress")
    land(csv_file, store, 1, 1, 2)
    assert ids(merge_landing(store)) == [1, 2]
    assert ids(stream_landing(store, progress)) == [1, 2]
    land(csv_file, store, 2, 3)
    assert ids(stream_landing(store, progress)) == [1, 2, 3]
    assert ids(merge_landing(store)) == [1, 2, 3]
    land(csv_file, store, 3, 4)
    assert [f.rpartition("/")[2] for f in pending_files(store, store.landing, "retail_data_*.csv")] == ["retail_data_3.csv"]
    assert ids(merge_landing(store, only_new=True)) == [1, 2, 3, 4]
    assert ids(merge_landing(store, only_new=True)) == [1, 2, 3, 4]
    assert ids(stream_landing(store, progress)) == [1, 2, 3, 4]
    assert merged_files(store).count() == 3
    assert LINEAGE not in store.read_bronze().columns and LINEAGE in store.read_bronze(lineage=True).columns


def test_stream_alone_leaves_nothing_for_a_batch(store, csv_file, tmp_path):
    land(csv_file, store, 1, 1)
    stream_landing(store, str(tmp_path / "progress"))
    assert ids(merge_landing(store)) == [1]
    assert merged_files(store, stream=False).count() == 0


def test_known_ids_stay_and_new_ones_follow(spark):
    order = ["name", "parent"]
    known = spark.createDataFrame([("a", "m", None, 1), ("a", "z", "p", 7), ("b", "m", None, 3)], "lookup string, name string, parent string, id long")
    df = spark.createDataFrame([("a", "z", "p"), ("a", "b", None), ("a", "z", None), ("b", "m", None), ("c", "x", None)], "lookup string, name string, parent string")
    got = rows(extend_key(df, order, "id", known, ["lookup"]))
    assert got == rows(spark.createDataFrame(
        [("a", "m", None, 1), ("a", "z", "p", 7), ("b", "m", None, 3), ("a", "b", None, 8), ("a", "z", None, 9), ("c", "x", None, 1)],
        "lookup string, name string, parent string, id long",
    ))


def test_lookups_keep_ids_of_names_that_are_gone(records):
    first = build_lookups(records({"City": "Spring", "State/Province": "East", "Country": "B"}, {"Product_Brand": "Zed"}))
    second = build_lookups(records({"City": "Autumn", "State/Province": "East", "Country": "A"}), known=first)
    for key in first:
        assert set(map(tuple, first[key].collect())) <= set(map(tuple, second[key].collect()))
    assert rows(second["country"].select("Country_ID")) == [(1,), (2,)]
    assert second["city"].count() == 3 and second["city"].select("State_ID").distinct().count() == 2


DAY = [datetime.datetime(2024, 1, d) for d in range(1, 5)]
CUSTOMER = "Customer_ID int, Name string, Email string, Phone string, Age int, Gender string, Income_Level_ID long, Customer_Segment_ID long, Created_Date timestamp_ntz, Updated_Date timestamp_ntz"


def customer(number, name, created, updated):
    return (number, name, None, None, None, None, None, None, DAY[created], DAY[updated])


def test_stamps_change_only_with_their_rows(spark):
    before = spark.createDataFrame(
        [customer(1, "a", 0, 1), customer(2, "b", 0, 0), customer(None, "n", 0, 0), customer(4, "x", 1, 1), customer(4, "y", 0, 2), customer(9, "gone", 0, 0)],
        CUSTOMER,
    )
    now = spark.createDataFrame(
        [customer(*c, 3, 3) for c in [(1, "a"), (1, "a"), (2, "B"), (None, "n"), (None, "m"), (3, "c"), (4, "x"), (4, "z"), (4, None)]], CUSTOMER
    )
    want = [customer(1, "a", 0, 1)] * 2 + [
        customer(2, "B", 0, 3), customer(None, "n", 0, 0), customer(None, "m", 0, 3), customer(3, "c", 3, 3),
        customer(4, "x", 1, 1), customer(4, "z", 0, 3), customer(4, None, 0, 3),
    ]
    got = carry_stamps(now, before, "customers")
    assert got.columns == list(ENTITIES["customers"].columns)
    assert rows(got) == rows(spark.createDataFrame(want, CUSTOMER))
    kept = carry_stamps(now, before, "customers", keep_missing=True)
    assert rows(kept) == rows(spark.createDataFrame([*want, customer(9, "gone", 0, 0)], CUSTOMER))
    assert rows(carry_stamps(now, before.limit(0), "customers")) == rows(now)
    assert carry_stamps(now.limit(0), before, "customers").count() == 0


TRANSACTION = "Transaction_ID int, Customer_ID int, Transaction_DateTime string, Total_Amount double, Total_Purchases int, Shipping_Method_ID long, Payment_Method_ID long, Order_Status_ID long, Created_Date timestamp_ntz, Updated_Date timestamp_ntz"


def transaction(number, time, amount, created, updated, method=None):
    return (number, 7, time, amount, 0, method, 0, 1, DAY[created], DAY[updated])


@pytest.mark.parametrize("evenly", [True, False])
def test_stamps_of_odd_contents(spark, monkeypatch, evenly):
    monkeypatch.setattr(history, "_spread_evenly", lambda *_: evenly)
    nan, values = float("nan"), [(1, "", 1.5), (1, None, 1.5), (2, "x", float("nan")), (3, "x", None), (3, "x", 0.0), (None, None, None), (4, "y", 42.0)]
    before = spark.createDataFrame(
        [transaction(*v, i % 2, 2) for i, v in enumerate(values)] + [transaction(*values[0], 1, 1), transaction(4, "y", 42.0, 0, 1, 0)], TRANSACTION
    )
    now = [*values, *values[:2], (2, "x", 2.5), (3, None, 0.0), (None, "", None), (5, "", nan), (4, "y", 43.0)]
    got = carry_stamps(spark.createDataFrame([transaction(*v, 3, 3) for v in now], TRANSACTION), before, "transactions")
    found = sorted((str(r.Transaction_ID), str(r.Transaction_DateTime), str(r.Total_Amount), DAY.index(r.Created_Date), DAY.index(r.Updated_Date)) for r in got.collect())
    first = {1: 0, 2: 0, 3: 0, 4: 0, None: 1}
    kept = [(*v, i % 2, 2) for i, v in enumerate(values)]
    new = [(*v, first.get(v[0], 3), 3) for v in now[9:]]
    assert found == sorted((str(a), str(b), str(c), d, e) for a, b, c, d, e in [*kept, *kept[:2], *new])


def test_rows_and_earlier_contents_are_moved_once(spark, monkeypatch):
    monkeypatch.setattr(history, "_spread_evenly", lambda *_: True)
    moves, write = {}, history.materialize

    def watched(df, label, codec):
        moves[label] = df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        return write(df, label, codec)

    monkeypatch.setattr(history, "materialize", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = spark.createDataFrame([transaction(i, "x", i / 4, 0, 0) for i in range(20)], TRANSACTION)
        now = spark.createDataFrame([transaction(i, "x", i / 4, 1, 1) for i in range(40)], TRANSACTION)
        got = rows(carry_stamps(now, before, "transactions").select("Transaction_ID", "Created_Date"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert moves["carried"] == 2  # the rows, and the contents as they are grouped
    assert sorted(got) == [(i, DAY[int(i >= 20)]) for i in range(40)]


def test_contents_that_many_rows_share_are_told(spark):
    some = spark.createDataFrame([customer(i % 97, "a", 0, 0) for i in range(500)], CUSTOMER)
    crowd = some.union(spark.createDataFrame([customer(None, None, 0, 0)] * 400, CUSTOMER))
    content = [c for c in some.columns if c not in ("Created_Date", "Updated_Date")]
    assert history._spread_evenly(some, some, content) and not history._spread_evenly(crowd, some, content)
    assert not history._spread_evenly(some, some.withColumn("Age", F.col("Age").cast("long")), content)
    assert history._spread_evenly(some.limit(0), some, content)


def test_silver_keeps_ids_and_stamps(store, csv_file):
    land(csv_file, store, 2, 5, 6)
    merge_landing(store)
    build_silver(store, as_of=DAY[0], keep=True)
    brand = store.read_silver("brand").collect()
    csv_file(Path(store.landing) / "retail_data_1.csv", {"Transaction_ID": 7, "Product_Brand": "Aaa"})
    merge_landing(store, only_new=True)
    build_silver(store, as_of=DAY[1], keep=True)
    assert set(brand) < set(store.read_silver("brand").collect())
    stamps = store.read_silver("transactions").select("Transaction_ID", "Created_Date", "Updated_Date")
    assert rows(stamps) == [(5, DAY[0], DAY[0]), (6, DAY[0], DAY[0]), (7, DAY[1], DAY[1])]


def test_records_that_dont_fit_are_set_aside(spark, tmp_path, csv_file):
    folder = tmp_path / "landing"
    folder.mkdir()
    csv_file(folder / "a.csv", {"Transaction_ID": 1}, {"Transaction_ID": 2, "Age": "old"}, {"Transaction_ID": "x", "Age": "y"})
    with open(folder / "a.csv", "a") as f:
        f.write("7,too,few\n")
    csv_file(folder / "b.csv", {"Transaction_ID": 3, "Zipcode": "SW1A", "Age": None})
    good, rejects = read_landing_checked(spark, str(folder))
    assert ids(good) == [1, 3]
    assert rows(rejects.select(F.element_at(F.split("file", "/"), -1), "reason")) == [("a.csv", "Age"), ("a.csv", "Transaction_ID"), ("a.csv", "columns")]
    assert sorted(r.record.split(",")[0] for r in rejects.collect()) == ["2", "7", "x"]
    assert good.count() + rejects.count() == 5


def test_a_failing_write_leaves_the_old_table(store, spark):
    store.write_silver("brand", spark.createDataFrame([(1, "a")], "Brand_ID long, Brand_Name string"))
    broken = spark.range(1000).select("id", F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.lit("b")).alias("Brand_Name"))
    with pytest.raises(Exception, match="lost"):
        store.write_silver("brand", broken.withColumnRenamed("id", "Brand_ID"))
    assert rows(store.read_silver("brand")) == [(1, "a")]
    table = store.read_silver("brand")
    store.write_silver("brand", table.union(spark.createDataFrame([(2, "b")], table.schema)))  # reads what it replaces
    assert rows(store.read_silver("brand")) == [(1, "a"), (2, "b")]
    assert os.listdir(os.path.dirname(store.silver("brand"))) == ["brand"]


CORE = ("addresses", "customers", "products", "transactions")


def silver_ids(store):
    counts = {key: store.read_silver(key).count() for key in CORE}
    found = ids(store.read_silver("transactions"))
    assert set(counts.values()) == {len(found)}
    assert ids(store.read_silver("products").select(F.col("Product_ID").alias("Transaction_ID"))) == list(range(1, len(found) + 1))
    return found


def test_silver_streams_add_each_record_once_in_whatever_order(store, csv_file, tmp_path):
    progress, landing = str(tmp_path / "silver"), str(tmp_path / "landing")
    land(csv_file, store, 1, 1, 2)
    merge_landing(store)
    stream_silver(store, progress, as_of=DAY[0])
    assert silver_ids(store) == [1, 2]
    land(csv_file, store, 2, 3)
    stream_landing(store, landing)
    stream_silver(store, progress, as_of=DAY[1])
    stream_silver(store, progress, as_of=DAY[2])
    assert silver_ids(store) == [1, 2, 3]
    land(csv_file, store, 3, 4)
    merge_landing(store)  # starts the batch part anew: new files of bronze, old records
    stream_silver(store, progress, as_of=DAY[2])
    assert silver_ids(store) == [1, 2, 3, 4]
    stamps = store.read_silver("transactions").select("Transaction_ID", "Created_Date")
    assert rows(stamps) == [(1, DAY[0]), (2, DAY[0]), (3, DAY[1]), (4, DAY[2])]
    land(csv_file, store, 4, 5)
    merge_landing(store, only_new=True)
    build_silver(store, as_of=DAY[3])
    assert silver_ids(store) == [1, 2, 3, 4, 5]
    assert {r.part for r in covered_files(store).collect()} == {"whole"}
    stream_silver(store, progress, as_of=DAY[3])
    assert silver_ids(store) == [1, 2, 3, 4, 5]
    land(csv_file, store, 5, 6)
    merge_landing(store, only_new=True)
    stream_silver(store, progress, as_of=DAY[3])
    assert silver_ids(store) == [1, 2, 3, 4, 5, 6]
    stream_silver(store, str(tmp_path / "another"), as_of=DAY[3])  # progress lost: batches get their old names again
    assert silver_ids(store) == [1, 2, 3, 4, 5, 6]


def test_a_silver_batch_that_is_lost_half_way_can_be_repeated(store, csv_file, monkeypatch):
    land(csv_file, store, 1, 1, 2)
    merge_landing(store)
    bronze = store.read_bronze(lineage=True)

    def lost(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        recorded = pipeline.cover
        broken.setattr(pipeline, "cover", lambda s, files, last, part: (recorded if part == "whole" else lost)(s, files, last, part))
        with pytest.raises(OSError, match="lost"):
            add_to_silver(store, bronze, "batch-0")
    assert add_to_silver(store, bronze, "batch-0")
    assert silver_ids(store) == [1, 2]
    assert add_to_silver(store, bronze, "batch-0")  # the same batch once more takes its own place
    assert silver_ids(store) == [1, 2]
    assert not add_to_silver(store, bronze, "batch-1")
    with pytest.raises(ValueError, match="landing file"):
        add_to_silver(store, store.read_bronze(), "batch-2")


def test_a_failed_build_has_to_be_repeated_before_batches(store, csv_file, monkeypatch):
    land(csv_file, store, 1, 1)
    merge_landing(store)

    def lost(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(pipeline, "cover", lost)
        with pytest.raises(OSError, match="lost"):
            build_silver(store)
    with pytest.raises(ValueError, match="build_silver"):
        add_to_silver(store, store.read_bronze(lineage=True), "batch-0")
    build_silver(store)
    assert not add_to_silver(store, store.read_bronze(lineage=True), "batch-0")


def test_new_names_of_a_batch_get_ids_behind_the_known_ones(store, csv_file):
    csv_file(_file(store, 1), {"Transaction_ID": 1, "Product_Brand": "M", "products": "z"})
    merge_landing(store)
    add_to_silver(store, store.read_bronze(lineage=True), "batch-0", as_of=DAY[0])
    csv_file(_file(store, 2), {"Transaction_ID": 2, "Product_Brand": "A", "products": "a"}, {"Transaction_ID": 3, "Product_Brand": None, "products": None})
    merge_landing(store, only_new=True)
    add_to_silver(store, store.read_bronze(lineage=True), "batch-1", as_of=DAY[1])
    assert rows(store.read_silver("brand")) == [(1, "M"), (2, "A")]
    products = store.read_silver("products").select("Product_ID", "Product_Name", "Brand_ID", "Created_Date")
    assert sorted(map(tuple, products.collect())) == [(1, "z", 1, DAY[0]), (2, None, None, DAY[1]), (3, "a", 2, DAY[1])]


def _file(store, number):
    os.makedirs(store.landing, exist_ok=True)
    return Path(store.landing) / f"retail_data_{number}.csv"
