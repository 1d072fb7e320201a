import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.plans import queries
from millrace.plans.pipeline import merge_landing, run_pipeline
from millrace.registry import LANDING_TYPES
from millrace.sources import tables
from millrace.sources.landing import PACKED_GLOB, landing_manifest, landing_schema, read_landing, read_landing_checked, reconcile
from millrace.sources.tables import Store, write_csv
from millrace.streaming.landing import stream_landing

COLUMNS = tuple(LANDING_TYPES)


def test_many_files_read_as_one_typed_table(spark, tmp_path, csv_file):
    csv_file(tmp_path / "a.csv", {"Transaction_ID": 1}, {"Transaction_ID": 2, "Income": None})
    csv_file(tmp_path / "b.csv", {"Transaction_ID": 3, "Age": "old"})
    df = read_landing(spark, str(tmp_path / "*.csv"))
    assert [tuple(d) for d in df.dtypes] == list(LANDING_TYPES.items())
    assert df.count() == 3
    assert df.where("Income is null").count() == 1 and df.where("Age is null").count() == 1
    assert df.first()["Time"] == "22:03:55"


def test_header_order_is_free_but_must_be_shared(spark, tmp_path, csv_file):
    swapped = ("Customer_ID", "Transaction_ID", *COLUMNS[2:])
    csv_file(tmp_path / "a.csv", {"Transaction_ID": 1, "Customer_ID": 8}, columns=swapped)
    assert read_landing(spark, str(tmp_path / "a.csv")).first()["Customer_ID"] == 8.0
    csv_file(tmp_path / "b.csv", {"Transaction_ID": 2, "Customer_ID": 9})
    with pytest.raises(Exception, match="header"):
        read_landing(spark, str(tmp_path / "*.csv")).collect()


def test_extra_columns_are_kept_and_missing_ones_refused(spark, tmp_path, csv_file):
    csv_file(tmp_path / "a.csv", {"Ratings": 5}, columns=(*COLUMNS, "Ratings"))
    assert read_landing(spark, str(tmp_path / "a.csv")).first()["Ratings"] == "5"
    csv_file(tmp_path / "b.csv", {}, columns=COLUMNS[1:])
    with pytest.raises(ValueError, match="Transaction_ID"):
        landing_schema(spark, str(tmp_path / "b.csv"))


def test_inference_is_opt_in(spark, tmp_path, csv_file):
    csv_file(tmp_path / "a.csv", {})
    assert dict(read_landing(spark, str(tmp_path), infer=True).dtypes)["Zipcode"] == "int"
    assert dict(read_landing(spark, str(tmp_path)).dtypes)["Zipcode"] == "string"


def test_manifest_names_missing_empty_and_unexpected_files(spark, tmp_path, csv_file):
    csv_file(tmp_path / "retail_data_1.csv", {}, {})
    csv_file(tmp_path / "retail_data_2.csv")
    csv_file(tmp_path / "stray.csv", {})
    out = {r.source: (r.rows, r.status) for r in landing_manifest(spark, str(tmp_path)).collect()}
    assert out["retail_data_1.csv"] == (2, "present")
    assert out["retail_data_2.csv"] == (0, "empty")
    assert out["stray.csv"] == (1, "unexpected")
    assert [s for s, (_, status) in out.items() if status == "missing"] and len(out) == 11


def test_manifest_of_an_empty_folder_and_of_odd_headers(spark, tmp_path, csv_file):
    assert {r.status for r in landing_manifest(spark, str(tmp_path)).collect()} == {"missing"}
    csv_file(tmp_path / "retail_data_3.csv", {}, {}, columns=("Name", "Time"))
    out = {r.source: (r.rows, r.status) for r in landing_manifest(spark, str(tmp_path)).collect()}
    assert out["retail_data_3.csv"] == (2, "present")


def test_merge_survives_a_missing_file(spark, tmp_path, csv_file):
    for i in range(1, 10):
        csv_file(tmp_path / f"retail_data_{i}.csv", {"Transaction_ID": i})
    store = Store(spark, str(tmp_path / "base"))
    bronze = merge_landing(store, str(tmp_path / "retail_data_*.csv"))
    assert sorted(r.Transaction_ID for r in bronze.collect()) == [float(i) for i in range(1, 10)]


def test_merge_overwrites_and_can_gather_files(spark, tmp_path, csv_file):
    csv_file(tmp_path / "a.csv", {})
    csv_file(tmp_path / "b.csv", {})
    store = Store(spark, str(tmp_path / "base"))
    merge_landing(store, str(tmp_path / "*.csv"))
    bronze = merge_landing(store, str(tmp_path / "*.csv"), num_files=1)
    assert bronze.count() == 2
    assert bronze.select(F.col("_metadata.file_name")).distinct().count() == 1


def test_csv_sink_has_a_header_and_no_index(spark, tmp_path, records):
    df = records({"Income": None}, {"Name": 'Quo"te, comma'})
    write_csv(df, str(tmp_path / "out"))
    assert rows(read_landing(spark, str(tmp_path / "out"))) == rows(df)


def test_packed_files_are_bounded_and_read_in_every_way(spark, tmp_path, records, monkeypatch):
    monkeypatch.setattr(tables, "PACKED_RECORDS", 2)
    df = records(*[{"Transaction_ID": float(i), "Income": None, "Name": 'Quo"te, \u00e9'} for i in range(7)]).coalesce(1)
    folder = str(tmp_path / "in")
    write_csv(df, folder, packed=True)
    assert len(list((tmp_path / "in").glob("*.csv.gz"))) == 4 and not list((tmp_path / "in").glob("*.csv"))
    assert rows(read_landing(spark, folder, pattern=PACKED_GLOB)) == rows(df)
    assert rows(read_landing_checked(spark, folder, PACKED_GLOB)[0]) == rows(df)
    store = Store(spark, str(tmp_path / "base"))
    assert rows(merge_landing(store, folder, pattern=PACKED_GLOB)) == rows(df)
    write_csv(records({"Transaction_ID": 7.0}).coalesce(1), f"{folder}/later", packed=True)
    both = stream_landing(store, str(tmp_path / "progress"), folder, pattern=PACKED_GLOB)
    assert both.count() == 8 and merge_landing(store, folder, only_new=True, pattern=PACKED_GLOB).count() == 8
    manifest = landing_manifest(spark, folder, [], pattern=PACKED_GLOB)
    assert manifest.count() == 5 and reconcile(manifest, both).first().status == "complete"
    counts = run_pipeline(spark, str(tmp_path / "lake"), folder, pattern=PACKED_GLOB)
    assert dict(counts.collect())["transactions"] == 8
    assert landing_manifest(spark, folder, []).count() == 0  # left alone unless asked for


@pytest.mark.parametrize("name", [
    "csv_roundtrip", "landing_stream", "landing_batch_then_stream", "landing_partitioned", "landing_ledger", "landing_rejects",
    "landing_manifest", "gold_row_counts_keyed",
])
def test_queries_land_packed_files_only(spark, tmp_path, records, monkeypatch, name):
    places = iter(range(100))
    monkeypatch.setattr(queries, "scratch_path", lambda spark, label="stage": str(tmp_path / f"{label}-{next(places)}"))
    monkeypatch.setattr(queries, "retail_records", lambda spark, sf_dir: records(*[{"Transaction_ID": float(i)} for i in range(1, 13)]))
    assert queries.QUERIES[name](spark, "").count() > 0
    landed = [p.name for p in tmp_path.glob("landing-*/**/part-*")]
    assert landed and all(x.endswith(".csv.gz") for x in landed)


def test_stream_merges_each_file_once(spark, tmp_path, csv_file):
    landing, store = tmp_path / "in", Store(spark, str(tmp_path / "base"))
    landing.mkdir()
    csv_file(landing / "a.csv", {"Transaction_ID": 1})
    csv_file(landing / "b.csv", {"Transaction_ID": 2})
    progress = str(tmp_path / "progress")
    assert stream_landing(store, progress, str(landing), files_per_batch=1).count() == 2
    csv_file(landing / "c.csv", {"Transaction_ID": 3})
    again = stream_landing(store, progress, str(landing))
    assert sorted(r.Transaction_ID for r in again.collect()) == [1.0, 2.0, 3.0]
    assert stream_landing(store, progress, str(landing)).count() == 3


def test_streams_and_batches_share_a_bronze(spark, tmp_path, csv_file):
    store, progress = Store(spark, str(tmp_path / "base")), str(tmp_path / "progress")
    arriving, whole = tmp_path / "arriving", tmp_path / "whole"
    for folder in (arriving, whole):
        folder.mkdir()
    csv_file(arriving / "a.csv", {"Transaction_ID": 1})
    csv_file(whole / "b.csv", {"Transaction_ID": 2})
    assert stream_landing(store, progress, str(arriving)).count() == 1
    assert merge_landing(store, str(whole)).count() == 2
    csv_file(arriving / "c.csv", {"Transaction_ID": 3})
    both = stream_landing(store, progress, str(arriving))
    assert sorted(r.Transaction_ID for r in both.collect()) == [1.0, 2.0, 3.0]


def test_nested_and_dated_folders_are_read_and_strays_left_alone(spark, tmp_path, csv_file):
    for i, place in enumerate(("day=1", "day=2/late", "more")):
        (tmp_path / place).mkdir(parents=True)
        csv_file(tmp_path / place / f"retail_data_{i}.csv", {"Transaction_ID": i})
    (tmp_path / "stray.txt").write_text("not,a,landing,file\n")
    assert sorted(r.Transaction_ID for r in read_landing(spark, str(tmp_path)).collect()) == [0.0, 1.0, 2.0]
    assert tuple(read_landing(spark, str(tmp_path)).columns) == COLUMNS
    store = Store(spark, str(tmp_path / "base"))
    assert stream_landing(store, str(tmp_path / "progress"), str(tmp_path / "day=2")).count() == 1


def test_inference_checks_the_headers_too(spark, tmp_path, csv_file):
    csv_file(tmp_path / "a.csv", {"Transaction_ID": 1})
    csv_file(tmp_path / "b.csv", {"Transaction_ID": 2}, columns=COLUMNS[::-1])
    with pytest.raises(Exception, match="header"):
        read_landing(spark, str(tmp_path), infer=True).collect()


def test_a_short_bronze_shows(spark, csv_file, tmp_path):
    folder = tmp_path / "landing"
    (folder / "day=1").mkdir(parents=True)
    csv_file(folder / "day=1" / "a.csv", {}, {})
    csv_file(folder / "b.csv", {})
    manifest = landing_manifest(spark, str(folder), ["a.csv", "b.csv", "c.csv"])
    seen = {r.source: (r.rows, r.status) for r in manifest.collect()}
    assert seen == {"a.csv": (2, "present"), "b.csv": (1, "present"), "c.csv": (0, "missing")}
    merged = read_landing(spark, str(folder))
    for bronze, status in ((merged, "complete"), (merged.limit(2), "short"), (merged.union(merged), "over")):
        got = reconcile(manifest, bronze).collect()
        assert [(r.files, r.landing_rows, r.bronze_rows, r.status) for r in got] == [(2, 3, bronze.count(), status)]


def test_stream_leaves_out_merged_files_without_shuffling_the_records(spark):
    from millrace.sources.tables import LINEAGE
    from millrace.streaming.landing import unmerged

    records = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], f"x long, {LINEAGE} string")
    known = spark.createDataFrame([("a",)], f"{LINEAGE} string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = unmerged(records, known)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.x for r in kept.collect()) == [2, 3]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and kept.columns == records.columns
