import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import keys
from millrace.operators.keys import dense_key, occurrence_key


def test_dense_key_follows_the_order(spark):
    values = random.Random(1).sample(range(100_000), 5_000)
    df = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(7)
    got = {r.v: r.id for r in dense_key(df, ["v"], "id").collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(values))}


def test_dense_key_starts_over_within_a_group(spark):
    rows = [(g, f"{g}{i:04d}") for g, n in (("a", 900), ("b", 1), ("c", 300)) for i in range(n)]
    df = spark.createDataFrame(random.Random(2).sample(rows, len(rows)), "g string, v string").repartition(5)
    got = {(r.g, r.v): r.id for r in dense_key(df, ["v"], "id", within=["g"]).collect()}
    want = {}
    for g in "abc":
        want.update({row: i + 1 for i, row in enumerate(sorted(r for r in rows if r[0] == g))})
    assert got == want


def test_dense_key_breaks_ties_by_the_next_column_and_sorts_nulls_first(spark):
    df = spark.createDataFrame([("x", "b"), ("x", None), ("x", "a"), (None, "z")], "n string, p string")
    got = {(r.n, r.p): r.id for r in dense_key(df, ["n", "p"], "id", "int").collect()}
    assert got == {(None, "z"): 1, ("x", None): 2, ("x", "a"): 3, ("x", "b"): 4}


def test_dense_key_of_nothing(spark):
    df = spark.createDataFrame([], "v string")
    out = dense_key(df, ["v"], "id", "int")
    assert out.count() == 0 and out.schema["id"].dataType.simpleString() == "int"


def test_dense_key_ignores_partitioning(spark):
    df = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("v"))
    one = dense_key(df.repartition(1), ["v"], "id")
    many = dense_key(df.repartition(13), ["v"], "id")
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


@pytest.mark.parametrize("chunk", [10, 1 << 16])
def test_occurrence_key_equals_a_row_number_even_with_a_hot_group(spark, monkeypatch, chunk):
    monkeypatch.setattr(keys, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(keys, "TASK_ROWS", chunk * 4)
    rnd = random.Random(3)
    sizes = {f"p{i:03d}": rnd.randint(1, 30) for i in range(200)} | {"p077": 2_000}
    groups = spark.createDataFrame([(k, n) for k, n in sizes.items()], "v string, n bigint").repartition(6)
    got = sorted((r.id, r.v) for r in occurrence_key(groups, ["v"], "n", "id").collect())
    flat = [v for v in sorted(sizes) for _ in range(sizes[v])]
    assert got == [(i + 1, v) for i, v in enumerate(flat)]


def test_a_hot_group_is_expanded_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(keys, "CHUNK_ROWS", 100)
    monkeypatch.setattr(keys, "TASK_ROWS", 400)
    groups = spark.createDataFrame([("hot", 4_000), ("cold", 1)], "v string, n bigint")
    out = occurrence_key(groups, ["v"], "n", "id").where("v = 'hot'")
    per_task = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 3 and sum(r["count"] for r in per_task) == 4_000


def test_occurrence_key_of_nothing_and_narrow_type(spark):
    groups = spark.createDataFrame([], "v string, n bigint")
    out = occurrence_key(groups, ["v"], "n", "id", "int")
    assert out.count() == 0 and out.schema["id"].dataType.simpleString() == "int"


def test_no_window_gathers_the_rows_in_one_partition(spark):
    """The only unpartitioned window is the one over the per-range shifts."""
    df = spark.range(10_000).select(F.col("id").cast("string").alias("v"))
    out = dense_key(df, ["v"], "id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    before_single = plan.split("SinglePartition")[1]
    assert "HashAggregate" in before_single.split("FileScan")[0]
