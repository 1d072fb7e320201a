import pytest
from conftest import rows

from pyspark.sql import functions as F

from millrace.operators.joins import BROADCAST_SETTING, SHARES, Match, attach, hot_keys, measure


@pytest.fixture(scope="module")
def tables(spark):
    facts = spark.createDataFrame(
        [(i, "hot" if i % 3 else None if i % 2 else f"k{i % 5}") for i in range(300)] + [(999, "unknown")],
        "id bigint, k string",
    )
    names = spark.createDataFrame([(1, "hot"), (2, "k0"), (3, "k2"), (4, "k2")], "nid bigint, name string")
    return facts, names


def test_broadcast_and_salted_joins_agree(tables):
    facts, names = tables
    small = attach(facts, [Match(names, {"k": "name"})])
    large = attach(facts, [Match(names, {"k": "name"})], broadcast_bytes=0)
    assert small.columns == large.columns == ["id", "k", "nid"]
    assert rows(small) == rows(large)
    assert rows(small) == rows(facts.join(names, facts.k == names.name, "left").drop("name"))


def test_every_record_survives_and_fan_out_is_kept(tables):
    facts, names = tables
    out = attach(facts, [Match(names, {"k": "name"})])
    doubled = facts.where("k = 'k2'").count()
    assert doubled and out.count() == facts.count() + doubled
    assert out.where("k is null and nid is not null").count() == 0
    assert out.where("id = 999").collect()[0].nid is None


def test_the_plan_follows_the_measured_size(tables):
    facts, names = tables
    match = [Match(names, {"k": "name"})]

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(attach(facts, match))
    assert "_salt" in plan(attach(facts, match, broadcast_bytes=0))


def test_measure_counts_text_and_overhead(spark):
    short = spark.createDataFrame([("a",)], "s string")
    long = spark.createDataFrame([("a" * 1000,)], "s string")
    empty = spark.createDataFrame([], "s string")
    a, b, none = measure([short, long, empty])
    assert b - a == 999 and none == 0


def test_the_session_can_set_the_limit(spark, tables):
    facts, names = tables
    spark.conf.set(BROADCAST_SETTING, "0")
    try:
        out = attach(facts, [Match(names, {"k": "name"})])
        assert "_salt" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(BROADCAST_SETTING)


@pytest.mark.parametrize("how", ["right", "full", "left_anti"])
def test_only_joins_that_keep_to_the_records(tables, how):
    facts, names = tables
    with pytest.raises(ValueError, match="how"):
        attach(facts, [Match(names, {"k": "name"})], how=how, broadcast_bytes=0)


def test_inner_joins_agree_whatever_the_size(tables):
    facts, names = tables
    match = [Match(names, {"k": "name"})]
    assert rows(attach(facts, match, "inner")) == rows(attach(facts, match, "inner", broadcast_bytes=0))


def test_the_limit_holds_for_all_tables_together(tables):
    facts, names = tables
    other = names.withColumnRenamed("nid", "oid")
    one = measure([names])[0]
    plan = attach(facts, [Match(names, {"k": "name"}), Match(other, {"k": "name"})], broadcast_bytes=one)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "_salt" in text


@pytest.fixture
def many_partitions(spark):
    """As many shuffle partitions as a small cluster has, none of them merged."""
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield 64
    for name, value in before.items():
        spark.conf.set(name, value)


def _skewed(spark, number=30_000):
    """A third of the records under one key, a tenth without any, the others all different."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 10 != 1, F.concat(F.lit("k"), F.col("id")))
    return spark.range(number).select("id", key.alias("k"))


def test_hot_keys_get_salts_by_their_share(spark, many_partitions):
    facts = _skewed(spark)
    (found,) = hot_keys(facts, [["k"]])
    (hash_of_hot,) = [r[0] for r in facts.where("k = 'hot'").select(F.xxhash64("k")).distinct().collect()]
    assert set(found) == {hash_of_hot}
    assert found[hash_of_hot] == pytest.approx(SHARES * many_partitions / 3, abs=2)


def test_keys_of_even_size_get_no_salt(spark, many_partitions):
    even = spark.range(30_000).select(F.concat(F.lit("k"), F.col("id") % 1000).alias("k"))
    assert hot_keys(even, [["k"], ["k"]]) == [{}, {}]
    assert hot_keys(even.limit(0), [["k"]]) == [{}]
    assert hot_keys(even.select(F.lit(None).cast("string").alias("k")), [["k"]]) == [{}]


def test_a_third_of_the_records_under_one_key_spreads_over_many_tasks(spark, many_partitions):
    facts = _skewed(spark)
    names = spark.range(30_000).select(F.col("id").alias("nid"), F.concat(F.lit("k"), F.col("id")).alias("name"))
    names = names.union(spark.createDataFrame([(-1, "hot")], "nid bigint, name string"))
    out = attach(facts, [Match(names, {"k": "name"})], broadcast_bytes=0)
    tasks = out.withColumn("task", F.spark_partition_id()).where("k = 'hot'").groupBy("task").count().collect()
    assert len(tasks) > 16
    assert max(t["count"] for t in tasks) < 3 * 30_000 / many_partitions
    empty = out.withColumn("task", F.spark_partition_id()).where("k is null").select("task").distinct().count()
    assert empty > 16
    want = facts.join(names, facts.k == names.name, "left").select("id", "k", "nid")
    assert out.exceptAll(want).isEmpty() and want.exceptAll(out).isEmpty()


def test_several_large_tables_and_keys_of_several_columns(spark, many_partitions):
    facts = _skewed(spark, 3000).withColumn("part", F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 7).cast("int")))
    places = facts.select(F.col("k").alias("name"), F.col("part").cast("bigint").alias("number")).distinct()
    places = places.withColumn("pid", F.hash("name", "number"))
    others = spark.createDataFrame([(1, "one"), (2, "two")], "number bigint, word string")
    matches = [Match(places, {"k": "name", "part": "number"}), Match(others, {"part": "number"})]
    small, large = attach(facts, matches), attach(facts, matches, broadcast_bytes=0)
    assert small.columns == large.columns == ["id", "k", "part", "pid", "word"]
    assert rows(small) == rows(large)
    assert large.where("k = 'hot' and pid is not null and word = 'one'").count() == 1000


def test_equal_records_are_all_kept(spark, many_partitions):
    facts = spark.range(1000).select(F.lit("same").alias("k"))
    names = spark.createDataFrame([(1, "same")], "nid bigint, name string")
    assert attach(facts, [Match(names, {"k": "name"})], broadcast_bytes=0).where("nid = 1").count() == 1000
