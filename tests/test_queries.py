"""Every registered query against its SQL on another engine, and against the contract."""

import importlib.util
import os

import duckdb
import pytest
from conftest import ROOT, SF_DIR

spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
spark_entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(spark_entry)

from millrace.plans.oracle import ORACLE  # noqa: E402
from millrace.plans.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    yield con
    con.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


def test_all_are_registered():
    registered = spark_entry.queries()
    assert set(QUERIES) <= set(registered)
    assert set(ORACLE) <= set(spark_entry.oracle_sql()) <= set(registered)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    flagship = name == "gold_row_counts"
    got = (spark_entry.entry(spark) if flagship else QUERIES[name](spark, SF_DIR)).toArrow()
    want = duck.sql(ORACLE[name]).to_arrow_table()
    columns = sorted(want.column_names)
    assert sorted(got.column_names) == columns
    got, want = got.select(columns), want.select(columns)
    assert [str(f.type) for f in got.schema] == [str(f.type) for f in want.schema]
    assert got.num_rows == want.num_rows > 0
    duck.register("got", got)
    duck.register("want", want)
    for left, right in (("got", "want"), ("want", "got")):
        extra = duck.sql(f"SELECT * FROM {left} EXCEPT ALL SELECT * FROM {right}").fetchall()
        assert extra == []

