"""Every registered query against its SQL on the smallest tables, and the shape of key plans."""

import os
import sys
from pathlib import Path

import duckdb
import pytest
from conftest import plan_of

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from seekframe.plans import QUERIES as OWN  # noqa: E402
from tools.check import TABLES, rows_of, types_of  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES = queries()
SQL = {name: sql for name, sql in oracle_sql().items() if name in OWN}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_names():
    assert set(oracle_sql()) <= set(QUERIES)
    assert set(OWN) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    got = df.toArrow()
    want = db.sql(SQL[name]).to_arrow_table()
    assert types_of(got) == types_of(want)
    assert rows_of(got) == rows_of(want)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["doc_id", "lang", "n_chars", "_score", "rank"]
    assert df.count() == 10


@pytest.mark.parametrize("name, parts", [
    ("filter_startswith", ["PushedFilters: [IsNotNull(source), StringStartsWith(source,src1)]"]),
    ("filter_endswith", ["StringEndsWith(source,7)"]),
    ("filter_gt", ["GreaterThan(n_chars,2000)", "ReadSchema: struct<doc_id:bigint,lang:string,n_chars:bigint>"]),
    ("match_topk", ["TakeOrderedAndProject", "GreaterThan(n_chars,200)"]),
    ("page_offset_limit", ["TakeOrderedAndProject(limit=30"]),
    ("drilldown_multi", ["Expand", "partial_count"]),
    ("sequence_last_n", ["WindowGroupLimit"]),
    ("suggest_batch", ["WindowGroupLimit", "BroadcastHashJoin"]),
    ("match_across_ref", ["BroadcastHashJoin"]),
])
def test_plans(spark, name, parts):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for part in parts:
        assert part in plan, part
