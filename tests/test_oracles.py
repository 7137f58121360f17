"""Every registered query against DuckDB on the same Parquet files."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import DATA, GIVEN
from millrace.plans.queries import ORACLES, QUERIES
from millrace.session import setting

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in GIVEN:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def same(df, duck, sql):
    columns = sorted(df.columns)
    mine = sorted(repr([r[c] for c in columns]) for r in df.collect())
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = sorted(repr([r[i] for i in order]) for r in cursor.fetchall())
    assert len(mine) == len(theirs)
    assert mine == theirs


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(name, spark, duck):
    same(QUERIES[name](spark, SF), duck, ORACLES[name])


LARGE_SIDE = [
    "bronze_child_export",
    "append_if_absent",
    "line_enriched",
    "refund_enriched",
    "asof_orders",
    "asof_lines",
    "fct_refunds",
    "role_playing_join",
    "dq_refund_above_total",
    "scd2_merge_part",
]


@pytest.mark.parametrize("name", LARGE_SIDE)
def test_query_matches_oracle_without_broadcast(name, spark, duck):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        same(QUERIES[name](spark, SF), duck, ORACLES[name])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert {"order_id", "restaurant_sk", "is_current_restaurant_details"} <= set(df.columns)
    assert df.count() == 1500
