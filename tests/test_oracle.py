"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) == set(E._ORACLE)


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF, name, con)
    assert r["status"] == "OK", r


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert tuple(df.columns) == ("order_id", "customer_id", "product_id", "quantity", "price", "total_price", "order_timestamp", "processing_timestamp", "status")


@pytest.mark.parametrize("name", ["enrich_orders", "truncate_ms", "by_order_time", "upsert_snapshot", "decode_micros_ts"])
def test_results_do_not_depend_on_the_session_zone(spark, con, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        r = compare(spark, SF, name, con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert r["status"] == "OK", r
