"""Last-arrival-wins and keyed merges (FIXTURES F7)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from orderstream.operators import empty_snapshot, enrich, latest_per_key, upsert_snapshot
from orderstream.sinks import KeyedTable

AT = "2024-06-01 00:00:00"
RAW = "offset long, order_id string, customer_id string, product_id string, quantity int, price decimal(10,2), order_timestamp timestamp_ntz, status string"


def batch(spark, rows, at=AT):
    df = spark.createDataFrame(rows, RAW)
    return enrich(df, at=at, keep=("offset",))


def row(offset, oid, qty, ts_day, status="pending"):
    return (offset, oid, "c", "p", qty, Decimal("1.00"), dt.datetime(2024, 1, ts_day), status)


def test_latest_per_key_arrival_order(spark):
    # the older order time arrives later and still wins
    b = batch(spark, [row(1, "a", 1, 5), row(2, "a", 2, 1), row(3, "b", 7, 2)])
    got = {r.order_id: r.quantity for r in latest_per_key(b).collect()}
    assert got == {"a": 2, "b": 7}


def test_latest_per_key_plan_reduces_before_shuffle(spark):
    b = batch(spark, [row(1, "a", 1, 5), row(2, "a", 2, 1)])
    plan = latest_per_key(b)._jdf.queryExecution().executedPlan().toString()
    # AQE wraps the plan; the initial plan holds the partial group limit
    text = latest_per_key(b)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text, text
    assert plan


def test_upsert_keeps_created_at_and_is_idempotent(spark):
    b1 = batch(spark, [row(1, "a", 1, 1), row(2, "b", 1, 1)], at="2024-06-01 00:00:00")
    b2 = batch(spark, [row(3, "a", 5, 2), row(4, "c", 1, 2)], at="2024-06-02 00:00:00")
    s1 = upsert_snapshot(empty_snapshot(b1), b1)
    s2 = upsert_snapshot(s1, b2)
    got = {r.order_id: (r.quantity, r.created_at, r.processing_timestamp) for r in s2.collect()}
    assert got["a"] == (5, dt.datetime(2024, 6, 1), dt.datetime(2024, 6, 2))
    assert got["b"] == (1, dt.datetime(2024, 6, 1), dt.datetime(2024, 6, 1))
    assert got["c"] == (1, dt.datetime(2024, 6, 2), dt.datetime(2024, 6, 2))
    # replaying the same batch gives the same table
    s3 = upsert_snapshot(s2, b2)
    assert s3.exceptAll(s2).count() == 0 and s2.exceptAll(s3).count() == 0


def test_batches_in_order_equal_whole_input_once(spark):
    rows = [row(i, f"k{i % 3}", i, 1 + i % 5) for i in range(20)]
    whole = batch(spark, rows)
    once = upsert_snapshot(empty_snapshot(whole), whole, created_value=F.col("order_timestamp"))
    snap = empty_snapshot(whole)
    for lo in range(0, 20, 7):
        part = batch(spark, rows[lo : lo + 7])
        snap = upsert_snapshot(snap, part, created_value=F.col("order_timestamp"))
    assert once.exceptAll(snap).count() == 0 and snap.exceptAll(once).count() == 0


def test_keyed_table_log_replay(spark, tmp_path):
    t = KeyedTable(str(tmp_path / "keyed"))
    b1 = batch(spark, [row(1, "a", 1, 1), row(2, "a", 2, 1)], at="2024-06-01 00:00:00")
    b2 = batch(spark, [row(3, "a", 3, 1), row(4, "b", 1, 1)], at="2024-06-02 00:00:00")
    t.write_batch(b1, 0)
    t.write_batch(b2, 1)
    t.write_batch(b2, 1)  # replay of batch 1 overwrites, never duplicates
    got = {r.order_id: (r.quantity, r.created_at) for r in t.snapshot(spark).collect()}
    assert got == {"a": (3, dt.datetime(2024, 6, 1)), "b": (1, dt.datetime(2024, 6, 2))}
    assert t.log(spark).count() == 3


def test_keyed_table_compaction_continues_from_base(spark, tmp_path):
    t1 = KeyedTable(str(tmp_path / "log1"))
    t1.write_batch(batch(spark, [row(1, "a", 1, 1), row(2, "b", 1, 1)], at="2024-06-01 00:00:00"), 0)
    t1.write_batch(batch(spark, [row(3, "a", 2, 1)], at="2024-06-02 00:00:00"), 1)
    base = str(tmp_path / "base1")
    t1.compact(spark, base)
    t2 = KeyedTable(str(tmp_path / "log2"), base=base)
    t2.write_batch(batch(spark, [row(4, "a", 3, 1), row(5, "c", 9, 1)], at="2024-06-03 00:00:00"), 0)
    got = {r.order_id: (r.quantity, r.created_at) for r in t2.snapshot(spark).collect()}
    assert got == {
        "a": (3, dt.datetime(2024, 6, 1)),
        "b": (1, dt.datetime(2024, 6, 1)),
        "c": (9, dt.datetime(2024, 6, 3)),
    }


def test_same_key_twice_in_one_message_last_line_wins(spark, tmp_path, messages):
    from orderstream.plans import PipelineOptions
    from orderstream.streaming import OrderBatchJob

    a1 = '{"order_id":"a","customer_id":"c","product_id":"p","quantity":1,"price":1,"order_timestamp":"2024-01-01T00:00:00","status":"x"}'
    a2 = a1.replace('"quantity":1', '"quantity":2')
    topic = messages([a1 + "\n" + a2, a2 + "\n" + a1])
    job = OrderBatchJob(str(tmp_path / "k"), target="keyed", opts=PipelineOptions(at=AT, split_lines=True))
    job(topic.filter("offset = 0"), 0)
    assert KeyedTable(str(tmp_path / "k")).snapshot(spark).collect()[0].quantity == 2
    job(topic, 1)  # message 1: a2 then a1, so a1 (quantity 1) arrives last
    assert KeyedTable(str(tmp_path / "k")).snapshot(spark).collect()[0].quantity == 1
    b = enrich(
        spark.createDataFrame([(0, 0, "a", "c", "p", 1, Decimal("1"), dt.datetime(2024, 1, 1), "x"),
                               (0, 1, "a", "c", "p", 2, Decimal("1"), dt.datetime(2024, 1, 1), "x")],
                              "offset long, line int, " + RAW.split(", ", 1)[1]),
        at=AT, keep=("offset", "line"),
    )
    got = upsert_snapshot(empty_snapshot(b), b, order=("offset", "line")).collect()
    assert [r.quantity for r in got] == [2]


def test_event_time_order_is_an_option(spark):
    # an older order time arriving later: arrival order keeps it, event-time order does not
    b = batch(spark, [row(1, "a", 1, 5), row(2, "a", 2, 1)])
    assert latest_per_key(b).collect()[0].quantity == 2
    assert latest_per_key(b, order=("order_timestamp", "offset")).collect()[0].quantity == 1


def test_keyed_table_with_base_and_empty_log(spark, tmp_path):
    t1 = KeyedTable(str(tmp_path / "log1"))
    t1.write_batch(batch(spark, [row(1, "a", 1, 1)]), 0)
    t1.compact(spark, str(tmp_path / "base"))
    t2 = KeyedTable(str(tmp_path / "log2"), base=str(tmp_path / "base"))
    assert [r.order_id for r in t2.snapshot(spark, empty_log=True).collect()] == ["a"]
    with pytest.raises(AnalysisException):  # a missing log is an error unless it is expected
        t2.snapshot(spark)
    with pytest.raises(AnalysisException):
        t2.compact(spark, str(tmp_path / "base2"))


def test_keyed_snapshot_folds_base_and_log(spark, tmp_path):
    t1 = KeyedTable(str(tmp_path / "log1"))
    t1.write_batch(batch(spark, [row(i, f"k{i}", i, 1) for i in range(10)]), 0)
    t1.compact(spark, str(tmp_path / "base"))
    t2 = KeyedTable(str(tmp_path / "log2"), base=str(tmp_path / "base"))
    t2.write_batch(batch(spark, [row(20, "k3", 99, 2), row(21, "new", 5, 2)], at="2024-06-02 00:00:00"), 0)
    got = {r.order_id: r.quantity for r in t2.snapshot(spark).collect()}
    assert got["k3"] == 99 and got["new"] == 5 and got["k4"] == 4 and len(got) == 11
