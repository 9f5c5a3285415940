"""Plan shape: one JSON parse per message, pruned scans, pushed filters."""

import re

from orderstream.operators import by_status, peek, split_valid
from orderstream.plans import PipelineOptions, process
from orderstream.sources import lineitem_topic, read_processed, read_table

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_single_json_parse(spark):
    valid, _ = split_valid(process(lineitem_topic(read_table(spark, SF, "lineitem")), PipelineOptions(at="2024-06-01 00:00:00")))
    plan = valid._jdf.queryExecution().sparkPlan().toString()
    # one parse into the order's fields; the whole-text check is behind a CASE and
    # runs only for a message that is not plainly one flat object
    assert plan.count("from_json(StructField") == 1 and plan.count("from_json(ArrayType") == 2, plan
    assert plan.count("THEN true ELSE (((size(from_json(ArrayType") == 1, plan
    assert plan.count("to_json") + plan.count("StructsToJsonEvaluator") == 1, plan  # messages are not built twice
    # narrow after the scan: no shuffle
    assert "Exchange" not in plan


def test_scan_reads_only_used_columns(spark):
    df = process(lineitem_topic(read_table(spark, SF, "lineitem")), PipelineOptions(at="2024-06-01 00:00:00"))
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "l_tax" not in plan and "l_discount" not in plan


def test_lookup_on_stored_table_pushes_down(spark, tmp_path):
    df = process(lineitem_topic(read_table(spark, SF, "lineitem")), PipelineOptions(at="2024-06-01 00:00:00"))
    path = str(tmp_path / "processed")
    df.write.partitionBy("status").parquet(path)
    stored = read_processed(spark, path)
    plan = by_status(stored, "SHIPPED").select("order_id")._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [isnotnull(status" in plan and "SHIPPED" in plan
    plan2 = stored.filter("customer_id = 'CUST-7'").select("order_id")._jdf.queryExecution().sparkPlan().toString()
    assert "PushedFilters: [IsNotNull(customer_id), EqualTo(customer_id,CUST-7)]" in plan2
    from orderstream.operators import by_order_time

    plan3 = by_order_time(stored, "1999-01-01 00:00:00", "1999-04-01 00:00:00").select("order_id")._jdf.queryExecution().sparkPlan().toString()
    assert "PushedFilters: [IsNotNull(order_timestamp), GreaterThanOrEqual(order_timestamp" in plan3 and "LessThan(order" in plan3, plan3


def test_peek_is_top_n_not_sort(spark):
    df = process(lineitem_topic(read_table(spark, SF, "lineitem")), PipelineOptions(at="2024-06-01 00:00:00"))
    plan = peek(df, 10)._jdf.queryExecution().sparkPlan().toString()
    assert "TakeOrderedAndProject" in plan
