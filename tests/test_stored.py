"""The stored, sorted table of processed orders behind the lookup queries."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as E


def test_messages_are_decoded_once_and_stored_in_ranges(spark, monkeypatch):
    n = 200
    decoded = spark.sparkContext.accumulator(0)

    def decode(i):
        decoded.add(1)
        return f"CUST-{i % 9}"

    start = dt.datetime(1999, 1, 1)
    rows = [(i, start + dt.timedelta(hours=i * 37 % n)) for i in range(n)] + [(7, start), (7, start)]
    orders = spark.createDataFrame(rows, "i long, order_timestamp timestamp_ntz").withColumn("customer_id", F.udf(decode, "string")("i"))
    monkeypatch.setattr(E, "_l_valid", lambda *_: orders)
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        stored = E._stored(spark, "unused")
    finally:
        spark.conf.set(conf, before)
    assert decoded.value == len(rows)  # the range partitioning's own pass decodes nothing
    assert sorted((r.i, r.order_timestamp) for r in stored.collect()) == sorted(rows)
    files = stored.groupBy(F.input_file_name()).agg(F.min("order_timestamp").alias("lo"), F.max("order_timestamp").alias("hi")).collect()
    spans = sorted((r.lo, r.hi) for r in files)
    assert len(spans) > 1 and all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False)), spans
