"""Small operators: value-only records, UTF-8 decode, key encoding, topic
record shape, stream naming and parallelism."""

from pyspark.sql import functions as F

from orderstream.functions import encode_key
from orderstream.operators import decode_utf8, to_processed
from orderstream.options import StreamOptions
from orderstream.schemas import PROCESSED_COLUMNS, TOPIC_RECORD
from orderstream.sinks import topic_records
from orderstream.sources import events_orders, events_topic, read_table, value_only
from orderstream.streaming import run, start

SF = "/root/testdata/sf0.001"


def test_topic_record_shape_and_value_only(spark):
    t = events_topic(read_table(spark, SF, "events"))
    assert [(f.name, f.dataType) for f in t.schema.fields] == [(f.name, f.dataType) for f in TOPIC_RECORD.fields]
    assert value_only(t).columns == ["value", "partition", "offset"]
    assert value_only(t, keep_offset=False).columns == ["value"]


def test_decode_utf8(spark):
    df = spark.createDataFrame([(bytearray("Ünï".encode()),), (None,)], "value binary")
    assert [r.value for r in decode_utf8(df).collect()] == ["Ünï", None]


def test_encode_key_null_or_empty_gives_no_key(spark):
    df = spark.createDataFrame([("ORD-1",), ("",), (None,)], "order_id string")
    keys = [r.k for r in df.select(encode_key("order_id").alias("k")).collect()]
    assert keys == [bytearray(b"ORD-1"), None, None]


def test_publish_records(spark):
    orders = events_orders(read_table(spark, SF, "events"))
    recs = topic_records(orders)
    assert recs.columns == ["key", "value"]
    r = recs.select(F.col("key").cast("string").alias("k"), F.get_json_object(F.col("value").cast("string"), "$.order_id").alias("id")).first()
    assert r.k == r.id


def test_to_processed_orders_columns(spark):
    t = events_topic(read_table(spark, SF, "events"))
    from orderstream.plans import PipelineOptions, process

    p = process(t, PipelineOptions(at="2024-06-01 00:00:00")).withColumn("extra", F.lit(1))
    assert tuple(to_processed(p).columns) == PROCESSED_COLUMNS


def test_stream_name_and_partitions(spark, tmp_path):
    src = str(tmp_path / "src")
    events_topic(read_table(spark, SF, "events")).write.parquet(src)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = {}
    records = spark.readStream.schema(TOPIC_RECORD).parquet(src)
    q = start(records, lambda df, b: seen.update(n=df.count(), partitions=df.sparkSession.conf.get("spark.sql.shuffle.partitions")), StreamOptions(name="orders_named", checkpoint=str(tmp_path / "ck"), available_now=True, partitions=3))
    assert q.name == "orders_named"
    run(q)
    assert seen["n"] == 1000 and seen["partitions"] == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before  # the session keeps its own
