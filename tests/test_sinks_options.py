"""Option mapping and JDBC statement generation (no broker or database is
started in this repository)."""

import pytest
from pyspark.sql import functions as F

from orderstream.options import JdbcOptions, StreamOptions, TopicOptions
from orderstream.sinks import upsert_statement, with_retries
from orderstream.sinks.files import ensure_tables, tables


def test_topic_options_from_env():
    o = TopicOptions.from_env({"KAFKA_BOOTSTRAP_SERVERS": "b:9092"}, group="g")
    r = o.reader_options()
    assert r["kafka.bootstrap.servers"] == "b:9092" and r["subscribe"] == "orders"
    assert r["startingOffsets"] == "latest" and r["kafka.group.id"] == "g"
    assert "maxOffsetsPerTrigger" not in r  # an option, not a default
    assert TopicOptions("b", max_per_batch=1_000_000).reader_options()["maxOffsetsPerTrigger"] == "1000000"
    assert o.writer_options()["kafka.acks"] == "all"
    with pytest.raises(KeyError):
        TopicOptions.from_env({})


def test_jdbc_options_require_credentials():
    with pytest.raises(KeyError):
        JdbcOptions.from_env({"POSTGRES_URL": "jdbc:x"})
    o = JdbcOptions.from_env({"POSTGRES_URL": "jdbc:x", "POSTGRES_USER": "u", "POSTGRES_PASSWORD": "p"})
    assert o.writer_options()["batchsize"] == "1000" and o.max_retries == 5


def test_stream_trigger():
    assert StreamOptions().trigger_kwargs() == {"processingTime": "10 seconds"}
    assert StreamOptions(available_now=True).trigger_kwargs() == {"availableNow": True}


def test_upsert_statements_keep_created_at():
    pg = upsert_statement("processed_orders", "stage")
    assert "ON CONFLICT (order_id) DO UPDATE SET" in pg
    assert "created_at" not in pg and "order_id = EXCLUDED" not in pg
    m = upsert_statement("t", "s", dialect="merge")
    assert m.startswith("MERGE INTO t t USING s s ON t.order_id = s.order_id")
    assert "status = s.status" in m


def test_retries():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("transient")

    with_retries(flaky, max_retries=5, backoff_s=0)
    assert len(calls) == 3
    with pytest.raises(RuntimeError):
        with_retries(lambda: (_ for _ in ()).throw(RuntimeError("x")), max_retries=1, backoff_s=0)


def test_ensure_tables(spark, tmp_path):
    names = ensure_tables(spark, str(tmp_path))
    listed = {r.tableName for r in tables(spark).collect()}
    assert set(names) <= listed
    spark.sql(
        "INSERT INTO spark_processed_orders (order_id, customer_id, product_id, quantity, price, total_price, "
        "order_timestamp, processing_timestamp, status, created_at) VALUES ('a','c','p',1,1.00,1.00,"
        "TIMESTAMP_NTZ'2024-01-01 00:00:00', TIMESTAMP_NTZ'2024-01-01 00:00:00','X', NULL)"
    )
    assert spark.table("spark_processed_orders").collect()[0].spark_engine == "PySpark"


def test_insert_into_declared_table_uses_defaults(spark, tmp_path):
    from orderstream.plans import enrich_sql_text, insert_into
    from orderstream.sinks.files import ensure_tables
    from orderstream.sources import events_topic, read_table, register_topic

    names = ensure_tables(spark, str(tmp_path / "db"), tagged="k_tagged", sorted_append="k_sorted")
    register_topic(spark, "orders_raw_insert", events_topic(read_table(spark, "/root/testdata/sf0.001", "events")), mode="drop_malformed")
    from orderstream.schemas import PROCESSED_COLUMNS

    insert_into(spark, enrich_sql_text("orders_raw_insert", "2024-06-01 00:00:00"), names[0], columns=PROCESSED_COLUMNS)
    t = spark.table(names[0])
    assert t.count() == 1000
    assert t.filter("spark_engine = 'PySpark'").count() == 1000 and t.filter("created_at IS NULL").count() == 1000


def test_declared_sorted_table_shows_what_the_writer_stored(spark, tmp_path):
    from orderstream.plans import PipelineOptions, process
    from orderstream.sinks import KeyedTable, append_sorted, register_keyed
    from orderstream.sources import events_topic, read_table

    p = process(events_topic(read_table(spark, "/root/testdata/sf0.001", "events")), PipelineOptions(at="2024-06-01 00:00:00"))
    append_sorted(p.drop("offset"), str(tmp_path / "w_sorted"), 0)
    ensure_tables(spark, str(tmp_path), tagged="w_tagged", sorted_append="w_sorted")
    append_sorted(p.drop("offset"), str(tmp_path / "w_sorted"), 1)
    ensure_tables(spark, str(tmp_path), tagged="w_tagged", sorted_append="w_sorted")
    assert spark.table("w_sorted").count() == 2000
    keyed = KeyedTable(str(tmp_path / "w_keyed"))
    for batch_id in (0, 1):
        keyed.write_batch(p, batch_id)
    register_keyed(spark, keyed, "w_orders")
    assert spark.table("w_orders").count() == p.select("order_id").distinct().count()


def test_upsert_jdbc_sequence_with_a_retry(spark, monkeypatch):
    import orderstream.sinks.jdbc as J
    from orderstream.options import JdbcOptions
    from orderstream.plans import PipelineOptions, process
    from orderstream.schemas import PROCESSED_COLUMNS
    from orderstream.sources import events_topic, read_table

    steps, fail = [], {"left": 1}

    def write(df, opts, table, mode):
        steps.append(("write", table, mode, df.columns, df.count(), df.select("order_id").distinct().count()))

    def execute(batch, opts, sql):
        if sql.startswith("INSERT") and fail["left"]:
            fail["left"] -= 1
            raise RuntimeError("connection reset")
        steps.append(("sql", sql.split(" ")[0]))
        assert not sql.startswith("INSERT") or "spark_engine" in sql

    monkeypatch.setattr(J, "write_table", write)
    monkeypatch.setattr(J, "execute_statement", execute)
    monkeypatch.setattr(J.time, "sleep", lambda s: None)
    batch = process(events_topic(read_table(spark, "/root/testdata/sf0.001", "events")), PipelineOptions(at="2024-06-01 00:00:00"))
    J.upsert_jdbc(batch.withColumn("spark_engine", F.lit("x")), JdbcOptions("jdbc:x", "u", "p"), 7, stream="/ck/a")
    write1, write2 = steps[0], steps[1]
    assert write1[:3] == ("write", J.stage_name("processed_orders", "/ck/a", 7), "overwrite") and write1[3] == [*PROCESSED_COLUMNS, "spark_engine"]
    assert J.stage_name("processed_orders", "/ck/a", 7) != J.stage_name("processed_orders", "/ck/b", 7)  # two streams, two stages
    assert write1[4] == write1[5]  # one row per key reaches the statement
    assert write2[:3] == write1[:3]  # the failed attempt reran from the stage write
    assert steps[2:] == [("sql", "INSERT"), ("sql", "DROP")]


def test_bounded_topic_read_options():
    from orderstream.sources.topic import batch_reader_options

    o = batch_reader_options(TopicOptions("b:9092", group="g", min_partitions=64))
    assert o["startingOffsets"] == "earliest" and o["endingOffsets"] == "latest"
    assert "maxOffsetsPerTrigger" not in o and o["minPartitions"] == "64" and o["subscribe"] == "orders"
