"""The job command on a file topic."""

import pytest

from orderstream.job import main, parse_args
from orderstream.sinks import KeyedTable
from orderstream.sources import events_topic, read_table

SF = "/root/testdata/sf0.001"


def test_job_files_to_keyed_then_restart(spark, tmp_path, caplog):
    src = str(tmp_path / "topic")
    events_topic(read_table(spark, SF, "events")).write.parquet(src)
    out, ck = str(tmp_path / "keyed"), str(tmp_path / "ck")
    args = ["--source", "files", "--topic-path", src, "--target", "keyed", "--target-path", out,
            "--rejected-path", str(tmp_path / "rej"), "--available-now", "--checkpoint", ck, "--name", "job_test"]
    with caplog.at_level("INFO", logger="orderstream.job"):
        q = main(args, env={}, spark=spark)
    assert q.lastProgress["observedMetrics"]["intake"]["messages"] == 1000
    assert any("batch 0 written: 1000 messages, 0 malformed, 0 rejected, 1000 valid rows" in m for m in caplog.messages)
    snap = KeyedTable(out).snapshot(spark)
    assert snap.count() == spark.read.parquet(src).select("key").distinct().count()
    main(args, env={}, spark=spark)  # restart: nothing new, nothing duplicated
    assert KeyedTable(out).log(spark).count() == snap.count()


def test_job_settings_need_broker_and_credentials(spark):
    from orderstream.job import _batch_fn, _records
    from orderstream.plans import PipelineOptions

    a = parse_args(["--target", "jdbc_upsert"])
    assert a.source == "broker" and a.trigger == "10 seconds"
    with pytest.raises(KeyError):  # no database credentials, no default password
        _batch_fn(a, {}, PipelineOptions())
    with pytest.raises(KeyError):  # no broker address
        _records(spark, a, {})
    assert parse_args(["--min-partitions", "64"]).min_partitions == 64
    assert callable(_batch_fn(a, {"POSTGRES_URL": "jdbc:x", "POSTGRES_USER": "u", "POSTGRES_PASSWORD": "p"}, PipelineOptions()))


def test_job_flags_reach_the_plan(spark, tmp_path):
    from orderstream.job import options_from_args

    o = options_from_args(parse_args(["--mode", "null_fields", "--coerce-numbers", "--ts-format", "micros",
                                      "--no-fill-missing", "--null-status", "drop", "--rounding", "scaled"]))
    assert (o.mode, o.coerce_numbers, o.ts_format, o.fill_missing, o.null_status, o.rounding) == (
        "null_fields", True, "micros", None, "drop", "scaled")
    src = str(tmp_path / "topic")
    events_topic(read_table(spark, SF, "events")).write.parquet(src)
    out = str(tmp_path / "keyed")
    main(["--source", "files", "--topic-path", src, "--target", "keyed", "--target-path", out, "--engine-tag-from-status",
          "--available-now", "--checkpoint", str(tmp_path / "ck"), "--name", "job_tag"], env={}, spark=spark)
    snap = KeyedTable(out, columns=("customer_id", "product_id", "quantity", "price", "total_price", "order_timestamp",
                                    "processing_timestamp", "status", "spark_engine")).snapshot(spark)
    assert snap.filter("spark_engine = status").count() == snap.count() > 0


def test_custom_writer_gets_valid_rows_and_dead_letters_are_kept(spark, tmp_path):
    from orderstream.plans import PipelineOptions
    from orderstream.sources import events_faulted_topic
    from orderstream.streaming import OrderBatchJob

    seen = []
    job = OrderBatchJob(target=lambda df, b: seen.append((b, df.count())), opts=PipelineOptions(),
                        rejected_path=str(tmp_path / "rej"), malformed_path=str(tmp_path / "bad"))
    job(events_faulted_topic(read_table(spark, SF, "events")), 3)
    rej = spark.read.parquet(str(tmp_path / "rej")).count()
    bad = spark.read.parquet(str(tmp_path / "bad")).count()
    assert seen[0][0] == 3 and seen[0][1] + rej + bad == 1000


def test_compact_command(spark, tmp_path):
    from orderstream.compact import main as compact

    src = str(tmp_path / "topic")
    events_topic(read_table(spark, SF, "events")).write.parquet(src)
    log = str(tmp_path / "keyed")
    main(["--source", "files", "--topic-path", src, "--target", "keyed", "--target-path", log,
          "--available-now", "--checkpoint", str(tmp_path / "ck"), "--name", "job_compact"], env={}, spark=spark)
    out = compact(["--log", log, "--out", str(tmp_path / "base1")], spark=spark)
    assert spark.read.parquet(out).count() == KeyedTable(log).snapshot(spark).count()


def test_jdbc_targets_receive_processed_rows(spark, monkeypatch):
    import orderstream.job as J
    from orderstream.plans import PipelineOptions
    from orderstream.schemas import PROCESSED_COLUMNS

    calls = []
    monkeypatch.setattr(J, "append_jdbc", lambda df, opts: calls.append(("append", df.columns, df.count(), df.select("order_id").distinct().count(), opts.table)))
    monkeypatch.setattr(J, "upsert_jdbc", lambda df, opts, b, order, stream: calls.append(("upsert", df.columns, df.count(), b, tuple(order), stream)))
    env = {"POSTGRES_URL": "jdbc:x", "POSTGRES_USER": "u", "POSTGRES_PASSWORD": "p"}
    topic = events_topic(read_table(spark, SF, "events"))
    for target, extra in (("jdbc_append", ["--engine-tag-from-status", "--jdbc-table", "spark_processed_orders"]), ("jdbc_upsert", [])):
        a = parse_args(["--target", target, *extra])
        J._batch_fn(a, env, PipelineOptions())(topic, 5)
    kind, cols, rows, keys, table = calls[0]
    assert kind == "append" and cols == [*PROCESSED_COLUMNS, "spark_engine"] and rows == 1000 > keys and table == "spark_processed_orders"
    kind, cols, rows, batch_id, order, stream = calls[1]
    assert "ckpt-orders-" in stream and stream == J.checkpoint_of(spark, parse_args(["--target", "jdbc_upsert"]))
    assert kind == "upsert" and cols[0] == "offset" and rows == 1000 and batch_id == 5 and order == ("offset",)


def test_a_table_belongs_to_one_checkpoint(spark, tmp_path):
    src = str(tmp_path / "topic")
    events_topic(read_table(spark, SF, "events")).write.parquet(src)
    common = ["--source", "files", "--topic-path", src, "--target", "sorted", "--target-path", str(tmp_path / "t"), "--available-now"]
    main([*common, "--checkpoint", str(tmp_path / "ck1"), "--name", "own1"], env={}, spark=spark)
    main([*common, "--checkpoint", str(tmp_path / "ck1"), "--name", "own1b"], env={}, spark=spark)  # same stream: fine
    with pytest.raises(Exception, match="is written by the stream checkpointed at"):
        main([*common, "--checkpoint", str(tmp_path / "ck2"), "--name", "own2"], env={}, spark=spark)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000
