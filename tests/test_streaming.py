"""Streams over a file topic: exactly-once file sink, restart, replay-safe
batch sinks, incremental SQL view, observed metrics."""

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from orderstream.options import StreamOptions
from orderstream.plans import PipelineOptions, enrich_sql_text, process
from orderstream.sinks import KeyedTable
from orderstream.sources import events_orders, events_topic, read_table, read_topic_files, register_topic
from orderstream.sources.standins import as_topic
from orderstream.streaming import OrderBatchJob, materialize, observe_intake, run, start, start_files

SF = "/root/testdata/sf0.001"
AT = "2024-06-01 00:00:00"


def _write_topic_files(spark, folder, n_files):
    """Split E into n topic files by event time (a whole-table partition)."""
    ev = read_table(spark, SF, "events")
    topic = as_topic(events_orders(ev)).withColumn("_part", F.ntile(n_files).over(Window.orderBy("offset")))
    for i in range(1, n_files + 1):
        topic.filter(F.col("_part") == i).drop("_part").coalesce(1).write.parquet(os.path.join(folder, f"part{i}"))


def test_stream_enrich_exactly_once_and_restart(spark, tmp_path):
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ck")
    _write_topic_files(spark, src, 2)
    opts = StreamOptions(name=None, checkpoint=ck, available_now=True)
    records = read_topic_files(spark, src + "/part*", max_files_per_trigger=1)
    q = start_files(process(observe_intake(records), PipelineOptions(at=AT)), out, opts)
    run(q)
    assert spark.read.parquet(out).count() == 1000
    assert q.lastProgress["observedMetrics"]["intake"]["messages"] > 0
    # restart on the same checkpoint with no new input: no batch, no duplicates
    q2 = start_files(process(read_topic_files(spark, src + "/part*"), PipelineOptions(at=AT)), out, opts)
    run(q2)
    assert spark.read.parquet(out).count() == 1000


def test_stream_keyed_multiple_batches_equals_batch(spark, tmp_path):
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "keyed"), str(tmp_path / "ck")
    _write_topic_files(spark, src, 3)
    job = OrderBatchJob(out, target="keyed", opts=PipelineOptions(at=AT), created_value=F.col("order_timestamp"),
                        rejected_path=str(tmp_path / "rej"), malformed_path=str(tmp_path / "bad"))
    q = start(read_topic_files(spark, src + "/part*", max_files_per_trigger=1), job, StreamOptions(name=None, checkpoint=ck, available_now=True))
    run(q)
    snap = KeyedTable(out).snapshot(spark)
    from orderstream.operators import empty_snapshot, upsert_snapshot

    whole = process(events_topic(read_table(spark, SF, "events")), PipelineOptions(at=AT))
    expect = upsert_snapshot(empty_snapshot(whole), whole, created_value=F.col("order_timestamp"))
    assert snap.exceptAll(expect).count() == 0 and expect.exceptAll(snap).count() == 0
    assert KeyedTable(out).log(spark).select("batch_id").distinct().count() == 3


def test_sorted_append_keeps_duplicates_and_replay_overwrites(spark, tmp_path):
    out = str(tmp_path / "sorted")
    job = OrderBatchJob(out, target="sorted", opts=PipelineOptions(at=AT))
    topic = events_topic(read_table(spark, SF, "events"))
    job(topic, 0)
    job(topic, 0)  # replayed batch
    df = spark.read.parquet(out)
    assert df.count() == 1000
    assert df.select("order_id").distinct().count() < 1000  # every version kept


def test_materialized_sql_view(spark, tmp_path):
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "mv"), str(tmp_path / "ck")
    _write_topic_files(spark, src, 1)
    decoded = register_topic(spark, "orders_raw_mv", read_topic_files(spark, src + "/part*"), mode="drop_malformed")
    q = materialize(spark, decoded, "orders_raw_mv", enrich_sql_text("orders_raw_mv", AT), out, StreamOptions(name=None, checkpoint=ck, available_now=True))
    run(q)
    got = spark.read.parquet(out)
    batch = process(events_topic(read_table(spark, SF, "events")), PipelineOptions(at=AT, keep=()))
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_batch_report_and_custom_decoder(spark, tmp_path):
    from orderstream.operators import decode_with
    from orderstream.schemas import RAW_ORDER

    seen = {}
    job = OrderBatchJob(str(tmp_path / "t"), target="sorted", opts=PipelineOptions(at=AT), report=lambda b, m: seen.update({b: m}))
    topic = events_topic(read_table(spark, SF, "events"))
    job(topic, 7)
    assert seen[7]["valid_rows"] == 1000 and seen[7]["total_amount"] is not None
    dec = decode_with(topic, lambda v: F.from_json(v, RAW_ORDER), keep=("offset",))
    assert dec.count() == 1000 and "order_id" in dec.columns


def test_register_topic_proctime(spark):
    df = register_topic(spark, "orders_pt", events_topic(read_table(spark, SF, "events")), proctime="proctime")
    assert "proctime" in df.columns
    assert spark.sql("SELECT count(*) AS n FROM orders_pt").collect()[0].n == 1000


def test_sorted_append_splits_a_hot_key(spark, tmp_path):
    # one order id holds most rows of the batch; the write must not put it in one task
    from orderstream.sinks import append_sorted

    topic = events_topic(read_table(spark, SF, "events"))
    df = process(topic, PipelineOptions(at=AT)).withColumn(
        "order_id", F.when(F.col("offset") % 3 != 0, F.lit("HOT")).otherwise(F.col("order_id"))
    )
    out = str(tmp_path / "hot")
    append_sorted(df, out, 0, partitions=4)
    per_file = spark.read.parquet(out).select(F.input_file_name().alias("f")).groupBy("f").count().collect()
    assert len(per_file) >= 3 and max(r["count"] for r in per_file) < 700


def test_failed_batch_is_replayed_without_duplicates(spark, tmp_path):
    """A batch that fails after writing part of its output is replayed on
    restart; the per-batch overwrite leaves exactly one copy."""
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "sorted"), str(tmp_path / "ck")
    _write_topic_files(spark, src, 2)
    job = OrderBatchJob(out, target="sorted", opts=PipelineOptions(at=AT), rejected_path=str(tmp_path / "rej"))

    class Crash(RuntimeError):
        pass

    def crashing(batch, batch_id):
        job(batch, batch_id)  # output written ...
        if batch_id == 1:
            raise Crash("executor lost after the write")  # ... but the batch never commits

    records = read_topic_files(spark, src + "/part*", max_files_per_trigger=1)
    q = start(records, crashing, StreamOptions(name=None, checkpoint=ck, available_now=True))
    try:
        run(q)
    except Exception:
        pass
    assert q.exception() is not None
    # restart on the same checkpoint: batch 1 runs again
    q2 = start(read_topic_files(spark, src + "/part*", max_files_per_trigger=1), job, StreamOptions(name=None, checkpoint=ck, available_now=True))
    run(q2)
    df = spark.read.parquet(out)
    assert df.count() == 1000
    assert df.select("offset").distinct().count() == 1000


def test_sorted_append_files_are_sorted_with_ordered_ranges(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from orderstream.sinks import append_sorted

    df = process(events_topic(read_table(spark, SF, "events")), PipelineOptions(at=AT))
    out = str(tmp_path / "sorted")
    append_sorted(df, out, 0, partitions=4)
    firsts_lasts = []
    for f in sorted(glob.glob(out + "/batch_id=0/*.parquet")):
        rows = pq.read_table(f, columns=["order_id", "processing_timestamp", "offset"]).to_pylist()
        keys = [(r["order_id"], r["processing_timestamp"], r["offset"]) for r in rows]
        assert keys == sorted(keys)
        firsts_lasts.append((keys[0], keys[-1]))
    firsts_lasts.sort()
    assert all(a[1] <= b[0] for a, b in zip(firsts_lasts, firsts_lasts[1:]))  # disjoint ranges


def test_processing_time_trigger_picks_up_new_files(spark, tmp_path):
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "keyed"), str(tmp_path / "ck")
    _write_topic_files(spark, src, 2)
    import shutil

    live = str(tmp_path / "live")
    os.makedirs(live)
    shutil.copytree(os.path.join(src, "part1"), os.path.join(live, "part1"))
    job = OrderBatchJob(out, target="keyed", opts=PipelineOptions(at=AT))
    q = start(read_topic_files(spark, live + "/part*"), job, StreamOptions(name="live_orders", checkpoint=ck, trigger="1 second"))
    try:
        q.processAllAvailable()
        first = KeyedTable(out).log(spark).count()
        shutil.copytree(os.path.join(src, "part2"), os.path.join(live, "part2"))  # a new file arrives
        q.processAllAvailable()
        assert run(q, timeout=0.5) is False  # still running: unbounded query
    finally:
        q.stop()
    assert KeyedTable(out).log(spark).select("batch_id").distinct().count() >= 2
    assert KeyedTable(out).log(spark).count() > first


def test_empty_micro_batch_is_harmless(spark, tmp_path):
    empty = events_topic(read_table(spark, SF, "events")).filter("offset < 0")
    seen = {}
    for target in ("sorted", "keyed"):
        job = OrderBatchJob(str(tmp_path / target), target=target, opts=PipelineOptions(at=AT),
                            rejected_path=str(tmp_path / f"rej_{target}"), report=lambda b, m: seen.update({b: m}))
        job(empty, 0)
        job(events_topic(read_table(spark, SF, "events")), 1)
        assert seen[0]["valid_rows"] == 0 and seen[1]["valid_rows"] == 1000
    assert spark.read.parquet(str(tmp_path / "sorted")).count() == 1000
    assert KeyedTable(str(tmp_path / "keyed")).snapshot(spark).count() > 0


def test_topic_of_the_stream_queries_has_a_file_per_partition(spark, tmp_path):
    import __spark_entry__ as E

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (5, 9):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            path = str(tmp_path / f"topic{parts}")
            assert E._topic_files(spark, SF, path, False) == parts
            assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == parts
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
