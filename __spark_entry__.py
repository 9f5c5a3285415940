"""

Every query reads the driver's tables (whole tables) and derives its order
messages from them with Spark (see ``orderstream.sources.standins``). The
oracle SQL for DuckDB computes the expected result straight from the same
tables; it shares only the input definitions (column mappings and fault
rules), never the decode / enrich / validate / upsert logic under test.

The processing stamp is pinned (``AT``) wherever a result is compared.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderstream.functions import round_money  # noqa: E402
from orderstream.functions.time import ntz_literal  # noqa: E402
from orderstream.operators import (  # noqa: E402
    by_customer,
    by_order_time,
    by_status,
    decode_json,
    decode_with,
    drop_failed,
    empty_snapshot,
    enrich,
    latest_per_key,
    malformed,
    peek,
    split_rows,
    split_valid,
    upsert_snapshot,
    with_audit_line,
    with_defaults,
    with_engine_tag,
)
from orderstream import compact  # noqa: E402
from orderstream.options import StreamOptions  # noqa: E402
from orderstream.plans import PipelineOptions, enrich_sql, enrich_sql_text, insert_into_keyed, process, process_split  # noqa: E402
from orderstream.schemas import PROCESSED_COLUMNS, RAW_COLUMNS, RAW_ORDER, UPDATE_COLUMNS  # noqa: E402
from orderstream.session import scratch_path  # noqa: E402
from orderstream.sinks import KeyedTable  # noqa: E402
from orderstream.sources import (  # noqa: E402
    EVENT_FAULTS,
    LINEITEM_FAULTS,
    events_correction_topic,
    events_csv_topic,
    events_faulted_topic,
    events_shaped_topic,
    events_topic,
    events_two_row_topic,
    lineitem_faulted_orders,
    lineitem_huge_topic,
    lineitem_net_topic,
    lineitem_topic,
    read_processed,
    read_table,
)
from orderstream.sources.standins import (  # noqa: E402
    EVENT_SHAPES,
    EVENTS_K_DUCKDB,
    csv_decoder,
    LINEITEM_FAULT_PRICE,
    LINEITEM_HUGE,
    LINEITEM_HUGE_PRICE,
    LINEITEM_NET_PRICE,
    LINEITEM_ORDER_SQL,
    events_order_sql,
)
from orderstream.sources.topic import read_topic_files, register_topic  # noqa: E402
from orderstream.streaming import OrderBatchJob, materialize, run, start, start_files  # noqa: E402
from orderstream.streaming.runner import observe_intake  # noqa: E402

AT = "2024-06-01 00:00:00"
HALF = "2024-01-16 00:00:00"
CUSTOMER = "CUST-7"
STATUS = "SHIPPED"
TIME_LO, TIME_HI = "1999-01-01 00:00:00", "1999-04-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- Spark side

def _events(spark: SparkSession, sf: str) -> DataFrame:
    # The test tables are one split each: deal their rows to all cores.
    return read_table(spark, sf, "events", partitions=spark.sparkContext.defaultParallelism)


def _lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "lineitem", partitions=spark.sparkContext.defaultParallelism)


def _e_processed(spark: SparkSession, sf: str, **kw) -> DataFrame:
    return process(events_topic(_events(spark, sf)), PipelineOptions(at=AT, **kw))


def _l_valid(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: lineitem -> order JSON messages -> decode -> enrich -> valid."""
    processed = process(lineitem_topic(_lineitem(spark, sf)), PipelineOptions(at=AT, keep=()))
    valid, _ = split_valid(processed)
    return valid


def q_decode_json(spark, sf):
    return decode_json(events_topic(_events(spark, sf)), "drop_malformed", keep=("offset",))


def q_decode_roundtrip(spark, sf):
    return decode_json(lineitem_topic(_lineitem(spark, sf)), "drop_malformed", keep=("offset",))


def _faulted(spark, sf, mode, **kw):
    return decode_json(events_faulted_topic(_events(spark, sf)), mode, keep=("offset",), **kw)


def q_decode_drop_malformed(spark, sf):
    return _faulted(spark, sf, "drop_malformed")


def q_decode_null_fields(spark, sf):
    return _faulted(spark, sf, "null_fields")


def q_decode_permissive(spark, sf):
    return _faulted(spark, sf, "permissive")


def q_decode_fill_missing(spark, sf):
    return _faulted(spark, sf, "drop_malformed", fill_missing={"quantity": 0, "price": 0})


def q_decode_coerce(spark, sf):
    return _faulted(spark, sf, "drop_malformed", coerce_numbers=True)


def q_decode_micros_ts(spark, sf):
    return _faulted(spark, sf, "drop_malformed", ts_format="micros")


def q_decode_rejects(spark, sf):
    return malformed(events_faulted_topic(_events(spark, sf)), "drop_malformed", keep=("offset",)).select("offset", "reason")


def q_truncate_ms(spark, sf):
    return _e_processed(spark, sf, ts_precision="ms")


def q_split_rows(spark, sf):
    return decode_json(split_rows(events_two_row_topic(_events(spark, sf))), "drop_malformed", keep=("offset", "line"))


def q_enrich_orders(spark, sf):
    return _l_valid(spark, sf)


def q_enrich_orders_sql(spark, sf):
    raw = decode_json(lineitem_topic(_lineitem(spark, sf)), "drop_malformed")
    return enrich_sql(spark, raw, at=AT)


def _total(mode: str) -> Query:
    def q(spark, sf):
        li = _lineitem(spark, sf)
        x = (
            F.expr(LINEITEM_ORDER_SQL["quantity"]).cast("decimal(10,0)")
            * F.expr(LINEITEM_ORDER_SQL["price"])
            * F.col("l_discount").try_cast("decimal(4,2)")
        )
        return li.select(
            F.expr(LINEITEM_ORDER_SQL["order_id"]).alias("order_id"),
            round_money(x, mode).try_cast("decimal(14,2)").alias(f"total_{mode}"),
        )

    return q


def q_engine_tag(spark, sf):
    return with_engine_tag(_l_valid(spark, sf))


def q_audit_line(spark, sf):
    return with_audit_line(_l_valid(spark, sf)).select("order_id", "audit_line")


def q_with_defaults(spark, sf):
    df = _l_valid(spark, sf)
    return with_defaults(df, {"spark_engine": "PySpark", "created_at": F.col("processing_timestamp")})


def q_upper_drop_null(spark, sf):
    topic = events_faulted_topic(_events(spark, sf))
    return process(topic, PipelineOptions(at=AT, null_status="drop"))


def q_topic_records(spark, sf):
    t = events_topic(_events(spark, sf))
    fields = "order_id string, quantity string, price string, order_timestamp string, status string"
    v = F.from_json(F.col("value").cast("string"), fields)
    parsed = t.select("offset", F.col("key").cast("string").alias("key"), F.explode(F.array(v)).alias("v"))
    return parsed.select(
        "offset",
        "key",
        F.col("v.order_id").alias("order_id"),
        F.col("v.quantity").try_cast("int").alias("quantity"),
        F.col("v.price").try_cast("decimal(10,2)").alias("price"),
        F.col("v.order_timestamp").alias("order_timestamp_text"),
        F.col("v.status").alias("status"),
    )


def _l_checked(spark, sf):
    return split_valid(enrich(lineitem_faulted_orders(_lineitem(spark, sf)), at=AT))


def q_valid_orders(spark, sf):
    return _l_checked(spark, sf)[0]


def q_rejected_orders(spark, sf):
    return _l_checked(spark, sf)[1]


def q_peek(spark, sf):
    return peek(_l_valid(spark, sf), 10)


def q_by_customer(spark, sf):
    return by_customer(_l_valid(spark, sf), CUSTOMER)


def q_by_order_time(spark, sf):
    return by_order_time(_l_valid(spark, sf), TIME_LO, TIME_HI)


def q_by_status(spark, sf):
    return by_status(_l_valid(spark, sf), STATUS)


def q_latest_per_key(spark, sf):
    return latest_per_key(_e_processed(spark, sf), "order_id", "offset")


def q_upsert_snapshot(spark, sf):
    p = _e_processed(spark, sf)
    half = ntz_literal(HALF)
    first = p.filter(F.col("order_timestamp") < half)
    second = p.filter(F.col("order_timestamp") >= half)
    created = F.col("order_timestamp")
    # The snapshot after the first batch is stored, as a keyed table is between batches.
    path = scratch_path(spark, "snapshot")
    upsert_snapshot(empty_snapshot(p), first, created_value=created).write.parquet(path)
    return upsert_snapshot(spark.read.parquet(path), second, created_value=created)


def _events_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a file stream."""
    schema = read_table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def _once(target: str) -> StreamOptions:
    """Run to the end of the available input, then stop (tests, backfills)."""
    return StreamOptions(name=None, available_now=True, checkpoint=target + "-ckpt")


def q_stream_enrich(spark, sf):
    target = scratch_path(spark, "stream_enrich")
    records = observe_intake(events_topic(_events_stream(spark, sf)))
    out = process(records, PipelineOptions(at=AT))
    q = start_files(out, target, _once(target))
    run(q)
    return spark.read.parquet(target)


def q_stream_upsert(spark, sf):
    target = scratch_path(spark, "stream_upsert")
    job = OrderBatchJob(target, target="keyed", opts=PipelineOptions(at=AT), created_value=F.col("order_timestamp"))
    q = start(events_topic(_events_stream(spark, sf)), job, _once(target))
    run(q)
    return KeyedTable(target).snapshot(spark)


def q_stream_sorted_append(spark, sf):
    target = scratch_path(spark, "stream_sorted")
    job = OrderBatchJob(target, target="sorted", opts=PipelineOptions(at=AT))
    q = start(events_topic(_events_stream(spark, sf)), job, _once(target))
    run(q)
    return spark.read.parquet(target).drop("batch_id")


def q_materialize(spark, sf):
    target = scratch_path(spark, "materialize")
    view = "orders_raw_" + target.rsplit("-", 1)[-1]
    decoded = register_topic(spark, view, events_topic(_events_stream(spark, sf)), mode="drop_malformed")
    q = materialize(spark, decoded, view, enrich_sql_text(view, AT), target, _once(target))
    run(q)
    return spark.read.parquet(target)


def q_drop_failed(spark, sf):
    return drop_failed(enrich(lineitem_faulted_orders(_lineitem(spark, sf)), at=AT))


def q_decode_custom(spark, sf):
    # The pluggable decoder hook with another wire format: orders as CSV lines,
    # decoded with one ``from_csv`` per message.
    return decode_with(events_csv_topic(_events(spark, sf)), csv_decoder(), keep=("offset",), columns=RAW_COLUMNS)


def q_sql_upsert(spark, sf):
    target = scratch_path(spark, "sql_upsert")
    view = "orders_raw_" + target.rsplit("-", 1)[-1]
    register_topic(spark, view, events_topic(_events(spark, sf)), mode="drop_malformed")
    select = enrich_sql_text(view, AT, keep=("offset",))
    table = KeyedTable(target)
    insert_into_keyed(spark, select, table, 0, created_value=F.col("order_timestamp"))
    return table.snapshot(spark)


def q_keyed_compaction(spark, sf):
    p = _e_processed(spark, sf)
    half = ntz_literal(HALF)
    created = F.col("order_timestamp")
    first_log = KeyedTable(scratch_path(spark, "keyed_log1"))
    first_log.write_batch(p.filter(F.col("order_timestamp") < half), 0, created)
    base = scratch_path(spark, "keyed_base")
    first_log.compact(spark, base)
    second_log = KeyedTable(scratch_path(spark, "keyed_log2"), base=base)
    second_log.write_batch(p.filter(F.col("order_timestamp") >= half), 0, created)
    return second_log.snapshot(spark)


def q_multi_row_upsert(spark, sf):
    target = scratch_path(spark, "multi_row_upsert")
    job = OrderBatchJob(
        target, target="keyed", opts=PipelineOptions(at=AT, split_lines=True), created_value=F.col("order_timestamp"),
    )
    job(events_correction_topic(_events(spark, sf)), 0)
    return KeyedTable(target, order=("offset", "line")).snapshot(spark)


def q_dead_letters(spark, sf):
    root = scratch_path(spark, "dead_letters")
    job = OrderBatchJob(
        f"{root}/orders", target="sorted", opts=PipelineOptions(at=AT),
        rejected_path=f"{root}/rejected", malformed_path=f"{root}/malformed",
    )
    job(events_faulted_topic(_events(spark, sf)), 0)
    rejected = spark.read.parquet(f"{root}/rejected").select("offset", F.lit("rejected").alias("kind"), F.col("reject_reasons").alias("reason"))
    malformed = spark.read.parquet(f"{root}/malformed").select("offset", F.lit("malformed").alias("kind"), "reason")
    return rejected.unionByName(malformed)


def q_engine_tag_parity(spark, sf):
    return with_engine_tag(_l_valid(spark, sf), from_status=True)


def q_stored_by_status(spark, sf):
    path = scratch_path(spark, "processed_by_status")
    _l_valid(spark, sf).write.partitionBy("status").parquet(path)
    stored = read_processed(spark, path)
    return by_status(stored, STATUS).select(*PROCESSED_COLUMNS)


def _pipeline(mode: str) -> Query:
    """The whole pipeline on messages whose price has four digits."""

    def q(spark, sf):
        processed = process(lineitem_net_topic(_lineitem(spark, sf)), PipelineOptions(at=AT, keep=(), rounding=mode))
        return split_valid(processed)[0]

    return q


def q_price_out_of_range(spark, sf):
    double_price = T.StructType([T.StructField("price", T.DoubleType()) if f.name == "price" else f for f in RAW_ORDER.fields])
    opts = PipelineOptions(at=AT, keep=(), rounding="half_up", schema=double_price)
    return process_split(lineitem_huge_topic(_lineitem(spark, sf)), opts)[1].select("order_id", "reject_reasons")


def q_decode_strict(spark, sf):
    return decode_json(events_shaped_topic(_events(spark, sf)), "drop_malformed", keep=("offset",))


def q_decode_strict_rejects(spark, sf):
    return malformed(events_shaped_topic(_events(spark, sf)), "drop_malformed", keep=("offset",)).select("offset", "reason")


def q_messages_accounted(spark, sf):
    seen = []
    job = OrderBatchJob(scratch_path(spark, "accounted"), opts=PipelineOptions(at=AT), report=lambda _, counts: seen.append(counts))
    job(events_faulted_topic(_events(spark, sf)), 0)
    counts = ("messages", "malformed", "rejected", "valid_rows", "total_amount")
    return spark.createDataFrame([[seen[0][c] for c in counts]], "messages long, malformed long, rejected long, valid_rows long, total_amount decimal(20,2)")


def q_enrich_sql_faulted(spark, sf):
    view = "orders_faulted_" + scratch_path(spark, "v").rsplit("-", 1)[-1]
    register_topic(spark, view, events_faulted_topic(_events(spark, sf)), mode="drop_malformed")
    return spark.sql(enrich_sql_text(view, AT, keep=("offset",), ts_precision="ms", null_status="drop"))


def q_sql_upsert_faulted(spark, sf):
    """Rows the store would refuse go out at the sink, with their reasons."""
    view = "orders_faulted_" + scratch_path(spark, "v").rsplit("-", 1)[-1]
    register_topic(spark, view, events_faulted_topic(_events(spark, sf)), mode="drop_malformed")
    table = KeyedTable(scratch_path(spark, "sql_upsert_faulted"))
    insert_into_keyed(spark, enrich_sql_text(view, AT, keep=("offset",)), table, 0, created_value=F.col("order_timestamp"))
    return table.snapshot(spark)


def q_tagged_compaction(spark, sf):
    """A column beyond the processed ones survives the upsert and a compaction."""
    p = with_engine_tag(_e_processed(spark, sf))
    half, created = ntz_literal(HALF), F.col("order_timestamp")
    columns = (*UPDATE_COLUMNS, "spark_engine")
    logs = [scratch_path(spark, "tagged_log") for _ in range(2)]
    KeyedTable(logs[0], columns=columns).write_batch(p.filter(F.col("order_timestamp") < half), 0, created)
    base = compact.main(["--log", logs[0], "--out", scratch_path(spark, "tagged_base")], spark=spark)
    KeyedTable(logs[1], columns=columns).write_batch(p.filter(F.col("order_timestamp") >= half), 0, created)
    out = compact.main(["--log", logs[1], "--base", base, "--out", scratch_path(spark, "tagged_base")], spark=spark)
    return spark.read.parquet(out)


def _topic_files(spark: SparkSession, sf: str, path: str, late: bool) -> int:
    """One half of the events, as order messages in as many files as Spark's
    default partitioning gives; that number."""
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    half = ntz_literal(HALF)
    events = _events(spark, sf).filter(F.col("ts") >= half if late else F.col("ts") < half)
    events_topic(events).repartitionByRange(files, "offset").write.mode("append").parquet(path)
    return files


def q_stream_restart(spark, sf):
    """A third of the files per micro-batch; the stream stops, more files arrive, it goes on."""
    topic, target = scratch_path(spark, "restart_topic"), scratch_path(spark, "restart_orders")
    for late in (False, True):
        files = _topic_files(spark, sf, topic, late)
        records = read_topic_files(spark, topic, max_files_per_trigger=-(-files // 3))
        job = OrderBatchJob(target, target="sorted", opts=PipelineOptions(at=AT))
        run(start(records, job, _once(target)))
    return spark.read.parquet(target).drop("batch_id")


def q_stream_multi_batch_upsert(spark, sf):
    """Keyed upserts over several micro-batches with a restart in between; a
    later batch wins over an earlier one. Each half is one micro-batch, as the
    order in which a stream takes files is not that of their offsets."""
    topic, target = scratch_path(spark, "upsert_topic"), scratch_path(spark, "upsert_orders")
    for late in (False, True):
        _topic_files(spark, sf, topic, late)
        records = read_topic_files(spark, topic)
        job = OrderBatchJob(target, target="keyed", opts=PipelineOptions(at=AT), created_value=F.col("order_timestamp"))
        run(start(records, job, _once(target)))
    return KeyedTable(target).snapshot(spark)


def _stored(spark: SparkSession, sf: str) -> DataFrame:
    """The processed orders as a stored table, sorted for lookups. The range
    partitioning reads its input twice (for the bounds, then for the rows): the
    orders are persisted, so that each message is decoded once."""
    path = scratch_path(spark, "processed_sorted")
    orders = _l_valid(spark, sf).persist(StorageLevel.DISK_ONLY)
    try:
        orders.repartitionByRange("order_timestamp").sortWithinPartitions("order_timestamp").write.parquet(path)
    finally:
        orders.unpersist()
    return read_processed(spark, path)


def q_stored_by_customer(spark, sf):
    return by_customer(_stored(spark, sf), CUSTOMER)


def q_stored_by_order_time(spark, sf):
    return by_order_time(_stored(spark, sf), TIME_LO, TIME_HI)


_QUERIES: dict[str, Query] = {
    "decode_json": q_decode_json,
    "decode_roundtrip": q_decode_roundtrip,
    "decode_drop_malformed": q_decode_drop_malformed,
    "decode_null_fields": q_decode_null_fields,
    "decode_permissive": q_decode_permissive,
    "decode_fill_missing": q_decode_fill_missing,
    "decode_coerce": q_decode_coerce,
    "decode_micros_ts": q_decode_micros_ts,
    "decode_rejects": q_decode_rejects,
    "truncate_ms": q_truncate_ms,
    "split_rows": q_split_rows,
    "enrich_orders": q_enrich_orders,
    "enrich_orders_sql": q_enrich_orders_sql,
    "total_half_up": _total("half_up"),
    "total_half_even": _total("half_even"),
    "total_scaled": _total("scaled"),
    "engine_tag": q_engine_tag,
    "audit_line": q_audit_line,
    "with_defaults": q_with_defaults,
    "upper_drop_null": q_upper_drop_null,
    "topic_records": q_topic_records,
    "valid_orders": q_valid_orders,
    "rejected_orders": q_rejected_orders,
    "peek": q_peek,
    "by_customer": q_by_customer,
    "by_order_time": q_by_order_time,
    "by_status": q_by_status,
    "latest_per_key": q_latest_per_key,
    "upsert_snapshot": q_upsert_snapshot,
    "stream_enrich": q_stream_enrich,
    "stream_upsert": q_stream_upsert,
    "stream_sorted_append": q_stream_sorted_append,
    "materialize": q_materialize,
    "drop_failed": q_drop_failed,
    "decode_custom": q_decode_custom,
    "sql_upsert": q_sql_upsert,
    "keyed_compaction": q_keyed_compaction,
    "engine_tag_parity": q_engine_tag_parity,
    "multi_row_upsert": q_multi_row_upsert,
    "dead_letters": q_dead_letters,
    "stored_by_status": q_stored_by_status,
    "pipeline_exact": _pipeline("exact"),
    "pipeline_half_up": _pipeline("half_up"),
    "pipeline_half_even": _pipeline("half_even"),
    "pipeline_scaled": _pipeline("scaled"),
    "price_out_of_range": q_price_out_of_range,
    "decode_strict": q_decode_strict,
    "decode_strict_rejects": q_decode_strict_rejects,
    "messages_accounted": q_messages_accounted,
    "enrich_sql_faulted": q_enrich_sql_faulted,
    "sql_upsert_faulted": q_sql_upsert_faulted,
    "tagged_compaction": q_tagged_compaction,
    "stream_restart": q_stream_restart,
    "stream_multi_batch_upsert": q_stream_multi_batch_upsert,
    "stored_by_customer": q_stored_by_customer,
    "stored_by_order_time": q_stored_by_order_time,
}


# The training-data operators are an optional subpackage: their queries are
# added only where it (and the pipeline built on it) is present.
try:
    import corpus_pipeline
    from orderstream.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if (missing.name or "").split(".llm")[0] not in ("orderstream", "corpus_pipeline"):
        raise
    _LLM_QUERIES: dict[str, Query] = {}
    _LLM_ORACLE: dict[str, str] = {}
else:
    _LLM_QUERIES = {**llm_queries.QUERIES, "pipeline": corpus_pipeline.run}
    _LLM_ORACLE = dict(llm_queries.ORACLE)
    if corpus_pipeline.ORACLE_SQL is not None:
        _LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """Flagship on sf0.001: lineitem as order messages -> decoded, enriched,
    constraint-checked processed orders."""
    return _l_valid(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_LLM_QUERIES}


# ---------------------------------------------------------------- oracle side

_TS = "TIMESTAMP '2024-06-01 00:00:00'"


def _as(mapping: dict[str, str], cols=RAW_COLUMNS) -> str:
    return ",\n       ".join(f"{mapping[c]} AS {c}" for c in cols)


_E_MAP = events_order_sql(EVENTS_K_DUCKDB)
_E_RAW = f"SELECT event_id AS offset,\n       {_as(_E_MAP)}\nFROM events"
_L_RAW = f"SELECT l_orderkey * 8 + l_linenumber AS offset,\n       {_as(LINEITEM_ORDER_SQL)}\nFROM lineitem"
_E_FAULTED = (
    f"SELECT event_id AS offset,\n       {_as(_E_MAP)},\n       "
    + ",\n       ".join(f"({v}) AS f_{k}" for k, v in EVENT_FAULTS.items())
    + "\nFROM events"
)


def _processed_select(src: str, *, offset: bool, ts: str = "order_timestamp", proc: str = _TS) -> str:
    head = "offset, " if offset else ""
    return (
        f"SELECT {head}order_id, customer_id, product_id, quantity, price,\n"
        f"       TRY_CAST(quantity * price AS DECIMAL(10,2)) AS total_price,\n"
        f"       {ts} AS order_timestamp, {proc} AS processing_timestamp, upper(status) AS status\n"
        f"FROM ({src}) s"
    )


_E_PROCESSED = _processed_select(_E_RAW, offset=True)
_L_PROCESSED = _processed_select(_L_RAW, offset=False)
_L_VALID = (
    f"SELECT * FROM ({_L_PROCESSED}) v WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL "
    "AND quantity IS NOT NULL AND price IS NOT NULL AND total_price IS NOT NULL AND order_timestamp IS NOT NULL "
    "AND status IS NOT NULL AND length(order_id) <= 50 AND length(customer_id) <= 50 AND length(product_id) <= 50 "
    "AND length(status) <= 20 AND quantity >= 0"
)

_DEAD = "(f_truncated OR f_null_message)"
_QFAIL = "(f_quantity_text OR f_quantity_fraction)"


def _faulted_sql(where: str, quantity: str, keep_all: bool = False) -> str:
    status = "CASE WHEN f_status_missing THEN NULL ELSE status END"
    # The fault drops the fraction digits from the message, so the value too.
    order_ts = "CASE WHEN f_no_fraction_ts THEN date_trunc('second', order_timestamp) ELSE order_timestamp END"
    if keep_all:
        cols = [(c, c) for c in ("order_id", "customer_id", "product_id")]
        cols += [(quantity, "quantity"), ("price", "price"), (order_ts, "order_timestamp"), (status, "status")]
        body = ", ".join(f"CASE WHEN {_DEAD} THEN NULL ELSE {e} END AS {n}" for e, n in cols)
        return f"SELECT offset, {body}\nFROM ({_E_FAULTED}) e"
    return (
        f"SELECT offset, order_id, customer_id, product_id, {quantity} AS quantity, price, {order_ts} AS order_timestamp,\n"
        f"       {status} AS status\n"
        f"FROM ({_E_FAULTED}) e WHERE {where}"
    )


_Q_STRICT = f"CASE WHEN f_quantity_missing OR {_QFAIL} THEN NULL ELSE quantity END"


def _total_sql(mode: str) -> str:
    x = (
        "(CAST(TRY_CAST(l_quantity AS INTEGER) AS DECIMAL(10,0)) * TRY_CAST(l_extendedprice AS DECIMAL(10,2))"
        " * TRY_CAST(l_discount AS DECIMAL(4,2)))"
    )
    r = {
        "half_up": f"round({x}, 2)",
        "half_even": f"round_even({x}, 2)",
        "scaled": f"floor({x} * 100 + 0.5) * 0.01",
    }[mode]
    return f"SELECT {LINEITEM_ORDER_SQL['order_id']} AS order_id, TRY_CAST({r} AS DECIMAL(14,2)) AS total_{mode} FROM lineitem"


_LF = {k: f"({v})" for k, v in LINEITEM_FAULTS.items()}
_L_FAULTED_RAW = (
    "SELECT "
    f"CASE WHEN {_LF['id_too_long']} THEN rpad({LINEITEM_ORDER_SQL['order_id']}, 51, 'x') ELSE {LINEITEM_ORDER_SQL['order_id']} END AS order_id, "
    f"CASE WHEN {_LF['customer_null']} THEN NULL ELSE {LINEITEM_ORDER_SQL['customer_id']} END AS customer_id, "
    f"{LINEITEM_ORDER_SQL['product_id']} AS product_id, "
    f"CASE WHEN {_LF['quantity_negative']} THEN -{LINEITEM_ORDER_SQL['quantity']} ELSE {LINEITEM_ORDER_SQL['quantity']} END AS quantity, "
    f"CASE WHEN {_LF['total_overflow']} THEN {LINEITEM_FAULT_PRICE} ELSE {LINEITEM_ORDER_SQL['price']} END AS price, "
    f"{LINEITEM_ORDER_SQL['order_timestamp']} AS order_timestamp, "
    f"CASE WHEN {_LF['status_null']} THEN NULL ELSE {LINEITEM_ORDER_SQL['status']} END AS status "
    "FROM lineitem"
)
_REASONS = (
    "concat_ws(',', "
    + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}:null' END" for c in PROCESSED_COLUMNS)
    + ", CASE WHEN length(order_id) > 50 THEN 'order_id:too_long' END"
    + ", CASE WHEN length(customer_id) > 50 THEN 'customer_id:too_long' END"
    + ", CASE WHEN length(product_id) > 50 THEN 'product_id:too_long' END"
    + ", CASE WHEN length(status) > 20 THEN 'status:too_long' END"
    + ", CASE WHEN quantity < 0 THEN 'quantity:negative' END)"
)
_L_CHECKED = f"SELECT *, {_REASONS} AS reject_reasons FROM ({_processed_select(_L_FAULTED_RAW, offset=False)}) c"

def _net_sql(mode: str) -> str:
    """The pipeline on the price after discount: the product is rounded, and the
    price is narrowed on its own."""
    x = f"CAST(quantity AS DECIMAL(10,0)) * ({LINEITEM_NET_PRICE})"
    total = {
        "exact": f"quantity * CAST({LINEITEM_NET_PRICE} AS DECIMAL(10,2))",
        "half_up": f"round({x}, 2)",
        "half_even": f"round_even({x}, 2)",
        "scaled": f"floor({x} * 100 + 0.5) * 0.01",
    }[mode]
    raw = _L_RAW.replace("FROM lineitem", ", l_extendedprice, l_discount FROM lineitem")
    return (
        f"SELECT order_id, customer_id, product_id, quantity, CAST({LINEITEM_NET_PRICE} AS DECIMAL(10,2)) AS price, "
        f"CAST({total} AS DECIMAL(10,2)) AS total_price, order_timestamp, {_TS} AS processing_timestamp, upper(status) AS status FROM ({raw}) r"
    )


_ODD = " OR ".join(f"({EVENT_SHAPES[k]})" for k in ("two_documents", "trailing_text", "single_quoted"))


def _latest_created(processed: str, rank_desc: str, rank_asc: str) -> str:
    return (
        "SELECT order_id, customer_id, product_id, quantity, price, total_price, order_timestamp, processing_timestamp, status, created_at "
        f"FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {rank_desc}) AS rn, "
        f"first_value(order_timestamp) OVER (PARTITION BY order_id ORDER BY {rank_asc}) AS created_at FROM ({processed}) p) r WHERE rn = 1"
    )


_E_LATEST_CREATED = (
    "SELECT order_id, customer_id, product_id, quantity, price, total_price, order_timestamp, "
    "processing_timestamp, status, created_at FROM ("
    "SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {rank_desc}) AS rn, "
    "first_value(order_timestamp) OVER (PARTITION BY order_id ORDER BY {rank_asc}) AS created_at "
    "FROM (SELECT *, CASE WHEN order_timestamp < TIMESTAMP '2024-01-16 00:00:00' THEN 0 ELSE 1 END AS half "
    f"FROM ({_E_PROCESSED}) p) h) r WHERE rn = 1"
)

_ORACLE: dict[str, str] = {
    "decode_json": _E_RAW,
    "decode_roundtrip": _L_RAW,
    "decode_drop_malformed": _faulted_sql(f"NOT {_DEAD} AND NOT {_QFAIL}", "CASE WHEN f_quantity_missing THEN NULL ELSE quantity END"),
    "decode_null_fields": _faulted_sql(f"NOT {_DEAD}", _Q_STRICT),
    "decode_permissive": _faulted_sql("TRUE", _Q_STRICT, keep_all=True),
    "decode_fill_missing": _faulted_sql(f"NOT {_DEAD} AND NOT {_QFAIL}", "CASE WHEN f_quantity_missing THEN 0 ELSE quantity END"),
    "decode_coerce": _faulted_sql(f"NOT {_DEAD}", "CASE WHEN f_quantity_missing THEN NULL ELSE quantity END"),
    "decode_micros_ts": _faulted_sql(
        f"NOT {_DEAD} AND NOT {_QFAIL} AND NOT f_no_fraction_ts", "CASE WHEN f_quantity_missing THEN NULL ELSE quantity END"
    ),
    "decode_rejects": (
        f"SELECT offset, CASE WHEN {_DEAD} THEN 'malformed_document' ELSE 'field_conversion' END AS reason "
        f"FROM ({_E_FAULTED}) e WHERE {_DEAD} OR {_QFAIL}"
    ),
    "truncate_ms": _processed_select(_E_RAW, offset=True, ts="date_trunc('milliseconds', order_timestamp)"),
    "split_rows": (
        f"SELECT offset, 0 AS line, order_id, customer_id, product_id, quantity, price, order_timestamp, status FROM ({_E_RAW}) a "
        f"UNION ALL SELECT offset, 1 AS line, order_id || '-B', customer_id, product_id, quantity, price, order_timestamp, status "
        f"FROM ({_E_RAW}) b"
    ),
    "enrich_orders": _L_VALID,
    "enrich_orders_sql": _L_PROCESSED,
    "total_half_up": _total_sql("half_up"),
    "total_half_even": _total_sql("half_even"),
    "total_scaled": _total_sql("scaled"),
    "engine_tag": f"SELECT *, 'PySpark' AS spark_engine FROM ({_L_VALID}) t",
    "audit_line": (
        "SELECT order_id, 'Processing: ' || order_id || ' | Status: ' || status || ' | Total: $' || "
        f"CAST(total_price AS VARCHAR) AS audit_line FROM ({_L_VALID}) t"
    ),
    "with_defaults": f"SELECT *, 'PySpark' AS spark_engine, processing_timestamp AS created_at FROM ({_L_VALID}) t",
    "upper_drop_null": _processed_select(
        _faulted_sql(f"NOT {_DEAD} AND NOT {_QFAIL} AND NOT f_status_missing", "CASE WHEN f_quantity_missing THEN 0 ELSE quantity END"),
        offset=True,
    ),
    "topic_records": (
        "SELECT event_id AS offset, "
        f"{_E_MAP['order_id']} AS key, {_E_MAP['order_id']} AS order_id, {_E_MAP['quantity']} AS quantity, "
        f"{_E_MAP['price']} AS price, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS order_timestamp_text, "
        "event_type AS status FROM events"
    ),
    "valid_orders": f"SELECT * EXCLUDE (reject_reasons) FROM ({_L_CHECKED}) c WHERE reject_reasons = ''",
    "rejected_orders": f"SELECT * FROM ({_L_CHECKED}) c WHERE reject_reasons <> ''",
    "peek": (
        f"SELECT * FROM ({_L_VALID}) t ORDER BY "
        + ", ".join(f"{c} ASC NULLS FIRST" for c in PROCESSED_COLUMNS)
        + " LIMIT 10"
    ),
    "by_customer": f"SELECT * FROM ({_L_VALID}) t WHERE customer_id = 'CUST-7'",
    "by_order_time": (
        f"SELECT * FROM ({_L_VALID}) t WHERE order_timestamp >= TIMESTAMP '1999-01-01 00:00:00' "
        "AND order_timestamp < TIMESTAMP '1999-04-01 00:00:00'"
    ),
    "by_status": f"SELECT * FROM ({_L_VALID}) t WHERE status = 'SHIPPED'",
    "latest_per_key": (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY offset DESC) AS rn "
        f"FROM ({_E_PROCESSED}) p) r WHERE rn = 1"
    ),
    "upsert_snapshot": _E_LATEST_CREATED.format(rank_desc="half DESC, offset DESC", rank_asc="half, offset"),
    "stream_enrich": _E_PROCESSED,
    "stream_upsert": _E_LATEST_CREATED.format(rank_desc="offset DESC", rank_asc="offset"),
    "stream_sorted_append": _E_PROCESSED,
    "materialize": _processed_select(_E_RAW, offset=False),
    "drop_failed": (
        f"SELECT * FROM ({_processed_select(_L_FAULTED_RAW, offset=False)}) c "
        "WHERE total_price IS NOT NULL AND order_timestamp IS NOT NULL"
    ),
    "decode_custom": _E_RAW,
    "sql_upsert": _E_LATEST_CREATED.format(rank_desc="offset DESC", rank_asc="offset"),
    "keyed_compaction": _E_LATEST_CREATED.format(rank_desc="half DESC, offset DESC", rank_asc="half, offset"),
    "engine_tag_parity": f"SELECT *, status AS spark_engine FROM ({_L_VALID}) t",
    "dead_letters": (
        f"SELECT offset, 'malformed' AS kind, CASE WHEN {_DEAD} THEN 'malformed_document' ELSE 'field_conversion' END AS reason "
        f"FROM ({_E_FAULTED}) e WHERE {_DEAD} OR {_QFAIL} "
        f"UNION ALL SELECT offset, 'rejected' AS kind, 'status:null' AS reason "
        f"FROM ({_E_FAULTED}) e WHERE f_status_missing AND NOT ({_DEAD} OR {_QFAIL})"
    ),
    "multi_row_upsert": (
        "SELECT order_id, customer_id, product_id, quantity, price, total_price, order_timestamp, processing_timestamp, "
        "status, created_at FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY offset DESC, line DESC) AS rn, "
        "first_value(order_timestamp) OVER (PARTITION BY order_id ORDER BY offset, line) AS created_at FROM ("
        + _processed_select(
            f"SELECT offset, 0 AS line, order_id, customer_id, product_id, quantity, price, order_timestamp, status "
            f"FROM ({_E_RAW}) a UNION ALL "
            f"SELECT offset, 1 AS line, order_id, customer_id, product_id, quantity + 1, price, order_timestamp, status "
            f"FROM ({_E_RAW}) b",
            offset=True,
        ).replace("SELECT offset,", "SELECT offset, line,", 1)
        + ") p) w WHERE rn = 1"
    ),
    **{f"pipeline_{mode}": _net_sql(mode) for mode in ("exact", "half_up", "half_even", "scaled")},
    "price_out_of_range": (
        f"SELECT {LINEITEM_ORDER_SQL['order_id']} AS order_id, 'price:null,total_price:null' AS reject_reasons FROM lineitem "
        f"WHERE {LINEITEM_HUGE} AND TRY_CAST({LINEITEM_HUGE_PRICE} AS DECIMAL(10,2)) IS NULL"
    ),
    "decode_strict": f"SELECT s.* FROM ({_E_RAW}) s JOIN events e ON s.offset = e.event_id WHERE NOT ({_ODD})",
    "decode_strict_rejects": f"SELECT event_id AS offset, 'malformed_document' AS reason FROM events WHERE {_ODD}",
    "messages_accounted": (
        f"SELECT count(*) AS messages, sum(bad::BIGINT)::BIGINT AS malformed, sum((NOT bad AND f_status_missing)::BIGINT)::BIGINT AS rejected, "
        "sum((NOT bad AND NOT f_status_missing)::BIGINT)::BIGINT AS valid_rows, "
        "sum(CASE WHEN NOT bad AND NOT f_status_missing AND NOT f_quantity_missing THEN quantity * price END)::DECIMAL(20,2) AS total_amount "
        f"FROM (SELECT *, {_DEAD} OR {_QFAIL} AS bad FROM ({_E_FAULTED}) e) b"
    ),
    "enrich_sql_faulted": _processed_select(
        _faulted_sql(f"NOT {_DEAD} AND NOT {_QFAIL} AND NOT f_status_missing", "CASE WHEN f_quantity_missing THEN 0 ELSE quantity END"),
        offset=True, ts="date_trunc('milliseconds', order_timestamp)",
    ),
    "sql_upsert_faulted": _latest_created(
        _processed_select(
            _faulted_sql(f"NOT {_DEAD} AND NOT {_QFAIL} AND NOT f_status_missing", "CASE WHEN f_quantity_missing THEN 0 ELSE quantity END"), offset=True
        ),
        "offset DESC", "offset",
    ),
    "tagged_compaction": "SELECT *, 'PySpark' AS spark_engine FROM (" + _E_LATEST_CREATED.format(rank_desc="half DESC, offset DESC", rank_asc="half, offset") + ") t",
    "stream_restart": _E_PROCESSED,
    "stream_multi_batch_upsert": _E_LATEST_CREATED.format(rank_desc="half DESC, offset DESC", rank_asc="half, offset"),
    "stored_by_customer": f"SELECT * FROM ({_L_VALID}) t WHERE customer_id = 'CUST-7'",
    "stored_by_order_time": (
        f"SELECT * FROM ({_L_VALID}) t WHERE order_timestamp >= TIMESTAMP '1999-01-01 00:00:00' "
        "AND order_timestamp < TIMESTAMP '1999-04-01 00:00:00'"
    ),
    "stored_by_status": f"SELECT * FROM ({_L_VALID}) t WHERE status = 'SHIPPED'",
}


def _quote_offset(sql: str) -> str:
    # ``offset`` is a reserved word in DuckDB; the column keeps its name.
    return re.sub(r'(?<!")\boffset\b(?!")', '"offset"', sql)


def oracle_sql() -> dict[str, str]:
    return {k: _quote_offset(v) for k, v in _ORACLE.items()} | _LLM_ORACLE
