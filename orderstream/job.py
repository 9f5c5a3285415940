"""The order-enrichment job as a command (STR-8, API-1).

    python -m orderstream --source files --topic-path /shared/orders-topic \
        --target keyed --target-path /shared/processed --available-now

Settings come from flags, else from the environment (the same names the
original jobs used), else defaults; credentials have no default. Checkpoints
live below the session's ``spark.checkpoint.dir``, in a folder that belongs to the
stream's name and target, unless ``--checkpoint`` is given.
"""

from __future__ import annotations

import argparse
import hashlib
import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from .operators.enrich import with_engine_tag
from .options import JdbcOptions, StreamOptions, TopicOptions
from .plans.enrichment import PipelineOptions
from .session import checkpoint_root
from .sinks.jdbc import append_jdbc, upsert_jdbc
from .sources.topic import read_topic, read_topic_files, value_only
from .streaming.jobs import OrderBatchJob
from .streaming.runner import observe_intake, run, start

TARGETS = ("keyed", "sorted", "jdbc_append", "jdbc_upsert")
log = logging.getLogger("orderstream.job")


def log_batch(batch_id: int, metrics: dict) -> None:
    """Report each written batch (from metrics observed during the write)."""
    log.info(
        "batch %s written: %s messages, %s malformed, %s rejected, %s valid rows, total %s",
        batch_id, *(metrics.get(k) for k in ("messages", "malformed", "rejected", "valid_rows", "total_amount")),
    )


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="orderstream", description="Decode, enrich and store order messages.")
    p.add_argument("--source", choices=("broker", "files"), default="broker")
    p.add_argument("--topic-path", help="folder of topic-record files (source=files)")
    p.add_argument("--group", help="consumer group name (source=broker)")
    p.add_argument("--starting", default="latest", help="start position for a new query (source=broker)")
    p.add_argument("--max-per-batch", type=int, default=None, help="messages (broker) or files per micro-batch")
    p.add_argument(
        "--min-partitions",
        type=int,
        default=None,
        help="broker: split topic partitions into at least this many tasks (a hot partition is divided)",
    )
    p.add_argument("--target", choices=TARGETS, default="keyed")
    p.add_argument("--target-path", help="table folder (keyed, sorted)")
    p.add_argument("--rejected-path", help="dead-letter folder for constraint violations")
    p.add_argument("--malformed-path", help="dead-letter folder for undecodable messages")
    p.add_argument("--jdbc-table", default="processed_orders")
    p.add_argument("--mode", choices=("drop_malformed", "null_fields", "permissive"), default="drop_malformed")
    p.add_argument("--split-lines", action="store_true", help="several newline-delimited orders per message")
    p.add_argument("--rounding", choices=("exact", "half_up", "half_even", "scaled"), default="exact")
    p.add_argument("--ts-precision", choices=("us", "ms"), default="us")
    p.add_argument("--ts-format", choices=("iso", "micros"), default="iso")
    p.add_argument("--coerce-numbers", action="store_true", help='accept "3" and 2.7 as quantities')
    p.add_argument("--no-fill-missing", action="store_true", help="absent quantity/price stay NULL (else 0)")
    p.add_argument("--null-numbers", choices=("drop", "fill"), default="drop", help="an explicit null quantity or price")
    p.add_argument("--partitions", type=int, default=None, help="shuffle partitions of this stream (first start)")
    p.add_argument("--null-status", choices=("keep", "drop"), default="keep")
    p.add_argument("--engine-tag", help="add a spark_engine column with this value")
    p.add_argument("--engine-tag-from-status", action="store_true", help="spark_engine copies the status")
    p.add_argument("--trigger", default="10 seconds")
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--checkpoint")
    p.add_argument("--name", default="orders")
    p.add_argument("--timeout", type=float, default=None, help="seconds to run before returning")
    return p.parse_args(argv)


def _records(spark: SparkSession, a: argparse.Namespace, env: Mapping[str, str]) -> DataFrame:
    if a.source == "files":
        if not a.topic_path:
            raise SystemExit("--topic-path is required with --source files")
        return read_topic_files(spark, a.topic_path, max_files_per_trigger=a.max_per_batch)
    base = TopicOptions.from_env(env, group=a.group)
    opts = TopicOptions(
        bootstrap_servers=base.bootstrap_servers,
        topic=base.topic,
        group=a.group,
        starting=a.starting,
        max_per_batch=a.max_per_batch or base.max_per_batch,
        min_partitions=a.min_partitions,
    )
    return read_topic(spark, opts)


def _tag(a: argparse.Namespace):
    if a.engine_tag_from_status:
        return lambda df: with_engine_tag(df, from_status=True)
    if a.engine_tag:
        return lambda df: with_engine_tag(df, a.engine_tag)
    return None


def _batch_fn(a: argparse.Namespace, env: Mapping[str, str], opts: PipelineOptions):
    tag = _tag(a)
    dead_letters = dict(rejected_path=a.rejected_path, malformed_path=a.malformed_path, opts=opts, tag=tag, report=log_batch)
    if a.target in ("keyed", "sorted"):
        if not a.target_path:
            raise SystemExit("--target-path is required for file targets")
        return OrderBatchJob(a.target_path, target=a.target, **dead_letters)
    jdbc = JdbcOptions.from_env(env, table=a.jdbc_table)
    order = (*opts.keep, "line") if opts.split_lines else tuple(opts.keep)

    def write(valid: DataFrame, batch_id: int) -> None:
        if a.target == "jdbc_append":
            append_jdbc(valid.drop(*order), jdbc)  # every version of an order
        else:
            upsert_jdbc(valid, jdbc, batch_id, order=order, stream=checkpoint_of(valid.sparkSession, a))

    return OrderBatchJob(target=write, **dead_letters)


def checkpoint_of(spark: SparkSession, a: argparse.Namespace) -> str:
    """The checkpoint given, or one that the stream's name and target always map
    to, so that a restarted job goes on where it stopped."""
    if a.checkpoint:
        return a.checkpoint
    target = hashlib.sha256(f"{a.target} {a.target_path} {a.jdbc_table}".encode()).hexdigest()[:12]
    return f"{checkpoint_root(spark)}/ckpt-{a.name}-{target}"


def options_from_args(a: argparse.Namespace) -> PipelineOptions:
    return PipelineOptions(
        mode=a.mode,
        split_lines=a.split_lines,
        fill_missing=None if a.no_fill_missing else {"quantity": 0, "price": 0},
        coerce_numbers=a.coerce_numbers,
        ts_format=a.ts_format,
        ts_precision=a.ts_precision,
        rounding=a.rounding,
        null_status=a.null_status,
        null_numbers=a.null_numbers,
    )


def main(argv: Sequence[str] | None = None, env: Mapping[str, str] | None = None, spark: SparkSession | None = None):
    import os

    a = parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    env = os.environ if env is None else env
    spark = spark or SparkSession.builder.appName(a.name).getOrCreate()
    opts = options_from_args(a)
    records = observe_intake(value_only(_records(spark, a, env)))
    stream = StreamOptions(
        name=a.name,
        checkpoint=checkpoint_of(spark, a),
        trigger=a.trigger,
        available_now=a.available_now,
        partitions=a.partitions,
    )
    batch_fn = _batch_fn(a, env, opts)
    batch_fn.owner = stream.checkpoint  # tables belong to this checkpoint
    query = start(records, batch_fn, stream)
    run(query, a.timeout)
    return query


if __name__ == "__main__":
    main()
