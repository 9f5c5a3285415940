"""Running streams (STR-1..3, STR-5, STR-7..10, SNK-9).

Progress is owned by the query checkpoint, which must be a shared folder:
after a failure the query resumes from its last committed batch and replays
at most that batch; the file and upsert sinks are idempotent per ``batch_id``,
a plain JDBC append is not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import split_valid
from ..options import StreamOptions
from ..session import scratch_path

_SHUFFLE = "spark.sql.shuffle.partitions"
BatchFn = Callable[[DataFrame, int], None]


def observe_intake(records: DataFrame, name: str = "intake") -> DataFrame:
    """Attach per-batch counters to a stream; they appear in
    ``query.lastProgress["observedMetrics"][name]`` (no driver-side loop)."""
    return records.observe(
        name,
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.when(F.col("value").isNull(), 1).otherwise(0)).alias("null_messages"),
    )


@contextmanager
def _partitions(spark: SparkSession, opts: StreamOptions) -> Iterator[None]:
    """Shuffle parallelism of the stream's keyed steps. A query takes its
    settings over when it starts, so the session's own value is put back then.
    Spark records it in the checkpoint; later restarts keep the recorded value."""
    if not opts.partitions:
        yield
        return
    before = spark.conf.get(_SHUFFLE)
    spark.conf.set(_SHUFFLE, str(opts.partitions))
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE, before)


def start(df: DataFrame, batch_fn: BatchFn, opts: StreamOptions) -> StreamingQuery:
    """Start ``df`` into ``batch_fn`` (``foreachBatch``) with a durable
    checkpoint; the trigger sets the commit cadence."""
    spark = df.sparkSession
    checkpoint = opts.checkpoint or scratch_path(spark, f"ckpt-{opts.name or 'stream'}")
    w = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch_fn)
    if opts.name:
        w = w.queryName(opts.name)
    trig = opts.trigger_kwargs()
    if trig:
        w = w.trigger(**trig)
    with _partitions(spark, opts):
        return w.start()


def start_files(df: DataFrame, path: str, opts: StreamOptions, file_format: str = "parquet", partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Start ``df`` into a file table (exactly-once through the sink's log)."""
    spark = df.sparkSession
    checkpoint = opts.checkpoint or scratch_path(spark, f"ckpt-{opts.name or 'stream'}")
    w = df.writeStream.format(file_format).option("checkpointLocation", checkpoint).outputMode("append")
    if opts.name:
        w = w.queryName(opts.name)
    if partition_by:
        w = w.partitionBy(*partition_by)
    trig = opts.trigger_kwargs()
    if trig:
        w = w.trigger(**trig)
    with _partitions(spark, opts):
        return w.start(path)


def run(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Block until the query ends (``availableNow``), is stopped, or
    ``timeout`` seconds pass. Re-raises a query failure."""
    if timeout is None:
        query.awaitTermination()
        return True
    return bool(query.awaitTermination(timeout))


def materialize(
    spark: SparkSession,
    records: DataFrame,
    view: str,
    select_sql: str,
    target: str,
    opts: StreamOptions,
) -> StreamingQuery:
    """An incremental view (STR-10): ``select_sql`` over the streaming view
    ``view`` continuously feeds the file table at ``target``."""
    records.createOrReplaceTempView(view)
    valid, _ = split_valid(spark.sql(select_sql))  # rows the store would refuse stay out
    return start_files(valid, target, opts)
