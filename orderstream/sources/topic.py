"""Topic sources (SRC-1..6).

``read_topic`` is the real broker source (``format("kafka")``). The
connector jar is not part of this image, so it is exercised for option
mapping only; ``read_topic_files`` reads the same record shape from files and
is what the tests and driver queries stream from.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.decode import decode_json, split_rows
from ..options import TopicOptions
from ..schemas import FILL_MISSING, TOPIC_RECORD


def read_topic(spark: SparkSession, opts: TopicOptions) -> DataFrame:
    """Unbounded topic read. Progress lives in the query checkpoint; the
    starting position applies only to a query without one."""
    return spark.readStream.format("kafka").options(**opts.reader_options()).load()


def batch_reader_options(opts: TopicOptions, starting: str = "earliest", ending: str = "latest") -> dict[str, str]:
    """Options for a bounded read: explicit start and end, no per-trigger cap
    (a batch read takes the whole range, split by ``minPartitions``)."""
    o = {k: v for k, v in opts.reader_options().items() if k not in ("startingOffsets", "maxOffsetsPerTrigger")}
    o.update(startingOffsets=starting, endingOffsets=ending)
    return o


def read_topic_batch(spark: SparkSession, opts: TopicOptions, starting: str = "earliest", ending: str = "latest") -> DataFrame:
    """Bounded topic read (backfills)."""
    return spark.read.format("kafka").options(**batch_reader_options(opts, starting, ending)).load()


def read_topic_files(
    spark: SparkSession,
    path: str,
    *,
    streaming: bool = True,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """Topic records stored as files (``TOPIC_RECORD`` columns). With
    ``max_files_per_trigger`` a stream works off a backlog in micro-batches of
    that many files; without, it takes all that is there."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(file_format).schema(TOPIC_RECORD)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def value_only(df: DataFrame, keep_offset: bool = True) -> DataFrame:
    """Drop key, topic, record time; keep the message and (for last-arrival
    -wins) its position."""
    cols = ["value"] + (["partition", "offset"] if keep_offset else [])
    return df.select(*cols)


def register_topic(
    spark: SparkSession,
    name: str,
    records: DataFrame,
    *,
    mode: str = "null_fields",
    split_lines: bool = False,
    keep: tuple[str, ...] = ("offset",),
    decode_options: Mapping[str, object] | None = None,
    proctime: str | None = None,
) -> DataFrame:
    """A decoded order source under a SQL name: the topic's records decoded by
    ``mode`` and registered as a temporary view, queryable with ``spark.sql``.
    Works for batch and streaming records alike. ``proctime`` names an extra
    processing-time column computed on the source (declared, optional)."""
    df = records
    keep = tuple(keep)
    if split_lines:
        df = split_rows(df)
        keep = (*keep, "line")
    # The defaults of ``PipelineOptions``, so that the SQL form starts from the
    # same rows as the DataFrame form.
    options = {"fill_missing": FILL_MISSING, **dict(decode_options or {})}
    decoded = decode_json(df, mode, keep=keep, **options)
    if proctime:
        decoded = decoded.withColumn(proctime, F.localtimestamp())
    decoded.createOrReplaceTempView(name)
    return decoded
