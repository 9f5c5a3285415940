"""Exact dedup with a keyed streaming state (operator 3).

Documents pass as a stream of arrivals (digest, doc_id, length, content locator).
A streaming aggregation without a watermark keeps one state entry per digest for
ever, in the disk-backed RocksDB store: the digest, the identifier of the row
that stays, its content locator and the number of rows. On a hit (a digest seen
more than once) the normalised bytes are fetched and compared in full; rows of
one digest whose bytes differ are told apart by their bytes. Built-in functions
only; a hot digest is pre-aggregated before the shuffle into the state, and the
joins on it are plain equi-joins that adaptive execution can split.

Texts are equal when identical after deleting white space. Of equal texts the
row with the most code points in the original text stays, then the smallest
doc_id, then the first arrival.

Edge cases: NULL text is the empty text (all blank texts are equal). A NULL
doc_id loses to any other. Repeated rows are separate arrivals, one of which
stays. Other columns are ignored by ``classify`` and carried by ``keep_first``.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CLASS, named_rows, scratch_path, stored, text_or_empty

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A store's working files leave the executor's disk once its batch is committed.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
Digest = Callable[[Column], Column]


def normalised(text: Column | str = "text") -> Column:
    return F.regexp_replace(text_or_empty(text), SPACE_CLASS + "+", "")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def arrivals(docs: DataFrame, digest: Digest, arrival: Column, file: Column, *more: Column) -> DataFrame:
    """One narrow row per document; ``arrival`` is its number in its ``file``."""
    return docs.select(
        digest(normalised()).alias("_digest"),
        F.length(text_or_empty()).cast("long").alias("_points"),
        F.col("doc_id").cast("long").alias("_doc_id"),
        arrival.alias("_arrival"),
        file.alias("_file"),
        *more,
    )


def state(stream: DataFrame) -> DataFrame:
    """The keyed state over a stream (or a table) of ``arrivals``."""
    first = F.struct(
        F.col("_points").alias("points"),
        (-F.col("_doc_id")).alias("neg_id"),  # NULL orders below every id
        (-F.col("_arrival")).alias("neg_arrival"),
        F.col("_file").alias("file"),
    )
    return stream.groupBy("_digest").agg(F.count(F.lit(1)).alias("_rows"), F.max(first).alias("_first"))


def run_stream(spark: SparkSession, source: str, schema, files_per_batch: int) -> DataFrame:
    """Stream the stored arrivals through the state; the last version of every entry."""
    own = spark.newSession()  # the state store setting stays in this session
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    for key, value in ROCKSDB.items():
        own.conf.set(key, value)
    target = scratch_path(spark, "exact_state")

    def write(batch: DataFrame, batch_id: int) -> None:
        # Overwriting the batch's own folder makes a repeated batch harmless.
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    stream = own.readStream.schema(schema).option("maxFilesPerTrigger", str(files_per_batch)).parquet(source)
    entries = state(stream)
    query = (
        entries.writeStream.outputMode("update")
        .option("checkpointLocation", scratch_path(spark, "exact_checkpoint"))
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    versions = spark.read.schema(entries.schema).parquet(f"{target}/batch=*") if query.lastProgress else None
    if versions is None:
        return spark.createDataFrame([], entries.schema)
    # An entry's row count only grows, so its largest version is its last.
    last = versions.groupBy("_digest").agg(F.max(F.struct("_rows", "_first")).alias("v"))
    return last.select("_digest", "v._rows", "v._first")


def _collided(docs: DataFrame, entries: DataFrame, digest: Digest) -> DataFrame:
    """Digests that stand for different bytes: full comparison of every hit."""
    hits = entries.filter("_rows > 1").select("_digest")
    texts = docs.select(digest(normalised()).alias("_digest"), normalised().alias("_bytes")).join(hits, "_digest", "left_semi")
    return texts.groupBy("_digest").agg((F.min("_bytes") != F.max("_bytes")).alias("differ")).filter("differ").select("_digest")


def _remember(flow: DataFrame, files_per_batch: int | None) -> tuple[DataFrame, DataFrame]:
    """(stored arrivals, the state's entries after all of them)."""
    spark = flow.sparkSession
    path = scratch_path(spark, "exact_arrivals")
    flow.write.parquet(path)
    seen = spark.read.schema(flow.schema).parquet(path)
    if files_per_batch is None:  # two micro-batches, so that hits cross batches
        files_per_batch = max(1, (len(seen.inputFiles()) + 1) // 2)
    return seen, stored(run_stream(spark, path, flow.schema, files_per_batch), "exact_entries")


def _classified(seen: DataFrame, entries: DataFrame) -> DataFrame:
    return seen.join(entries, "_digest").select(
        F.col("_doc_id").alias("doc_id"),
        (-F.col("_first.neg_id")).alias("keep_id"),
        F.col("_rows").alias("group_size"),
        ((F.col("_arrival") == -F.col("_first.neg_arrival")) & (F.col("_file") == F.col("_first.file"))).alias("kept"),
        "_digest",
        "_arrival",
        "_file",
        F.col("_first.file").alias("keep_file"),
    )


def _told_apart(docs: DataFrame, collided: DataFrame, digest: Digest, arrival: Column, file: Column) -> DataFrame:
    """Classes among the rows of collided digests, by digest and full bytes."""
    rows = arrivals(docs, digest, arrival, file, normalised().alias("_bytes")).join(collided, "_digest", "left_semi")
    keyed = stored(rows, "exact_collided").withColumn("_digest", F.struct("_digest", "_bytes"))
    return _classified(keyed, state(keyed)).withColumn("_digest", F.col("_digest._digest"))


def _classes(docs: DataFrame, digest: Digest, files_per_batch: int | None, arrival: Column, file: Column) -> DataFrame:
    seen, entries = _remember(arrivals(docs, digest, arrival, file), files_per_batch)
    collided = stored(_collided(docs, entries, digest), "exact_differ")
    out = _classified(seen, entries)
    if not collided.isEmpty():
        out = out.join(collided, "_digest", "left_anti").unionByName(_told_apart(docs, collided, digest, arrival, file))
    return out


def classify(docs: DataFrame, digest: Digest = sha256, files_per_batch: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest, keep_file."""
    out = _classes(docs, digest, files_per_batch, F.monotonically_increasing_id(), F.input_file_name())
    return out.select("doc_id", "keep_id", "group_size", "kept", F.col("_digest").alias("digest"), "keep_file")


def keep_first(docs: DataFrame, digest: Digest = sha256, files_per_batch: int | None = None, on_files: bool = False) -> DataFrame:
    """The documents that stay, with the columns of ``docs``. Rows are named first
    (``on_files``: see ``named_rows``), so that a choice names one row; of equal
    ones on files the earliest in its file arrives first."""
    rows, row = named_rows(docs, "exact_documents", on_files)
    classes = _classes(rows, digest, files_per_batch, F.col(f"{row}.row_index"), F.col(f"{row}.file_path"))
    stays = classes.filter("kept").select(F.struct(F.col("_file").alias("file_path"), F.col("_arrival").alias("row_index")).alias(row))
    return rows.join(stays, row, "left_semi").select(*docs.columns)
