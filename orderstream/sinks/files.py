"""File-table sinks (SNK-6, SNK-2b, SNK-8, SNK-10).

Every batch write is keyed by ``batch_id`` and overwrites only its own
partition (dynamic partition overwrite), so a replayed micro-batch replaces
what its first attempt wrote instead of duplicating it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..schemas import KEY, UPDATE_COLUMNS

BATCH = "batch_id"


def _write_batch_partition(df: DataFrame, path: str, batch_id: int, file_format: str = "parquet") -> None:
    (
        df.withColumn(BATCH, F.lit(int(batch_id)).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH)
        .format(file_format)
        .save(path)
    )


def append_sorted(
    batch: DataFrame,
    path: str,
    batch_id: int,
    *,
    sort_by: Sequence[str] = ("order_id", "processing_timestamp"),
    partitions: int | None = None,
    observe: Callable[[DataFrame], DataFrame] | None = None,
    tiebreak: Sequence[str] = ("offset", "line"),
) -> None:
    """Append a batch to a table stored in ``sort_by`` order; every version of
    an order is kept. Range partitioning on the sort key gives each output
    file a disjoint key range (tight min/max statistics for lookups); the
    sort runs per partition, never globally on one task. ``observe`` attaches
    metrics above the exchange, so the range sampling pass does not count."""
    # A micro-batch shares one processing stamp, so a hot order id would be a
    # single unsplittable range; the arrival position breaks the tie, letting
    # the range partitioner spread it while the declared order still holds.
    tiebreak = [c for c in tiebreak if c in batch.columns and c not in sort_by]
    cols = [F.col(c) for c in (*sort_by, *tiebreak)]
    # Without a count, adaptive execution sizes the files to the batch.
    ranged = batch.repartitionByRange(partitions, *cols) if partitions else batch.repartitionByRange(*cols)
    out = ranged.sortWithinPartitions(*cols)
    _write_batch_partition(observe(out) if observe else out, path, batch_id)


def _if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame, or None where its path does not exist. Any other failure is
    the caller's to see."""
    try:
        return read()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def claim(spark: SparkSession, path: str, owner: str) -> None:
    """Record that the batch-keyed table at ``path`` is written by the stream
    whose checkpoint is ``owner``; fail if another stream already owns it
    (its batch ids would collide). The marker lives in ``_owner``, which table
    reads ignore."""
    marker = f"{path.rstrip('/')}/_owner"
    stored = _if_present(lambda: spark.read.text(marker))
    current = stored.first() if stored is not None else None
    if current is None:
        spark.createDataFrame([(owner,)], "value string").coalesce(1).write.mode("overwrite").text(marker)
    elif current[0] != owner:
        raise RuntimeError(
            f"{path} is written by the stream checkpointed at {current[0]}; "
            f"compact it and give the stream at {owner} a new table"
        )


def write_rejected(rejected: DataFrame, path: str, batch_id: int) -> None:
    """Dead-letter table: rejected rows with their reasons, per batch."""
    _write_batch_partition(rejected, path, batch_id)


class KeyedTable:
    """A keyed table where the last arrival wins and ``created_at`` keeps the
    first arrival's value, stored as an append-only log of reduced batches on
    top of an optional compacted base.

    * ``write_batch`` reduces the batch to one row per key (map-side first)
      and writes it as partition ``batch_id`` - O(batch) work, idempotent.
    * ``snapshot`` folds base + log: one two-phase aggregate on the key, the
      latest version by ``(batch_id, order)`` and the earliest ``created_at``;
      base rows rank before every log row.
    * ``compact(target)`` writes the folded snapshot as a new base; a new log
      then continues from it (``KeyedTable(new_log, base=target)``), so reads
      never fold an unbounded log.

    A log belongs to one stream checkpoint: batch ids restart at 0 on a new
    checkpoint and would overwrite the old partitions. To move a stream to a
    new checkpoint, compact first and give it a new log on top of the base.
    """

    def __init__(
        self,
        path: str,
        *,
        key: str = KEY,
        columns: Sequence[str] = UPDATE_COLUMNS,
        order: str | Sequence[str] = "offset",
        base: str | None = None,
    ):
        self.path = path.rstrip("/")
        self.key = key
        self.columns = list(columns)
        # A total arrival order within a key, e.g. ``(offset, line)`` when one
        # message carries several rows.
        self.order = [order] if isinstance(order, str) else list(order)
        self.base = base

    def write_batch(
        self,
        batch: DataFrame,
        batch_id: int,
        created_value: Column | None = None,
        observe: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        created_value = created_value if created_value is not None else F.col("processing_timestamp")
        batch = observe(batch) if observe else batch
        order = F.struct(*[F.col(c) for c in self.order])
        # One two-phase aggregate: last arrival's columns, first arrival's
        # creation value.
        out = (
            batch.groupBy(self.key)
            .agg(
                F.max_by(F.struct(*[F.col(c) for c in self.columns], order.alias("_order")), order).alias("_last"),
                F.min_by(created_value, order).alias("created_at"),
            )
            .select(F.col(self.key), *[F.col(f"_last.{c}").alias(c) for c in self.columns], F.col("created_at"), F.col("_last._order").alias("_order"))
        )
        _write_batch_partition(out, self.path, batch_id)

    def log(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def snapshot(self, spark: SparkSession, *, empty_log: bool = False) -> DataFrame:
        """The folded table. ``empty_log=True`` says that a log without any batch
        is expected (a new log on a base); otherwise a missing log is an error."""
        log = _if_present(lambda: self.log(spark)) if empty_log else self.log(spark)
        if log is None:
            if not self.base:
                raise ValueError(f"keyed table {self.path} has neither a base nor a written batch")
            return spark.read.parquet(self.base)
        if not self.base:
            return fold_log(log, key=self.key, columns=self._columns(log))
        base = spark.read.parquet(self.base)
        # A column that only one side has is kept, NULL on the other.
        columns = list(dict.fromkeys([*self._columns(log), *[c for c in base.columns if c not in (self.key, "created_at")]]))
        as_log = base.withColumns(
            {BATCH: F.lit(-1).cast("long"), "_order": F.lit(None).cast(log.schema["_order"].dataType)}
        )
        return fold_log(as_log.unionByName(log, allowMissingColumns=True), key=self.key, columns=columns)

    def _columns(self, log: DataFrame) -> list[str]:
        """The stored columns: those declared, then any other the log has."""
        extra = [c for c in log.columns if c not in (self.key, "created_at", "_order", BATCH, *self.columns)]
        return [*self.columns, *extra]

    def compact(self, spark: SparkSession, target: str) -> None:
        """Write the current snapshot as a new base at ``target`` (a written
        table in the shared folder; it also cuts the lineage of the fold)."""
        self.snapshot(spark).write.mode("errorifexists").parquet(target)


def fold_log(log: DataFrame, *, key: str = KEY, columns: Sequence[str] = UPDATE_COLUMNS) -> DataFrame:
    """Latest version per key across a batch log, first ``created_at``."""
    rank = F.struct(F.col(BATCH), F.col("_order"))
    cols = list(columns)
    return (
        log.groupBy(key)
        .agg(
            F.max_by(F.struct(*[F.col(c) for c in cols]), rank).alias("_last"),
            F.min_by(F.col("created_at"), rank).alias("created_at"),
        )
        .select(F.col(key), *[F.col(f"_last.{c}").alias(c) for c in cols], F.col("created_at"))
    )


# The target tables' column types and defaults.
PROCESSED_DDL = """
    order_id STRING,
    customer_id STRING,
    product_id STRING,
    quantity INT,
    price DECIMAL(10,2),
    total_price DECIMAL(10,2),
    order_timestamp TIMESTAMP_NTZ,
    processing_timestamp TIMESTAMP_NTZ,
    status STRING
"""


def ensure_tables(spark: SparkSession, location: str, *, tagged: str = "spark_processed_orders", sorted_append: str = "processed_orders_sorted") -> list[str]:
    """Declare the append targets if missing, as the writers store them, and make
    the batches written so far visible: the tagged table (plain rows, with the
    tag's default) and the sorted one (a partition per batch)."""
    location = location.rstrip("/")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {tagged} ({PROCESSED_DDL}, spark_engine STRING DEFAULT 'PySpark', "
        f"created_at TIMESTAMP_NTZ) USING parquet LOCATION '{location}/{tagged}'"
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {sorted_append} ({PROCESSED_DDL}, batch_id BIGINT) "
        f"USING parquet PARTITIONED BY (batch_id) LOCATION '{location}/{sorted_append}'"
    )
    if _if_present(lambda: spark.read.schema("order_id string").parquet(f"{location}/{sorted_append}")) is not None:
        spark.sql(f"ALTER TABLE {sorted_append} RECOVER PARTITIONS")
    return [tagged, sorted_append]


def register_keyed(spark: SparkSession, table: KeyedTable, name: str = "processed_orders") -> DataFrame:
    """The keyed target under a SQL name: its folded snapshot, one row per key
    (the stored log has one per key and batch)."""
    snapshot = table.snapshot(spark)
    snapshot.createOrReplaceTempView(name)
    return snapshot


def tables(spark: SparkSession) -> DataFrame:
    """List tables (SNK-11) as a DataFrame."""
    return spark.sql("SHOW TABLES")
