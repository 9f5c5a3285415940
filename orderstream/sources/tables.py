"""Reading stored tables (SRC-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..options import JdbcOptions


def read_table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    """A stored table, read as its files are split. ``partitions`` deals its rows
    to that many tasks instead (for a table of few splits and much work per row):
    by a hash of each row's position, which a retried task repeats."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df if partitions is None else df.repartition(partitions, F.monotonically_increasing_id())


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """A processed-orders table stored as parquet (filters and projections
    reach the scan)."""
    return spark.read.parquet(path)


def read_processed_jdbc(
    spark: SparkSession,
    opts: JdbcOptions,
    *,
    table: str | None = None,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """A processed-orders table over JDBC. With a numeric partition column the
    read is split into ``num_partitions`` range queries instead of one."""
    reader = spark.read.format("jdbc").options(
        url=opts.url, dbtable=table or opts.table, user=opts.user, password=opts.password
    )
    if opts.driver:
        reader = reader.option("driver", opts.driver)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(num_partitions or 8))
        )
    return reader.load()
