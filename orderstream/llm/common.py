"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, scratch_path

# Fixed value: the white space of the contracts, as a Java and RE2 character class.
SPACE_CLASS = r"[ \x09-\x0D]"
WORD_CLASS = r"[^ \x09-\x0D]"

__all__ = ["SPACE_CLASS", "WORD_CLASS", "checkpoint_root", "named_rows", "scratch_path", "stored", "table", "text_or_empty", "words"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table of the data folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: cuts the
    lineage, and survives a lost executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def named_rows(docs: DataFrame, name: str, on_files: bool = False) -> tuple[DataFrame, str]:
    """``docs`` with a column that names each row for good, and that column's name
    (one that ``docs`` do not have): a struct of file_path and row_index.

    ``on_files``: ``docs`` are read from files as they are, with no join or explode
    since that could repeat a row. The name is then the row's place in its file and
    no copy is stored. Else, or where the source knows no places, rows are numbered
    and stored with their number (file_path is empty)."""
    taken = {c.lower() for c in docs.columns}
    row = "_row"
    while row in taken:
        row += "_"
    if on_files and "_metadata" not in taken:
        try:
            return docs.withColumn(row, F.struct("_metadata.file_path", "_metadata.row_index")), row
        except AnalysisException:
            pass  # not a file source: numbered below
    number = F.struct(F.lit("").alias("file_path"), F.monotonically_increasing_id().alias("row_index"))
    return stored(docs.withColumn(row, number), name), row


def text_or_empty(c: Column | str = "text") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def words(text: Column) -> Column:
    """The maximal runs without white space, in order."""
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != F.lit(""))
