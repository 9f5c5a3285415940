import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def docs(spark):
    """documents rows from (doc_id, text[, lang, source])."""

    def make(rows):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, *("en", "src0")[len(row) - 2 :])
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCS)

    return make
