import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[*]")
        .appName("orderstream-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Use the environment's checkpoint folder; name a private one only if unset.
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        folder = str(tmp_path_factory.mktemp("ckpt"))
        spark.conf.set("spark.checkpoint.dir", folder)
        spark.sparkContext.setCheckpointDir(folder)
    yield spark
    spark.stop()


@pytest.fixture
def messages(spark):
    """Build a topic-record DataFrame from message strings (offsets 0..n-1)."""
    from pyspark.sql import functions as F

    def make(values, keys=None):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "offset long, text string")
        return df.select(F.encode("text", "UTF-8").alias("value"), "offset")

    return make
