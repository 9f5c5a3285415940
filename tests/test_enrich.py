"""Enrichment, rounding and constraint checks (FIXTURES F6)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderstream.functions import round_money, to_millis, total_price
from orderstream.operators import enrich, split_valid, with_audit_line, with_defaults, with_engine_tag
from orderstream.plans import enrich_sql
from orderstream.schemas import PROCESSED_COLUMNS

AT = "2024-06-01 00:00:00"
RAW = "order_id string, customer_id string, product_id string, quantity int, price decimal(10,2), order_timestamp timestamp_ntz, status string"
TS = dt.datetime(2024, 1, 1, 3, 4, 5, 123456)


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_enrich_columns_and_values(spark):
    df = raw(spark, [("a", "c", "p", 3, Decimal("10.10"), TS, "pending")])
    out = enrich(df, at=AT)
    assert tuple(out.columns) == PROCESSED_COLUMNS
    r = out.collect()[0]
    assert r.total_price == Decimal("30.30")
    assert r.status == "PENDING"
    assert r.processing_timestamp == dt.datetime(2024, 6, 1)
    assert dict(out.dtypes)["processing_timestamp"] == "timestamp_ntz"


def test_sql_form_equals_dataframe_form(spark):
    rows = [("a", "c", "p", 3, Decimal("10.10"), TS, "pending"), ("b", "c", "p", 0, None, None, None)]
    df = raw(spark, rows)
    a = enrich(df, at=AT)
    b = enrich_sql(spark, df, at=AT)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_total_overflow_is_null_not_error(spark):
    df = raw(spark, [("a", "c", "p", 2000, Decimal("99999999.99"), TS, "x")])
    assert enrich(df, at=AT).collect()[0].total_price is None


@pytest.mark.parametrize(
    "x,half_up,half_even,scaled",
    [
        ("1.005", "1.01", "1.00", "1.01"),
        ("2.675", "2.68", "2.68", "2.68"),
        ("0.125", "0.13", "0.12", "0.13"),
        ("-0.125", "-0.13", "-0.12", "-0.12"),
    ],
)
def test_rounding_modes_on_decimals(spark, x, half_up, half_even, scaled):
    df = spark.createDataFrame([(Decimal(x),)], "x decimal(10,3)")
    r = df.select(
        *[round_money("x", m).cast("decimal(10,2)").alias(m) for m in ("half_up", "half_even", "scaled")]
    ).collect()[0]
    assert (str(r.half_up), str(r.half_even), str(r.scaled)) == (half_up, half_even, scaled)


def test_total_price_modes_agree_on_well_formed(spark):
    df = spark.createDataFrame([(3, Decimal("10.10"))], "quantity int, price decimal(10,2)")
    vals = df.select(*[total_price(rounding=m).alias(m) for m in ("exact", "half_up", "half_even", "scaled")]).collect()[0]
    assert set(vals) == {Decimal("30.30")}


def test_null_status(spark):
    df = raw(spark, [("a", "c", "p", 1, Decimal("1"), TS, None), ("b", "c", "p", 1, Decimal("1"), TS, "x")])
    assert enrich(df, at=AT).count() == 2
    assert [r.order_id for r in enrich(df, at=AT, null_status="drop").collect()] == ["b"]


def test_ms_truncation_keeps_zone_less_value(spark):
    df = spark.createDataFrame([(TS,)], "t timestamp_ntz")
    r = df.select(to_millis("t").alias("m")).collect()[0]
    assert r.m == dt.datetime(2024, 1, 1, 3, 4, 5, 123000)
    assert df.select(to_millis("t")).dtypes[0][1] == "timestamp_ntz"


def test_split_valid_reasons(spark):
    rows = [
        ("ok", "c", "p", 1, Decimal("1.00"), TS, "pending"),
        ("x" * 51, "c", "p", 1, Decimal("1.00"), TS, "pending"),
        ("neg", "c", "p", -1, Decimal("1.00"), TS, "pending"),
        ("nulls", None, "p", 1, Decimal("1.00"), TS, None),
        ("long_status", "c", "p", 1, Decimal("1.00"), TS, "s" * 21),
    ]
    valid, rejected = split_valid(enrich(raw(spark, rows), at=AT))
    assert [r.order_id for r in valid.collect()] == ["ok"]
    reasons = {r.order_id: r.reject_reasons for r in rejected.collect()}
    assert reasons["x" * 51] == "order_id:too_long"
    assert reasons["neg"] == "quantity:negative"
    assert reasons["nulls"] == "customer_id:null,status:null"
    assert reasons["long_status"] == "status:too_long"


def test_tags_defaults_audit(spark):
    df = enrich(raw(spark, [("a", "c", "p", 3, Decimal("10.10"), TS, "pending")]), at=AT)
    assert with_engine_tag(df).collect()[0].spark_engine == "PySpark"
    assert with_engine_tag(df, from_status=True).collect()[0].spark_engine == "PENDING"
    d = with_defaults(df.withColumn("spark_engine", F.lit(None).cast("string")), {"spark_engine": "PySpark", "created_at": F.col("processing_timestamp")})
    r = d.collect()[0]
    assert r.spark_engine == "PySpark" and r.created_at == dt.datetime(2024, 6, 1)
    assert with_audit_line(df).collect()[0].audit_line == "Processing: a | Status: PENDING | Total: $30.30"


def test_double_price_schema_still_gives_decimal_totals(spark, messages):
    from pyspark.sql import types as T

    from orderstream.plans import PipelineOptions, process
    from orderstream.schemas import RAW_ORDER

    as_double = T.StructType([T.StructField(f.name, T.DoubleType()) if f.name == "price" else f for f in RAW_ORDER.fields])
    df = messages(['{"order_id":"a","customer_id":"c","product_id":"p","quantity":3,"price":10.1,"order_timestamp":"2024-01-01T00:00:00","status":"x"}'])
    r = process(df, PipelineOptions(at=AT, schema=as_double)).collect()[0]
    assert r.price == Decimal("10.10") and r.total_price == Decimal("30.30")


def test_total_is_rounded_from_the_message_price(spark):
    from decimal import Decimal

    from orderstream.functions import total_price

    df = spark.sql("SELECT 3 AS quantity, CAST(1.005 AS DECIMAL(18,6)) AS price")
    got = {m: df.select(total_price("quantity", "price", m)).first()[0] for m in ("exact", "half_up", "half_even", "scaled")}
    assert got == {"exact": Decimal("3.03"), "half_up": Decimal("3.02"), "half_even": Decimal("3.02"), "scaled": Decimal("3.02")}
    df = spark.sql("SELECT 1 AS quantity, CAST(2.125 AS DECIMAL(18,6)) AS price UNION ALL SELECT 1, -2.125")
    got = {m: [r[0] for r in df.select(total_price("quantity", "price", m)).collect()] for m in ("half_up", "half_even", "scaled")}
    assert got == {
        "half_up": [Decimal("2.13"), Decimal("-2.13")], "half_even": [Decimal("2.12"), Decimal("-2.12")], "scaled": [Decimal("2.13"), Decimal("-2.12")],
    }


def test_a_price_out_of_range_is_null_in_every_mode(spark):
    from orderstream.functions import total_price

    for kind in ("double", "decimal(38,6)"):
        df = spark.sql(f"SELECT 3 AS quantity, CAST(1e12 AS {kind}) AS price UNION ALL SELECT 2147483647, CAST(99999999 AS {kind})")
        for mode in ("exact", "half_up", "half_even", "scaled"):
            assert [r[0] for r in df.select(total_price("quantity", "price", mode)).collect()] == [None, None]


def test_audit_line_is_never_null(spark):
    from orderstream.functions.text import audit_line

    df = spark.sql("SELECT 'a' AS order_id, CAST(NULL AS STRING) AS status, CAST(NULL AS DECIMAL(10,2)) AS total_price")
    assert df.select(audit_line()).first()[0] == "Processing: a | Status: null | Total: $null"
