"""Order topics derived from the driver's tables.

The reference reads orders from a message topic; the test data has none, so
two stand-ins are built from it with Spark expressions, over whole tables:

* **E** (``events``): arrival order ``event_id``; the key ``user_id`` repeats,
  so E exercises last-arrival-wins; the quantity comes from the real JSON
  payload ``props``.
* **L** (``lineitem``): a large order table; its ids are not unique.

The column mappings and fault rules are SQL text valid in both Spark SQL and
DuckDB, so the oracle reads the same input definition and computes the
expected results independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codec import ISO_MICROS, encode_json
from ..functions.text import encode_key
from ..schemas import RAW_COLUMNS, RAW_ORDER

# Spark spelling of the payload field; DuckDB uses json_extract_string.
EVENTS_K_SPARK = "try_cast(get_json_object(props, '$.k') AS INT)"
EVENTS_K_DUCKDB = "TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)"


def events_order_sql(k: str) -> dict[str, str]:
    return {
        "order_id": "'ORD-' || lpad(CAST(user_id AS STRING), 8, '0')",
        "customer_id": "'CUST-' || lpad(CAST(user_id AS STRING), 4, '0')",
        "product_id": f"'PROD-' || lpad(CAST({k} AS STRING), 3, '0')",
        "quantity": k,
        "price": "TRY_CAST(value AS DECIMAL(10,2))",
        "order_timestamp": "ts",
        "status": "event_type",
    }


LINEITEM_ORDER_SQL = {
    "order_id": "'ORD-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
    "customer_id": "'CUST-' || CAST(l_suppkey AS STRING)",
    "product_id": "'PROD-' || CAST(l_partkey AS STRING)",
    "quantity": "TRY_CAST(l_quantity AS INTEGER)",
    "price": "TRY_CAST(l_extendedprice AS DECIMAL(10,2))",
    "order_timestamp": "l_shipdate",
    "status": (
        "CASE WHEN l_returnflag = 'R' THEN 'cancelled' "
        "WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 'pending' "
        "WHEN l_linestatus = 'O' THEN 'processing' "
        "WHEN l_returnflag = 'A' THEN 'delivered' ELSE 'shipped' END"
    ),
}

# A price with four digits, so that the rounding modes differ.
LINEITEM_NET_PRICE = "TRY_CAST(l_extendedprice AS DECIMAL(10,2)) * (1 - TRY_CAST(l_discount AS DECIMAL(4,2)))"
# A price in a double field that no stored amount can hold.
LINEITEM_HUGE = "l_tax = 0.0"
LINEITEM_HUGE_PRICE = "l_extendedprice * 10000000000"

# Messages that are more or less than one JSON object, or just padded.
EVENT_SHAPES = {
    "two_documents": "event_type = 'error'",
    "trailing_text": "event_type = 'purchase' AND value < 5",
    "single_quoted": "event_type = 'view' AND value < 5",
    "padded": "event_type = 'click' AND value < 5",
}

# Faults planted in E messages, selected by content (every row is still
# processed). The rule texts are shared with the oracle SQL.
EVENT_FAULTS = {
    "truncated": "event_type = 'error'",
    "null_message": "event_type = 'purchase' AND value < 5",
    "quantity_text": "event_type = 'view' AND value < 5",
    "quantity_fraction": "event_type = 'click' AND value < 5",
    "quantity_missing": "event_type = 'signup' AND value < 5",
    "no_fraction_ts": "event_type = 'purchase' AND value >= 5 AND value < 10",
    "status_missing": "event_type = 'view' AND value >= 5 AND value < 10",
}

# Faults planted in L orders for the constraint checks.
LINEITEM_FAULT_PRICE = "TRY_CAST(l_extendedprice * 100 AS DECIMAL(10,2))"
LINEITEM_FAULTS = {
    "status_null": "l_returnflag = 'R' AND l_linestatus = 'O' AND l_tax = 0.0",
    "id_too_long": "l_discount = 0.1 AND l_tax = 0.08",
    "quantity_negative": "l_discount = 0.0 AND l_tax = 0.01",
    "total_overflow": "l_discount = 0.05 AND l_tax = 0.02",
    "customer_null": "l_returnflag = 'N' AND l_discount = 0.09 AND l_tax = 0.03",
}


def events_orders(events: DataFrame) -> DataFrame:
    """E as typed raw orders plus ``offset`` (= ``event_id``, arrival order)."""
    m = events_order_sql(EVENTS_K_SPARK)
    return events.select(F.col("event_id").alias("offset"), *[F.expr(m[c]).alias(c) for c in RAW_COLUMNS])


def lineitem_orders(lineitem: DataFrame, price: str | None = None) -> DataFrame:
    """L as typed raw orders plus a deterministic ``offset`` (not unique)."""
    mapping = LINEITEM_ORDER_SQL if price is None else {**LINEITEM_ORDER_SQL, "price": price}
    return lineitem.select(
        (F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber")).alias("offset"),
        *[F.expr(mapping[c]).alias(c) for c in RAW_COLUMNS],
    )


def lineitem_faulted_orders(lineitem: DataFrame) -> DataFrame:
    """L with planted constraint violations (typed; decode is not the point)."""
    f = {k: F.expr(v) for k, v in LINEITEM_FAULTS.items()}
    cols = {
        "status": F.when(f["status_null"], F.lit(None).cast("string")).otherwise(F.expr(LINEITEM_ORDER_SQL["status"])),
        "order_id": F.when(f["id_too_long"], F.rpad(F.expr(LINEITEM_ORDER_SQL["order_id"]), 51, "x")).otherwise(
            F.expr(LINEITEM_ORDER_SQL["order_id"])
        ),
        "quantity": F.when(f["quantity_negative"], -F.expr(LINEITEM_ORDER_SQL["quantity"])).otherwise(
            F.expr(LINEITEM_ORDER_SQL["quantity"])
        ),
        "price": F.when(f["total_overflow"], F.expr(LINEITEM_FAULT_PRICE)).otherwise(
            F.expr(LINEITEM_ORDER_SQL["price"])
        ),
        "customer_id": F.when(f["customer_null"], F.lit(None).cast("string")).otherwise(
            F.expr(LINEITEM_ORDER_SQL["customer_id"])
        ),
    }
    other = [F.expr(LINEITEM_ORDER_SQL[c]).alias(c) for c in RAW_COLUMNS if c not in cols]
    return lineitem.select(
        (F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber")).alias("offset"),
        *other,
        *[v.alias(k) for k, v in cols.items()],
    ).select("offset", *RAW_COLUMNS)


def as_topic(orders: DataFrame, topic: str = "orders", message: "F.Column | None" = None) -> DataFrame:
    """Typed orders -> topic records (key = id bytes, value = JSON bytes)."""
    msg = message if message is not None else encode_json()
    return orders.select(
        encode_key("order_id").alias("key"),
        F.encode(msg, "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def events_topic(events: DataFrame) -> DataFrame:
    return as_topic(events_orders(events))


def lineitem_topic(lineitem: DataFrame) -> DataFrame:
    return as_topic(lineitem_orders(lineitem))


def events_faulted_topic(events: DataFrame) -> DataFrame:
    """E messages with the faults of ``EVENT_FAULTS`` planted by content."""
    f = {k: F.expr(v) for k, v in EVENT_FAULTS.items()}
    orders = events.select(
        "event_id", "value", "event_type", F.col("event_id").alias("offset"),
        *[F.expr(v).alias(c) for c, v in events_order_sql(EVENTS_K_SPARK).items()],
    )
    orders = orders.withColumns(
        {
            "quantity": F.when(f["quantity_missing"], F.lit(None).cast("int")).otherwise(F.col("quantity")),
            "status": F.when(f["status_missing"], F.lit(None).cast("string")).otherwise(F.col("status")),
        }
    )
    js = encode_json()
    msg = (
        F.when(f["null_message"], F.lit(None).cast("string"))
        .when(f["truncated"], F.expr("substring(_js, 1, length(_js) - 5)"))
        .when(f["quantity_text"], F.regexp_replace("_js", r'"quantity":(-?\d+)', '"quantity":"$1"'))
        .when(f["quantity_fraction"], F.regexp_replace("_js", r'"quantity":(-?\d+)', '"quantity":$1.5'))
        .when(f["no_fraction_ts"], F.regexp_replace("_js", r'("order_timestamp":"[^".]*)\.\d+"', '$1"'))
        .otherwise(F.col("_js"))
    )
    return as_topic(orders.withColumn("_js", js), message=msg)


def lineitem_net_topic(lineitem: DataFrame) -> DataFrame:
    """L messages whose price is after discount."""
    return as_topic(lineitem_orders(lineitem, price=LINEITEM_NET_PRICE))


def lineitem_huge_topic(lineitem: DataFrame) -> DataFrame:
    """L messages with a double price, far out of range by ``LINEITEM_HUGE``."""
    return as_topic(lineitem_orders(lineitem, price=f"CASE WHEN {LINEITEM_HUGE} THEN {LINEITEM_HUGE_PRICE} ELSE l_extendedprice END"))


def events_shaped_topic(events: DataFrame) -> DataFrame:
    """E messages of the shapes of ``EVENT_SHAPES``."""
    f = {k: F.expr(v) for k, v in EVENT_SHAPES.items()}
    orders = events.select(
        "value", "event_type", F.col("event_id").alias("offset"),
        *[F.expr(v).alias(c) for c, v in events_order_sql(EVENTS_K_SPARK).items()],
    ).withColumn("_js", encode_json())
    js = F.col("_js")
    msg = (
        F.when(f["two_documents"], F.concat(js, F.lit("\n"), js))
        .when(f["trailing_text"], F.concat(js, F.lit(" trailing")))
        .when(f["single_quoted"], F.replace(js, F.lit('"'), F.lit("'")))
        .when(f["padded"], F.concat(F.lit("  "), js, F.lit("\r\n")))
        .otherwise(js)
    )
    return as_topic(orders, message=msg)


def events_correction_topic(events: DataFrame) -> DataFrame:
    """E messages each carrying the order and then a correction of it (same
    id, quantity + 1) as two newline-delimited rows: within one message the
    later line is the later arrival."""
    orders = events_orders(events)
    corrected = F.to_json(
        F.struct(*[(F.col(c) + F.lit(1)).alias(c) if c == "quantity" else F.col(c) for c in RAW_COLUMNS]),
        {"timestampNTZFormat": ISO_MICROS},
    )
    return as_topic(orders, message=F.concat(encode_json(), F.lit("\n"), corrected))


def events_csv_topic(events: DataFrame) -> DataFrame:
    """E messages as CSV lines (a second wire format for a custom decoder)."""
    line = F.to_csv(F.struct(*[F.col(c) for c in RAW_COLUMNS]), {"timestampNTZFormat": ISO_MICROS})
    return as_topic(events_orders(events), message=line)


def csv_decoder():
    """A decoder for ``events_csv_topic`` messages (for ``decode_with``)."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_ORDER.fields)
    return lambda text: F.from_csv(text, ddl, {"timestampNTZFormat": ISO_MICROS})


def events_two_row_topic(events: DataFrame) -> DataFrame:
    """E messages each carrying two newline-delimited orders: the order and a
    twin whose id ends in ``-B``."""
    orders = events_orders(events)
    msg = F.concat(
        encode_json(),
        F.lit("\n"),
        F.to_json(
            F.struct(*[(F.concat("order_id", F.lit("-B")) if c == "order_id" else F.col(c)).alias(c) for c in RAW_COLUMNS]),
            {"timestampNTZFormat": ISO_MICROS},
        ),
    )
    return as_topic(orders, message=msg)
