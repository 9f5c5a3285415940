"""Record shapes of the order pipeline.

Three shapes flow through the engine:

* ``TOPIC_RECORD`` - one message of the order topic (key/value bytes plus
  the position the broker gave it).
* ``RAW_ORDER`` - the seven fields an order message carries.
* ``PROCESSED_ORDER`` - the nine columns written to the targets.

Money is ``decimal(10,2)`` end to end; order time is zone-less
(``timestamp_ntz``) because the producer writes local ISO strings without an
offset, and the processing stamp is local wall-clock time for the same reason.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
# A price as a message may carry it, before it is narrowed to ``MONEY``.
UNROUNDED = T.DecimalType(18, 6)

TOPIC_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

RAW_ORDER = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("price", MONEY),
        T.StructField("order_timestamp", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
    ]
)
RAW_COLUMNS = tuple(f.name for f in RAW_ORDER.fields)
# The same with the price's own digits kept, for the modes that round the total.
RAW_ORDER_UNROUNDED = T.StructType([T.StructField("price", UNROUNDED) if f.name == "price" else f for f in RAW_ORDER.fields])

PROCESSED_ORDER = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("price", MONEY),
        T.StructField("total_price", MONEY),
        T.StructField("order_timestamp", T.TimestampNTZType()),
        T.StructField("processing_timestamp", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
    ]
)
PROCESSED_COLUMNS = tuple(f.name for f in PROCESSED_ORDER.fields)

# What an absent number counts as.
FILL_MISSING = {"quantity": 0, "price": 0}

KEY = "order_id"
# Columns the keyed target overwrites on a repeated key; ``created_at`` is
# deliberately not among them (it keeps the first insert's value).
UPDATE_COLUMNS = tuple(c for c in PROCESSED_COLUMNS if c != KEY)

# The store's column limits (VARCHAR lengths, DECIMAL(10,2) bound)
# and its defaults.
MAX_ID_LENGTH = 50
MAX_STATUS_LENGTH = 20
ENGINE_TAG = "spark_engine"
ENGINE_TAG_DEFAULT = "PySpark"
ENGINE_TAG_MAX_LENGTH = 20

REQUIRED_COLUMNS = PROCESSED_COLUMNS
