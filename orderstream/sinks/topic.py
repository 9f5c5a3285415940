"""Publishing orders to a topic (SNK-7): key = order id, value = JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.codec import encode_json
from ..functions.text import encode_key
from ..options import TopicOptions


def topic_records(orders: DataFrame) -> DataFrame:
    """Orders -> ``(key, value)`` byte columns ready for a topic writer."""
    from pyspark.sql import functions as F

    return orders.select(encode_key("order_id").alias("key"), F.encode(encode_json(), "UTF-8").alias("value"))


def publish(orders: DataFrame, opts: TopicOptions) -> None:
    """Write orders to the topic with ``acks=all``. Needs the broker
    connector on the classpath (not in this image)."""
    topic_records(orders).write.format("kafka").options(**opts.writer_options()).save()
