"""S8 + P8 + P9: canonical messages and the topic sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlens.functions.contract import DEVICE_FIELDS
from eventlens.functions.text import routing_key
from eventlens.functions.time import iso_utc

PRODUCER_OPTIONS = {  # fixed values of the specification: durable, compressed, short linger
    "kafka.acks": "all",
    "kafka.compression.type": "snappy",
    "kafka.linger.ms": "5",
}


def canonical_message(events: DataFrame) -> DataFrame:
    """P8 + P9: (key, value) with every field present (nulls kept), the
    timestamp as ISO 8601 and properties as a JSON object."""
    device = F.when(F.col("device").isNotNull(),
                    F.struct(*[F.col(f"device.{f}").alias(f) for f in DEVICE_FIELDS]))
    body = F.struct(
        "event_id", iso_utc("timestamp").alias("timestamp"), "user_id", "anonymous_id",
        "session_id", "event_type", "page_url", "referrer_url", device.alias("device"),
        "price", "product_id", F.parse_json(F.coalesce(F.col("properties"), F.lit("{}"))).alias("properties"))
    return events.select(routing_key().alias("key"),
                         F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def write_topic(messages: DataFrame, bootstrap: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Stream (key, value) to a topic.  Needs the Kafka connector jar."""
    return (messages.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint)
            .options(**PRODUCER_OPTIONS)
            .start())
