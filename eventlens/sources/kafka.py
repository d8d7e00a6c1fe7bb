"""The event topic as a Structured Streaming source.

No Kafka connector jar ships in this environment, so these builders are not
exercised end to end here; the same pipelines run offline on file streams
(:mod:`eventlens.streaming.jobs`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.functions.contract import ARCHIVE_BATCH_ROWS, ARCHIVE_FLUSH_SECONDS

# --- Fixed value (must equal the reference's): the raw event topic ---------
DEFAULT_TOPIC = "events.clickstream.raw"
# ---------------------------------------------------------------------------


def topic_options(bootstrap: str, topic: str = DEFAULT_TOPIC, starting: str = "latest",
                  min_offsets: int | None = None, max_trigger_delay: str | None = None,
                  max_offsets: int | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    """Reader options.  ``starting='latest'`` for the speed layer (S1),
    ``'earliest'`` for the archive (S2); it applies on the first start only,
    later starts resume from the checkpoint.  ``min_offsets`` +
    ``max_trigger_delay`` give the archive's "N rows or T seconds" batches (S6).
    Offsets that have expired unread fail the query unless ``fail_on_data_loss`` is off.
    """
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if min_offsets:
        opts["minOffsetsPerTrigger"] = str(min_offsets)
    if max_trigger_delay:
        opts["maxTriggerDelay"] = max_trigger_delay
    if max_offsets:
        opts["maxOffsetsPerTrigger"] = str(max_offsets)
    return opts


def archive_options(bootstrap: str, **options) -> dict[str, str]:
    """The archive's reader (S2 + S6): from the start, in batches of 5,000 rows or 60 seconds."""
    return topic_options(bootstrap, **{"starting": "earliest", "min_offsets": ARCHIVE_BATCH_ROWS,
                                       "max_trigger_delay": f"{ARCHIVE_FLUSH_SECONDS}s", **options})


def read_topic(spark: SparkSession, **options) -> DataFrame:
    """Streaming DataFrame of (value, arrival_ts, key, partition, offset); the last two place a message."""
    raw = spark.readStream.format("kafka").options(**topic_options(**options)).load()
    return records_to_messages(raw)


def records_to_messages(records: DataFrame) -> DataFrame:
    """Broker records to message text plus the record time (the speed clock)."""
    return records.select(F.col("value").cast("string").alias("value"),
                          F.col("timestamp").alias("arrival_ts"),
                          F.col("key").cast("string").alias("key"),
                          *(c for c in ("partition", "offset") if c in records.columns))
