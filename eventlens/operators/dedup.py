"""Drop repeated deliveries of the same event_id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Groups a hot id's copies are split into before the final dedup on a stream.
STREAM_DEDUP_SALTS = 16


def dedup_events(events: DataFrame, key: str = "event_id", time_col: str = "arrival_ts",
                 delay: str | None = None, salts: int = STREAM_DEDUP_SALTS) -> DataFrame:
    """Keep one row per ``key``; rows without a key are events of their own and all stay.

    Batch: ``dropDuplicates`` is an aggregate, so copies of a hot id are
    merged map-side before the shuffle.

    Stream: ``dropDuplicatesWithinWatermark`` has no map-side step, so every
    copy of an id would be shuffled to the one task owning its state.  With
    ``salts > 1`` the dedup runs twice: first per (key, salt), where the salt
    comes from the source partition and arrival time, which spreads a storm of
    copies over ``salts`` tasks; then per key, which now sees at most ``salts``
    rows of that id per batch.  The cost is a second state entry per id.
    ``delay`` (the watermark) is required on a stream and bounds how long ids
    are remembered.
    """
    if not events.isStreaming:
        # a row without a key gets a mark of its own, so one scan serves both
        own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
        return events.withColumn("_own", own).dropDuplicates([key, "_own"]).drop("_own")
    if delay is None:
        raise ValueError("streaming dedup needs a watermark delay")
    every = events.withWatermark(time_col, delay)
    wm = every.filter(F.col(key).isNotNull())
    if salts and salts > 1:
        salt = F.pmod(F.xxhash64(F.spark_partition_id(), F.col(time_col)), F.lit(salts))
        wm = (wm.withColumn("_salt", salt)
              .dropDuplicatesWithinWatermark([key, "_salt"])
              .drop("_salt"))
    return wm.dropDuplicatesWithinWatermark([key]).unionByName(every.filter(F.col(key).isNull()))
