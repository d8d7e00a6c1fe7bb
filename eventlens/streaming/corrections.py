"""Late events corrected in the served table instead of lost.

The speed layer's state is gone for windows that the watermark has passed, so
Spark drops events that arrive later.  A second, stateless query over the same
source keeps every batch's events at rest by hour.  A batch that holds events of
windows that had ended at the latest time seen before it has those windows (and
keys) counted again from the events kept, and the counts are written to a table
of corrections.  A reader takes a correction where there is one, and the speed
layer's row elsewhere.

Whether an event is late is judged without any delay, so every event that the
speed layer may drop, under whatever delay and batches of its own, lies in a
window that is corrected.

Everything a batch writes lies in folders of its number: a batch that runs again
replaces what it wrote.  The latest time is in the folder of the batch before, so
a batch reads one row of it, and only the hours its late events touch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlens.functions.contract import SPEED_WINDOW
from eventlens.functions.text import default_product
from eventlens.operators.windows import product_window_counts, serving_projection
from eventlens.sinks.serving import ServingTable, child_ids
from eventlens.streaming.jobs import PRODUCT_COUNT_KEYS, serve

_KEYS = ["event_type", "product_id", "window_end"]


class Corrections:
    """Corrected counts per (event_type, window_end, product_id) under ``root``."""

    def __init__(self, root: str, window: str = SPEED_WINDOW, time_col: str = "arrival_ts"):
        self.root, self.window, self.time_col = root.rstrip("/"), window, time_col
        self.table = ServingTable(f"{self.root}/corrections", PRODUCT_COUNT_KEYS)

    def _latest_before(self, spark: SparkSession, batch_id: int):
        """The latest time (microseconds) of the batches before, from the last one's single row."""
        seen = [b for b in child_ids(spark, f"{self.root}/seen", "batch_id") if b < batch_id]
        if not seen:
            return None
        return spark.read.parquet(f"{self.root}/seen/batch_id={seen[-1]}").first()["latest"]

    def fold(self, batch: DataFrame, batch_id: int) -> None:
        """foreachBatch: keep the batch's events, count touched windows again."""
        spark, batch_id = batch.sparkSession, int(batch_id)
        ends = F.window(F.col(self.time_col), self.window).end
        hour = F.floor(F.unix_micros(self.time_col) / 3_600_000_000)
        (batch.filter(F.col(self.time_col).isNotNull())  # the others enter no window
         .select("event_type", default_product("product_id").alias("product_id"), self.time_col,
                 ends.alias("window_end"), hour.alias("hour"))
         .write.mode("overwrite").partitionBy("hour").parquet(f"{self.root}/arrivals/batch_id={batch_id}"))
        kinds = (f"event_type string, product_id string, `{self.time_col}` timestamp, window_end timestamp, "
                 "batch_id bigint, hour bigint")
        kept = spark.read.schema(kinds).parquet(f"{self.root}/arrivals").filter(F.col("batch_id") <= batch_id)
        own = kept.filter(F.col("batch_id") == batch_id)
        before = self._latest_before(spark, batch_id)
        newest = own.agg(F.unix_micros(F.max(self.time_col)).alias("newest")).first()["newest"]
        late = own.filter(F.lit(False) if before is None else F.unix_micros("window_end") <= F.lit(before))
        touched = late.select(*_KEYS, "hour").distinct()
        # events of the touched windows, of this and all earlier batches; Spark prunes the hours by `touched`
        hours = touched.select("hour").distinct()
        span = touched.select(*_KEYS).distinct()
        again = kept
        if self._within_hours():
            again = again.join(hours, "hour", "left_semi")
        again = again.join(span, _KEYS, "left_semi")
        self.table.upsert(serving_projection(product_window_counts(again, self.window, self.time_col)), batch_id)
        latest = max((t for t in (before, newest) if t is not None), default=None)
        # written last: a batch counts as seen when all else of it is there
        (spark.range(1).select(F.lit(latest).cast("long").alias("latest"))
         .coalesce(1).write.mode("overwrite").parquet(f"{self.root}/seen/batch_id={batch_id}"))

    def _within_hours(self) -> bool:
        """Whether a window's events lie in the hour of any of them (windows that divide an hour)."""
        number, unit = self.window.split()
        size = int(number) * {"second": 1, "minute": 60, "hour": 3600}.get(unit.rstrip("s"), 0)
        return size > 0 and 3600 % size == 0

    def start(self, events: DataFrame, checkpoint: str, **how) -> StreamingQuery:
        return serve(events, self.table, checkpoint, write=self.fold, **how)

    def read(self, spark: SparkSession, served: ServingTable) -> DataFrame:
        """The served rows, corrected ones in place of the speed layer's."""
        speed = served.read(spark)
        try:
            fixed = self.table.read(spark)
        except FileNotFoundError:
            return speed
        return speed.join(fixed, list(PRODUCT_COUNT_KEYS), "left_anti").unionByName(fixed)
