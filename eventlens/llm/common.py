"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.session import ensure_checkpoint_dir

#: Text bytes that a task holds in numpy form at once (a longer text stands alone).
SLICE_BYTES = 2 << 20
#: Rows of an Arrow batch: with documents of some KB, a batch stays at a few MB.
BATCH_ROWS = 2000
#: ``[^\x20\x09-\x0D]+``: a word, as the contracts define it.
WORD = r"[^\x20\x09-\x0D]+"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the session's shared checkpoint folder, and read from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` in small batches, whatever the session's batch size."""
    rows = int(df.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                yield from fn(batch.slice(at, BATCH_ROWS))

    return df.mapInArrow(run if rows > BATCH_ROWS else (lambda b: (x for y in b for x in fn(y))), schema)


def tasks_by_bytes(df: DataFrame, text_col: str, each: int = 32 << 20, most: int = 20_000) -> int:
    """Tasks to deal the texts out to: about ``each`` bytes a task, two for every core at least, ``most`` at most."""
    size = df.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    return min(most, max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-size // each)))


def as_bytes(column: pa.Array) -> pa.Array:
    """A string column as bytes with 64-bit offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of n + 1 rows, bytes) of a large_binary column, from offset 0."""
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(n + 1, np.int64), np.zeros(0, np.uint8)
    return at - at[0], np.frombuffer(data, np.uint8, int(at[-1] - at[0]), int(at[0]))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes, or one longer row."""
    at, _ = buffers(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def lookup(df: DataFrame, small: DataFrame, on: str, rows: int, max_rows: int = 10_000,
           salts: int = 16, how: str = "left") -> DataFrame:
    """Join ``small`` (unique by ``on``) to ``df``, whose keys may be hot.

    With at most ``max_rows`` counted rows ``small`` is broadcast; beyond
    that both sides are shuffled by (key, salt), a key's rows over ``salts`` tasks.
    Null keys match null keys.
    """
    key = f"__key_{on}"
    small = small.withColumnRenamed(on, key)
    if rows <= max_rows:
        return df.join(F.broadcast(small), F.col(on).eqNullSafe(F.col(key)), how).drop(key)
    spread = small.withColumn("__salt_r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = df.withColumn("__salt_l", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
    return salted.join(spread, F.col(on).eqNullSafe(F.col(key)) & (F.col("__salt_l") == F.col("__salt_r")),
                       how).drop(key, "__salt_l", "__salt_r")


def words_in(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
