"""Operator 9: exact deduplication with a heavy-hitter split.

Texts are equal when they are identical after lower-casing A-Z; a null text
counts as empty.  Their SHA-256 is taken once per row.  Misra-Gries summaries
(at most ``k`` counters per task, merged in two rounds of bounded size) name
every digest that more than n / (k + 1) rows share; an exact second count
verifies them, and these at most ``k`` winners are broadcast, so a large group
of copies is settled where its rows lie.  The other digests, none with more
than n / (k + 1) rows, take an ordinary shuffle.

Defined cases: an empty table gives an empty result; null and empty texts form
one group; a null id is smaller than any other; rows that repeat id and text
count each in ``group_size`` and agree in ``kept``, but `drop_exact_copies`
leaves one of them; columns beside id and text, whatever their names, are
carried by `drop_exact_copies` and ignored by `exact_groups`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import as_bytes, cut_lineage, map_arrow

#: Counters of a summary, and so the most digests that are ever broadcast.
COUNTERS = 256
#: Groups of task summaries in the first merging round.
MERGE_GROUPS = 256
_DIGEST = "__digest"


def text_digest(text: bytes) -> bytes:
    return hashlib.sha256(text.lower()).digest()  # bytes.lower() changes A-Z only


def with_digest(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` and the digest of its text, as the binary column ``__digest``."""
    at = df.columns.index(text_col)
    df = df.select("*")

    def digests(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = pa.array([text_digest(t) for t in as_bytes(batch.column(at)).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, _DIGEST])

    schema = df.schema
    return map_arrow(df, digests, type(schema)([*schema.fields]).add(_DIGEST, "binary"))


def trim(counts: pd.Series, k: int) -> pd.Series:
    """At most k counters of a summary: the (k+1)-th largest count leaves every counter."""
    if len(counts) <= k:
        return counts
    counts = counts.sort_values(ascending=False)
    counts = counts.iloc[:k] - counts.iloc[k]
    return counts[counts > 0]


def frequent_candidates(digests: DataFrame, k: int = COUNTERS) -> DataFrame:
    """At most k digests, among them all that more than n / (k + 1) rows have."""
    def frame(kept: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"d": pd.Series(list(kept.index), dtype=object), "n": kept.astype("int64").to_numpy()})

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = pd.Series(dtype="int64")
        for pdf in batches:
            kept = trim(kept.add(pdf["d"].value_counts(), fill_value=0), k)
        yield frame(kept)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        kept = trim(pdf.groupby("d")["n"].sum(), k)
        return frame(kept)

    parts = digests.select(F.lower(F.hex(_DIGEST)).alias("d")).mapInPandas(summarise, "d string, n long")
    parts = parts.withColumn("g", F.spark_partition_id() % MERGE_GROUPS)
    for _ in range(2):  # first by group, then all
        parts = parts.groupBy("g").applyInPandas(merge, "d string, n long").withColumn("g", F.lit(0))
    return parts.select(F.unhex("d").alias(_DIGEST))


def split_groups(dg: DataFrame, k: int = COUNTERS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(heavy digests, rows of heavy digests, other rows), rows with keep_id and group_size."""
    found = cut_lineage(frequent_candidates(dg, k))
    least = max(2, dg.count() // (k + 1))
    heavy = cut_lineage(dg.join(F.broadcast(found), _DIGEST)
                        .groupBy(_DIGEST).agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
                        .filter(F.col("group_size") >= least))
    hot = dg.join(F.broadcast(heavy), _DIGEST)
    rest = dg.join(F.broadcast(heavy), _DIGEST, "left_anti")
    sizes = rest.groupBy(_DIGEST).agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    return heavy, hot, rest.join(sizes, _DIGEST)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 k: int = COUNTERS) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    dg = cut_lineage(with_digest(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text")
                     .select("id", _DIGEST))
    _, hot, rest = split_groups(dg, k)
    return hot.unionByName(rest).select(
        F.col("id").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex(_DIGEST)).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      k: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged.

    Losers of heavy groups leave before the texts are shuffled.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    id_name, text_name = (names[docs.columns.index(c)] for c in (id_col, text_col))
    full = with_digest(docs.toDF(*names), text_name)
    dg = cut_lineage(full.select(F.col(id_name).alias("id"), _DIGEST))
    heavy, hot, rest = split_groups(dg, k)
    # plain keys for join and dedup alike, so that the texts are shuffled once
    key = lambda c: F.coalesce(F.concat(F.lit("i"), F.col(c).cast("string")), F.lit("n")).alias("__id")
    won = (hot.unionByName(rest).filter(F.col("id").eqNullSafe(F.col("keep_id")))
           .select(_DIGEST, key("id")).distinct())
    light = full.join(F.broadcast(heavy.select(_DIGEST, F.col("keep_id").alias("heavy_id"))), _DIGEST, "left").filter(
        F.col("heavy_id").isNull() | (F.col(id_name) == F.col("heavy_id"))).drop("heavy_id")
    kept = light.withColumn("__id", key(id_name)).join(won, [_DIGEST, "__id"], "left_semi")
    return kept.dropDuplicates([_DIGEST, "__id"]).select(*names).toDF(*docs.columns)


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
