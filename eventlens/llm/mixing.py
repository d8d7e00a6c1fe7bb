"""Operator 6: mixing sources to target weights (DataFrame operations only).

Words are counted per document and source.  Sources, by code point with null
last, weigh 5, 2, 1, repeating, and share ``share`` times all words; a target
stops at ``max_rate`` times its source's words and the excess goes to the others
by weight until none is above.  With rate = target / source's words, a document
is emitted floor(rate) times, plus one copy when its hash-seeded uniform number
is below the fraction, so reruns agree.

Each source's row is an aggregate (partial sums first, so a hot source is no
burden).  The numbering of sources is a range partition with per-partition
offsets, not one sorted task.  Rates are joined by broadcast up to a counted
number of sources, salted beyond (`common.lookup`).

Defined cases: an empty table gives an empty result; a null text has size 0; a
null source is a source of its own; a source without words has target 0 and
rate 0; rows that repeat an id draw the same number; a null id draws as one id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventlens.llm.common import cut_lineage, lookup, words_in

#: Fixed values of the contract.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_RATE = 2.0
SEED = "mix-1"


def uniform(id_col: Column, seed: str = SEED) -> Column:
    """In [0, 1): 52 bits of the MD5 of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def numbered(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` (unique by ``by``) with their position 0, 1, ... in code point order, null last, as ``pos``."""
    order = F.col(by).asc_nulls_last()
    dealt = cut_lineage(rows.repartitionByRange(order).withColumn("pid", F.spark_partition_id()))
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = dealt.groupBy("pid").agg(F.count("*").alias("n")).select(
        "pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    inner = F.row_number().over(Window.partitionBy("pid").orderBy(order)) - 1
    return dealt.withColumn("inner", inner).join(offsets, "pid").withColumn(
        "pos", F.col("inner") + F.col("off")).drop("pid", "inner", "off")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_rate: float = MAX_RATE) -> tuple[DataFrame, int]:
    """((source, source_size, target, rate), number of sources) from (source, size) rows."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    cap = F.col("source_size") * F.lit(float(max_rate))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("pos") % len(weights) + 1).cast("int"))
    rows = cut_lineage(numbered(per_source, "source").withColumn("w", weight).withColumn("cap", cap))
    first = rows.agg(F.sum("source_size"), F.sum("w"), F.count("*")).first()
    budget, spent, open_w, n_capped = float(first[0] or 0) * share, 0.0, int(first[1] or 0), 0
    while True:  # every round settles a source at least; the amounts left only grow
        above = F.lit(budget - spent) * F.col("w") > F.col("cap") * F.lit(open_w)
        now = rows.agg(F.count_if(above), F.sum(F.when(above, F.col("cap"))),
                       F.sum(F.when(~above, F.col("w")))).first()
        if now[0] == n_capped:
            break
        n_capped, spent, open_w = now[0], float(now[1]), int(now[2] or 0)
    target = F.when(above, F.col("cap")).otherwise(F.lit(budget - spent) * F.col("w") / F.lit(float(open_w or 1)))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return rows.withColumn("target", target).select("source", "source_size", "target", rate.alias("rate")), first[2]


def copies(rate: Column, id_col: Column, seed: str = SEED) -> Column:
    whole = F.floor(rate)
    return (whole + (uniform(id_col, seed) < rate - whole).cast("int")).cast("long")


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            seed: str = SEED, **targets) -> DataFrame:
    """One row per document: id, size, source_size, target, taken."""
    sizes = cut_lineage(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                                    words_in(F.col(text_col)).alias("size")))
    rates, n = source_targets(sizes, **targets)
    return lookup(sizes, rates, "source", n).select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        (F.col("size") * copies(F.col("rate"), F.col("id"), seed)).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: str = SEED, **targets) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns unchanged."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    id_name, text_name, source_name = (names[docs.columns.index(c)] for c in (id_col, text_col, source_col))
    plain = docs.toDF(*names)
    sizes = cut_lineage(plain.select(F.col(source_name).alias("source"), words_in(F.col(text_name)).alias("size")))
    rates, n = source_targets(sizes, **targets)
    rates = rates.select(F.col("source").alias(source_name), F.col("rate").alias("__rate"))
    taken = lookup(plain, rates, source_name, n).withColumn(
        "__copies", copies(F.col("__rate"), F.col(id_name), seed)).filter("__copies > 0")
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(
        *names).toDF(*docs.columns)


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    return mixture(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS w
  FROM sized GROUP BY source),
budget AS (SELECT 1.5::DOUBLE * sum(source_size) AS t FROM per_source),
ordered AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
         coalesce(sum(source_size * 2.0::DOUBLE) OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
         sum(w) OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w
  FROM per_source),
split AS (SELECT o.*, (t - spent) * w > cap * open_w AS above, t FROM ordered o, budget),
level AS (
  SELECT coalesce(sum(cap) FILTER (WHERE above), 0) AS spent, sum(w) FILTER (WHERE NOT above) AS open_w FROM split),
targets AS (
  SELECT s.source, source_size,
         CASE WHEN above THEN cap ELSE (t - l.spent) * w / CAST(l.open_w AS DOUBLE) END AS target
  FROM split s, level l),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets)
SELECT doc_id, size, source_size, target,
       size * CAST(floor(rate) + CASE WHEN
         CAST(('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13)) AS BIGINT)
           / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM sized d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
"""
