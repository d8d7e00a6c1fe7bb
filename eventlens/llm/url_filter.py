"""Operator 10: URL filter by rules and a character language-model ratio.

Rules (host, path) fit a host and its subdomains when the path starts with the
rule's; the longest rule's text wins (of equally long ones the longer host).
URLs without a rule are judged by two variable-order Markov models, of the
accepted and of the rejected URLs that rules decide: byte n-grams up to
``LONGEST`` bytes, counted over all of them, each order smoothed by the next
lower one (unseen contexts leave it alone), the lowest by a uniform one.  The
score is the difference of both log-likelihoods over the URL's length; it is
calibrated: the threshold has the best balanced accuracy on a fifth of the
rule-decided URLs under models of the other four fifths, then all of them are
counted together.  N-grams are counted exactly, one row for each (what is counted
grows with the corpus); a position's log-ratio depends on its longest n-gram
alone, so each n-gram's is computed once.  The at most ``FREQUENT`` n-grams that
make up 1/``FREQUENT`` of all positions each are broadcast; the others of a URL
are joined and added to its sum, in whole units of 2^-32, so the sum doesn't
depend on the order.

Defined cases: a null URL or one without ``://`` has empty host and path and is
judged by its text (null: empty); without accepted or without rejected URLs
every other URL is allowed; an empty table gives an empty result; rows that
repeat are judged alike and counted each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.llm.common import as_bytes, buffers, cut_lineage, map_arrow, slices

#: Fixed values of the contract: (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
LONGEST = 4
#: Broadcast n-grams at most; any other has less than this part of all positions.
FREQUENT = 1 << 17
#: N-grams that a counting task holds before it hands them on.
HELD = 1 << 20
#: Bits of a symbol (a byte plus 4, or a mark) in an n-gram's number, the newest one lowest.
BITS = 9
UNIT = float(1 << 32)
#: Weight, in counts, of the next lower order's estimate.
SMOOTH = 2.0
BIN = 0.005
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    found = [F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", i), F.lit("")) for i in (1, 2)]
    return F.translate(found[0], _UPPER, _LOWER), found[1]


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the winning rule, or nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]), r)):  # the winner comes last
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, v).otherwise(verdict)
    return text, verdict


def grams(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the longest n-gram that ends at each byte and end mark of some texts, in order; the texts' bounds."""
    n, lead = len(offsets) - 1, LONGEST - 1
    size = np.diff(offsets)
    bounds = np.concatenate([[0], np.cumsum(size + 1)])
    wide = np.full(len(data) + n * (lead + 1), 3, np.int64)  # end marks
    begin = bounds[:-1] + np.arange(n) * lead
    wide[(begin[:, None] + np.arange(lead)).ravel()] = 2  # start marks
    doc = np.repeat(np.arange(n), size)
    wide[np.arange(len(data)) - offsets[doc] + begin[doc] + lead] = data.astype(np.int64) + 4
    at = np.arange(bounds[-1]) + (np.repeat(np.arange(n), size + 1) + 1) * lead
    found = np.zeros(len(at), np.int64)
    for m in range(LONGEST):
        found |= wide[at - m] << (BITS * m)
    return found, bounds


def gram_counts(urls: DataFrame) -> DataFrame:
    """(gram, kind, n): how often each longest n-gram occurs in the URLs of (url, kind); kind is 0 to 3."""
    def merged(held: list) -> pa.RecordBatch:
        key, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        n = np.zeros(len(key), np.int64)
        np.add.at(n, at, np.concatenate([c for _, c in held]))
        return pa.RecordBatch.from_pydict({"gram": key >> 2, "kind": (key & 3).astype(np.int32), "n": n})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            texts = as_bytes(batch.column(0))
            kinds = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi in slices(texts):
                found, bounds = grams(*buffers(texts.slice(lo, hi - lo)))
                held.append(np.unique(found << 2 | np.repeat(kinds[lo:hi], np.diff(bounds)), return_counts=True))
                size += len(held[-1][0])
                if size > HELD:
                    yield merged(held)
                    held, size = [], 0
        if held:
            yield merged(held)

    return (urls.mapInArrow(count, "gram long, kind int, n long")
            .groupBy("gram", "kind").agg(F.sum("n").alias("n")))


@dataclass
class Models:
    """Exact counts (gram, rejected, accepted) of the longest n-grams, which those of shorter ones and of contexts
    add up from; and how many n-grams were counted: [rejected, accepted][length]."""
    counts: DataFrame
    ends: np.ndarray

    def ratios(self, seen: DataFrame) -> DataFrame:
        """(gram, n, ratio) of all n-grams in ``seen`` (gram, n): ``ratio`` is the accepted model's log-likelihood
        of its last symbol less the rejected one's, in ``UNIT`` parts."""
        zero = F.lit(0).cast("long")
        table = cut_lineage(
            seen.select("gram", "n", zero.alias("rejected"), zero.alias("accepted"))
            .unionByName(self.counts.select("gram", zero.alias("n"), "rejected", "accepted"))
            .groupBy("gram").agg(*(F.sum(c).alias(c) for c in ("n", "rejected", "accepted"))))
        levels = {LONGEST: table}
        for m in range(LONGEST - 1, 0, -1):
            levels[m] = levels[m + 1].groupBy(_suffix(m).alias("gram")).agg(
                *(F.sum(c).alias(c) for c in ("rejected", "accepted")))
        lower = None
        for m in range(1, LONGEST + 1):
            context = Window.partitionBy(F.shiftright("gram", BITS))  # an n-gram without its last symbol: <= 258 rows
            rows = levels[m].select("*", *(F.sum(c).over(context).alias(f"{c}_in") for c in ("rejected", "accepted")))
            if lower is None:
                rows = rows.select("*", *(F.lit(1 / 257).alias(f"{c}_p") for c in ("rejected", "accepted")))
            else:
                rows = rows.withColumn("suffix", _suffix(m - 1)).join(F.broadcast(lower) if m <= 3 else lower, "suffix")
            p = {c: (F.col(c) + SMOOTH * F.col(f"{c}_p")) / (F.col(f"{c}_in") + SMOOTH) for c in ("rejected", "accepted")}
            if m < LONGEST:
                lower = rows.select(F.col("gram").alias("suffix"), *(x.alias(f"{c}_p") for c, x in p.items()))
        ratio = F.round((F.log(p["accepted"]) - F.log(p["rejected"])) * UNIT).cast("long")
        return cut_lineage(rows.filter("n > 0").select("gram", "n", ratio.alias("ratio")))

    def scores(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Scores of a few texts on the driver."""
        texts = [bytes(data[lo:hi]) for lo, hi in zip(offsets, offsets[1:], strict=False)]
        rows = self.counts.sparkSession.createDataFrame(list(enumerate(texts)), "at long, url binary")
        return np.array([r.score for r in scored(rows, self).orderBy("at").select("score").collect()])


def _suffix(m: int) -> Column:
    return F.col("gram").bitwiseAND(F.lit((1 << (BITS * m)) - 1))


def counted(urls: DataFrame) -> tuple[Models, Models]:
    """Models of the URLs in (url, accepted, spare): without the spare ones, and of all."""
    kind = F.col("accepted").cast("int") + 2 * F.col("spare").cast("int")
    sums = {k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)) for k in range(4)}
    counts = cut_lineage(gram_counts(urls.select("url", kind.alias("kind"))).groupBy("gram").agg(
        sums[0].alias("r0"), sums[1].alias("a0"), (sums[0] + sums[2]).alias("r1"), (sums[1] + sums[3]).alias("a1")))
    totals = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("r0", "a0", "r1", "a1"))).first()
    trial, models = (
        Models(counts.select("gram", F.col(f"r{k}").alias("rejected"), F.col(f"a{k}").alias("accepted")),
               np.repeat([[totals[f"r{k}"]], [totals[f"a{k}"]]], LONGEST, axis=1)) for k in (0, 1))
    return trial, models


def scored(rows: DataFrame, models: Models, url_col: str = "url", frequent: int = FREQUENT) -> DataFrame:
    """``rows`` with the models' ``score`` of their url: length-normalised log-likelihood difference, accepted less
    rejected."""
    seen = gram_counts(rows.select(url_col, F.lit(0).alias("kind"))).select("gram", "n")
    ratios = models.ratios(seen)
    total = ratios.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    got = ratios.filter(F.col("n") >= total / frequent).select("gram", "ratio").toArrow()  # at most ``frequent`` rows
    known, worth = (got.column(c).to_numpy().astype(np.int64) for c in ("gram", "ratio"))
    order = np.argsort(known)
    shared = rows.sparkSession.sparkContext.broadcast((known[order], worth[order]))
    at = rows.columns.index(url_col)
    pair = pa.struct([("gram", pa.int64()), ("times", pa.int64())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = as_bytes(batch.column(at))
        known, worth = shared.value
        for lo, hi in slices(texts):
            found, bounds = grams(*buffers(texts.slice(lo, hi - lo)))
            place = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
            hit = known[place] == found if len(known) else np.zeros(len(found), bool)
            sums = np.r_[0, np.cumsum(np.where(hit, worth[place] if len(known) else 0, 0))]
            row = np.repeat(np.arange(hi - lo), np.diff(bounds))
            left = np.stack([row[~hit], found[~hit]])
            left, times = np.unique(left, axis=1, return_counts=True)
            to = np.searchsorted(left[0], np.arange(hi - lo + 1))
            rest = pa.ListArray.from_arrays(pa.array(to, pa.int32()),
                                            pa.StructArray.from_arrays([pa.array(left[1]), pa.array(times)], fields=list(pair)))
            yield pa.RecordBatch.from_arrays(
                [*batch.slice(lo, hi - lo).columns, pa.array(np.diff(bounds)), pa.array(sums[bounds[1:]] - sums[bounds[:-1]]), rest],
                names=[*batch.schema.names, "__size", "__sum", "__rest"])

    schema = T.StructType([*rows.schema.fields]).add("__size", "long").add("__sum", "long").add(
        "__rest", T.ArrayType(T.StructType().add("gram", "long").add("times", "long")))
    parts = cut_lineage(map_arrow(rows, run, schema).withColumn("__row", F.monotonically_increasing_id()))
    rest = (parts.select("__row", F.inline("__rest")).join(ratios.select("gram", "ratio"), "gram")
            .groupBy("__row").agg(F.sum(F.col("times") * F.col("ratio")).alias("__more")))
    score = (F.col("__sum") + F.coalesce("__more", F.lit(0))) / F.lit(UNIT) / F.col("__size")
    return parts.drop("__rest").join(rest, "__row", "left").select(*rows.columns, score.alias("score"))


def threshold(spare: DataFrame) -> float:
    """The score with the best balanced accuracy on (score, accepted), by bins of ``BIN`` within -10 and 10."""
    top = round(10 / BIN)
    bins = spare.groupBy(F.least(F.greatest(F.floor(F.col("score") / BIN), F.lit(-top)), F.lit(top)).alias("bin"),
                         "accepted").count().toArrow()
    counts = np.zeros((2, 2 * top + 1))
    np.add.at(counts, (bins.column("accepted").to_numpy(zero_copy_only=False).astype(int),
                       bins.column("bin").to_numpy() + top), bins.column("count").to_numpy())
    below = np.concatenate([np.zeros((2, 1)), counts.cumsum(axis=1)], axis=1) / np.maximum(counts.sum(axis=1), 1)[:, None]
    gain = below[0] - below[1]  # rejected ones below less accepted ones below
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    runs = np.split(best, np.flatnonzero(np.diff(best) > 1) + 1)
    widest = max(runs, key=lambda r: (len(r), -abs(float(r.mean()) - top)))
    return (float(widest.mean()) - top) * BIN


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: id, host, path, rule, verdict, score (null where a rule decides)."""
    host, path = url_parts(F.col("url"))
    rows = (pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
            .withColumn("host", host).withColumn("path", path))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("by_rule", verdict)
    known = rows.filter("by_rule is not null").select(
        "url", (F.col("by_rule") == "allow").alias("accepted"),
        (F.pmod(F.xxhash64("url"), F.lit(5)) == 0).alias("spare"))
    trial, models = counted(known)
    if models.ends[0, 0] and models.ends[1, 0]:
        least = threshold(scored(known.filter("spare"), trial).select("score", "accepted"))
    else:
        least = -np.inf
    told = F.when(F.col("score") >= float(least), "allow").otherwise("block")
    by_model = scored(rows.filter("by_rule is null"), models).select("id", "host", "path", "rule", told.alias("verdict"), "score")
    by_rule = rows.filter("by_rule is not null").select(
        "id", "host", "path", "rule", F.col("by_rule").alias("verdict"), F.lit(None).cast("double").alias("score"))
    return by_model.unionByName(by_rule).withColumnRenamed("id", id_col)


def op10_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
