"""Operator 2: toxic spans and document scores from a linear-chain CRF.

Labels exist per document, so token labels are derived first: among the words
and word beginnings of a bounded sample of labelled documents, those are taken
whose documents are toxic far more often than chance allows, greedily by the
toxic documents they newly explain; words that carry one in a toxic document
are labelled 1.  A CRF (`crf`) learns from these tokens.  Forward-backward
marginals of every word of every whole text are then turned into a document
score (strongest word and expected number of toxic words, through a logistic
curve fitted on sample documents that the CRF hasn't seen) and into offending
offsets (runs of words with marginal >= 0.5, in code points).

Only the fit is bounded: ``sample_docs`` documents of at most ``sample_chars``
characters and ``sample_bytes`` bytes of text together, by hash of the id, toxic
ones up to half of each bound and clean ones for the rest.  The bytes bound the
driver's memory too, at some 40 bytes for each; the curve's intercept is set right by the labels' own rate.  Every
document is scored whole.  Scores depend on the text alone.

Defined cases: null, empty and wordless texts get the score of a text without
signs, and no spans; where the sample shows no signs (no usable labels, all or
none of them toxic), every score is the labels' rate of toxic documents, 0.49
at most, so none is called toxic; rows that repeat an id are
scored each; columns beside id and text are ignored or, by `drop_toxic`, kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.llm import crf as C
from eventlens.llm.common import as_bytes, buffers, cut_lineage, map_arrow, slices

SAMPLE_DOCS = 3000
SAMPLE_CHARS = 20_000
SAMPLE_BYTES = 8 << 20
SEEDS = (0x9FB21C651E98DF25, 0xD1B54A32D192ED03, 0xAEF17502108EF2D9, 0x8CB92BA72F3D8DD7)


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, mod 5; 0 is held out (null ids too)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5


@dataclass
class Model:
    crf: C.Crf | None
    curve: tuple[float, float, float]

    def score(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, C.Tokens, np.ndarray]:
        """(document scores, words, words' probabilities) of a block of documents."""
        n = len(offsets) - 1
        tokens = C.tokenize(offsets, data)
        p = C.marginals(self.crf, tokens) if self.crf else np.zeros(len(tokens))
        return self.curve_of(*signs(tokens, p, n)), tokens, p

    def curve_of(self, top: np.ndarray, total: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        return 1.0 / (1.0 + np.exp(-np.clip(a + b * top + c * total, -30, 30)))


def signs(tokens: C.Tokens, p: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document: the log-odds of the strongest word, and the log of the expected number of toxic words."""
    top, total = np.zeros(n), np.zeros(n)
    np.maximum.at(top, tokens.doc, p)
    total += np.bincount(tokens.doc, p, n)
    top = np.clip(top, 1e-4, 1 - 1e-4)
    return np.log(top / (1 - top)), np.log(np.clip(total, 1e-2, 1e2))


def unlike(tokens: C.Tokens, n: int) -> np.ndarray:
    """One document of each group of near copies, by the least hashes of three-word runs."""
    keep = np.ones(n, bool)
    if len(tokens) < 3:
        return keep
    w = tokens.hashes["word"]
    three = np.flatnonzero(tokens.doc[2:] == tokens.doc[:-2])
    if not len(three):
        return keep
    doc = tokens.doc[three]
    begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    for seed in SEEDS:
        s = np.uint64(seed)
        run = ((w[three] * s) ^ w[three + 1]) * s ^ w[three + 2]
        least = np.minimum.reduceat(run * s, begin)
        _, kept = np.unique(least, return_index=True)
        lost = np.ones(len(begin), bool)
        lost[kept] = False
        keep[doc[begin[lost]]] = False
    return keep


def toxic_signs(tokens: C.Tokens, toxic: np.ndarray) -> np.ndarray:
    """Hashes of words and word beginnings that mark toxic documents by standing in them, once or repeatedly."""
    keep = unlike(tokens, len(toxic))
    use = keep[tokens.doc]
    rate = min(max(float(toxic[keep].mean()), 1e-3), 0.999)
    sets: list[tuple[np.uint64, np.ndarray, int]] = []  # sign, documents, toxic ones among them
    for kind in C.KINDS[:-2]:
        here = use & (tokens.hashes[kind] != 0)
        pairs, docs = tokens.hashes[kind][here], tokens.doc[here].astype(np.int32)
        order = np.argsort(pairs, kind="stable")  # documents are in order already
        pairs, docs = pairs[order], docs[order]
        del order
        new = np.r_[True, (pairs[1:] != pairs[:-1]) | (docs[1:] != docs[:-1])][:len(pairs)]
        often = np.diff(np.r_[np.flatnonzero(new), len(pairs)])
        pairs, docs = pairs[new], docs[new]
        for times, purity in ((1, 0.95), (2, 0.8)):
            names, at, n = np.unique(pairs[often >= times], return_index=True, return_counts=True)
            if not len(names):
                continue
            held = docs[often >= times]
            n_toxic = np.add.reduceat(toxic[held].astype(np.int64), at)
            clean = n - n_toxic
            # log-likelihood ratio against chance; by chance alone, fewer than 0.01 names get above the bar
            gain = n_toxic * np.log(np.maximum(n_toxic, 1) / (n * rate)) + clean * np.log(
                np.maximum(clean, 1) / (n * (1 - rate)))
            bar = math.log(len(names) * len(C.KINDS) / 0.01)
            for i in np.flatnonzero((n_toxic >= purity * n) & (gain > bar)).tolist():
                sets.append((names[i], held[at[i]:at[i] + n[i]], int(n_toxic[i])))
    # the most telling sign first; the next must explain documents that are still unexplained
    unexplained, taken, open_ = toxic & keep, [], dict(enumerate(sets))
    least = max(3, math.ceil(math.log(100) / -math.log(rate)))
    while open_:
        news = {i: int(unexplained[d].sum()) for i, (_, d, _) in open_.items()}
        i = max(news, key=lambda j: (news[j], -len(open_[j][1]), j))
        if news[i] < least:
            break
        taken.append(sets[i][0])
        unexplained[open_.pop(i)[1]] = False
        open_ = {j: x for j, x in open_.items() if news[j] >= least or x[2] >= 4 * least}
    # other signs as frequent count too, though their documents are explained already
    taken += [name for name, d, n in open_.values() if n >= 4 * least]
    return np.unique(np.array(taken, np.uint64))


def token_labels(tokens: C.Tokens, toxic: np.ndarray) -> np.ndarray:
    """1 for words that carry a toxic sign in a toxic document, else 0."""
    gold = np.zeros(len(tokens))
    if not toxic.any() or toxic.all() or not len(tokens):
        return gold
    marks = toxic_signs(tokens, toxic)
    for kind in C.KINDS[:-2]:
        gold[np.isin(tokens.hashes[kind], marks) & toxic[tokens.doc]] = 1.0
    return gold


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps for a logistic curve with an intercept."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w = w + np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return w


def fit_block(offsets: np.ndarray, data: np.ndarray, toxic: np.ndarray, rate: float | None = None) -> Model:
    """Fit on the texts of a sample; every fourth document serves the logistic curve only.  ``rate`` of the documents
    are toxic where the sample was drawn (the sample's own rate if not given)."""
    n = len(toxic)
    true_rate = rate if rate is not None else float(toxic.mean()) if n else 0.0
    rate = min(max(true_rate, 1e-9), 0.49)  # without signs nothing is called toxic
    flat = Model(None, (math.log(rate / (1 - rate)), 0.0, 0.0))
    if not n or not toxic.any() or toxic.all():
        return flat
    tokens = C.tokenize_slices(offsets, data)
    gold = token_labels(tokens, toxic)
    if not gold.any():
        return flat
    marked = np.bincount(tokens.doc, gold, n) > 0
    clean = np.flatnonzero(~toxic)
    spare = np.arange(n) % 4 == 3
    # the CRF learns from all explained toxic documents and about twice as many clean ones
    chosen = np.zeros(n, bool)
    chosen[clean[: 2 * int(marked.sum()) + 50]] = True
    chosen = (chosen | marked) & ~spare
    own = chosen[tokens.doc]
    gold = gold[own]
    if not gold.any():
        return flat
    part = C.Tokens(tokens.starts[own], tokens.ends[own], tokens.doc[own], tokens.first[own],
                    {k: tokens.hashes.pop(k)[own] for k in list(tokens.hashes)})
    del tokens, own
    model = C.train(part, gold)
    found = []
    for lo, hi in C.ranges(offsets):  # some documents at a time, as in scoring
        tokens = C.tokenize(offsets[lo:hi + 1] - offsets[lo], data[offsets[lo]:offsets[hi]])
        found.append(signs(tokens, C.marginals(model, tokens), hi - lo))
    top, total = (np.concatenate(x) for x in zip(*found, strict=True))
    curve = logistic(np.column_stack([top, total])[spare], toxic[spare].astype(float))
    if 0 < toxic[spare].sum() < spare.sum():  # the curve saw this rate
        curve[0] += _logit(min(max(true_rate, 1e-9), 1 - 1e-9)) - _logit(float(toxic[spare].mean()))
    return Model(model, tuple(curve.tolist()))


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "toxic", sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS,
           sample_bytes: int = SAMPLE_BYTES) -> tuple[DataFrame, float]:
    """((id, text, bad) of the bounded sample in a fixed order, rate of toxic documents among the usable labels).

    Documents outside the held-out fold are taken by hash of the id; both bounds are halved between toxic and clean
    ones, and what one kind leaves the other may use."""
    known = (labels.select(F.col(id_col).alias("label_id"), F.col(label_col).alias("label"))
             .filter(F.col("label").isNotNull() & F.col("label_id").isNotNull() & (fold(F.col("label_id")) != 0))
             .groupBy("label_id").agg((F.max("label") > 0).alias("bad")))
    two = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.length("text") <= sample_chars)
    sizes = two.groupBy("id").agg(F.sum(F.octet_length("text").cast("long")).alias("size"))  # rows may repeat an id
    usable = cut_lineage(known.join(sizes, F.col("id") == F.col("label_id")).select("label_id", "bad", "size"))
    count = {r.bad: r["count"] for r in usable.groupBy("bad").count().collect()}
    n_bad, n_good = count.get(True, 0), count.get(False, 0)
    few = min(n_bad, max(sample_docs // 2, sample_docs - n_good))
    order = Window.partitionBy("bad").orderBy(F.xxhash64("label_id"), "label_id")
    kept = [usable.filter((F.col("bad") == F.lit(bad)) & (F.col("size") <= 4 * sample_chars))
            .orderBy(F.xxhash64("label_id"), "label_id").limit(size) for bad, size in ((True, few), (False, sample_docs - few))]
    # sample_docs rows at most: their sizes are added up in one task for each kind
    first = cut_lineage(kept[0].unionByName(kept[1]).withColumn("so_far", F.sum("size").over(
        order.rowsBetween(Window.unboundedPreceding, 0))))
    total = {r.bad: r.total for r in first.groupBy("bad").agg(F.max("so_far").alias("total")).collect()}
    half = sample_bytes // 2
    most = {bad: max(half, sample_bytes - total.get(not bad, 0)) for bad in (True, False)}
    first = first.filter(F.when(F.col("bad"), F.col("so_far") <= most[True]).otherwise(F.col("so_far") <= most[False]))
    rows = two.join(F.broadcast(first), F.col("id") == F.col("label_id")).select("id", "text", "bad")
    return rows.orderBy(F.xxhash64("id"), "id", "text").limit(sample_docs), n_bad / max(n_bad + n_good, 1)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS,
        sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on the bounded `sample` of labelled documents outside the held-out fold."""
    rows, rate = sample(docs, labels, id_col, text_col, label_col, sample_docs, sample_chars, sample_bytes)
    got = rows.select("text", "bad").toArrow().combine_chunks()
    if not got.num_rows:
        return fit_block(np.zeros(1, np.int64), np.zeros(0, np.uint8), np.zeros(0, bool))
    bad = got.column("bad").to_numpy().astype(bool)
    return fit_block(*buffers(as_bytes(got.column("text"))), bad, rate)


SPAN = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("probability", pa.float64())])


def _spans(tokens: C.Tokens, p: np.ndarray, data: np.ndarray, offsets: np.ndarray, n: int) -> pa.Array:
    """Runs of words with probability >= 0.5, as code point offsets within their documents."""
    hot = np.flatnonzero(p >= 0.5)
    if not len(hot):
        return pa.array([[]] * n, pa.list_(SPAN))
    joined = (np.diff(hot) == 1) & (tokens.doc[hot][1:] == tokens.doc[hot][:-1])
    lo = np.flatnonzero(np.r_[True, ~joined])
    hi = np.r_[lo[1:], len(hot)] - 1
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    doc = tokens.doc[hot[lo]]
    base = points[offsets[doc]]
    values = pa.StructArray.from_arrays(
        [pa.array((points[tokens.starts[hot[lo]]] - base).astype(np.int32)),
         pa.array((points[tokens.ends[hot[hi]]] - base).astype(np.int32)),
         pa.array(np.maximum.reduceat(p[hot], lo))], fields=list(SPAN))
    at = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), values)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, spans) of every whole text."""
    two = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = as_bytes(batch.column(1))
        for lo, hi in slices(texts):
            part = texts.slice(lo, hi - lo)
            offsets, data = buffers(part)
            found, tokens, p = model.score(offsets, data)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(found), _spans(tokens, p, data, offsets, hi - lo)],
                names=["id", "score", "spans"])

    return map_arrow(two, run, f"id {two.schema['id'].dataType.simpleString()}, score double, "
                     "spans array<struct<start:int,stop:int,probability:double>>").withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, all columns unchanged; no shuffle."""
    model = fit(docs, labels, id_col, text_col)
    at = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = as_bytes(batch.column(at))
        for lo, hi in slices(texts):
            found, _, _ = model.score(*buffers(texts.slice(lo, hi - lo)))
            yield batch.slice(lo, hi - lo).filter(pa.array(found < threshold))

    return map_arrow(docs.toDF(*(f"c{i}" for i in range(len(docs.columns)))), run,
                     type(docs.schema)([type(f)(f"c{i}", f.dataType, True) for i, f in enumerate(docs.schema)])
                     ).toDF(*docs.columns)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
