"""Operator 13: periodic runs of words, by recompression.

A run is a longest stretch of consecutive words with smallest period q, repeated
at least ``TIMES`` times and of at least ``least`` words.  The words of a block of
documents become one sequence with a symbol of its own between documents;
`recompression` turns it into a run-length grammar.  A run of period p holds a
whole window of (TIMES - 1) * p places i whose word equals the one p further on,
and so a multiple of that number: these places (a harmonic series of them over
all periods) are the candidates.  Where both words agree, the grammar's common
extensions to both sides give the exact stretch; of one stretch the smallest
period is kept.  No suffix array is built, and nothing is shuffled.

`collapse` drops what repeats: all words of a run after its first q.

Defined cases: null, empty and wordless texts have no runs and an empty
collapsed text; a text of any length is taken whole, in memory of some hundred
bytes a word; rows that repeat get a result each; ties are kept (every run is
listed); an empty table gives an empty result; columns beside id and text are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import as_bytes, buffers, map_arrow, slices
from eventlens.llm.recompression import Grammar, once, recompress

#: A run repeats its period so often at least.
TIMES = 4
LEAST_WORDS = 6
#: Candidate places that are looked at together.
CANDIDATES = 1 << 20


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte after the last, document) of every word ``[^\\x20\\x09-\\x0D]+``."""
    space = _space(data)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(~space & (np.append(True, space)[:-1] | edge[:-1]))
    ends = np.flatnonzero(~space & (np.append(space, True)[1:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.DictionaryArray:
    """The words, as numbers of distinct words."""
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    packed = data[~_space(data)]
    array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(packed)])
    return array.dictionary_encode()


def _places(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, place, period) of all candidates, some at a time."""
    periods = np.where(sizes >= LEAST_WORDS, sizes // TIMES, 0)
    doc = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = (TIMES - 1) * period
    count = (sizes[doc] - 1 - period) // step + 1
    total = np.append(0, np.cumsum(count))
    lo = 0
    while lo < len(doc):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + CANDIDATES, "right")) - 1)
        n = count[lo:hi]
        number = np.arange(total[hi] - total[lo]) - np.repeat(total[lo:hi] - total[lo], n)
        yield np.repeat(doc[lo:hi], n), np.repeat(step[lo:hi], n) * number, np.repeat(period[lo:hi], n)
        lo = hi


def find(codes: np.ndarray, sizes: np.ndarray, least: int = LEAST_WORDS) -> tuple[np.ndarray, ...]:
    """(document, start, length, period) of all runs, by document, start and period.

    ``codes``: the words of all documents in turn; ``sizes``: words of each document."""
    n = len(sizes)
    base = np.cumsum(sizes) - sizes + np.arange(n) + 1
    doc = np.repeat(np.arange(n), sizes)
    seq = np.arange(len(codes)) + doc + 1
    # a word matches only in its own document, and what stands between documents nowhere
    symbols = np.empty(len(codes) + n + 1, np.int64)
    symbols[:] = -1
    symbols[seq] = doc * (int(codes.max(initial=0)) + 1) + codes
    single = np.ones(len(symbols), bool)
    single[seq] = once(symbols[seq])
    grammar: Grammar = recompress(symbols, single)
    plain, found = grammar.symbols[0], []
    for d, place, p in _places(sizes):
        i = base[d] + place
        ok = np.flatnonzero(plain[i] == plain[i + p])
        d, i, p = d[ok], i[ok], p[ok]
        stop = i + p + grammar.extend(i, i + p)
        start = i - grammar.extend(i, i + p, back=True)
        ok = stop - start >= np.maximum(least, TIMES * p)
        d, start, stop, p = d[ok], start[ok] - base[d[ok]], stop[ok] - base[d[ok]], p[ok]
        found.append(_smallest(d, start, stop, p))
    d, start, stop, p = _smallest(*(np.concatenate(c) for c in zip(*found, strict=True))) if found else [np.zeros(0, np.int64)] * 4
    order = np.lexsort((p, start, d))
    return d[order], start[order], (stop - start)[order], p[order]


def _smallest(d: np.ndarray, start: np.ndarray, stop: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of equal stretches the one with the smallest period."""
    order = np.lexsort((p, stop, start, d))
    d, start, stop, p = d[order], start[order], stop[order], p[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    return d[new], start[new], stop[new], p[new]


def _collapsed(offsets, data, starts, ends, doc, first, runs) -> pa.Array:
    """Every document's words outside the repeated parts of runs, joined by single spaces."""
    d, start, length, period = runs
    depth = np.zeros(len(starts) + 1, np.int64)
    np.add.at(depth, first[d] + start + period, 1)
    np.add.at(depth, first[d] + start + length, -1)
    kept = np.flatnonzero(np.cumsum(depth)[:-1] == 0)
    space = _space(data)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts[kept]] = 1
    inside[ends[kept]] -= 1  # words don't touch, but for the ends of documents
    take = np.cumsum(inside, dtype=np.int8)[:-1].astype(bool)
    take[ends[kept[:-1]][doc[kept[1:]] == doc[kept[:-1]]]] = True  # the space after a word that another one follows
    at = np.append(0, np.cumsum(take))[offsets].astype(np.int32)
    text = np.where(space, np.uint8(32), data)[take]
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(at), pa.py_buffer(text))


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def block(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(number of words, runs, collapsed text) of every text."""
    offsets, data = buffers(texts)
    starts, ends, doc = words(offsets, data)
    n = len(texts)
    sizes = np.bincount(doc, minlength=n).astype(np.int64)
    first = np.cumsum(sizes) - sizes
    runs = find(word_codes(data, starts, ends).indices.to_numpy().astype(np.int64), sizes)
    at = np.searchsorted(runs[0], np.arange(n + 1)).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(c) for c in runs[1:]], fields=list(RUN))
    return (pa.array(sizes), pa.ListArray.from_arrays(pa.array(at), values),
            _collapsed(offsets, data, starts, ends, doc, first, runs))


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, runs (by start, then period; in words) and the collapsed text."""
    two = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = as_bytes(batch.column(1))
        for lo, hi in slices(texts):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *block(texts.slice(lo, hi - lo))],
                                             names=["id", "n_words", "runs", "collapsed"])

    return map_arrow(two, run, f"id {two.schema['id'].dataType.simpleString()}, n_words long, "
                     "runs array<struct<start:long,length:long,period:long>>, collapsed string"
                     ).withColumnRenamed("id", id_col)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one of ten documents (by crc32 of the id, none without one) is periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    # the words are a column of their own: inside the lambda below they would be split anew for every word
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n, a, p = F.size("words").cast("long"), F.col("a"), F.col("p")
    cut = cut.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn(
        "p", F.when(n > 0, F.floor((n - a) / (F.col("g") % 8 + 3)) + 1))
    planted = F.array_join(F.transform("words", lambda x, i: F.when(i < a, x).otherwise(
        F.get("words", (a + (i - a) % p).cast("int")))), " ")
    return cut.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = collapse(with_planted_runs(docs.select("doc_id", "text")))
    best = F.element_at(F.sort_array(F.transform("runs", lambda r: F.struct(
        -r["length"], r["start"], r["period"]))), 1)
    top = found.withColumn("best", F.when(F.size("runs") > 0, best)).withColumn("length", -F.col("best.col1"))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), "length",
        F.col("best.period").alias("period"),
        F.floor(F.col("length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
