"""Operator 8: SimHash near-deduplication with pivot distance tables.

Fingerprint: A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, shingles are
``shingle`` consecutive words joined by a space, repeats included (fewer words:
the whole sequence; no word: fingerprint 0).  A bit is 1 if it is set in over
half of the shingles' XXH64 (UTF-8, seed 42).

Search: fingerprints link at ``max_bits`` or fewer differing bits.  Equal ones
are merged first.  The 64 bits are cut into ``blocks`` blocks; linked
fingerprints agree in at least ``blocks - max_bits`` of them, so each choice of
that many blocks is a table of buckets, and no link is missed.  A bucket of more
than ``REFINE`` times ``BUCKET_ROWS`` rows is split in the same way by the bits that
its rows needn't share: cut into twice ``max_bits`` blocks, linked rows agree in half
of them.  What is still larger than ``BUCKET_ROWS`` is dealt out to tasks as pairs of
its parts.  Inside a
bucket, rows are sorted by their distance to the first pivot; pairs are
discarded when any of the ``PIVOTS`` precomputed distances differ by more than
``max_bits`` (triangle inequality), and the survivors' bits are compared.  A
bucket emits a spanning forest of its links, never all its pairs.

Defined cases: an empty table gives an empty result; null, empty and blank texts
share fingerprint 0 and are linked like any other; a null id counts as a row,
but is never a component's id unless all its ids are null; rows that repeat an
id keep one row each.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import as_bytes, cut_lineage, map_arrow, slices
from eventlens.llm.components import components

SHINGLE = 3
MAX_BITS = 3
BLOCKS = 5
PIVOTS = 16
#: A larger bucket is split into parts of about half as many rows.
BUCKET_ROWS = 1024
#: A bucket so many times larger is split by further bits first: pairs of its parts would be more copies of a row.
REFINE = 10
_PIVOTS = np.array([xxhash.xxh64_intdigest(str(i), 42) for i in range(PIVOTS)], np.uint64)


def shingle_hashes(text: bytes, shingle: int) -> list[int]:
    words = text.lower().split()
    if not words:
        return []
    joined, n = b" ".join(words), len(words)
    ends = list(itertools.accumulate(map(len, words), lambda a, b: a + 1 + b))
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        return [digest(joined, 42)]
    starts = [0, *(e + 1 for e in ends[: n - shingle])]
    return [digest(joined[s:e], 42) for s, e in zip(starts, ends[shingle - 1:], strict=True)]


def fingerprint_block(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints (uint64) of some texts."""
    per_doc = [shingle_hashes(t, shingle) for t in texts]
    counts = np.array([len(h) for h in per_doc], np.int64)
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    hashes = np.fromiter(itertools.chain.from_iterable(per_doc), np.uint64, int(counts.sum()))
    ends = np.cumsum(counts[full])
    starts = ends - counts[full]
    ones = np.zeros((len(full), 64), np.int64)
    step = 1 << 16  # hashes whose 64 bits are unpacked at once
    for at in range(0, len(hashes), step):
        bits = np.unpackbits(hashes[at:at + step].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        lo = int(np.searchsorted(ends, at, "right"))
        hi = int(np.searchsorted(starts, at + len(bits), "left"))
        ones[lo:hi] += np.add.reduceat(bits, np.maximum(starts[lo:hi] - at, 0), axis=0, dtype=np.int32)
    packed = np.packbits(2 * ones > counts[full][:, None], axis=1, bitorder="little")
    out[full] = packed.view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint of every text, as the signed 64-bit number of the same bits."""
    two = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = as_bytes(batch.column(1))
        found = [fingerprint_block(texts.slice(lo, hi - lo).to_pylist(), shingle) for lo, hi in slices(texts)]
        fps = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["id", "fp"])

    return map_arrow(two, run, f"id {two.schema['id'].dataType.simpleString()}, fp long")


def masks(blocks: int, max_bits: int) -> list[int]:
    """For each choice of ``blocks - max_bits`` blocks, the mask of their bits (signed)."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in itertools.pairwise(cuts)]
    chosen = [sum(c) for c in itertools.combinations(block, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def finer(mask: int, max_bits: int) -> list[int]:
    """``mask`` with each choice of half of the blocks that its other bits are cut into (signed)."""
    free = [i for i in range(64) if not mask >> i & 1]
    n = 2 * max_bits
    block = [sum(1 << b for b in free[len(free) * i // n:len(free) * (i + 1) // n]) for i in range(n)]
    chosen = [(mask | sum(c)) % (1 << 64) for c in itertools.combinations(block, n - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def bucket_links(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Spanning forests of the links within each run of equal keys."""
    near = np.bitwise_count(fps[:, None] ^ _PIVOTS[None, :]).astype(np.int8)
    order = np.lexsort((near[:, 0], keys))
    keys, fps, near = keys[order], fps[order], near[order]
    n = len(keys)
    first = np.r_[True, keys[1:] != keys[:-1]] if n else np.zeros(0, bool)
    run = np.cumsum(first) - 1
    parent = np.arange(n)
    left = np.bincount(run, minlength=1) - 1  # unions that a run still lacks

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    here, gap = np.arange(n), 0
    while len(here):
        gap += 1
        here = here[here + gap < n]
        there = here + gap
        # rows are sorted by the first pivot, so a row whose partner is too far is done
        on = (run[there] == run[here]) & (near[there, 0] - near[here, 0] <= max_bits) & (left[run[here]] > 0)
        here = here[on]
        there = here + gap
        for lo in range(0, len(here), 1 << 16):
            i, j = here[lo:lo + (1 << 16)], there[lo:lo + (1 << 16)]
            ok = np.abs(near[i] - near[j]).max(axis=1) <= max_bits
            i, j = i[ok], j[ok]
            ok = np.bitwise_count(fps[i] ^ fps[j]) <= max_bits
            made = []
            for x, y in zip(i[ok].tolist(), j[ok].tolist(), strict=True):
                a, b = root(x), root(y)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    left[run[x]] -= 1
                    made.append((x, y))
            if made:
                pairs = np.array(made)
                yield fps[pairs[:, 0]], fps[pairs[:, 1]]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints ``fp`` like all links within ``max_bits`` bits."""
    tables = masks(blocks, max_bits)

    def buckets(rows: DataFrame, choices: Column) -> DataFrame:
        """(fp, t, k, n) in the buckets of the tables (t, mask) of ``choices`` that hold several rows."""
        rows = rows.select("fp", F.explode(choices).alias("b")).select(
            "fp", "b.t", F.col("fp").bitwiseAND(F.col("b.m")).alias("k"))
        return rows.join(rows.groupBy("t", "k").agg(F.count("*").alias("n")).filter("n > 1"), ["t", "k"])

    def several(numbered) -> Column:
        return F.array(*(F.struct(F.lit(t).alias("t"), F.lit(m).cast("long").alias("m")) for t, m in numbered))

    rows = buckets(distinct, several(enumerate(tables)))
    if max_bits:
        rows = cut_lineage(rows)
        each = [finer(m, max_bits) for m in tables]
        within = F.element_at(F.array(*(several(enumerate(f, len(tables) + i * len(f))) for i, f in enumerate(each))),
                              F.col("t") + 1)
        large = F.col("n") > REFINE * BUCKET_ROWS
        rows = rows.filter(~large).unionByName(buckets(rows.filter(large), within))
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    rows = (rows
            .withColumn("parts", F.when(F.col("n") > BUCKET_ROWS, F.ceil(F.col("n") * 2 / BUCKET_ROWS)).otherwise(1))
            .withColumn("p", part)
            .withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
            .select("fp", F.xxhash64("t", "k", F.least("p", "o"), F.greatest("p", "o")).alias("key")))
    rows = rows.repartition("key").sortWithinPartitions("key")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.uint64))  # the bucket that may go on

        def found(keys, fps):
            for a, b in bucket_links(keys, fps, max_bits):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                                 names=["a", "b"])

        for batch in batches:
            keys = np.concatenate([held[0], batch.column(1).to_numpy(zero_copy_only=False)])
            fps = np.concatenate([held[1], batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)])
            if len(keys):
                cut = int(np.searchsorted(keys, keys[-1], "left"))
                held = (keys[cut:], fps[cut:])
                yield from found(keys[:cut], fps[:cut])
        yield from found(*held)

    return rows.mapInArrow(search, "a long, b long")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id."""
    fps = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    distinct = cut_lineage(fps.groupBy("fp").agg(F.min("id").alias("least")))
    roots = cut_lineage(components(links(distinct, max_bits, blocks)))
    linked = distinct.join(roots, distinct.fp == roots.node)
    of_root = linked.groupBy("root").agg(F.min("least").alias("of_root"))
    of_fp = cut_lineage(distinct.join(linked.join(of_root, "root").select("fp", "of_root"), "fp", "left").select(
        F.col("fp").alias("fp_"), F.coalesce("of_root", "least").alias("component_id")))  # so that Spark can split
    # the next join's hot fingerprints
    return fps.join(of_fp, F.col("fp") == F.col("fp_")).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                     max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, all columns unchanged.

    An id that repeats with other texts, or a null id (which comes after the
    others), stays with the text of the smallest digest; rows that repeat both id
    and text all stay (exact deduplication is another operator's task).
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    id_name, text_name = (names[docs.columns.index(c)] for c in (id_col, text_col))
    plain = docs.toDF(*names).withColumn("digest", F.unhex(F.md5(F.col(text_name).cast("binary"))))
    own = F.struct(F.col(id_name).isNull().alias("no_id"), F.col(id_name).alias("id"), F.col("digest"))
    groups = near_groups(plain.select(own.alias("own"), text_name), "own", text_name, shingle, max_bits, blocks)
    kept = groups.select(F.col("component_id.id").alias("kept_id"), F.col("component_id.digest").alias("kept_digest")
                         ).distinct()
    same = F.col(id_name).eqNullSafe(F.col("kept_id")) & F.col("digest").eqNullSafe(F.col("kept_digest"))
    return plain.join(kept, same, "left_semi").drop("digest").toDF(*docs.columns)


def op8_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
