"""Operator 5: document fingerprints by context-triggered piecewise hashing.

A hash over the last ``WINDOW`` bytes rolls over the text; where its k lowest
bits are zero, a piece ends, so block size 2^k gives pieces of about 2^k bytes
and an edit changes only the pieces around it.  Each piece gives one of 64
characters.  A document's k is the least (from ``LEAST``) that needs at most 64
characters; where that leaves fewer than 16 (repetitive texts), it is one less,
and the 64th piece takes all the rest of the text.  The fingerprint is ``k:signature at k:signature at k + 1`` and
depends on the text alone.  Fingerprints are compared at equal block sizes:
1 - edit distance / (sum of lengths), insertions and deletions costing 1 and
changes 2, the better of the sizes both have; without ``RUN`` characters in a
row in common (fewer for short signatures) the likeness is 0.

`with_next` pairs each document with the next by ascending id (null ids first,
equal ids by a hash of the text; after the last comes the first): texts are
range-partitioned and sorted once, each task keeps one row of lookahead, and the
partitions' edge rows are joined by partition number.

Defined cases: a null text counts as empty; empty texts have equal
fingerprints; a table of one row is its own next document; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventlens.llm.common import as_bytes, cut_lineage, slices, tasks_by_bytes

WINDOW = 7
LEAST = 2
LENGTH = 64
RUN = 4
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+-", np.uint8)
_ROLL = 0x9E3779B1
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


@dataclass
class Prints:
    """Fingerprints of some texts: block size exponents, and codes and lengths at k and at k + 1."""
    k: np.ndarray
    codes: tuple[np.ndarray, np.ndarray]
    lengths: tuple[np.ndarray, np.ndarray]

    def take(self, rows) -> Prints:
        return Prints(self.k[rows], tuple(c[rows] for c in self.codes), tuple(x[rows] for x in self.lengths))

    def strings(self) -> list[str]:
        letters = [ALPHABET[c] for c in self.codes]
        return [f"{k}:{a[:m].tobytes().decode()}:{b[:n].tobytes().decode()}" for k, a, m, b, n in zip(
            self.k.tolist(), letters[0], self.lengths[0].tolist(), letters[1], self.lengths[1].tolist(), strict=True)]


def _powers(base: int, n: int) -> np.ndarray:
    table = np.full(n, base, np.uint64)
    table[:1] = 1
    return np.cumprod(table, dtype=np.uint64)


def prints(texts: list[bytes]) -> Prints:
    """Fingerprints of a block of texts."""
    n, gap = len(texts), b"\0" * (WINDOW - 1)  # before every text, so that windows don't reach the one before
    data = np.frombuffer(gap.join([b"", *texts]) if n else b"", np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(size + len(gap)) - size
    rolled = np.zeros(len(data), np.uint32)
    for j in range(WINDOW):
        rolled[j:] += (data[: len(data) - j].astype(np.uint32) + np.uint32(1)) * np.uint32(pow(_ROLL, j, 1 << 32))
    rolled ^= rolled >> np.uint32(15)
    rolled *= np.uint32(0x2C1B3C6D)
    rolled ^= rolled >> np.uint32(12)
    np.add.at(marks := np.zeros(len(data) + 1, np.int32), begin, 1)
    np.add.at(marks, begin + size, -1)
    inside = np.cumsum(marks[:-1]) > 0
    at = np.flatnonzero((rolled & np.uint32((1 << LEAST) - 1) == 0) & inside)
    hit = rolled[at] | np.uint32(1 << 30)
    level = np.bitwise_count((hit & (~hit + np.uint32(1))) - np.uint32(1)).astype(np.int64)
    doc = np.searchsorted(begin, at, "right") - 1
    at_end = at == begin[doc] + size[doc] - 1
    by_level = np.bincount(doc * 32 + level, minlength=32 * n).reshape(n, 32)[:, ::-1].cumsum(axis=1)[:, ::-1]
    tail = np.ones((n, 32), np.int64)
    tail[doc[at_end]] = np.arange(32) > level[at_end][:, None]  # no rest where a piece ends with the text
    pieces = np.where(size[:, None] > 0, by_level + tail, 0)
    pieces[:, :LEAST] = LENGTH + 1
    k = np.argmax(pieces <= LENGTH, axis=1)
    few = pieces[np.arange(n), k] < LENGTH // 4
    k -= few & (k > LEAST)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=sums[1:], dtype=np.uint64)
    back = _powers(_INVERSE, len(data) + 1)
    codes, lengths = [], []
    for more in (0, 1):
        cut = level >= (k + more)[doc]
        rest = np.flatnonzero((size > 0) & (np.take_along_axis(tail, (k + more)[:, None], 1)[:, 0] > 0))
        ends = np.concatenate([at[cut] + 1, (begin + size)[rest]])
        owner = np.concatenate([doc[cut], rest])
        order = np.argsort(ends, kind="stable")
        ends, owner = ends[order], owner[order]
        count = np.bincount(owner, minlength=n)
        column = np.arange(len(owner)) - (np.cumsum(count) - count)[owner]
        ends = np.where((column == LENGTH - 1) & (count[owner] > LENGTH), (begin + size)[owner], ends)
        ends, owner, column = (x[column < LENGTH] for x in (ends, owner, column))
        first = column == 0
        starts = np.where(first, begin[owner], np.r_[0, ends[:-1]][: len(ends)])
        h = (sums[ends] - sums[starts]) * back[starts]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        sign = np.full((n, LENGTH), 255, np.uint8)
        sign[owner, column] = (h >> np.uint64(58)).astype(np.uint8)
        codes.append(sign)
        lengths.append(np.minimum(count, LENGTH))
    for c in codes:
        c[c == 255] = 0
    return Prints(k, tuple(codes), tuple(lengths))


def _ratio(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """1 - edit distance / (la + lb) of signature pairs, by bit-parallel longest common subsequences."""
    n = len(a)
    one = np.uint64(1)
    free = np.full(n, ~np.uint64(0))
    runs = [np.zeros(n, np.uint64) for _ in range(RUN)]
    longest = np.zeros(n, np.int64)
    valid = np.arange(LENGTH)[None, :] < la[:, None]
    for j in range(int(lb.max(initial=0))):
        same = (a == b[:, j, None]) & valid & (j < lb)[:, None]
        mask = np.packbits(same, axis=1, bitorder="little").view("<u8").ravel()
        hit = free & mask
        free = (free + hit) | (free - hit)
        for r in range(RUN - 1, 0, -1):
            runs[r] = (runs[r - 1] << one) & mask
        runs[0] = mask
        for r in range(RUN):
            longest = np.where(runs[r] != 0, np.maximum(longest, r + 1), longest)
    common = np.bitwise_count(~free).astype(np.int64)
    need = np.clip(np.minimum(la, lb) // 3, 1, RUN)
    return np.where((longest >= need) & (la + lb > 0), 2.0 * common / np.maximum(la + lb, 1), 0.0)


def likeness(x: Prints, y: Prints) -> np.ndarray:
    """Likeness (0 to 1) of fingerprints, row by row."""
    out = np.zeros(len(x.k))
    for i in (0, 1):
        for j in (0, 1):
            rows = np.flatnonzero(x.k + i == y.k + j)
            if len(rows):
                out[rows] = np.maximum(out[rows], _ratio(x.codes[i][rows], x.lengths[i][rows],
                                                         y.codes[j][rows], y.lengths[j][rows]))
    out[(x.lengths[0] == 0) & (y.lengths[0] == 0)] = 1.0
    return out


def edited(text: bytes, following: bytes) -> tuple[int, bytes]:
    """Code points of a text; the text with its last half replaced by as many of the next text's first."""
    t = text.decode("utf-8", "surrogateescape")
    half = len(t) // 2
    # a code point has four bytes at most
    new = following[: 4 * half].decode("utf-8", "surrogateescape")[:half]
    return len(t), (t[: len(t) - half] + new).encode("utf-8", "surrogateescape")


_RESULT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def compare(texts: list[bytes]) -> list[pa.Array]:
    """The result columns of all but the last text, each compared with the one after it."""
    own = prints(texts)
    changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    new = prints([t for _, t in changed])
    here, after = own.take(slice(None, -1)), own.take(slice(1, None))
    return [pa.array([n for n, _ in changed], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for _, t in changed], pa.string()),
            pa.array(here.strings(), pa.string()), pa.array(new.strings(), pa.string()),
            pa.array(likeness(here, new)), pa.array(likeness(here, after))]


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    two = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tie = F.xxhash64("text").alias("tie")
    dealt = (two.withColumn("tie", tie).repartitionByRange(tasks_by_bytes(two, "text"), "id", "tie").sortWithinPartitions("id", "tie")
             .select("id", "text", F.spark_partition_id().alias("part")))
    kind = two.schema["id"].dataType
    names = ["id", *(c.split()[0] for c in _RESULT.split(", ")), "part", "edge", "text"]

    def rows(ids: pa.Array, part, edge: int, columns: list[pa.Array] | None, texts: list | None = None):
        n = len(ids)
        empty = [pa.nulls(n, t) for t in (pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64())]
        return pa.RecordBatch.from_arrays(
            [ids, *(columns or empty), pa.array([part] * n, pa.int32()), pa.array([edge] * n, pa.int32()),
             pa.array(texts, pa.string()) if texts else pa.nulls(n, pa.string())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = part = None  # the row whose next one hasn't come yet
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for lo, hi in slices(texts):
                ids = batch.column(0).slice(lo, hi - lo)
                block = texts.slice(lo, hi - lo).to_pylist()
                if held is None:
                    part = batch.column(2)[0].as_py()
                    yield rows(ids.slice(0, 1), part, 1, None, block[:1])
                else:
                    ids, block = pa.concat_arrays([held[0], ids]), [held[1], *block]
                if len(block) > 1:
                    yield rows(ids.slice(0, len(block) - 1), part, 0, compare(block))
                held = (ids.slice(len(block) - 1), block[-1])
        if held is not None:
            yield rows(held[0], part, 2, None, [held[1]])

    schema = f"id {kind.simpleString()}, {_RESULT}, part int, edge int, text string"
    done = cut_lineage(dealt.mapInArrow(run, schema))
    parts = done.filter("edge = 1").select("part")  # one tiny row per partition
    order = Window.orderBy("part")
    nexts = parts.select("part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("next"))
    last = done.filter("edge = 2").select("id", "text", "part").join(nexts, "part")
    first = done.filter("edge = 1").select(F.col("part").alias("next"), F.col("text").alias("following"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = [x.slice(i, 1).to_pylist()[0] for x in (as_bytes(batch.column(1)), as_bytes(batch.column(2)))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), *compare(pair)], names=names[:-3])

    ends = last.join(first, "next").select("id", "text", "following").mapInArrow(
        close, f"id {kind.simpleString()}, {_RESULT}")
    return done.filter("edge = 0").drop("part", "edge", "text").unionByName(ends).withColumnRenamed("id", id_col)


def op5_piecewise_hash(spark, sf_dir: str) -> DataFrame:
    return with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
