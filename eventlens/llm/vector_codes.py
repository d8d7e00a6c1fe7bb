"""Operator 12: product codes of vectors, their codebooks fitted through a trie of distinct parts.

Vectors become integers (floor of ``SCALE`` times a component) and are cut into
``parts`` equal consecutive parts.  The distinct parts of each position are
counted and dealt out in lexicographic order, so a task holds a range of them
with their common beginnings.  A task walks the trie of its parts depth first, a
stretch of leaves at a time: the distances of a node to all entries of the
codebook are its parent's plus those of its own component, computed once however
many parts lie below it (the path to a stretch's first leaf is kept from the
stretch before).  The leaves take the nearest entry and add up their parts'
components times their counts.  A round's sums, one row for each entry, are all
that the driver sees: ``parts * entries`` rows.

At last every vector's own parts are looked up in the same way, in the tries of
its batch of rows, and errors are added up by label.

Defined cases: rows whose vector is null, holds null or non-finite components or
has another length than that of the smallest kept id are dropped; a length that
``parts`` doesn't divide is cut at floor(i * length / parts); empty vectors get
code 0 in every part; components too large for 64-bit sums of squares are held at
`bound` (131,072 and more with 64 components), sums by label at the largest
long; a codebook begins with the ``entries`` smallest ids, null last, rows of one
id by their components (all rows, if there are fewer); null ids and labels are
kept; rows that repeat are coded each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlens.llm.common import cut_lineage, lookup, map_arrow
from eventlens.session import ensure_checkpoint_dir

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Distances (leaf x entry) that a task holds at once.
CELLS = 1 << 18


def bound(length: int) -> int:
    """Components' largest absolute value for which error sums of a vector fit 63 bits."""
    return min(math.isqrt(((1 << 63) - 1) // (4 * max(length, 1))), (1 << 31) - 1)


def cuts(length: int, parts: int) -> list[tuple[int, int]]:
    return [(i * length // parts, (i + 1) * length // parts) for i in range(parts)]


def integers(vectors: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows kept, their integer components) of a list column."""
    sizes = pc.list_value_length(vectors).fill_null(-1).to_numpy()
    rows = np.flatnonzero(sizes == length)
    flat = vectors.take(pa.array(rows)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: NaN
    x = flat.reshape(len(rows), length)
    good = np.isfinite(x).all(axis=1)
    top = bound(length)
    return rows[good], np.clip(np.floor(np.clip(x[good], -2.0 * top, 2.0 * top) * SCALE), -top, top).astype(np.int64)


def keys_of(x: np.ndarray, position: int) -> np.ndarray:
    """Parts as byte strings whose order is that of (position, components)."""
    wide = (x + (1 << 31)).astype(">u4")
    out = np.empty((len(x), 4 * x.shape[1] + 1), np.uint8)
    out[:, 0] = position
    out[:, 1:] = wide.view(np.uint8).reshape(len(x), 4 * x.shape[1])
    return out


def parts_of(keys: np.ndarray) -> np.ndarray:
    """Components of the parts that `keys_of` made byte strings."""
    n = (keys.shape[1] - 1) // 4
    return np.frombuffer(keys[:, 1:].tobytes(), ">u4").reshape(len(keys), n).astype(np.int64) - (1 << 31)


def walk(x: np.ndarray, book: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, its squared distance) of parts in lexicographic order, by their trie; ties to the lower entry."""
    n, depth = x.shape
    entries = len(book)
    nearest, distance = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n or not depth:
        return nearest, distance
    span = int(max(x.max(), book.max())) - int(min(x.min(), book.min()))
    kind = np.int32 if depth * span * span < 1 << 31 else np.int64
    x, book = x.astype(kind), np.ascontiguousarray(book.T.astype(kind))  # component x entry
    differ = np.zeros((n, depth), bool)  # at or before this component from the part before
    differ[0] = True
    differ[1:] = np.logical_or.accumulate(x[1:] != x[:-1], axis=1)
    path = np.zeros((depth, entries), kind)  # distance vectors on the way to the last leaf
    step = max(1, cells // max(entries, 1))
    for lo in range(0, n, step):
        hi = min(lo + step, n)
        above, node = np.zeros((1, entries), kind), np.zeros(hi - lo, np.int64)
        for d in range(depth):
            new = differ[lo:hi, d].copy()
            kept = not new[0]  # the first leaf's node was entered in the stretch before
            new[0] = True
            at = np.flatnonzero(new)
            own = x[lo + at, d, None] - book[d]
            own *= own
            own += above[node[at]]
            if kept:
                own[0] = path[d]
            above, node = own, np.cumsum(new) - 1
            path[d] = own[-1]
        best = above.argmin(axis=1)
        nearest[lo:hi] = best[node]
        distance[lo:hi] = above[np.arange(len(above)), best][node]
    return nearest, distance


@dataclass
class Codebooks:
    """For each position the entries, lowest index first, as integer components."""
    books: list[np.ndarray]
    length: int

    def sha256(self) -> str:
        """Of all components in decimal, by part, entry and position within the part, joined by commas."""
        return hashlib.sha256(",".join(str(v) for b in self.books for v in b.ravel().tolist()).encode()).hexdigest()

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code of every part, summed squared distance) of vectors, by the tries of their distinct parts."""
        codes, error = np.zeros((len(x), len(self.books)), np.int64), np.zeros(len(x), np.int64)
        for i, (lo, hi) in enumerate(cuts(self.length, len(self.books))):
            part = x[:, lo:hi]
            order, new, which = _sorted(part)
            near, far = walk(part[order][new], self.books[i])
            codes[order, i] = near[which]
            error[order] += far[which]
        return codes, error


def _sorted(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, mark of each first of equals, number among the distinct) of parts in lexicographic order."""
    order = np.lexsort(part.T[::-1]) if part.shape[1] else np.arange(len(part))
    s = part[order]
    new = np.ones(len(part), bool)
    new[1:] = (s[1:] != s[:-1]).any(axis=1)
    return order, new, np.cumsum(new) - 1


def _columns(table: DataFrame, id_col: str, vector_col: str, *more: str) -> DataFrame:
    return table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), *more)


def _start(rows: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """Codebooks of the smallest kept ids."""
    finite = F.col("vector").isNotNull() & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf))
    good = rows.filter(finite).select("id", "vector", F.size("vector").alias("length"))
    first = good.orderBy(F.asc_nulls_last("id"), "vector").limit(1).select("length").first()
    if first is None:
        return None
    order = [F.asc_nulls_last("id"), F.transform("vector", lambda v: F.floor(v.cast("double") * SCALE))]
    got = good.filter(F.col("length") == first.length).orderBy(*order).limit(entries).select("vector").toArrow()
    _, x = integers(got.column(0).combine_chunks(), first.length)
    return Codebooks([x[:, lo:hi] for lo, hi in cuts(first.length, parts)], first.length)


def distinct_parts(rows: DataFrame, length: int, parts: int) -> DataFrame:
    """(key, n): every distinct part of every position with its count, dealt out and sorted by key."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        _, x = integers(batch.column(0), length)
        for i, (lo, hi) in enumerate(cuts(length, parts)):
            part = x[:, lo:hi]
            order, new, which = _sorted(part)  # equal parts of a batch are one row
            raw = keys_of(part[order][new], i)
            at = np.arange(len(raw) + 1, dtype=np.int32) * raw.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.BinaryArray.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(at), pa.py_buffer(raw)]),
                 pa.array(np.bincount(which, minlength=len(raw)).astype(np.int64))], names=["key", "n"])

    found = map_arrow(rows.select("vector"), run, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))
    ensure_checkpoint_dir(rows.sparkSession)
    return cut_lineage(found.repartitionByRange("key").sortWithinPartitions("key"))


def improve(distinct: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every entry becomes the floor of the mean of the parts that are nearest to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            keys, n = batch.column(0), batch.column(1).to_numpy()
            sizes = pc.binary_length(keys).to_numpy()
            positions = pc.binary_slice(keys, 0, 1).to_pylist()
            marks = np.frombuffer(b"".join(positions), np.uint8)
            for i in np.unique(marks).tolist():
                rows = np.flatnonzero(marks == i)
                raw = np.frombuffer(b"".join(keys.take(pa.array(rows)).to_pylist()), np.uint8)
                x = parts_of(raw.reshape(len(rows), int(sizes[rows[0]])))
                near, _ = walk(x, books.books[i])
                wide = object if int(n[rows].sum()) * int(np.abs(x).max(initial=1)) >= 1 << 62 else np.int64
                total, count = held.setdefault(i, (np.zeros(books.books[i].shape, object), np.zeros(len(books.books[i]), object)))
                order = np.argsort(near, kind="stable")
                at = np.flatnonzero(np.append(True, np.diff(near[order]) != 0))
                weights = n[rows].astype(wide)
                entry = near[order][at]
                total[entry] += np.add.reduceat(x[order].astype(wide) * weights[order, None], at, axis=0)
                count[entry] += np.add.reduceat(weights[order], at)
        out = [(i, int(e), int(c[e]), [str(v) for v in t[e]]) for i, (t, c) in held.items() for e in np.flatnonzero(c)]
        if out:
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.list_(pa.string()))], names=["part", "entry", "n", "sums"])

    sums = distinct.mapInArrow(run, "part int, entry int, n long, sums array<string>")
    # a row for each entry's component (-1: the count), as long as the codebooks are
    total = (sums.select("part", "entry", F.posexplode(F.concat(F.array(F.col("n").cast("string")), "sums")))
             .groupBy("part", "entry", "pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("total")))
    got = {(r.part, r.entry, r.pos): int(r.total) for r in total.collect()}
    new = [b.copy() for b in books.books]
    for (i, e, pos), value in got.items():
        if pos:
            new[i][e, pos - 1] = value // got[i, e, 0]
    return Codebooks(new, books.length)


def fit(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS,
        entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks after ``rounds`` rounds over all vectors (None: no vector to start from)."""
    rows = _columns(table, id_col, vector_col)
    books = _start(rows, parts, entries)
    if books is None:
        return None
    distinct = distinct_parts(rows, books.length, parts)
    for _ in range(rounds):
        books = improve(distinct, books)
    return books


def compress(table: DataFrame, books: Codebooks, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label") -> DataFrame:
    """Per kept vector: id, label, codes (array of entries, by part) and error; no shuffle."""
    rows = _columns(table, id_col, vector_col, F.col(label_col).alias("label"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept, x = integers(batch.column(1), books.length)
        codes, error = books.encode(x)
        at = np.arange(len(kept) + 1, dtype=np.int32) * len(books.books)
        take = pa.array(kept)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), batch.column(2).take(take),
             pa.ListArray.from_arrays(pa.array(at), pa.array(codes.ravel().astype(np.int32))), pa.array(error)],
            names=["id", "label", "codes", "error"])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", "label")]
    return map_arrow(rows, run, f"id {kinds[0]}, label {kinds[1]}, codes array<int>, error long")


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with the errors added up by label; a label may hold any share of the rows."""
    coded = cut_lineage(coded)
    top = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    sums = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(20,0)")), top).cast("long").alias("label_error"))
    sums = cut_lineage(sums)
    return lookup(coded, sums, "label", sums.count())


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    books = fit(table)
    if books is None:  # no row is kept
        books = Codebooks([np.zeros((1, 0), np.int64)] * PARTS, 0)
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return with_label_error(compress(table, books)).select(
        F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"))


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB SQL of the query: plain distances to every entry, a round after the other."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {scale})) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT r, i AS part, v[i * len(v) // {parts} + 1 : (i + 1) * len(v) // {parts}] AS w
  FROM kept, (SELECT unnest(range({parts})) AS i)),
c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, w FROM p WHERE r <= {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
  SELECT p.r, p.part, any_value(p.w) AS w,
         min((list_inner_product(p.w, p.w) - 2 * list_inner_product(p.w, c.w) + list_inner_product(c.w, c.w))
             * {entries} + c.entry) AS best
  FROM p JOIN c{k} AS c ON p.part = c.part GROUP BY p.r, p.part)""")
        if k < rounds:
            steps.append(f"""
m{k} AS MATERIALIZED (
  SELECT part, entry, list(mean ORDER BY d) AS w FROM (
    SELECT part, entry, d, floor(sum(x) / count(*)) AS mean FROM (
      SELECT part, CAST(best % {entries} AS BIGINT) AS entry, unnest(w) AS x, unnest(range(len(w))) AS d FROM a{k})
    GROUP BY part, entry, d) GROUP BY part, entry),
c{k + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.w, c.w) AS w FROM c{k} AS c LEFT JOIN m{k} AS m USING (part, entry))""")
    return "WITH " + ",".join(steps) + f""",
h AS (SELECT sha256(string_agg(array_to_string(list_transform(w, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','), ','
                               ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds}),
e AS (SELECT r, string_agg(printf('%02x', CAST(best % {entries} AS BIGINT)), '' ORDER BY part) AS code,
             CAST(sum(floor(best / {entries})) AS BIGINT) AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN e USING (r), h
"""


ORACLE = _oracle()
