"""Operator 4: SentencePiece encoding and decoding by a max-plus parallel scan.

The model is a BPE model, so the lattice is the exact BPE one of `bpe_lattice`
(a plain sum of piece scores would give other ids than the tokenizer itself).
Documents longer than ``chunk`` characters are split into chunks, which are
dealt out to tasks; each yields its max-plus transfer matrix between boundary
states.  The matrices are combined associatively, first by groups of ``GROUP``
chunks and then by document; the states at all boundaries go back down the same
way, and every chunk is backtraced on its own.  A shorter document is one chunk
from text start to text end, whose path is the library's encoding itself.

Text spaces are the model's space mark, so U+2581 in a text decodes to a space;
any other text decodes to itself (characters without a piece become byte
tokens).

Defined cases: null and empty texts have no tokens and decode to the empty
text; an empty table gives an empty result; rows that repeat are encoded each;
columns beside id and text are kept by `encode`, except that ``token_ids`` and
the columns it adds replace columns of these names.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.llm import bpe_lattice as B
from eventlens.llm.common import BATCH_ROWS, as_bytes, buffers, cut_lineage, map_arrow

#: A longer text is giant.
CHUNK = 16_384
#: Chunks whose matrices one task multiplies in the first combining round.
GROUP = 256
_pieces: dict[bytes, B.Pieces] = {}


def default_model() -> bytes:
    import public_tokenizers
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def pieces(model: bytes) -> B.Pieces:
    """The model, loaded once in a process."""
    key = hashlib.sha256(model).digest()
    if key not in _pieces:
        _pieces[key] = B.Pieces(model)
    return _pieces[key]


def decode_block(p: B.Pieces, ids: pa.Array) -> pa.Array:
    """Texts (bytes) of lists of token ids."""
    at = np.asarray(ids.offsets, np.int64)
    flat = pa.array(p.bytes_of, pa.large_binary()).take(ids.flatten())  # tokens' bytes lie side by side
    offsets, data = buffers(flat)
    ends = offsets[at - at[0]]
    texts = [data[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return pa.array([t[1:] if t.startswith(b" ") else t for t in texts], pa.large_binary())


def _add_keys(docs: DataFrame, text_col: str) -> DataFrame:
    """Columns as c0, c1, ... and the text as ``text``."""
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return plain.withColumn("text", F.coalesce(F.col(f"c{docs.columns.index(text_col)}"), F.lit("")))


def encode_short(rows: DataFrame, model: bytes) -> DataFrame:
    """``rows`` with token_ids in place of ``text``, each encoded as a whole."""
    at = rows.columns.index("text")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        p, found, counts = pieces(model), [], [0]
        for raw in as_bytes(batch.column(at)).to_pylist():
            text = raw.decode("utf-8", "replace").replace(B.SPACE, " ")
            ids = p.encode_spaced(" " + text) if text else np.zeros(0, np.int32)
            found.append(ids)
            counts.append(len(ids))
        ids = pa.ListArray.from_arrays(pa.array(np.cumsum(counts).astype(np.int32)),
                                       pa.array(np.concatenate([np.zeros(0, np.int32), *found])))
        yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != at), ids],
                                         names=[*(n for n in batch.schema.names if n != "text"), "token_ids"])

    schema = rows.drop("text").schema.add("token_ids", T.ArrayType(T.IntegerType()))
    return map_arrow(rows, run, schema)


_CHUNK = pa.schema([("uid", pa.int64()), ("chunk", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32()),
                    ("last", pa.bool_()), ("s", pa.string())])


def chunks(rows: DataFrame, model: bytes, chunk: int) -> DataFrame:
    """(uid, chunk, lo, hi, last, s) and the other columns of ``rows`` (uid, text, ...): each chunk of the texts
    with context on both sides; the other columns stand on a document's first chunk."""
    others = [c for c in rows.columns if c not in ("uid", "text")]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest = pieces(model).longest
        for batch in batches:
            for i, (uid, raw) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
                s = B.SPACE + raw.as_py().replace(" ", B.SPACE)
                at = B.cuts(len(s), chunk, longest)
                for k, (a, b) in enumerate(zip(at, at[1:], strict=False)):
                    o = max(0, a - longest)
                    one = pa.RecordBatch.from_pydict({"uid": [uid], "chunk": [k], "lo": [a - o], "hi": [b - o],
                                                      "last": [b == len(s)], "s": [s[o:b + longest]]}, _CHUNK)
                    own = [c.slice(i, 1) if k == 0 else pa.nulls(1, c.type) for c in batch.columns[2:]]
                    yield pa.RecordBatch.from_arrays([*one.columns, *own], names=[*_CHUNK.names, *others])

    schema = T.StructType([T.StructField("uid", T.LongType()), T.StructField("chunk", T.IntegerType()),
                           T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType()),
                           T.StructField("last", T.BooleanType()), T.StructField("s", T.StringType()),
                           *(T.StructField(f.name, f.dataType) for f in rows.select(*others).schema)])
    return rows.select("uid", "text", *others).mapInArrow(split, schema)


_MATRIX = "uid long, chunk int, rows int, cells array<double>"


def _matrix(row) -> np.ndarray:
    return np.asarray(row.cells, float).reshape(row.rows, -1)


def transfers(parts: DataFrame, model: bytes) -> DataFrame:
    """(uid, chunk, rows, cells): the transfer matrix of every chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for uid, k, lo, hi, last, s in _rows(batches):
            m = p.transfer(s, lo, hi, k == 0, last)
            yield pa.RecordBatch.from_arrays(
                [pa.array([uid]), pa.array([k], pa.int32()), pa.array([m.shape[0]], pa.int32()),
                 pa.ListArray.from_arrays(pa.array([0, m.size], pa.int32()), pa.array(m.ravel()))],
                names=["uid", "chunk", "rows", "cells"])

    return parts.mapInArrow(run, _MATRIX)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of some batches, one by one."""
    for batch in batches:
        for row in zip(*batch.columns, strict=True):
            yield tuple(x.as_py() for x in row)


def _in_order(rows: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """``fn`` on the rows (in order of ``chunk``) of each key, several keys to a task."""
    names = rows.columns
    at = [names.index(k) for k in keys]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = (r for pdf in batches for r in pdf.itertuples(index=False, name="Row"))
        found = []
        for key, group in itertools.groupby(every, key=lambda r: tuple(r[i] for i in at)):
            found += fn(key, list(group))
            if len(found) >= BATCH_ROWS:
                yield frame(found)
                found = []
        yield frame(found)

    def frame(found: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(found, columns=[c.split()[0] for c in schema.split(", ")])

    return rows.repartition(*keys).sortWithinPartitions(*keys, "chunk").mapInPandas(run, schema)


def boundary_states(mats: DataFrame) -> DataFrame:
    """(uid, chunk, enter, leave): the states at both ends of every chunk on the document's best path."""
    def combine(key: tuple, rows: list) -> list[tuple]:
        whole = _matrix(rows[0])
        for r in rows[1:]:
            whole = B.product(whole, _matrix(r))
        return [(key[0], key[1], whole.shape[0], whole.ravel())]

    def down(key: tuple, rows: list) -> list[tuple]:
        at = B.chain([_matrix(r) for r in rows], rows[0].enter, rows[0].leave)
        return [(key[0], r.chunk, x, y) for r, x, y in zip(rows, at[:-1], at[1:], strict=True)]

    states = "uid long, chunk int, enter int, leave int"
    mats = mats.withColumn("g", F.floor(F.col("chunk") / GROUP).cast("int"))
    groups = _in_order(mats, ["uid", "g"], combine, _MATRIX)
    whole = groups.withColumn("enter", F.lit(0)).withColumn("leave", F.lit(0))  # text start and text end
    of_groups = _in_order(whole, ["uid"], down, states).withColumnRenamed("chunk", "g")
    return _in_order(mats.join(of_groups, ["uid", "g"]), ["uid", "g"], down, states)


def encode_giant(rows: DataFrame, model: bytes, chunk: int) -> DataFrame:
    """``rows`` (text and other columns) with token_ids in place of ``text``."""
    others = [c for c in rows.columns if c != "text"]
    # written once, which fixes the numbers of the documents; only the join below spreads the chunks over tasks
    all_parts = cut_lineage(chunks(rows.withColumn("uid", F.monotonically_increasing_id()), model, chunk))
    parts = all_parts.select(*_CHUNK.names)
    mats = cut_lineage(transfers(parts, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for uid, k, lo, hi, last, s, enter, leave in _rows(batches):
            ids = p.path(s, lo, hi, k == 0, last, enter, leave)
            yield pa.RecordBatch.from_arrays(
                [pa.array([uid]), pa.array([k], pa.int32()),
                 pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids))], names=["uid", "chunk", "ids"])

    ids = parts.join(boundary_states(mats), ["uid", "chunk"]).select(
        *parts.columns, "enter", "leave").mapInArrow(run, "uid long, chunk int, ids array<int>")
    whole = ids.groupBy("uid").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])).alias("token_ids"))
    return all_parts.filter("chunk = 0").select("uid", *others).join(whole, "uid").select(*others, "token_ids")


def encode(docs: DataFrame, text_col: str = "text", model: bytes | None = None, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with ``token_ids`` in place of the text column."""
    model = model or default_model()
    rows = _add_keys(docs, text_col)
    own = [c for c in rows.columns if c != "text" and c != f"c{docs.columns.index(text_col)}"]
    names = [docs.columns[int(c[1:])] for c in own]
    rows = rows.select(*own, "text")
    giant = encode_giant(rows.filter(F.length("text") > chunk).withColumn(
        "text", F.replace("text", F.lit(B.SPACE), F.lit(" "))), model, chunk)
    out = encode_short(rows.filter(F.length("text") <= chunk), model).unionByName(giant)
    clash = {"token_ids"} & set(names)
    return out.select(*(F.col(c).alias(n) for c, n in zip(own, names, strict=True) if n not in clash), "token_ids")


def decode(tokens: DataFrame, model: bytes | None = None) -> DataFrame:
    """``tokens`` with ``text`` in place of token_ids."""
    model = model or default_model()
    at = tokens.columns.index("token_ids")
    rest = [i for i, c in enumerate(tokens.columns) if i != at and c != "text"]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw = decode_block(pieces(model), batch.column(at))
        texts = pa.array([t.decode("utf-8", "replace") for t in raw.to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in rest), texts],
                                         names=[*(batch.schema.names[i] for i in rest), "text"])

    keep = [tokens.columns[i] for i in rest]
    schema = tokens.select(*keep).schema.add("text", "string")
    return map_arrow(tokens, run, schema)


def op4_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Per document: number of tokens, SHA-256 of the ids (32 bits each, little endian) and of the decoded text,
    and whether the text came back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = default_model()
    marked = docs.select("doc_id", "text", F.sha2(F.replace(
        F.coalesce("text", F.lit("")), F.lit(B.SPACE), F.lit(" ")), 256).alias("expected"))
    tokens = encode(marked, model=model)

    def digests(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = batch.column(2)
        texts = decode_block(pieces(model), lists).to_pylist()
        flat, at = np.asarray(lists.flatten()), np.asarray(lists.offsets) - np.asarray(lists.offsets)[0]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array(np.diff(at).astype(np.int64)),
            pa.array([hashlib.sha256(flat[a:b].astype("<i4").tobytes()).hexdigest()
                      for a, b in zip(at[:-1], at[1:], strict=True)], pa.string()),
            pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())],
            names=["doc_id", "expected", "n_tokens", "ids_sha256", "decoded_sha256"])

    found = map_arrow(tokens.select("doc_id", "expected", "token_ids"), digests,
                      "doc_id long, expected string, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256",
                        (F.col("decoded_sha256") == F.col("expected")).alias("round_trip"))
