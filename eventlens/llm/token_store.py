"""Operator 11: token ids of documents in ORC files, in the order of the document ids.

`write` deals the documents out by ranges of (id, text), encodes each whole text
and writes one row a document: its id, its ids (an integer column: run-length
encoded), their number, the range's number and the place within the range (ids
of the range before it).  Files have row indexes every ``ROWS_IN_GROUP`` rows and
Bloom filters on the document id, so `find` reads only the row groups that may
hold the ids asked for, by metadata.  Stripes of ``STRIPE_BYTES`` are read in
parallel: Spark's splits of a file take whole stripes.

`read` adds ``start``: the ids of all documents before one, from the sums of the
ranges (one row each) and the place, so no document is counted in one task.

Encoding.  The tokenizer's own pattern drops white space and matches nothing
across it, its normalizer neither composes across it, and its special tokens hold
none.  So a text's ids are those of its words ``[^\\x20\\x09-\\x0D]+`` in turn, and a
distinct word is looked up once in a batch.  Words of ASCII and Latin letters, digits
and signs are cut into pre-tokens by the file's pattern; the library's model encodes each
distinct one, and the task remembers some ``REMEMBERED`` of them.  Other words go
through the library's whole chain.  `separable` checks a tokenizer file; with
another one, every text is given to the library whole.

Defined cases: a null text is empty; an empty or wordless text has the end id
alone; null ids come first, rows that repeat an id are ordered by their texts'
hashes and stay rows of their own; an empty table gives an empty result; other
columns are ignored.  A row is encoded in the memory of one task.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlens.llm.common import as_bytes, buffers, cut_lineage, slices, tasks_by_bytes
from eventlens.llm.periodic_runs import word_codes, words
from eventlens.session import scratch_path

END_ID = 2
STRIPE_BYTES = 16 << 20
ROWS_IN_GROUP = 1000
#: Text bytes that a task encodes together.
TOGETHER = 4 << 20
#: Distinct pre-tokens whose ids a task remembers, about.
REMEMBERED = 300_000
#: Pre-tokens that are encoded as one text.
JOINED = 100
#: Words whose pre-tokens are told by these classes, and the pre-tokens of such words in lower case.
_PLAIN = r"^[!-~À-ÖØ-öø-ÿ]+$"
_PRE_TOKEN = r"('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ a-zß-öø-ÿ0-9]+)"

_loaded: dict[bytes, object] = {}


def default_tokenizer() -> str:
    import public_tokenizers
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def tokenizer(text: str):
    """The tokenizer of a JSON text, loaded once in a process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer
    key = hashlib.sha256(text.encode()).digest()
    if key not in _loaded:
        _loaded[key] = Tokenizer.from_str(text)
    return _loaded[key]


def separable(text: str) -> bool:
    """Whether a tokenizer encodes words of a text apart: white space is dropped, and nothing depends on it."""
    spec = json.loads(text)
    steps = spec["normalizer"] or {}
    names = [s["type"] for s in steps.get("normalizers", [steps] if steps else [])]
    splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    # fixed values of the format: what this kind of tokenizer's file holds
    return (names == ["NFC", "Replace", "Lowercase"] and len(splits) == 2
            and splits[0]["type"] == "Split" and splits[0]["invert"] and splits[0]["behavior"] == "Removed"
            and splits[0]["pattern"]["Regex"] == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
            and splits[1]["type"] == "ByteLevel" and not splits[1]["add_prefix_space"]
            and spec["post_processor"] is None and spec["truncation"] is None and spec["padding"] is None
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"])
                        for t in spec["added_tokens"]))


def _gather(begin: np.ndarray, size: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each stretch begins in the result, and the end; the stretches ``flat[begin:begin + size]`` in turn)."""
    total = np.append(0, np.cumsum(size))
    return total, flat[np.arange(total[-1]) + np.repeat(begin - total[:-1], size)]


class Encoder:
    """Whole texts to ids, with the ids of pre-tokens seen before."""

    def __init__(self, text: str, end_id: int, by_words: bool):
        self.end_id, self.by_words = end_id, by_words
        self.tokenizer = tokenizer(text)
        if by_words:
            spec = json.loads(text)
            spec.update(normalizer=None, added_tokens=[], pre_tokenizer={"type": "Sequence", "pretokenizers": [
                {"type": "WhitespaceSplit"}, spec["pre_tokenizer"]["pretokenizers"][1]]})
            self.pieces = tokenizer(json.dumps(spec))  # the same model, for texts that are normal and cut already
            vocabulary = self.pieces.get_vocab()
            self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # ids that end a pre-token
            self.last[[i for t, i in vocabulary.items() if t.endswith(spec["model"]["end_of_word_suffix"])]] = True
            self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.begin, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)

    @staticmethod
    def _ids(encode, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids)."""
        got = [e.ids for e in encode.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        return size, np.fromiter(chain.from_iterable(got), np.int32, int(size.sum()))

    def _learn(self, new: pa.Array) -> None:
        """Encode pre-tokens, many of them as one text: each ends with one id of its kind."""
        offsets, data = buffers(as_bytes(new))
        joined = np.insert(data, offsets[1:], 32).tobytes()
        cut = (offsets + np.arange(len(offsets)))[np.append(np.arange(0, len(new), JOINED), len(new))].tolist()
        _, ids = self._ids(self.pieces, [joined[a:b].decode() for a, b in zip(cut, cut[1:], strict=False)])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(new):
            raise ValueError("the tokenizer doesn't mark the ends of its pre-tokens")
        self.known = pa.concat_arrays([self.known, new])
        self.begin = np.append(self.begin, self.begin[-1] + ends)
        self.flat = np.append(self.flat, ids)

    def _words(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, size, ids) of distinct words: plain ones by their pre-tokens, others whole."""
        plain = pc.and_not(pc.match_substring_regex(names, _PLAIN), pc.match_substring(names, "<|"))
        held = pc.split_pattern(pc.utf8_rtrim(pc.replace_substring_regex(
            pc.utf8_lower(names.filter(plain)), _PRE_TOKEN, r"\1 "), " "), " ")
        found = held.flatten().dictionary_encode()
        if len(self.known) > REMEMBERED:
            self._forget()
        place = pc.index_in(found.dictionary, self.known)
        new = found.dictionary.filter(pc.is_null(place))
        if len(new):
            self._learn(new)
            place = pc.index_in(found.dictionary, self.known)
        place = place.to_numpy()[found.indices.to_numpy()]
        at, ids = _gather(self.begin[place], np.diff(self.begin)[place], self.flat)
        ends = at[np.cumsum(pc.list_value_length(held).to_numpy())] if len(held) else np.zeros(0, np.int64)
        odd, odd_ids = self._ids(self.tokenizer, names.filter(pc.invert(plain)).to_pylist())
        size, mask = np.empty(len(names), np.int64), plain.to_numpy(zero_copy_only=False)
        size[mask], size[~mask] = np.diff(ends, prepend=0), odd
        begin = np.empty(len(names), np.int64)
        begin[mask], begin[~mask] = ends - size[mask], len(ids) + np.cumsum(odd) - odd
        return begin, size, np.append(ids, odd_ids)

    def __call__(self, texts: pa.Array) -> pa.Array:
        """The ids of each text (a large_binary column), the end id last."""
        n = len(texts)
        if self.by_words:
            offsets, data = buffers(texts)
            starts, ends, doc = words(offsets, data)
            coded = word_codes(data, starts, ends)
            begin, size, flat = self._words(coded.dictionary.cast(pa.large_string()))
            codes = coded.indices.to_numpy()
            begin, size = begin[codes], size[codes]
        else:
            size, flat = self._ids(self.tokenizer, texts.cast(pa.large_string()).to_pylist())
            begin, doc = np.cumsum(size) - size, np.arange(n)
        # the end id is one more word, after each text's others
        after = np.cumsum(np.bincount(doc, minlength=n))
        begin, size = np.insert(begin, after, len(flat)), np.insert(size, after, 1)
        at, ids = _gather(begin, size, np.append(flat, np.int32(self.end_id)))
        return pa.LargeListArray.from_arrays(pa.array(at[np.append(0, after + np.arange(1, n + 1))]), pa.array(ids))


def write(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer_json: str | None = None,
          end_id: int = END_ID) -> None:
    """Write the documents' ids to ORC files in ``folder``, in ascending order of the document ids."""
    text = tokenizer_json if tokenizer_json is not None else default_tokenizer()
    by_words = separable(text)
    two = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # of rows with one id and text any may come first; the number spreads a group of them
    keys = [F.asc_nulls_first("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    names = ["k1", "k2"]
    dealt = (two.select("doc_id", "text", keys[1].alias("k1"), keys[2].alias("k2"))
             .repartitionByRange(tasks_by_bytes(two, "text"), keys[0], *names)
             .sortWithinPartitions(keys[0], *names).select("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, encode = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            encode = encode or Encoder(text, end_id, by_words)
            texts = as_bytes(batch.column(1))
            for lo, hi in slices(texts, TOGETHER):
                ids = encode(texts.slice(lo, hi - lo))
                n = pc.list_value_length(ids).to_numpy().astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.full(hi - lo, part, np.int32)),
                     pa.array(place + np.cumsum(n) - n), pa.array(n), ids.cast(pa.list_(pa.int32()))],
                    names=["doc_id", "part", "place", "n_tokens", "ids"])
                place += int(n.sum())

    kind = two.schema["doc_id"].dataType.simpleString()
    (dealt.mapInArrow(run, f"doc_id {kind}, part int, place long, n_tokens long, ids array<int>")
     .write.option("orc.create.index", "true").option("orc.row.index.stride", ROWS_IN_GROUP)
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01)
     .option("orc.stripe.size", STRIPE_BYTES).orc(folder))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in ``folder``."""
    rows = spark.read.orc(folder)
    sums = rows.groupBy("part").agg(F.max(F.col("place") + F.col("n_tokens")).alias("held"))  # a row for each task
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(cut_lineage(sums)), "part").select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids")


def find(spark: SparkSession, folder: str, ids: list) -> DataFrame:
    """(doc_id, ids) of the documents asked for; row groups without them are passed over by index and Bloom filter."""
    return spark.read.orc(folder).filter(F.col("doc_id").isin(ids)).select("doc_id", "ids")


def with_crc32(rows: DataFrame) -> DataFrame:
    """``rows`` with the crc32 of their ids (little-endian, 32 bits each) in place of the ids."""
    rest = [c for c in rows.columns if c != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(len(rest))
            at, values = ids.offsets.to_numpy(), memoryview(ids.values.to_numpy().astype("<u4")).cast("B")
            sums = [zlib.crc32(values[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(rest)], pa.array(sums, pa.int64())],
                                             names=[*rest, "ids_crc32"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in rest)
    return rows.select(*rest, "ids").mapInArrow(run, f"{kinds}, ids_crc32 long")


def op11_token_store(spark, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder)
    return with_crc32(read(spark, folder))
