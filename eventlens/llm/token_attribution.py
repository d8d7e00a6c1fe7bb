"""Operator 1: token counts by section, from one encoding of the whole document.

A document is encoded once (byte-level BPE: tokens are byte strings that join to
the text, so the running sum of their lengths maps every token to its bytes).
Token spans and section spans are then joined as intervals, and each token is
allocated by an explicit rule:

* ``tokens``: the section with most of the token's bytes, the earlier one of
  equals;
* ``tokens_first``: the section that holds the token's first byte;
* ``tokens_share``: to each section the part of the token's bytes it holds.

Each rule gives every token away exactly once: over a document's rows,
including ``outside`` (what no section covers), every column sums up to the
document's tokens.  ``crossing`` counts tokens that begin in a section and end
beyond it.

Sections are spans of code points in the row's ``sections`` array.
`render_fields` makes a document of fields and the spans of their values.

Defined cases: null and empty texts and sections have 0 tokens; a null element of
``sections`` is passed over; a section with a null bound, or that stops before it
starts, is empty; where sections overlap, the one that starts first (then: stops
first) has the characters; an empty table gives an empty result; rows that repeat
are counted each; columns beside those named are ignored.  Texts that the
tokenizer's pattern can't take in one go are cut where every pre-token ends:
before single spaces between other characters, and around long runs of white
space, which are one pre-token but for a last character before other text.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import map_arrow

#: The tokenizer takes at most about so many characters at once.
PIECE = 50_000
_SAFE = re.compile(r"(?<=\S) (?=\S)")
#: White space as the patterns mean it, more of it than they take at once.
_LONG_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % PIECE)
#: How a pattern ends that makes a run of white space one pre-token, its last character aside before other text.
_RUNS = r"\s+(?!\S)|\s+"
_loaded: dict[bytes, tuple[tiktoken.Encoding, np.ndarray]] = {}


def default_vocabulary() -> tuple[bytes, str]:
    """(ranks file, pattern of pre-tokens)."""
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def encoding(vocabulary: bytes, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The tokenizer and its tokens' lengths in bytes, loaded once in a process."""
    key = hashlib.sha256(vocabulary + pattern.encode()).digest()
    if key not in _loaded:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            lengths[i] = len(token)
        _loaded[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths
    return _loaded[key]


def pieces(text: str, limit: int = PIECE) -> Iterator[str]:
    """The text in parts of about ``limit`` characters, cut where a pre-token begins."""
    lo = 0
    while len(text) - lo > limit:
        cut = _SAFE.search(text, lo + limit)
        if not cut:
            break
        yield text[lo:cut.start()]
        lo = cut.start()
    yield text[lo:]


def encode(text: str, enc: tiktoken.Encoding, runs: bool = True) -> list[int]:
    """The ids of a text of any length; ``runs``: the pattern ends like `_RUNS`."""
    ids, lo = [], 0
    for found in _LONG_SPACE.finditer(text) if runs else ():
        stop = found.end() if found.end() == len(text) else found.end() - 1
        ids += [i for p in pieces(text[lo:found.start()]) for i in enc.encode_ordinary(p)]
        ids += enc._encode_single_piece(text[found.start():stop].encode())
        lo = stop
    return ids + [i for p in pieces(text[lo:]) for i in enc.encode_ordinary(p)]


def allocate(ends: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens by majority, by first byte and by share, and crossing tokens, of the parts of a text.

    ``ends``: where tokens end; ``bounds``: 0, where the parts end (not falling), the last being the text's end.
    """
    starts = np.r_[0, ends[:-1]][: len(ends)]
    first = np.diff(np.searchsorted(starts, bounds, "left"))
    # tokens before a bound, with the crossing token's part
    full = np.searchsorted(ends, bounds, "right")
    at = np.minimum(full, max(len(ends) - 1, 0))
    part = (bounds - starts[at]) / np.maximum(ends - starts, 1)[at] if len(ends) else np.zeros(len(bounds))
    share = np.diff(full + np.where(full < len(ends), part, 0.0))
    owner = np.searchsorted(bounds, starts, "right") - 1
    over = np.flatnonzero(ends > bounds[np.minimum(owner + 1, len(bounds) - 1)])
    crossing = np.bincount(owner[over], minlength=len(bounds) - 1)
    most = first.copy()
    for t in over.tolist():
        held = np.minimum(bounds[1:], ends[t]) - np.maximum(bounds[:-1], starts[t])
        most[owner[t]] -= 1
        most[int(np.argmax(held))] += 1
    return most, first, share, crossing


def _count(text: str, spans: list[tuple[str, int | None, int | None]], enc, lengths, runs: bool = True) -> tuple[list, list[np.ndarray]]:
    """(names of the parts, their columns: n_chars and the four of `allocate`); the last part is outside."""
    ids = encode(text, enc, runs)
    ends = np.cumsum(lengths[np.array(ids, np.int64)])
    raw = np.frombuffer(text.encode(), np.uint8)
    byte_of = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    n = len(text)
    spans = [(s, 0, 0) if a is None or b is None else (s, a, max(a, b)) for s, a, b in spans]
    order = sorted(range(len(spans)), key=lambda i: spans[i][1:])
    cuts, part_of, last = [0], [], 0  # parts of the text: gaps (None) and sections
    for i in order:
        _, a, b = spans[i]
        a = min(max(a, last), n)
        b = min(max(b, a), n)
        if a > last:
            cuts.append(a)
            part_of.append(None)
        cuts.append(b)
        part_of.append(i)
        last = b
    if last < n or not part_of:
        cuts.append(n)
        part_of.append(None)
    cuts = np.array(cuts)
    columns = [np.diff(cuts), *allocate(ends, byte_of[cuts])]
    to = np.array([len(spans) if i is None else i for i in part_of])
    return [s[0] for s in spans] + ["outside"], [np.bincount(to, c, len(spans) + 1) for c in columns]


def attribute(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sections_col: str = "sections",
              vocabulary: bytes | None = None, pattern: str | None = None) -> DataFrame:
    """Per document and section: id, section, n_chars, tokens, tokens_first, tokens_share, crossing."""
    if vocabulary is None:
        vocabulary, pattern = default_vocabulary()
    three = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        F.expr(f"transform(filter(coalesce(`{sections_col}`, array()), s -> s is not null), s -> struct("
                               "s.section as section, int(s.start) as start, int(s.stop) as stop))").alias("spans"))
    kind = three.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        enc, lengths = encoding(vocabulary, pattern)
        names, columns, row = [], [[] for _ in range(5)], []
        for i, (text, spans) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
            own, found = _count(text, [(s["section"], s["start"], s["stop"]) for s in spans], enc, lengths,
                                pattern.endswith(_RUNS))
            names += own
            row += [i] * len(own)
            for c, f in zip(columns, found, strict=True):
                c.append(f)
        got = [np.concatenate([np.zeros(0), *c]) for c in columns]
        whole = [pa.array(np.rint(g).astype(np.int64)) for g in (got[0], got[1], got[2], got[4])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(row, pa.int32())), pa.array(names, pa.string()), *whole[:3],
             pa.array(got[3]), whole[3]],
            names=["id", "section", "n_chars", "tokens", "tokens_first", "tokens_share", "crossing"])

    return map_arrow(three, run, f"id {kind}, section string, n_chars long, tokens long, tokens_first long, "
                     "tokens_share double, crossing long").withColumnRenamed("id", id_col)


def render_fields(rows: DataFrame, fields: list[str], id_col: str) -> DataFrame:
    """(id, text, sections): ``name: value`` lines of the fields, and the spans of their values (null: empty)."""
    text, spans = F.lit(""), []
    for i, name in enumerate(fields):
        label = ("\n" if i else "") + f"{name}: "
        text = F.concat(text, F.lit(label))
        value = F.coalesce(F.col(name).cast("string"), F.lit(""))
        start = F.char_length(text)
        spans.append(F.struct(F.lit(name).alias("section"), start.alias("start"),
                              (start + F.char_length(value)).alias("stop")))
        text = F.concat(text, value)
    return rows.select(F.col(id_col), text.alias("text"), F.array(*spans).alias("sections"))


def op1_token_attribution(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return attribute(render_fields(docs, ["source", "lang", "text"], "doc_id"))
