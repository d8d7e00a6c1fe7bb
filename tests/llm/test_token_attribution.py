import numpy as np
import public_tokenizers
import pytest
from conftest_llm import DOCS, LONG, MESSY
from tokenizers import Tokenizer

from eventlens.llm import token_attribution as A


def test_allocation_equals_token_by_token():
    rng = np.random.default_rng(4)
    for _ in range(300):
        ends = np.cumsum(rng.integers(1, 6, rng.integers(0, 12)))
        total = int(ends[-1]) if len(ends) else 0
        bounds = np.array([0, *sorted(rng.integers(0, total + 1, rng.integers(0, 6)).tolist()), total])
        most, first, share, crossing = A.allocate(ends, bounds)
        n = len(bounds) - 1
        want = np.zeros((4, n))
        for a, b in zip([0, *ends[:-1]], ends):
            held = [max(0, min(b, bounds[i + 1]) - max(a, bounds[i])) for i in range(n)]
            owner = next(i for i in range(n) if held[i])
            want[0, int(np.argmax(held))] += 1
            want[1, owner] += 1
            want[2] += np.array(held) / (b - a)
            want[3, owner] += b > bounds[owner + 1]
        assert np.allclose([most, first, share, crossing], want)


def test_counts_equal_another_library_s_offsets(spark):
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("n_chars < 3000")
    plain = A.render_fields(docs, ["source", "lang", "text"], "doc_id")
    got = {}
    for r in A.attribute(plain).collect():
        got.setdefault(r.doc_id, {})[r.section] = r
    for r in plain.collect():
        e = other.encode(r.text, add_special_tokens=False)
        mine = got[r.doc_id]
        for c in ("tokens", "tokens_first", "tokens_share"):
            assert abs(sum(x[c] for x in mine.values()) - len(e.ids)) < 1e-6
        assert sum(x.n_chars for x in mine.values()) == len(r.text)
        if r.text.isascii():
            for s in r.sections:
                first = sum(s.start <= a < s.stop for a, _ in e.offsets)
                share = sum(max(0, min(b, s.stop) - max(a, s.start)) / (b - a) for a, b in e.offsets)
                assert mine[s.section].tokens_first == first and abs(mine[s.section].tokens_share - share) < 1e-6


def test_pieces_of_long_texts_give_the_same_tokens():
    enc, _ = A.encoding(*A.default_vocabulary())
    text = LONG + "\n\n  x" * 500 + "é北 ok" * 900
    parts = list(A.pieces(text, 1000))
    assert "".join(parts) == text and len(parts) > 10
    assert [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_messy_rows_and_empty_table(spark):
    df = spark.createDataFrame(MESSY, DOCS)
    rows = A.attribute(A.render_fields(df, ["source", "lang", "text"], "doc_id")).collect()
    assert len(rows) == 4 * len(MESSY)
    assert all(r.tokens == 0 for r in rows if r.doc_id == 4 and r.section == "text")
    schema = "doc_id long, text string, sections array<struct<section:string,start:int,stop:int>>, tokens string"
    df = spark.createDataFrame([(1, "abc def", [("a", 0, 3), ("b", 3, 99)], ""), (2, None, None, ""), (2, "x", [], "")], schema)
    got = sorted((r.doc_id, r.section, r.n_chars, r.tokens) for r in A.attribute(df).collect())
    assert got == [(1, "a", 3, 1), (1, "b", 4, 1), (1, "outside", 0, 0), (2, "outside", 0, 0), (2, "outside", 1, 1)]
    assert A.attribute(df.limit(0)).count() == 0



@pytest.mark.parametrize("char", [" ", "\n", "a", "1", "\u0301", "\u6f22"])
def test_a_million_of_one_character(char):
    enc, lengths = A.encoding(*A.default_vocabulary())
    for text in (char * 1_000_000, "x" + char * 1_000_000 + " y"):
        assert lengths[A.encode(text, enc)].sum() == len(text.encode())


def test_long_white_space_is_cut_where_pre_tokens_end():
    enc, _ = A.encoding(*A.default_vocabulary())
    n = A.PIECE
    for text in (" " * n, "a" + " " * n, " " * n + "a", "a" + "\n" * n + "b", "\t" * n + " b" + " \n" * n + "c d",
                 "a" + " " * (n - 1) + "b", "a" + "\u3000" * n + "\n" + "\x1c" + " " * n):
        assert A.encode(text, enc) == enc.encode_ordinary(text)


def test_null_and_overlapping_sections(spark):
    text = "alpha beta gamma"
    spans = [("n", None, 3), ("m", 2, None), ("back", 9, 4), ("one", 0, 8), ("two", 6, 12), ("out", 90, 99), None]
    df = spark.createDataFrame([(1, text, spans), (2, text, None)],
                               "doc_id long, text string, sections array<struct<section:string,start:int,stop:int>>")
    got = {(r.doc_id, r.section): r for r in A.attribute(df).collect()}
    assert {s: got[1, s].n_chars for s in ("n", "m", "back", "one", "two", "out", "outside")} == {
        "n": 0, "m": 0, "back": 0, "one": 8, "two": 4, "out": 0, "outside": 4}
    for column in ("tokens", "tokens_first", "tokens_share"):
        assert abs(sum(r[column] for (i, _), r in got.items() if i == 1) - got[2, "outside"].tokens) < 1e-9
