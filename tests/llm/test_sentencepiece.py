import public_tokenizers
import pytest
import sentencepiece
from conftest_llm import DOCS, MESSY
from hypothesis import given, settings
from hypothesis import strategies as st

from eventlens.llm import bpe_lattice as B
from eventlens.llm import sentencepiece_codec as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PIECES = S.pieces(S.default_model())
PART = st.sampled_from(["a", "b", "  ", " ", "the", "ing", "é", "北", "\n", "\U0001f600", "x0", "-----", "====", "1234", "ß"])


def by_chunks(text, size):
    if not text:
        return []
    s, p = B.SPACE + text.replace(" ", B.SPACE), PIECES
    at = B.cuts(len(s), size, p.longest)
    parts = []
    for a, b in zip(at, at[1:]):
        o = max(0, a - p.longest)
        parts.append((s[o:b + p.longest], a - o, b - o, a == 0, b == len(s)))
    states = B.chain([p.transfer(*x) for x in parts], 0, 0)
    return [i for x, e, f in zip(parts, states, states[1:]) for i in p.path(*x, e, f).tolist()]


@settings(max_examples=60, deadline=None)
@given(st.lists(PART, max_size=50).map("".join), st.integers(17, 40))
def test_chunks_give_the_library_s_ids(text, size):
    want = LIBRARY.encode(text)
    assert by_chunks(text, size) == want
    assert (PIECES.encode_spaced(" " + text).tolist() if text else []) == want


def test_text_without_any_space():
    text = "abcdefghij" * 60
    assert by_chunks(text, 50) == LIBRARY.encode(text)


def test_products_of_matrices_are_associative():
    import numpy as np
    rng = np.random.default_rng(0)
    a, b, c = (np.where(rng.random((3, 3)) < 0.4, -np.inf, rng.integers(-9, 0, (3, 3))) for _ in range(3))
    assert (B.product(B.product(a, b), c) == B.product(a, B.product(b, c))).all()


@pytest.mark.parametrize("chunk", [30, S.CHUNK])
def test_frames_round_trip(spark, chunk, monkeypatch):
    monkeypatch.setattr(S, "GROUP", 4)
    rows = [*MESSY, (16, "▁ mark", "en", "a", 6), (17, "x" * 500, "en", "a", 500)]
    df = spark.createDataFrame(rows, DOCS)
    out = S.encode(df, chunk=chunk)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "token_ids"]
    text = lambda t: (t or "").replace("▁", " ")
    got = sorted((str(r.doc_id), r.token_ids) for r in out.collect())
    assert got == sorted((str(r[0]), LIBRARY.encode(text(r[1]))) for r in rows)
    back = sorted((str(r.doc_id), r.text) for r in S.decode(out).collect())
    assert back == sorted((str(r[0]), text(r[1])) for r in rows)


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([("k", "some text", 5)], "uid string, text string, token_ids long")
    (r,) = S.encode(df).collect()
    assert r.asDict() == {"uid": "k", "token_ids": LIBRARY.encode("some text")}
    assert S.encode(df.limit(0)).count() == 0


def test_a_worker_remembers_few_segments():
    p = B.Pieces(S.default_model())
    for k in range(0, 120_000, 1000):
        words = [f"w{i}" for i in range(k, k + 1000)]
        assert p.encode_spaced(" " + " ".join(words)).tolist() == p.sp.encode(" ".join(words))
    assert len(p.new) + len(p.old) <= 60_000
    assert p.compatible.cache_info().maxsize <= 100_000 and p.solid.cache_info().maxsize <= 25_000
