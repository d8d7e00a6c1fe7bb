import re

import numpy as np
import pytest
import xxhash
from conftest_llm import DOCS, MESSY

from eventlens.llm import simhash
from eventlens.llm.components import components


def slow_print(text, shingle=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    ones = [0] * 64
    for r in runs:
        h = xxhash.xxh64_intdigest(r.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(runs))


def slow_components(prints, ids, bits=3):
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, i in zip(group, ids):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return [least.get(g) for g in group]


def test_prints_and_components_on_messy_rows(spark):
    got = simhash.near_groups(spark.createDataFrame(MESSY, DOCS)).collect()
    prints = [slow_print(t[1]) for t in MESSY]
    want = sorted(zip([t[0] for t in MESSY], (f"{p:016x}" for p in prints),
                      slow_components(prints, [t[0] for t in MESSY])), key=str)
    assert sorted(map(tuple, got), key=str) == want


def test_blocks_of_hashes_cut_documents_anywhere():
    texts = [b"", b"x " * 70000, b"a b c", b"", b"q w e r t y " * 9000]
    assert [int(p) for p in simhash.fingerprint_block(texts)] == [slow_print(t.decode()) for t in texts]


@pytest.mark.parametrize("rows, refine", [(simhash.BUCKET_ROWS, 10), (8, 10), (8, 1), (2, 0)])
def test_links_of_clusters_lose_nothing(spark, monkeypatch, rows, refine):
    """A dense ball, chains, and loners; with tiny buckets a hot bucket is split by further bits, or its parts meet in
    pairs."""
    monkeypatch.setattr(simhash, "BUCKET_ROWS", rows)
    monkeypatch.setattr(simhash, "REFINE", refine)
    rng = np.random.default_rng(5)
    prints = {int(x) for x in rng.integers(0, 1 << 63, 60)}
    center = int(rng.integers(0, 1 << 63))
    for _ in range(120):
        prints.add(center ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 4), replace=False)))
    at = int(rng.integers(0, 1 << 63))
    for _ in range(30):
        at ^= sum(1 << int(b) for b in rng.choice(63, 3, replace=False))
        prints.add(at)
    prints = sorted(prints)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = simhash.links(df)
    n = edges.count()
    root = {r.node: r.root for r in components(edges).collect()}
    want = slow_components(prints, prints)
    assert [root.get(p, p) for p in prints] == want
    if rows > 1000:  # a spanning forest per bucket, not all pairs
        assert n <= len(prints) * len(simhash.masks(5, 3))
    assert all((a ^ b).bit_count() <= 3 for a, b in edges.collect())


def test_every_link_shares_a_bucket():
    masks = [m % (1 << 64) for m in simhash.masks(5, 3)]
    rng = np.random.default_rng(0)
    for _ in range(300):
        flips = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(flips & m == 0 for m in masks)


def test_every_link_of_a_large_bucket_shares_a_finer_one():
    rng = np.random.default_rng(1)
    for m in simhash.masks(5, 3):
        free = [i for i in range(64) if not m >> i & 1]
        for _ in range(50):
            flips = sum(1 << int(b) for b in rng.choice(free, 3, replace=False))
            finer = [f % (1 << 64) for f in simhash.finer(m, 3)]
            assert any(flips & f == 0 for f in finer) and all(f & m % (1 << 64) == m % (1 << 64) for f in finer)


def test_long_chain_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (5, 5)], "a long, b long")
    root = {r.node: r.root for r in components(edges).collect()}
    assert root == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}


def test_dropping_keeps_columns(spark):
    rows = [(5, "a b c d e", "f"), (2, "a b c d e", "g"), (7, "other words here", "h"), (9, None, "i"), (8, "", "j")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    out = simhash.drop_near_copies(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [2, 7, 8]


def test_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert simhash.near_groups(df).count() == 0 and simhash.drop_near_copies(df).count() == 0


def test_dropping_with_null_and_repeated_ids(spark):
    """Case changes the text, not the fingerprint."""
    rows = [(None, "a b c d e"), (None, "A b c d e"), (1, "other words stand here"), (None, "Other words stand here"),
            (2, "Other words Stand here"), (2, "something else entirely again"), (3, "Something else entirely again"),
            (4, "one more text of words"), (4, "One more text of words"), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, (r.text or "").lower()) for r in simhash.drop_near_copies(df).collect()]
    assert sorted(got, key=str) == sorted([(None, "a b c d e"), (1, rows[2][1]), (2, rows[5][1]), (4, rows[7][1]),
                                           (None, "")], key=str)
