import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest
from conftest_llm import DOCS, MESSY

from eventlens.llm import periodic_runs as R
from eventlens.llm.recompression import once, recompress

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    """(start, length, period) of all runs, period by period."""
    best = {}
    for p in range(1, len(w) // 4 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(6, 4 * p):
                best.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((a, b - a, p) for (a, b), p in best.items())


def collapsed(w, runs):
    drop = {i for a, n, p in runs for i in range(a + p, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in drop)


def planted(doc_id, text):
    w = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 or not n or doc_id is None:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_like_brute_force(seed):
    random.seed(seed)
    for _ in range(40):
        texts = []
        for _ in range(random.randint(1, 8)):
            w = [random.choice("abcdefghij"[:random.choice([1, 2, 3, 10])]) for _ in range(random.choice([0, 1, 5, 6, 20, 90]))]
            if random.random() < 0.5 and w:
                p, a = random.randint(1, 8), random.randrange(len(w))
                w = w[:a] + (w[a:a + p] * 20)[:random.randint(1, 100)] + w[a:]
            texts.append(w)
        n, runs, short = R.block(pa.array([" \t".join(w).encode() for w in texts], pa.large_binary()))
        for w, size, found, text in zip(texts, n.to_pylist(), runs.to_pylist(), short.to_pylist(), strict=True):
            assert size == len(w)
            assert [(r["start"], r["length"], r["period"]) for r in found] == brute(w)
            assert text == collapsed(w, brute(w))


def test_extensions_on_the_grammar():
    import numpy as np
    rng = np.random.default_rng(2)
    for _ in range(30):
        s = np.r_[100, rng.integers(0, rng.integers(1, 4), 200), 101]
        s[50:90] = s[10:50]
        g = recompress(s, once(s))
        a = rng.integers(1, 200, 300)
        b = np.minimum(a + rng.integers(1, 100, 300), 200)
        a, b = a[a < b], b[a < b]
        ahead, back = g.extend(a, b), g.extend(a, b, back=True)
        for i, j, x, y in zip(a.tolist(), b.tolist(), ahead.tolist(), back.tolist(), strict=True):
            k = 0
            while j + k < len(s) and s[i + k] == s[j + k]:
                k += 1
            m = 0
            while i - m - 1 >= 0 and s[i - m - 1] == s[j - m - 1]:
                m += 1
            assert (x, y) == (k, m)


def test_long_texts():
    random.seed(1)
    one = ["x"] * 200_000
    mixed = [random.choice("ab") for _ in range(50_000)]
    mixed[1000:31_000] = (mixed[:700] * 50)[:30_000]
    for w in (one, mixed):
        _, runs, _ = R.block(pa.array([" ".join(w).encode()], pa.large_binary()))
        found = [tuple(r.values()) for r in runs.to_pylist()[0]]
        if w is one:
            assert found == [(0, 200_000, 1)]
        else:
            assert max(found, key=lambda r: r[1])[2] == 700
            for start, length, p in found:
                x = w[start:start + length]
                assert x[p:] == x[:-p] and length >= max(6, 4 * p)


def check(rows, docs):
    want = []
    for i, text in docs:
        w = planted(i, text)
        runs = brute(w)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        want.append((i, len(runs), top[0], top[1], top[2], 1000 * top[1] // top[2] if runs else None,
                     hashlib.sha256("".join(f"{a},{n},{p}\n" for a, n, p in runs).encode()).hexdigest(),
                     hashlib.sha256(collapsed(w, runs).encode()).hexdigest()))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted((tuple(r[c] for c in names) for r in rows), key=repr) == sorted(want, key=repr)


def test_query_on_messy_rows(spark, tables):
    rows = MESSY + [(i, "a b c " * (i % 9) + "d " * (i % 11), "en", "a", 1) for i in range(100, 400)]
    docs = spark.createDataFrame(rows, DOCS)
    for c in ("runs", "best", "length", "id"):
        docs = docs.withColumn(c, docs.lang)
    check(R.op13_periodic_runs(spark, tables(documents=docs)).collect(), [r[:2] for r in rows])


def test_query_on_a_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = R.op13_periodic_runs(spark, sf).collect()
    assert sum(r.n_runs > 0 for r in rows) > 5
    check(rows, docs)


def test_empty_table(spark, tables):
    assert R.op13_periodic_runs(spark, tables(documents=spark.createDataFrame([], DOCS))).collect() == []
