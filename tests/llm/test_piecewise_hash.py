import hashlib

import numpy as np
from conftest_llm import DOCS, MESSY

from eventlens.llm import piecewise_hash as H


def slow_print(x):
    hashes = []
    for i in range(len(x)):
        v, f = 0, 1
        for j in range(H.WINDOW):
            v = (v + ((x[i - j] if i >= j else 0) + 1) * f) % 2**32
            f = f * H._ROLL % 2**32
        v ^= v >> 15
        v = v * 0x2C1B3C6D % 2**32
        hashes.append(v ^ v >> 12)

    def cut(k):
        out, lo = [], 0
        for i, v in enumerate(hashes):
            if v % (1 << k) == 0:
                out.append(x[lo:i + 1])
                lo = i + 1
        return out + [x[lo:]] * (lo < len(x))

    def sign(k):
        parts = cut(k)
        if len(parts) > 64:
            parts = [*parts[:63], x[sum(map(len, parts[:63])):]]
        out = ""
        for p in parts:
            h = sum((c + 1) * pow(H._BASE, i, 2**64) for i, c in enumerate(p)) % 2**64
            out += chr(H.ALPHABET[(h ^ h >> 31) * 0x7FB5D329728EA185 % 2**64 >> 58])
        return out

    k = H.LEAST
    while len(cut(k)) > 64:
        k += 1
    k -= len(cut(k)) < 16 and k > H.LEAST
    return f"{k}:{sign(k)}:{sign(k + 1)}"


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def random_texts():
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 123, rng.integers(2, 9)).astype(np.uint8)) for _ in range(300)]
    return [b" ".join(words[i] for i in rng.integers(0, 300, n)) for n in (0, 1, 5, 40, 300, 300, 900)]


def test_prints_equal_the_slow_version():
    texts = [*random_texts(), b"", b"a", "é".encode(), b"abc " * 400, b"", bytes(300)]
    assert H.prints(texts).strings() == [slow_print(t) for t in texts]
    assert H.prints([]).strings() == []


def test_ratio_is_the_edit_distance():
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 4, (200, 64)).astype(np.uint8) for _ in range(2))
    la, lb = (rng.integers(1, 65, 200) for _ in range(2))
    got = H._ratio(a, la, b, lb)
    for i in range(200):
        want = 2 * lcs(a[i, :la[i]].tolist(), b[i, :lb[i]].tolist()) / (la[i] + lb[i])
        assert got[i] == 0 or abs(got[i] - want) < 1e-12
    assert (got > 0).mean() > 0.9


def test_edits_stay_near_and_strangers_do_not():
    texts = random_texts()[4:]
    for t in texts:
        cut = len(t) // 2
        x, y = H.prints([t, t]), H.prints([t[:cut] + b"inserted words" + t[cut:], random_texts()[3] * 9])
        near, far = H.likeness(x, y)
        assert near > 0.8 and far < 0.2 and H.likeness(x, x).min() == 1


def test_next_documents_on_messy_rows(spark):
    df = spark.createDataFrame(MESSY, DOCS)
    got = sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint)
                 for r in H.with_next(df.repartition(5)).collect())
    from pyspark.sql import functions as F
    tie = {r.t: r.h for r in df.select(F.coalesce("text", F.lit("")).alias("t"),
                                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    rows = sorted(((r[0], r[1] or "") for r in MESSY), key=lambda r: (r[0] is not None, r[0] or 0, tie[r[1]]))
    want = []
    for (i, t), (_, n) in zip(rows, [*rows[1:], rows[0]]):
        half = len(t) // 2
        e = (t[:len(t) - half] + n[:half]).encode()
        want.append((str(i), len(t), hashlib.sha256(e).hexdigest(), *H.prints([t.encode(), e]).strings()))
    assert got == sorted(want)


def test_one_row_and_none(spark):
    df = spark.createDataFrame([(1, "ab", 5)], "doc_id long, text string, part int")
    (r,) = H.with_next(df).collect()
    assert r.edited_sha256 == hashlib.sha256(b"aa").hexdigest() and r.near_next == 1
    assert H.with_next(df.limit(0)).count() == 0
