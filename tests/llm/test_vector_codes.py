import hashlib
import math

import numpy as np
import pytest
from conftest_llm import same_rows

from eventlens.llm import vector_codes as V

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """The query's rows by plain distances, of (vec_id, embedding, label)."""
    kept = sorted(((i, [math.floor(1024 * float(x)) for x in v], lab) for i, v, lab in rows
                   if v is not None and all(x is not None and math.isfinite(x) for x in v)),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    x = np.array([r[1] for r in kept], dtype=np.int64).reshape(len(kept), -1)
    step = x.shape[1] // 4
    books = [x[:256, i * step:(i + 1) * step].copy() for i in range(4)]
    for turn in range(5):
        near, error = [], 0
        for i, book in enumerate(books):
            part = x[:, i * step:(i + 1) * step]
            far = ((part[:, None] - book[None]) ** 2).sum(2)
            near.append(far.argmin(1))
            error = error + far.min(1)
            if turn < 4:
                for e in set(near[-1].tolist()):
                    own = part[near[-1] == e]
                    book[e] = own.sum(0) // len(own)
    sha = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    by_label = {}
    for r, e in zip(kept, error.tolist(), strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return [(r[0], "".join(f"{near[i][k]:02x}" for i in range(4)), int(error[k]), by_label[r[2]], sha)
            for k, r in enumerate(kept)]


@pytest.mark.parametrize("cells", [7, 64, 1 << 18])
def test_trie_walk_is_plain_nearest_entry(cells):
    rng = np.random.default_rng(cells)
    for _ in range(20):
        x = rng.integers(-3, 3, (rng.integers(1, 500), rng.integers(1, 6)))
        x = x[np.lexsort(x.T[::-1])]
        book = rng.integers(-3, 3, (rng.integers(1, 40), x.shape[1]))
        near, far = V.walk(x, book, cells)
        all_far = ((x[:, None] - book[None]) ** 2).sum(2)
        assert (near == all_far.argmin(1)).all() and (far == all_far.min(1)).all()


def test_keys_order_like_components():
    x = np.array([[-5, 3], [0, -1], [7, 0], [7, 1], [1 << 30, -(1 << 30)]])
    keys = V.keys_of(x, 2)
    assert [bytes(k) for k in keys] == sorted(bytes(k) for k in keys)
    assert (V.parts_of(keys) == x).all()


def _query(spark, tables, rows, schema=VECTORS):
    df = spark.createDataFrame(rows, schema)
    for c in ("n", "key", "code", "id"):
        df = df.withColumn(c, df.label)
    return V.op12_vector_codes(spark, tables(embeddings=df))


def test_messy_rows(spark, tables):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(v) for v in rng.integers(-9, 9, 8) / 7], int(i) % 3) for i in rng.permutation(400)]
    rows += [(900 + i, [0.5] * 8, None) for i in range(200)]  # a third of all rows are one vector
    rows += [(None, [0.25] * 8, None), (3, [0.125] * 8, 1), (3, [0.125] * 8, 1)]
    rows += [(-1, None, 0), (-2, [1.0] * 7 + [None], 0), (-3, [math.nan] * 8, 0), (-4, [math.inf] + [0.0] * 7, 1)]
    want = brute(rows)
    got = [tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256"))
           for r in _query(spark, tables, rows).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_few_rows_and_odd_lengths(spark, tables):
    rows = [(1, [1.0, 2.0, 3.0, 4.0], 1), (2, [1.0, 2.0, 3.0, 4.5], 1), (3, [9.0], 1), (4, [], 2)]
    got = {r.vec_id: (r.code, r.error) for r in _query(spark, tables, rows).collect()}
    assert got == {1: ("00000000", 0), 2: ("00000001", 0)}  # other lengths are dropped
    assert [r.code for r in _query(spark, tables, [(4, [], 2), (5, [], 2)]).collect()] == ["00000000"] * 2
    six = [(i, [float(i)] * 6, 0) for i in range(3)]
    assert len(_query(spark, tables, six).collect()) == 3


def test_large_components_are_held(spark, tables):
    rows = [(1, [3e38, 0.0, 0.0, 0.0], 1), (2, [-3e38, 0.0, 0.0, 0.0], 1), (3, [1e300, 0.0, 0.0, 0.0], 1)]
    got = _query(spark, tables, rows, "vec_id long, embedding array<double>, label int").collect()
    assert len(got) == 3 and all(r.error >= 0 for r in got)


def test_empty_tables(spark, tables):
    for rows in ([], [(1, None, 1)]):
        got = _query(spark, tables, rows)
        assert got.collect() == [] and "codebooks_sha256" in got.columns


def test_like_sql(spark, duck):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    rel = con.sql(V.ORACLE)
    same_rows(V.op12_vector_codes(spark, sf), rel.columns, rel.fetchall())
