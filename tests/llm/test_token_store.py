import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import DOCS, MESSY

from eventlens.llm import token_store as T
from eventlens.llm.common import as_bytes


@pytest.fixture(scope="module")
def tok():
    return T.tokenizer(T.default_tokenizer())


def whole(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids + [T.END_ID]


def expected(tok, docs):
    """Rows in the order of ids (null first); rows of one id and text are alike."""
    out, start = [], 0
    for i, text in docs:
        ids = whole(tok, text)
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_words_and_whole_texts_have_the_same_ids(tok):
    rng = np.random.default_rng(5)
    letters = list("aZé1 'stdrvel.,<|>\n\t ́İΣ漢ß\x1c \u0085À")
    texts = ["".join(rng.choice(letters, rng.choice([0, 1, 5, 40]))) for _ in range(2000)]
    texts += ["<|endoftext|>a", "a <|startoftext|>b", "x" * 100_000, "x" * 100_000, " " * 100_000, "don't 'LL"]
    got = T.Encoder(T.default_tokenizer(), T.END_ID, True)(as_bytes(pa.array(texts)))
    assert got.to_pylist() == [whole(tok, t) for t in texts]


def test_forgotten_words_are_encoded_again(tok, monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 3)
    encode = T.Encoder(T.default_tokenizer(), T.END_ID, True)
    for texts in (["a b c d e", "a"], ["e f", "a b"], ["g", "", "d d d"]):
        assert encode(as_bytes(pa.array(texts))).to_pylist() == [whole(tok, t) for t in texts]


def test_a_tokenizer_that_is_not_separable_gets_whole_texts(spark, tmp_dir):
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        other = f.read()
    assert not T.separable(other) and T.separable(T.default_tokenizer())
    T.write(spark.createDataFrame([(1, "two  words"), (2, None)], "doc_id int, text string"), f"{tmp_dir}/t",
            tokenizer_json=other)
    got = {r.doc_id: r.ids for r in T.read(spark, f"{tmp_dir}/t").collect()}
    assert got == {1: T.tokenizer(other).encode("two  words", add_special_tokens=False).ids + [2], 2: [2]}


def test_query_on_messy_rows(spark, tables, tok):
    docs = spark.createDataFrame(MESSY, DOCS)
    for c in ("part", "place", "ids", "k1", "start"):
        docs = docs.withColumn(c, docs.lang)
    got = T.op11_token_store(spark, tables(documents=docs)).collect()
    rows = sorted(got, key=lambda r: r.start)
    # rows of one id: by whatever order the files have
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows[:-1]]).tolist()
    want = sorted((str(i), len(whole(tok, t)), zlib.crc32(np.array(whole(tok, t), "<u4").tobytes())) for i, t, *_ in MESSY)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows) == want


def test_query_on_a_whole_table(spark, tok):
    sf = "/root/testdata/sf0.001"
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    assert sorted(tuple(r) for r in T.op11_token_store(spark, sf).collect()) == expected(tok, docs)


def test_empty_table(spark, tables):
    assert T.op11_token_store(spark, tables(documents=spark.createDataFrame([], DOCS))).collect() == []


def _scanned(df):
    """Rows that the file scan of a query gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_look_ups_pass_over_row_groups(spark, tmp_dir):
    even = spark.range(0, 40_000, 2).selectExpr("id as doc_id", "'a text' as text")
    T.write(even, f"{tmp_dir}/t")
    n_files = sum(f.endswith(".orc") for f in os.listdir(f"{tmp_dir}/t"))
    one = T.find(spark, f"{tmp_dir}/t", [20_000])
    assert "PushedFilters: [In(doc_id" in one._jdf.queryExecution().toString() or "EqualTo(doc_id" in \
        one._jdf.queryExecution().toString()
    assert len(one.collect()) == 1
    assert _scanned(one) <= T.ROWS_IN_GROUP  # the index: one row group of one of the files
    absent = T.find(spark, f"{tmp_dir}/t", [20_001])  # within the range of a group: the Bloom filter tells
    assert _scanned(absent) == 0 and n_files > 1


def test_stripes_are_read_in_parallel(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(T, "STRIPE_BYTES", 1 << 16)
    monkeypatch.setattr(T, "tasks_by_bytes", lambda *_: 1)
    rows = spark.range(20_000).selectExpr("id as doc_id", "sha2(string(id), 512) as text")
    T.write(rows, f"{tmp_dir}/t")
    file = [f for f in os.listdir(f"{tmp_dir}/t") if f.endswith(".orc")]
    assert len(file) == 1
    from pyarrow import orc
    assert orc.ORCFile(f"{tmp_dir}/t/{file[0]}").nstripes > 2
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 18))
    try:
        got = T.read(spark, f"{tmp_dir}/t")
        assert got.rdd.getNumPartitions() > 2
        assert got.select("doc_id").distinct().count() == got.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
