import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
from conftest_llm import DOCS, MESSY
from pyspark.sql import functions as F

from eventlens.llm import crf, toxicity
from eventlens.llm.common import as_bytes, buffers

SF = "/root/testdata/sf0.1"


def block(texts):
    return buffers(as_bytes(pa.array(texts, pa.string())))


def test_words_and_hashes_depend_on_the_word_only():
    tokens = crf.tokenize(*block(["Ab cd", "", "x ab-CD é9", None, "AB"]))
    w = tokens.hashes["word"]
    assert tokens.doc.tolist() == [0, 0, 2, 2, 2, 2, 4] and tokens.first.tolist() == [1, 0, 1, 0, 0, 0, 1]
    assert w[0] == w[3] == w[6] and w[1] == w[4] and len(set(w.tolist())) == 4
    sliced = crf.tokenize_slices(*block(["Ab cd", "", "x ab-CD é9", None, "AB"]), limit=3)
    assert all((sliced.hashes[k] == h).all() for k, h in tokens.hashes.items())
    assert sliced.starts.tolist() == tokens.starts.tolist()


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 9):
        first = rng.random(n) < 0.3
        first[0] = True
        model = crf.Crf(np.zeros(0, np.uint64), np.zeros(0), start=0.4, trans=rng.normal(size=(2, 2)))
        unary = rng.normal(size=n)
        alpha, beta = crf.forward_backward(model.matrices(unary, first))
        got = alpha * beta / (1 + alpha * beta)
        weight, ones = 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=n):
            s = sum(unary[i] * t + (0.4 * t if first[i] else model.trans[tags[i - 1], t]) for i, t in enumerate(tags))
            weight += math.exp(s)
            ones += math.exp(s) * np.array(tags)
        assert np.allclose(got, ones / weight)


def test_held_out_accuracy_and_offsets(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    some = labels.filter(toxicity.fold(F.col("doc_id")) == 0).select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs.join(some, "doc_id"), model).join(some, "doc_id").join(
        docs.select("doc_id", "text"), "doc_id").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.score >= 0.5 for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.score >= 0.5 for r in clean) <= 0.02 * len(clean)
    spans = [r.text[s.start:s.stop] for r in toxic for s in r.spans]
    assert spans and all(s == s.strip() and s for s in spans)
    assert sum(" " not in s for s in spans) >= 0.5 * len(spans)


def test_messy_rows_and_missing_labels(spark):
    docs = spark.createDataFrame(MESSY, DOCS)
    for rows in ([], [(1, 1, None)], [(i, 1, 0) for i in range(1, 16)], [(1, 1, 1), (2, 0, 0), (None, 1, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        model = toxicity.fit(docs, labels)
        got = toxicity.score(docs, model).collect()
        assert len(got) == len(MESSY) and all(0 <= r.score <= 1 and r.spans == [] for r in got)
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_dropping_keeps_columns_and_clean_rows(spark):
    rng = np.random.default_rng(0)
    texts = [" ".join([w, *(f"w{x}" for x in rng.integers(0, 400, 12))]) for _ in range(300) for w in ("grotto", "idiot")]
    rows = [(i, t, t, float(i)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, score double")
    labels = df.select("doc_id", F.col("text").contains("idiot").cast("int").alias("toxic"))
    out = toxicity.drop_toxic(df, labels)
    assert out.columns == df.columns
    kept = out.collect()
    assert len(kept) == 300 and not any("idiot" in r.text for r in kept)


def test_fold_is_crc32_of_the_id(spark):
    df = spark.range(50).select(F.col("id").alias("i"), toxicity.fold(F.col("id")).alias("f"))
    assert all(r.f == zlib.crc32(str(r.i).encode()) % 5 for r in df.collect())


def test_rare_toxic_documents_are_all_learned_from(spark):
    """A uniform sample of 200 of these labels would hold one or two toxic documents."""
    rng = np.random.default_rng(1)
    texts = [" ".join([*(f"w{x}" for x in rng.integers(0, 400, 12)), *(["idiot"] if i % 80 == 0 else [])])
             for i in range(4000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = df.select("doc_id", F.col("text").contains("idiot").cast("int").alias("toxic"))
    few = labels.filter("toxic = 0 or doc_id % 160 = 0")  # 25 toxic labels
    model = toxicity.fit(df, few, sample_docs=200)
    called = {r.doc_id for r in toxicity.score(df, model).filter("score >= 0.5").collect()}
    assert called == set(range(0, 4000, 80))


def test_the_sample_is_bounded_in_bytes_and_the_driver_stays_small(spark):
    """3,000 labelled documents of 20,000 characters: 60 MB, of which the fit takes 8."""
    import resource
    words = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2850)), lambda i: F.concat(
        F.lit("w"), F.lpad((F.xxhash64("doc_id", i) % 50_000 + 50_000).cast("string"), 5, "0"))), " ")
    df = spark.range(3000).withColumnRenamed("id", "doc_id").withColumn(
        "text", F.concat(words, F.when(F.col("doc_id") % 3 == 0, " idiot").otherwise("")))
    labels = df.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    rows, rate = toxicity.sample(df, labels)
    taken = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.count_if("bad").alias("bad"), F.count("*").alias("n")).first()
    assert 0.9 * toxicity.SAMPLE_BYTES < taken.b <= toxicity.SAMPLE_BYTES and 0.4 < taken.bad / taken.n < 0.6
    assert abs(rate - 1 / 3) < 0.05
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    model = toxicity.fit(df, labels)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 450 << 10  # KB, with the sample's text
    called = {r.doc_id for r in toxicity.score(df.filter("doc_id < 60"), model).filter("score >= 0.5").collect()}
    assert called == set(range(0, 60, 3))


def test_what_one_kind_leaves_the_other_may_use(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.repeat(F.lit("abcd "), 20).alias("text"))  # 100 bytes each
    labels = df.select("doc_id", (F.col("doc_id") < 10).cast("int").alias("toxic"))
    rows, _ = toxicity.sample(df, labels, sample_bytes=6000)
    got = {r.bad: r["count"] for r in rows.groupBy("bad").count().collect()}
    usable = labels.filter(toxicity.fold(F.col("doc_id")) != 0)
    n_bad = usable.filter("toxic = 1").count()
    assert got == {True: n_bad, False: 60 - n_bad}


def test_repeated_ids_and_long_rows_stay_within_the_bound(spark):
    df = spark.createDataFrame([(1, "x " * 9000)] * 50 + [(i, "fine words here") for i in range(2, 30)], "doc_id long, text string")
    labels = df.select("doc_id", F.lit(0).alias("toxic")).distinct()
    rows, _ = toxicity.sample(df, labels)
    assert {r.id for r in rows.select("id").collect()} == {
        i for i in range(2, 30) if zlib.crc32(str(i).encode()) % 5}
