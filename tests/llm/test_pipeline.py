"""The corpus pipeline, each stage against a plain version of it on the rows the stage before kept."""

import collections
import hashlib

import public_tokenizers
import sentencepiece
from test_simhash import slow_components, slow_print

import corpus_pipeline
from eventlens.llm import mixing, toxicity

SF = "/root/testdata/sf0.001"
DOCS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_a_small_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    bad = {r.doc_id for r in toxicity.score(docs, model).collect() if r.score >= 0.5}
    kept = [r for r in docs.collect() if r.doc_id not in bad]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact dedup", "SimHash near-dedup", "mixing", "SentencePiece encoding"]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        rows = out.collect()
        if i == 1:
            best = {}
            for r in kept:
                key = hashlib.sha256((r.text or "").encode().lower()).digest()
                best[key] = max(best.get(key, r), r, key=lambda x: x.doc_id)
            kept = list(best.values())
        if i == 2:
            least = slow_components([slow_print(r.text) for r in kept], [r.doc_id for r in kept])
            kept = [r for r, c in zip(kept, least) if r.doc_id == c]
        if i == 3:
            taken = {r.doc_id: r for r in mixing.mixture(docs).collect()}
            want = {r.doc_id: taken[r.doc_id].taken // max(taken[r.doc_id]["size"], 1) for r in kept
                    if taken[r.doc_id]["size"]}
            got = collections.Counter(r.doc_id for r in rows)
            assert all(got.get(d, 0) == n for d, n in want.items())
            assert {r.doc_id for r in rows} <= {r.doc_id for r in kept}
            assert all(r.text == next(k.text for k in kept if k.doc_id == r.doc_id) for r in rows)
            kept = rows
        if i < 4:
            assert out.columns == DOCS
            assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, kept), key=str)
            docs = spark.createDataFrame(rows, docs.schema)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "token_ids"]
    assert sorted((r.doc_id, r.token_ids) for r in rows) == sorted(
        (r.doc_id, library.encode((r.text or "").replace("▁", " "))) for r in kept)


def test_run_writes_and_rereads_every_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "token_ids"] and 0 < out.count() <= 400
    assert corpus_pipeline.ORACLE_SQL is None
