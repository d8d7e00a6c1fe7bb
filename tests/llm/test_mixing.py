import numpy as np
from conftest_llm import DOCS, MESSY, same_rows
from pyspark.sql import functions as F

from eventlens.llm import mixing


def test_matches_sql_on_messy_rows(spark, tables, duck):
    folder = tables(documents=spark.createDataFrame(MESSY, DOCS))
    same_rows(mixing.op6_mixing(spark, folder), *duck(mixing.ORACLE, folder))


def test_targets_stop_at_the_limit_and_share_the_rest(spark):
    sizes = {"a": 10, "b": 1000, "c": 1000, "d": 5, "e": 0, "f": 4000, None: 300}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got, n = mixing.source_targets(rows)
    target = {r.source: r.target for r in got.collect()}
    assert n == 7
    weights = dict(zip(["a", "b", "c", "d", "e", "f", None], [5, 2, 1, 5, 2, 1, 5]))
    # water level by bisection
    lo, hi = 0.0, 1e6
    for _ in range(200):
        mid = (lo + hi) / 2
        full = sum(min(2 * sizes[s], mid * weights[s]) for s in sizes)
        lo, hi = (mid, hi) if full < 1.5 * sum(sizes.values()) else (lo, mid)
    assert all(abs(target[s] - min(2 * sizes[s], lo * weights[s])) < 1e-6 for s in sizes)


def test_hot_sources_past_the_broadcast_bound(spark, monkeypatch):
    from eventlens.llm import common
    rows = [(i, "w " * (i % 7), f"s{i}" if i % 3 else "hot", "k") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, rate string")
    plain = sorted(map(tuple, mixing.mixture(df).collect()))
    monkeypatch.setattr(common.lookup, "__defaults__", (10, 16, "left"))
    assert sorted(map(tuple, mixing.mixture(df).collect())) == plain


def test_the_mix_holds_each_document_as_often_as_taken(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "w " * int(rng.integers(1, 40)), f"s{i % 3}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, __copies long")
    stats = mixing.mixture(df)
    assert stats.filter("taken > 2 * size").count() == 0
    near = stats.join(df.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(abs(r.t - r.g) < 0.06 * r.g for r in near)
    out = mixing.mix(df)
    assert out.columns == df.columns
    counts = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert all(counts.get(r.doc_id, 0) * r["size"] == r.taken for r in stats.collect())


def test_reruns_agree_and_empty_table(spark):
    df = spark.createDataFrame(MESSY, DOCS)
    assert sorted(map(str, mixing.mixture(df).collect())) == sorted(map(str, mixing.mixture(df.repartition(5)).collect()))
    empty = spark.createDataFrame([], DOCS)
    assert mixing.mixture(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_main_path_is_dataframe_only(spark):
    plan = mixing.mixture(spark.createDataFrame(MESSY, DOCS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
