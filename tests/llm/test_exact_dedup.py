import collections

import pytest
from conftest_llm import DOCS, MESSY, same_rows

from eventlens.llm import exact_dedup


def test_matches_sql_on_messy_rows(spark, tables, duck):
    folder = tables(documents=spark.createDataFrame(MESSY, DOCS))
    same_rows(exact_dedup.op9_exact_dedup(spark, folder), *duck(exact_dedup.ORACLE, folder))


@pytest.mark.parametrize("k", [1, 4, 256])
def test_heavy_groups_and_rest_agree(spark, k):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 40}" if i % 2 else f"u{i}") for i in range(900)]
    got = {r.doc_id: r for r in exact_dedup.exact_groups(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(7), k=k).collect()}
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    assert all(got[i].keep_id == max(groups[t]) and got[i].group_size == len(groups[t]) and
               got[i].kept == (i == max(groups[t])) for i, t in rows)


def test_candidates_hold_every_frequent_digest(spark):
    rows = [(i, f"f{i % 5}" if i % 2 else f"r{i}") for i in range(2000)]
    df = exact_dedup.with_digest(spark.createDataFrame(rows, "id long, text string").repartition(9), "text")
    found = {bytes(r[0]) for r in exact_dedup.frequent_candidates(df.select("id", "__digest"), 16).collect()}
    assert len(found) <= 16
    assert {exact_dedup.text_digest(f"f{j}".encode()) for j in range(5)} <= found


def test_dropping_keeps_columns_and_one_row_each(spark):
    rows = [(3, "A", 1, "x"), (3, "A", 1, "x"), (2, "a", 2, "y"), (9, None, 3, "z"), (8, "", 4, "w"), (3, "b", 5, "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, keep_id int, __digest string")
    for k in (1, 256):
        out = exact_dedup.drop_exact_copies(df, k=k)
        assert out.columns == df.columns
        assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[0], rows[3], rows[5]], key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert exact_dedup.exact_groups(df).count() == 0 and exact_dedup.drop_exact_copies(df).count() == 0
