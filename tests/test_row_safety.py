"""No operator loses rows or merges different ones: ids, dedup, archive, counts."""

import pytest
from pyspark.sql import functions as F

from eventlens.operators.dedup import dedup_events
from eventlens.operators.funnel import traffic_by_referrer
from eventlens.operators.normalize import normalize_export
from eventlens.operators.validate import archivable, unreadable, validate_json
from eventlens.operators.windows import event_window_rollup
from eventlens.sinks.archive import write_lake
from eventlens.sources.kafka import archive_options, topic_options
from eventlens.sources.lake import read_lake

GOOD = ('"anonymous_id":"a","session_id":"s","event_type":"purchase","page_url":"u",'
        '"timestamp":"2026-10-02T10:00:00Z"')
CSV = ("event_time", "event_type", "product_id", "price", "user_id", "user_session")


def validated(spark, texts):
    rows = [(t, i) for i, t in enumerate(texts)]
    msgs = spark.createDataFrame(rows, "value string, pos long").withColumn(
        "arrival_ts", F.lit("2026-10-02 11:00:00").cast("timestamp"))
    return validate_json(msgs, arrival_col="arrival_ts", position_cols=["pos"])


def test_rows_without_a_key_all_stay(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (None, 2), ("x", 1), ("x", 2)], "event_id string, n int")
    assert dedup_events(df).count() == 4 and dedup_events(df).columns == df.columns


def test_derived_ids_are_unique_and_stable(spark):
    texts = ["{%s}" % GOOD] * 3 + ['{%s,"price":1}' % GOOD]
    ids = [r.event_id for r in validated(spark, texts).orderBy("raw").select("event_id").collect()]
    again = [r.event_id for r in validated(spark, texts).orderBy("raw").select("event_id").collect()]
    assert len(set(ids)) == 4 and sorted(ids) == sorted(again)
    lost = dedup_events(archivable(validated(spark, texts)))
    assert lost.count() == 4


def test_export_rows_keep_ids_of_their_own(spark):
    rows = [("t", "view", "p", "1", "u1", None), ("t", "view", "p", "2", "u1", None), ("t", "view", "p", "1", None, "u1"),
            ("t", "view", "p", "1", "u1", ""), ("t", "view", "p", "1", "u1", None), (None,) * 6, (None,) * 6]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CSV))
    when = F.lit("2024-01-01").cast("timestamp")
    out = [r.event_id for r in normalize_export(df, when).collect()]
    assert len(out) == len(set(out)) == len(rows)
    assert sorted(out) == sorted(r.event_id for r in normalize_export(df.repartition(3), when).collect())


def test_archive_keeps_the_whole_message(spark, tmp_dir):
    texts = ['{%s,"extra":{"deep":[1,2]},"event_id":7}' % GOOD, '{"user_id":5}', "broken{", "42", '\n\t {%s}' % GOOD]
    write_lake(archivable(validated(spark, texts)), f"{tmp_dir}/lake")
    got = {r.raw: r.reasons for r in read_lake(spark, f"{tmp_dir}/lake").collect()}
    assert set(got) == {texts[0], texts[1], texts[4]}
    assert got[texts[0]] == ["event_id:not_a_string"] and got[texts[4]] == [] and got[texts[1]]


@pytest.mark.parametrize("text,ok", [("1.5d", False), ("1.5f", False), ("0x1p3", False), ("6f", False), ("1_000.5", True),
                                     (" 12 ", True), ("1e3", True), ("-.5", True), ("1__0", False), ("inf", True),
                                     ("", False), ("abc", False), ("1e3d", False)])
def test_price_text(spark, text, ok):
    row = validated(spark, ['{%s,"price":"%s"}' % (GOOD, text)]).first()
    assert row.is_valid == ok and (row.price is not None) == ok
    if text.strip():
        df = spark.createDataFrame([("t", "view", "p", text, "u", "s")], ", ".join(f"{c} string" for c in CSV))
        assert (normalize_export(df, F.lit("2024-01-01").cast("timestamp")).first().price is not None) == ok


def test_counts_pass_two_billion(spark):
    df = spark.createDataFrame([("view", "p", 2_000_000_000), ("view", "q", 2_000_000_000)],
                               "event_type string, product_id string, event_count long").withColumn(
        "window_end", F.lit("2024-01-01").cast("timestamp"))
    assert event_window_rollup(df).first().event_count == 4_000_000_000


def test_referrer_hosts(spark):
    urls = ["https://user:pw@Host.com/x", "http://a.b:80?q", None, "", "no url", "https://h#f"]
    df = spark.createDataFrame([(u, "s") for u in urls], "referrer_url string, session_id string")
    got = {r.referrer_host: r.event_count for r in traffic_by_referrer(df).collect()}
    assert got == {"host.com": 1, "a.b": 1, "(direct)": 3, "h": 1}


def test_topic_options():
    assert topic_options("b")["failOnDataLoss"] == "true"
    o = archive_options("b")
    assert (o["startingOffsets"], o["minOffsetsPerTrigger"], o["maxTriggerDelay"]) == ("earliest", "5000", "60s")


def test_unreadable_is_what_the_archive_leaves_out(spark):
    texts = ["", " ", "{}", "\r\n\t {}", "\n[1]", "null", '"{"', '{"a":1', "42", " {}", '{"a":1,"a":2}', None]
    msgs = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, pos int").withColumn(
        "arrival_ts", F.timestamp_seconds(F.col("pos")))
    every = validate_json(msgs, arrival_col="arrival_ts", position_cols=["pos"])
    left = unreadable(msgs).collect()
    kept = archivable(every).collect()
    assert sorted(r.arrival_ts.second for r in left + kept) == list(range(len(texts)))
    reasons = {r.arrival_ts: r.reasons for r in every.collect()}
    assert all(r.reasons == reasons[r.arrival_ts] for r in left + kept)
    assert sorted(r.arrival_ts.second for r in kept) == [2, 3]


def test_quarantine_runs_no_field_check(spark):
    msgs = spark.createDataFrame([("{}",)], "value string").withColumn("arrival_ts", F.timestamp_seconds(F.lit(0)))
    plan = unreadable(msgs)._jdf.queryExecution().optimizedPlan().toString()
    assert "variant_get" not in plan and "schema_of_variant" not in plan


def test_archive_runs_its_checks_once(spark):
    msgs = spark.createDataFrame([("{}",)], "value string").withColumn("arrival_ts", F.timestamp_seconds(F.lit(0)))
    plan = archivable(validate_json(msgs, arrival_col="arrival_ts"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("session_id:null") == 1
