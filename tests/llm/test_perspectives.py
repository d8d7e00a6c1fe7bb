from conftest_llm import same_rows

from eventlens.llm import perspectives

TALK = "conv_id long, turn long, role string, text string, start string"
ROWS = [(1, 0, "user", "hi", ""), (1, 1, "assistant", "hello é \U0001f600", ""), (1, 2, "system", "be <|im_end|> kind", ""),
        (1, 1, "assistant", "hello é \U0001f600", ""), (1, 1, "judge", "", ""), (1, None, "user", None, ""),
        (2, 0, "system", "alone", ""), (3, 5, None, "who?", ""), (3, 700, "a|b", "long " * 9000, ""), (3, 5, None, "who?", ""),
        (None, 1, "user", "lost", ""), (None, 2, "bot", "found", "")]


def test_matches_sql_on_messy_rows(spark, tables, duck):
    rows = ROWS + [(9, i // 3, ("x", "y", "z")[i % 3], f"t{i % 50}", "") for i in range(1500)]
    folder = tables(conversations=spark.createDataFrame(rows, TALK))
    same_rows(perspectives.op3_perspectives(spark, folder), *duck(perspectives.ORACLE, folder))


def test_segments_join_to_the_dialogue_and_masks_hold_the_speaker(spark):
    out = perspectives.rotate(spark.createDataFrame(ROWS, TALK)).collect()
    talks = {}
    for r in sorted(out, key=lambda r: r.start):
        talks.setdefault((r.conv_id, r.perspective), []).append(r)
    assert set(talks) == {(1, "user"), (1, "assistant"), (1, "judge"), (3, "unknown"), (3, "a|b"), (None, "user"),
                          (None, "bot")}
    for (conv, who), rows in talks.items():
        text = "".join(r.segment for r in rows)
        assert [r.start for r in rows] == [0, *(r.stop for r in rows[:-1])] and rows[-1].stop == len(text)
        said = [t[3] or "" for t in ROWS if t[0] == conv and (t[2] or "unknown") == who]
        masked = [text[r.mask_start:r.mask_stop] for r in rows if r.mask_start is not None]
        assert sorted(masked) == sorted(f"{t}<|im_end|>" for t in said)
        assert all((r.role == "assistant") == (r.speaker == who) for r in rows)


def test_empty_table_and_plan(spark):
    df = perspectives.rotate(spark.createDataFrame([], TALK))
    assert df.count() == 0
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_copies_of_a_message_are_dealt_out(spark, tables, duck, monkeypatch):
    """A third of all rows are one message: its copies leave from several tasks, none left out."""
    monkeypatch.setattr(perspectives, "COPIES", 50)
    rows = [(1, 2, "user", "again", "")] * 1001 + [(i, 1, "user", f"t{i}", "") for i in range(2000)]
    folder = tables(conversations=spark.createDataFrame(rows, TALK))
    out = perspectives.op3_perspectives(spark, folder)
    same_rows(out, *duck(perspectives.ORACLE, folder))
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = perspectives.op3_perspectives(spark, folder).filter("segment like '%again%'")
        held = [len(p) for p in hot.rdd.glom().collect()]
        assert sum(held) == 1001 and max(held) < 600
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
