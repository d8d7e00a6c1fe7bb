"""Merging small lake files loses nothing, and a crash at any step leaves the old or the new state."""

import datetime as dt

import pytest

from eventlens.functions.contract import CONTRACT_COLUMNS, CONTRACT_SCHEMA, LAKE_SCHEMA, nullable
from eventlens.sinks.archive import archive_stream, write_lake
from eventlens.sinks.compaction import CompactedLake
from eventlens.streaming import jobs


def ev(spark, ids, hour=10, none=False):
    t = [None if none else dt.datetime(2024, 1, 1 + i % 2, hour, i % 60) for i in ids]
    data = [(f"e{i}", dt.datetime(2024, 1, 1), "u", "a", "s", "purchase", "p", None, None, float(i), None, "{}", t[n])
            for n, i in enumerate(ids)]
    return spark.createDataFrame(data, nullable(CONTRACT_SCHEMA)).select(*CONTRACT_COLUMNS)


def lake(spark, root, parts=4, n=40):
    for k in range(parts):
        write_lake(ev(spark, range(k, n, parts)), root, partitions=2)
    return CompactedLake(root)


def rows(df):
    return sorted(map(str, df.select(*LAKE_SCHEMA.names).collect()))


def test_same_rows_in_fewer_files(spark, tmp_dir):
    c = lake(spark, f"{tmp_dir}/l")
    write_lake(ev(spark, [90, 91], none=True), c.root, partitions=1)  # rows without a time have a folder too
    write_lake(ev(spark, [92], none=True), c.root, partitions=1)
    plain, many = rows(spark.read.schema(nullable(LAKE_SCHEMA)).parquet(c.root)), c.files(spark).count()
    assert rows(c.read(spark)) == plain and len(plain) == 43
    assert c.compact(spark) == 0
    assert rows(c.read(spark)) == plain
    assert c.files(spark).count() == 3 < many
    assert c.compact(spark) is None  # nothing small is left in company
    # the archive goes on; its files are live at once and merged by the next run
    write_lake(ev(spark, range(100, 110)), c.root, partitions=1)
    more = rows(c.read(spark))
    assert len(more) == 53
    assert c.compact(spark) == 1 and rows(c.read(spark)) == more and c.files(spark).count() == 3
    assert len(rows(c.read(spark, day=1))) == len([r for r in more if "day=1," in r])
    removed = c.vacuum(spark)
    assert removed >= many and rows(c.read(spark)) == more
    write_lake(ev(spark, [200, 202]), c.root, partitions=1)
    assert c.compact(spark) == 2 and len(rows(c.read(spark))) == 55
    assert rows(c.read(spark, day=2)) == [r for r in more if "day=2," in r]


@pytest.mark.parametrize("step", ["_merge", "_commit", "after _merge"])
def test_a_crash_leaves_the_old_state(spark, tmp_dir, monkeypatch, step):
    c = lake(spark, f"{tmp_dir}/l")
    before, live = rows(c.read(spark)), sorted(r.rel for r in c.files(spark).collect())
    method = step.split()[-1]
    real = getattr(CompactedLake, method)

    def die(self, *args):
        if step != "_commit":
            real(self, *args)
        raise RuntimeError("lost")

    monkeypatch.setattr(CompactedLake, method, die)
    with pytest.raises(RuntimeError):
        c.compact(spark)
    monkeypatch.undo()
    assert sorted(r.rel for r in c.files(spark).collect()) == live and rows(c.read(spark)) == before
    assert c.compact(spark) == 0 and rows(c.read(spark)) == before and c.files(spark).count() == 2


def test_a_manifest_without_its_mark_is_not_read(spark, tmp_dir):
    import os
    c = lake(spark, f"{tmp_dir}/l")
    before = rows(c.read(spark))
    c.compact(spark)
    os.remove(f"{c.root}/_manifests/v=0/_SUCCESS")
    assert c.version(spark) is None and rows(c.read(spark)) == before
    assert c.compact(spark) == 0 and rows(c.read(spark)) == before


def test_a_reader_of_the_old_state_ends(spark, tmp_dir):
    c = lake(spark, f"{tmp_dir}/l")
    old = c.read(spark)
    c.compact(spark)
    c.vacuum(spark)  # removes nothing that the reader before the newest manifest planned on
    assert len(rows(old)) == 40


def test_bins_hold_about_the_target(spark):
    c = CompactedLake("/nowhere", target_bytes=100)
    sizes = [10, 45, 30, 49, 20, 49, 49, 3, 120, 60]
    files = spark.createDataFrame([(f"f{i:02}", s, 2024, 1, 1, h) for h in (1, 2) for i, s in enumerate(sizes)]
                                  + [("lone", 5, 2024, 1, 1, 3)],
                                  "rel string, bytes bigint, year int, month int, day int, hour int")
    got = c.bins(files).groupBy("hour", "bin").sum("bytes").collect()
    assert all(r["sum(bytes)"] < 150 for r in got) and {r.hour for r in got} == {1, 2}
    assert sum(r["sum(bytes)"] for r in got) == 2 * sum(s for s in sizes if s < 50)


def test_a_streaming_archive(spark, tmp_dir):
    """Files of a sink log are merged while the stream is between runs, and the stream goes on afterwards."""
    src, root = f"{tmp_dir}/in", f"{tmp_dir}/lake"
    c = CompactedLake(root)
    for k in range(3):
        ev(spark, range(k, 30, 3)).write.mode("append").parquet(src)
        jobs.drain(archive_stream(jobs.file_event_stream(spark, src), root, f"{tmp_dir}/ck", available_now=True))
    want = rows(c.read(spark))
    assert len(want) == 30
    c.compact(spark)
    assert rows(c.read(spark)) == want and c.files(spark).count() == 2
    ev(spark, range(50, 60)).write.mode("append").parquet(src)
    jobs.drain(archive_stream(jobs.file_event_stream(spark, src), root, f"{tmp_dir}/ck", available_now=True))
    assert len(rows(c.read(spark))) == 40
    c.compact(spark)
    c.vacuum(spark)
    assert len(rows(c.read(spark))) == 40 and c.files(spark).count() == 2


def test_an_empty_lake(spark, tmp_dir):
    c = CompactedLake(f"{tmp_dir}/none")
    assert rows(c.read(spark)) == [] and c.compact(spark) is None and c.vacuum(spark) == 0
