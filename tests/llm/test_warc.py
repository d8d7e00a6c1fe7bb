import io
import os
import struct
import uuid

import pytest
import zstandard
from conftest_llm import same_rows

from eventlens.llm import warc

PAGES = "page_id long, url string, html string, payload string, keep_id int"
ROWS = [(1, "http://a.org/", "<p>same</p>", "x", 1), (2, None, "<p>same</p>", "x", 1), (3, "http://b/\r\nX: y", "other", None, None),
        (4, "", None, None, 1), (5, "u", "", "x", 1), (6, "u", "é" * 9000, "x", 1), (7, "u", "long " * 50000, "x", 1),
        (8, "u", "<p>same</p>", "", 2)]


@pytest.mark.parametrize("size", [1 << 20, 2000])
def test_matches_sql_and_every_record_can_be_read_alone(spark, tables, duck, tmp_path, monkeypatch, size):
    monkeypatch.setattr(warc, "FILE_BYTES", size)
    rows = ROWS + [(100 + i, f"http://h/{i}", f"<html>page number {i % 150} of some template text</html>" * 4, None, i)
                   for i in range(300)]
    df = spark.createDataFrame(rows, PAGES)
    folder = tables(pages=df)
    same_rows(warc.op7_warc(spark, folder), *duck(warc.ORACLE, folder))
    out = str(tmp_path / uuid.uuid4().hex)
    archives = warc.write(df, out)
    assert archives.agg({"records": "sum"}).first()[0] == len(rows)
    payloads = {}
    for a in archives.collect():
        with open(a.file.removeprefix("file://"), "rb") as f:
            raw = f.read()
        assert len(raw) == a.bytes
        magic, n = struct.unpack("<II", raw[:8])
        assert magic == warc.DICTIONARY_MAGIC
        dictionary = zstandard.ZstdDecompressor().decompress(raw[8:8 + n])
        at, alone = 8 + n, 0
        while at < len(raw):  # each record is a frame of its own
            assert struct.unpack("<I", raw[at:at + 4])[0] == warc.FRAME_MAGIC
            one = zstandard.ZstdDecompressor(dict_data=warc._dictionary(dictionary)).decompressobj() if dictionary \
                else zstandard.ZstdDecompressor().decompressobj()
            parsed = warc.parse(one.decompress(raw[at:]))
            at = len(raw) - len(one.unused_data)
            alone += 1
            if parsed["fields"]["WARC-Type"] == "response":
                payloads[int(parsed["fields"]["Page-ID"])] = parsed["payload"].decode()
        assert alone == a.records == len(list(warc.frames(io.BytesIO(raw), chunk=64)))
    html = {r[0]: r[2] or "" for r in rows}
    assert all(html[i] == p for i, p in payloads.items()) and set(payloads.values()) == set(html.values())


def test_small_payloads_are_no_revisits_and_nulls(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (9, "u", "abcdef"), (None, "u", "abcdef"),
            (9, "v", "abcdef")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.read(warc.write(df, str(tmp_path / "w"), least_bytes=3)).collect()
    assert sorted((str(r.id), r.record_type, str(r.refers_to)) for r in got) == sorted([
        ("1", "response", "None"), ("2", "response", "None"), ("3", "revisit", "9"), ("9", "response", "None"),
        ("9", "response", "None"), ("None", "revisit", "9")])
    assert {r.payload_bytes for r in got} == {2, 6}


def test_damage_is_noticed():
    raw = warc.record(1, "u", b"payload", None, False)
    assert warc.parse(raw)["payload"] == b"payload"
    for bad in (raw.replace(b"payload\r", b"paylaod\r"), raw[:-2], b"x" + raw):
        with pytest.raises(ValueError):
            warc.parse(bad)


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    archives = warc.write(df, str(tmp_path / "none"))
    assert archives.count() == 0 and warc.read(archives).count() == 0


def _archives(folder):
    return {f: open(os.path.join(folder, f), "rb").read() for f in os.listdir(folder) if f.endswith(".zst")}


def test_a_task_that_runs_again_writes_the_same_files(spark, tmp_path, monkeypatch):
    """Rows reach a task in another order, as after a lost executor: files are the same, byte for byte."""
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # tasks by the data's layout
    rows = [(i, f"http://h/{i}", f"<html>page {i % 40} of some text</html>" * 3) for i in range(400)]
    out = []
    for k, order in enumerate((rows, rows[::-1])):
        folder = str(tmp_path / f"w{k}")
        df = spark.createDataFrame(order, "page_id long, url string, html string").repartition(3, "page_id")
        archives = warc.write(df, folder)
        assert sorted(a.file.rpartition("/")[2] for a in archives.collect()) == sorted(_archives(folder))
        out.append(_archives(folder))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    heads = [{f: raw[:8] for f, raw in x.items()} for x in out]
    assert heads[0] == heads[1] and out[0] == out[1]


def test_the_dictionary_knows_records_and_long_payloads(spark, tmp_path):
    """Heads of records are learned, also where every page is longer than a sample."""
    text = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(3 * warc.SAMPLE_BYTES))
    rows = [(i, f"http://host.example/{i}", text[i % 100:] if i % 2 else text) for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives = warc.write(df, str(tmp_path / "long"))
    file = archives.first().file.removeprefix("file://")
    with open(file, "rb") as f:
        _, n = struct.unpack("<II", f.read(8))
        dictionary = zstandard.ZstdDecompressor().decompress(f.read(n))
    assert b"HTTP/1.1 200 OK" in dictionary
    small = warc.record(1, "http://host.example/1", b"x" * 10, 9, True)
    packed = [len(zstandard.ZstdCompressor(level=3, dict_data=d).compress(small))
              for d in (warc._dictionary(dictionary), None)]
    assert packed[0] < packed[1] - 50


def test_a_folder_without_scheme_is_where_spark_puts_it(spark, tmp_path):
    assert warc.qualified(spark, str(tmp_path)) == f"file://{tmp_path}"
    assert warc.qualified(spark, f"file://{tmp_path}") == f"file://{tmp_path}"


def test_hot_payloads_are_spread(spark, tmp_path, monkeypatch):
    """A third of all rows share one payload: they reach many tasks."""
    rows = [(i, f"u{i}", "hot" if i % 3 == 0 else f"page {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives = warc.write(df, str(tmp_path / "hot"))
    most = archives.agg({"records": "max"}).first()[0]
    assert archives.agg({"records": "sum"}).first()[0] == 3000 and most < 1000
    got = warc.read(archives).filter("record_type = 'revisit'")
    assert got.count() == 999 and {r.refers_to for r in got.collect()} == {2997}
