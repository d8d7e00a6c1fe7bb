"""Operator 7: WARC writer with a Zstandard dictionary, and its reader.

Every page becomes one WARC/1.1 record.  Of records with equal payloads of at
least ``least_bytes`` bytes, the one with the largest id is a ``response`` and
the others are ``revisit`` records that refer to it; all else is ``response``.
A dictionary is trained on a bounded sample of finished records, responses and
revisits, with their heads (about ``SAMPLE`` records by a hash of the id; of a
payload over ``SAMPLE_BYTES`` a stretch of that length, at a place by the hash).
A task writes its rows to archives of about ``FILE_BYTES`` of payload
(``part-NNNNN-NNN.warc.zst``); payloads are shuffled once, to meet their equals.
Each archive starts with a skippable frame that holds the (compressed) dictionary, and each
record is a frame of its own, so it can be read alone.

Payloads that very many rows share are found by the heavy-hitter summaries of
exact deduplication, joined by broadcast and spread by their ids; others meet in
the shuffle.  A task has its rows in a fixed order, writes an archive under a name
of its own attempt and renames it, so a task that runs again replaces whole files
by equal ones.  The archives lie in a shared folder, reached by pyarrow's file
systems (file, hdfs, s3, gs); a path without scheme is on Spark's default one.

Defined cases: a null payload is empty; a null url leaves out the target; an
empty table gives no archives; rows that repeat an id and payload are a response
(or revisits) each and refer to that id; a null id is smaller than any other;
where the sample is too small to train on (some dozens of records) the dictionary
is empty and records are compressed without one; control characters of a url are percent-encoded; extra columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm import exact_dedup
from eventlens.llm.common import SLICE_BYTES, cut_lineage
from eventlens.session import scratch_path

#: Payload bytes of an archive, about.
FILE_BYTES = 32 << 20
SAMPLE = 1000
SAMPLE_BYTES = 32 << 10
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: Fixed values of the format: the skippable frame that holds a dictionary, and the zstd frame.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def _target(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id, url: str | None, payload: bytes, keep_id, revisit: bool) -> bytes:
    """One WARC record; a revisit keeps the HTTP headers and leaves out the payload."""
    digest = base32(hashlib.sha1(payload).digest())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)),
              ("WARC-Date", DATE), ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}")]
    if url is not None:
        fields.append(("WARC-Target-URI", _target(url)))
    if page_id is not None:
        fields.append(("Page-ID", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(keep_id, digest))]
        if keep_id is not None:
            fields.append(("Refers-To-Page-ID", str(keep_id)))
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """A record's fields, block and payload; its digests are verified."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"no WARC record: {first[:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha1:{base32(hashlib.sha1(block).digest())}":
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    if fields["WARC-Type"] == "response" and \
            fields["WARC-Payload-Digest"] != f"sha1:{base32(hashlib.sha1(payload).digest())}":
        raise ValueError(f"damaged payload {fields['WARC-Record-ID']}")
    full = next(int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))
    return {"fields": fields, "payload": payload, "payload_bytes": full}


def train(samples: list[bytes]) -> bytes:
    """A Zstandard dictionary, or none if there is too little to learn from."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def leading_frame(dictionary: bytes) -> bytes:
    body = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body


def frames(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive doesn't start with a dictionary")
    raw = zstandard.ZstdDecompressor().decompress(stream.read(size))
    reader = zstandard.ZstdDecompressor(dict_data=_dictionary(raw)) if raw else zstandard.ZstdDecompressor()
    held = stream.read(chunk)
    while held:
        one, parts = reader.decompressobj(), []
        while True:
            parts.append(one.decompress(held))
            if one.eof:
                held = one.unused_data or stream.read(chunk)
                break
            held = stream.read(chunk)
            if not held:
                raise ValueError("the archive ends within a record")
        yield b"".join(parts)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme that Spark gives it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return "file://" + found.removeprefix("file:") if found.startswith("file:/") and not found.startswith("file://") else found


def groups(rows: DataFrame, least_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(digest, keep_id) of the payloads that several rows share: of very many rows (few digests), of others."""
    small = cut_lineage(rows.filter(F.col("size") >= least_bytes).select("id", "__digest"))
    heavy, _, rest = exact_dedup.split_groups(small)
    return heavy.select("__digest", "keep_id"), rest.filter("group_size > 1").select("__digest", "keep_id").distinct()


def with_response(rows: DataFrame, heavy: DataFrame, shared: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(id, url, payload, keep_id, shared) in a fixed order within the tasks; payloads are shuffled once."""
    found = (rows.join(F.broadcast(heavy.withColumnRenamed("keep_id", "heavy_id").withColumn("hot", F.lit(True))),
                       "__digest", "left").withColumn("hot", F.col("hot").isNotNull() & (F.col("size") >= least_bytes)))
    # rows that have no equals to meet are spread by a key of their own
    apart = F.col("hot") | (F.col("size") < least_bytes)
    found = found.withColumn("key", F.when(apart, F.concat(F.lit("-"), F.xxhash64("id", "url").cast("string")).cast("binary"))
                             .otherwise(F.col("__digest")))
    met = found.join(shared.select(F.col("__digest").alias("key"), F.col("keep_id"), F.lit(True).alias("met")), "key", "left")
    return met.sortWithinPartitions("key", "id", "url").select(
        "id", "url", "payload", F.when(F.col("hot"), F.col("heavy_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        (F.col("hot") | F.col("met").isNotNull()).alias("shared"))


def _samples(rows: DataFrame, heavy: DataFrame, shared: DataFrame, n: int) -> list[bytes]:
    """About ``SAMPLE`` of ``n`` records (twice as many at most), by a hash of the id; of long payloads a stretch."""
    below = int(min(1.0, SAMPLE / n) * ((1 << 62) - 1))
    h = F.xxhash64("id", "url").bitwiseAND(F.lit((1 << 62) - 1))
    at = F.when(F.col("size") > SAMPLE_BYTES, h % (F.col("size") - SAMPLE_BYTES + 1)).otherwise(0).cast("int") + 1
    some = rows.filter(h <= below).limit(2 * SAMPLE).select(
        "id", "url", "__digest", F.substring("payload", at, F.lit(SAMPLE_BYTES)).alias("payload"))
    got = some.join(heavy.unionByName(shared).withColumn("shared", F.lit(True)), "__digest", "left").select(
        "id", "url", "payload", "keep_id", "shared").toLocalIterator()
    found = (record(r.id, r.url, bytes(r.payload), r.keep_id, bool(r.shared) and r.id != r.keep_id) for r in got)
    return sorted(found, key=lambda x: hashlib.sha1(x).digest())  # the trainer minds the order


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          least_bytes: int = 0) -> DataFrame:
    """Write archives to ``folder``; (file, records, bytes) of each."""
    folder = qualified(pages.sparkSession, folder)
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))
    base = base.withColumn("size", F.length("payload")).withColumn("__digest", F.unhex(F.sha2("payload", 256)))
    heavy, shared = (cut_lineage(x) for x in groups(base, least_bytes))
    rows = pages.count()
    dictionary = train(_samples(base, heavy, shared, rows)) if rows else b""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open(folder)
        task = TaskContext.get()
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary))
        out, n, held, part = None, 0, 0, 0

        def done() -> pa.RecordBatch:
            size = out.tell()
            out.close()
            files.move(own, posixpath.join(root, name))
            return pa.RecordBatch.from_pydict({"file": [posixpath.join(folder, name)], "records": [n], "bytes": [size]})

        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                page, url, payload, keep, shared = (x.as_py() for x in row)
                if out is None:
                    name = f"part-{task.partitionId():05d}-{part:03d}.warc.zst"
                    own = posixpath.join(root, f"_{name}.{task.taskAttemptId()}")
                    files.create_dir(root, recursive=True)
                    out = files.open_output_stream(own, compression=None)
                    out.write(leading_frame(dictionary))
                out.write(packer.compress(record(page, url, payload, keep, shared and page != keep)))
                n, held = n + 1, held + len(payload)
                if held >= FILE_BYTES:
                    yield done()
                    out, n, held, part = None, 0, 0, part + 1
        if out is not None:
            yield done()

    return cut_lineage(with_response(base, heavy, shared, least_bytes).mapInArrow(
        run, "file string, records long, bytes long"))


def read(archives: DataFrame, id_type: str = "long") -> DataFrame:
    """Per record of the archives in (file): id, url, payload_bytes, payload_digest, record_type, refers_to, payload."""
    kind = pa.int64() if id_type in ("long", "bigint") else pa.string()
    schema = pa.schema([("id", kind), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", kind),
                        ("payload", pa.binary())])

    def number(x: str | None):
        return x if x is None or kind == pa.string() else int(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for file in batch.column(0).to_pylist():
                files, path = _open(file)
                with files.open_input_stream(path, compression=None) as stream:
                    for raw in frames(stream):
                        r = parse(raw)
                        f = r["fields"]
                        rows.append((number(f.get("Page-ID")), f.get("WARC-Target-URI"), r["payload_bytes"],
                                     f["WARC-Payload-Digest"].partition(":")[2], f["WARC-Type"],
                                     number(f.get("Refers-To-Page-ID")),
                                     r["payload"] if f["WARC-Type"] == "response" else None))
                        held += len(raw)
                        if held >= SLICE_BYTES:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, t) for c, t in zip(zip(*rows), schema.types, strict=True)], schema=schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), schema.types, strict=True)], schema=schema)

    what = "long" if kind == pa.int64() else "string"
    # one task an archive
    return archives.select("file").repartition(max(1, archives.count())).mapInArrow(
        run, f"id {what}, url string, payload_bytes long, payload_digest string, record_type string, "
             f"refers_to {what}, payload binary")


def op7_warc(spark, sf_dir: str) -> DataFrame:
    archives = write(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch_path(spark, "warc"))
    return read(archives).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The archives' content, as SQL sees it: base32 of the SHA-1 by groups of five bits.
ORACLE = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, hex,
         array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + (CAST(('0x' || substr(hex, CAST(i // 8 * 10 + 1 AS BIGINT), 10)) AS BIGINT)
                >> CAST(35 - 5 * (i % 8) AS BIGINT)) % 32, 1)), '') AS payload_digest,
         max(page_id) OVER (PARTITION BY hex) AS keep_id
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = keep_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keep_id THEN keep_id END AS refers_to
FROM d
"""
