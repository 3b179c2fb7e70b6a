"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames of about ``frame_bytes`` each; every frame is compressed on its own,
frames follow each other in a bundle, and the bundle ends with a seek table: a skippable frame that
lists the compressed and plain size of each frame. Any Zstandard reader can read a bundle from front
to back; a reader of the table can fetch one frame. The index maps record identifiers to (bundle,
frame, offset in the frame's plain bytes), so one record costs one frame.

Writing runs in Spark tasks. A bundle's name has a random part, and only bundles named in the index
(which Spark commits task by task) count: what a lost or repeated attempt has left is never read.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.llm._common import map_batches, scratch_path, staged, utf8

FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 256 << 20
LEVEL = 3
MIN_REVISIT_BYTES = 100
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the formats
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_TABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(uri: str):
    fs, path = pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)
    return fs, path


# ---- records -------------------------------------------------------------------------------------

def record_id(page_id, url, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id!r} {url!r} {digest}')}>"


def _one_line(s: str) -> str:
    return "".join(c if c > " " and c != "%" else "".join(f"%{b:02X}" for b in c.encode()) for c in s)


def make_record(page_id, url, payload: bytes, digest: str, refers_to: str | None, date: str = DATE) -> tuple[str, bytes]:
    """A record's identifier and bytes. A revisit carries the response's HTTP header without its
    payload and names the record it refers to."""
    rid = record_id(page_id, url, digest)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {rid}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_one_line(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return rid, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(plain: bytes) -> Iterator[tuple[int, dict, bytes]]:
    """Offset, header fields and block of each record in a frame."""
    at = 0
    while at < len(plain):
        end = plain.index(b"\r\n\r\n", at)
        lines = plain[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        size = int(head["Content-Length"])
        yield at, head, plain[end + 4:end + 4 + size]
        at = end + 8 + size


def payload_of(block: bytes) -> bytes:
    return block[block.index(b"\r\n\r\n") + 4:]


# ---- bundles -------------------------------------------------------------------------------------

class BundleWriter:
    def __init__(self, out, level: int = LEVEL):
        self.out, self.sizes, self.plain, self.held, self.written = out, [], 0, [], 0
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True)

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame and offset of the record."""
        where = (len(self.sizes), self.plain)
        self.held.append(record)
        self.plain += len(record)
        return where

    def end_frame(self) -> None:
        if self.held:
            packed = self.zstd.compress(b"".join(self.held))
            self.out.write(packed)
            self.sizes.append((len(packed), self.plain))
            self.written += self.plain
            self.held, self.plain = [], 0

    def close(self) -> None:
        self.end_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEK_TABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)


def seek_table(f) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of each frame, from the bundle's footer alone."""
    f.seek(0, io.SEEK_END)
    end = f.tell()
    f.seek(end - 9)
    n, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEK_TABLE_MAGIC:
        raise ValueError("no seek table")
    f.seek(end - 9 - 8 * n)
    sizes = struct.iter_unpack("<II", f.read(8 * n))
    out, at = [], 0
    for packed, plain in sizes:
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(f, offset: int, packed: int, plain: int) -> bytes:
    f.seek(offset)
    return zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=plain)


# ---- Spark ---------------------------------------------------------------------------------------

_INDEX = "bundle string, record_id string, page_id long, frame long, at long, size long"


def _write_batches(folder: str, frame_bytes: int, bundle_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        rows: list[tuple] = []
        out = writer = name = None

        def finish():
            writer.close()
            out.close()
            batch = pa.RecordBatch.from_pylist([dict(zip(("bundle", "record_id", "page_id", "frame", "at", "size"), r)) for r in rows],
                                               schema=pa.schema([("bundle", pa.string()), ("record_id", pa.string()), ("page_id", pa.int64()),
                                                                 ("frame", pa.int64()), ("at", pa.int64()), ("size", pa.int64())]))
            rows.clear()
            return batch

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "_payload", "digest", "refers_to"))):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    writer = BundleWriter(out)
                rid, record = make_record(*row)
                frame, at = writer.add(record)
                rows.append((f"{folder}/{name}", rid, row[0], frame, at, len(record)))
                if writer.plain >= frame_bytes:
                    writer.end_frame()
                if writer.written >= bundle_bytes:
                    yield finish()
                    out = None
        if out is not None:
            yield finish()
    return run


def decide(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages as ``page_id, url, _payload, digest, refers_to`` (record to refer to, null: response).

    Of rows with equal payloads of ``min_bytes`` or more, those with the smallest page_id are
    responses (several only if that page_id repeats), the rest revisit it. A null page_id is never
    the smallest; payloads that only rows without page_id have are all responses.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), utf8("html").alias("_payload"))
    rows = rows.withColumn("digest", F.sha2("_payload", 256))
    first = (rows.filter(F.length("_payload") >= min_bytes).groupBy("digest")
             .agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")).alias("first"), F.count("*").alias("n"))
             .filter("n > 1 and first.page_id is not null").select(F.col("digest"), F.col("first.page_id").alias("_p"), F.col("first.url").alias("_u")))
    met = rows.join(first, "digest", "left")
    again = F.col("_p").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_p"))
    return met.select("page_id", "url", "_payload", "digest", F.when(again, F.struct("_p", "_u")).alias("_to"))


def _with_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        to = [None if t is None else record_id(t["_p"], t["_u"], d) for t, d in zip(b.column("_to").to_pylist(), b.column("digest").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(c) for c in ("page_id", "url", "_payload", "digest")] + [pa.array(to, pa.string())],
                                         names=["page_id", "url", "_payload", "digest", "refers_to"])


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES, frame_bytes: int = FRAME_BYTES,
                   bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write one record a row to bundles in ``folder`` and return the index (``bundle, record_id,
    page_id, frame, at, size``), which is stored beside them in ``index``.

    Null html is an empty payload; null url or page_id leave out their header. Other columns are not
    read. Repeated rows are records of their own with one identifier. No rows: an empty index.
    """
    write = _write_batches(folder, frame_bytes, bundle_bytes)

    def run(batches):
        return write(_with_ids(batches))

    map_batches(decide(pages, min_bytes), run, _INDEX).write.parquet(f"{folder}/index")
    return read_index(pages.sparkSession, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(f"{folder}/index")


def _frame_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for uri in b.column("bundle").to_pylist():
            fs, path = _open(uri)
            with fs.open_input_file(path) as f:
                t = seek_table(f)
            yield pa.RecordBatch.from_arrays(
                [pa.array([uri] * len(t), pa.string()), pa.array(range(len(t)), pa.int64())] + [pa.array([x[k] for x in t], pa.int64()) for k in range(3)],
                names=["bundle", "frame", "offset", "packed", "plain"])


_RECORD = "bundle string, frame long, at long, record_id string, page_id long, url string, record_type string, refers_to_record string, digest string, payload binary"


def _record_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("bundle", pa.string()), ("frame", pa.int64()), ("at", pa.int64()), ("record_id", pa.string()), ("page_id", pa.int64()),
                        ("url", pa.string()), ("record_type", pa.string()), ("refers_to_record", pa.string()), ("digest", pa.string()), ("payload", pa.binary())])
    for b in batches:
        for r in b.to_pylist():
            fs, path = _open(r["bundle"])
            with fs.open_input_file(path) as f:
                plain = read_frame(f, r["offset"], r["packed"], r["plain"])
            cols: list[list] = [[] for _ in schema]
            for at, head, block in parse_records(plain):
                kind = head["WARC-Type"]
                payload = payload_of(block) if kind == "response" else None
                digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                if payload is not None and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
                values = (r["bundle"], r["frame"], at, head["WARC-Record-ID"], int(head["X-Page-ID"]) if "X-Page-ID" in head else None,
                          head.get("WARC-Target-URI"), kind, head.get("WARC-Refers-To"), digest, payload)
                for c, v in zip(cols, values):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def read_archives(index: DataFrame) -> DataFrame:
    """Every record of the bundles that ``index`` names: seek tables first, then frames dealt over
    the cluster. Payload digests are checked; a revisit has no payload of its own."""
    bundles = staged(index.select("bundle").distinct(), "bundles")
    frames = map_batches(bundles, _frame_batches, "bundle string, frame long, offset long, packed long, plain long")
    n = max(index.sparkSession.sparkContext.defaultParallelism, 1)
    return map_batches(staged(frames, "frames").repartition(max(n, 8)), _record_batches, _RECORD)


def fetch(index: DataFrame, record_ids: list[str]) -> DataFrame:
    """Single records by identifier: only the frames that hold them are read."""
    want = index.filter(F.col("record_id").isin(record_ids)).select("bundle", "frame", "record_id").distinct()
    frames = map_batches(want.select("bundle").distinct(), _frame_batches, "bundle string, frame long, offset long, packed long, plain long")
    frames = frames.join(want.select("bundle", "frame").distinct(), ["bundle", "frame"], "left_semi")
    return map_batches(frames.select("bundle", "frame", "offset", "packed", "plain"), _record_batches, _RECORD).filter(F.col("record_id").isin(record_ids))


def op3_warc(spark, sf_dir: str) -> DataFrame:
    index = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch_path(spark, "warc"))
    records = staged(read_archives(index).select("record_id", "page_id", "record_type", "refers_to_record", "digest",
                                                 F.length("payload").cast("long").alias("n")), "warc-records")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = records.filter("record_type = 'response'")
    full = (responses.groupBy(F.col("record_id").alias("refers_to_record"))
            .agg(F.min("page_id").alias("refers_to"), F.min("n").alias("payload_bytes"), F.min("digest").alias("payload_digest")))
    # only revisits look anything up: responses, whose reference is null, would all meet in one task
    again = records.filter("record_type <> 'response'").join(full, "refers_to_record").select(*columns)
    return responses.select("page_id", F.col("n").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type",
                            F.lit(None).cast("long").alias("refers_to")).unionByName(again)


OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     g AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest,
                  min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM g
"""
