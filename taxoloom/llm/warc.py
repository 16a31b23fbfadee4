"""WARC archives in seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, then a skippable frame with the record index, then the
seek table of the public seekable format (a skippable frame that ends in the magic number 0x8F92EAB1).
Each frame holds whole WARC records; the index maps a record's number to its frame and its offset in that frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxoloom.llm.common import materialize, scratch_path

#: Fixed values of the seekable format.
SKIPPABLE_SEEK, SKIPPABLE_INDEX, SEEKABLE = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = "none"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, sha: str, refers_to: int | None, revisit: bool) -> bytes:
    """A response record, or a revisit that holds the HTTP head alone and names the record it repeats."""
    block = HTTP % len(payload) + (b"" if revisit else payload)
    name = NO_ID if page_id is None else str(page_id)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{name}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append(f"WARC-Target-URI: {''.join(c if c > ' ' else '%%%02X' % ord(c) for c in url)}")
    head.append(f"WARC-Payload-Digest: sha1:{sha}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers (lower case) and block of the record at ``at``, and where the next one begins."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record at {at}")
    head = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
    start = end + 4
    stop = start + int(head["content-length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError(f"record at {at} has a wrong length")
    return head, data[start:stop], stop + 4


class Bundle:
    """Writes one bundle: add records, then close for its index."""

    def __init__(self, out, frame_bytes: int, level: int):
        self.out, self.frame_bytes, self.level = out, frame_bytes, level
        self.held: list[bytes] = []
        self.size = self.at = 0
        self.frames: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int]] = []

    def add(self, rec: bytes) -> None:
        self.index.append((len(self.frames), self.size, len(rec)))
        self.held.append(rec)
        self.size += len(rec)
        if self.size >= self.frame_bytes:
            self.flush()

    def flush(self) -> None:
        if self.held:
            packed = zstandard.ZstdCompressor(level=self.level).compress(b"".join(self.held))
            self.out.write(packed)
            self.frames.append((self.at, len(packed), self.size))
            self.at += len(packed)
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        index = b"".join(struct.pack("<III", *x) for x in self.index)
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        table = b"".join(struct.pack("<II", c, n) for _, c, n in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)
        self.out.close()


class Reader:
    """Random access to a bundle: ``frames`` from the seek table, ``index`` from the record index."""

    def __init__(self, file):
        self.file = file
        size = file.seek(0, 2)
        n, flags, magic = struct.unpack("<IBI", self.read(size - 9, 9))
        if magic != SEEKABLE or flags & 0x7F:
            raise ValueError("no seek table")
        width = 12 if flags & 0x80 else 8
        table = size - 9 - n * width - 8
        entries = self.read(table + 8, n * width)
        self.frames, at = [], 0
        for i in range(n):
            packed, whole = struct.unpack_from("<II", entries, i * width)
            self.frames.append((at, packed, whole))
            at += packed
        raw = self.read(at, table - at)
        kind, length = struct.unpack_from("<II", raw)
        if kind != SKIPPABLE_INDEX:
            raise ValueError("no record index")
        self.index = list(struct.iter_unpack("<III", raw[8 : 8 + length]))

    def read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def frame(self, k: int) -> bytes:
        at, packed, whole = self.frames[k]
        return zstandard.ZstdDecompressor().decompress(self.read(at, packed), max_output_size=whole)

    def record(self, number: int) -> tuple[dict[str, str], bytes]:
        k, offset, length = self.index[number]
        return parse(self.frame(k)[offset : offset + length], 0)[:2]


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages(page_id, payload)`` -> distinct ``(page_id, sha, refers_to)`` of the pages that another repeats.

    Of equal payloads (SHA-1 and length) of at least ``min_bytes``, that with the largest page_id is the response.
    """
    slim = pages.select("page_id", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("n")).where(F.col("n") >= min_bytes)
    last = slim.groupBy("sha", "n").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("rows")).where("rows > 1 and refers_to is not null")
    return (
        slim.join(last, ["sha", "n"])
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select("page_id", "sha", "refers_to")
        .distinct()
    )


def write_bundles(pages: DataFrame, folder: str, min_bytes: int = 0, frame_bytes: int = 256 << 10, bundle_bytes: int = 64 << 20, level: int = 3) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as bundles below ``folder``; returns the manifest.

    The manifest ``(bundle, record, page_id, frame, offset, length, frame_at, frame_packed, frame_bytes)`` is a
    table in ``folder``, written when all bundles are. A task that is tried again writes bundles of other
    names, so the manifest names whole ones only. Null html is an empty payload; a payload of any length is one record in a frame
    of its own. Repeated rows are repeated records; a null page_id is written as ``none``. Other columns are not read. An empty
    table writes an empty manifest.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    named = revisits(rows, min_bytes)
    whole = rows.withColumn("own", F.sha1("payload"))
    marked = whole.join(named, whole.page_id.eqNullSafe(named.page_id) & (whole.own == named.sha), "left").select(whole.page_id, "url", "payload", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        bundle, name, ids = None, "", []

        def done() -> pa.RecordBatch:
            bundle.close()
            frames = bundle.frames
            cols = list(zip(*((i, p, *x, *frames[x[0]]) for i, (p, x) in enumerate(zip(ids, bundle.index, strict=True))), strict=True))
            return pa.RecordBatch.from_arrays([pa.array([name] * len(ids)), *(pa.array(c, pa.int64()) for c in cols)], [n.split()[0] for n in MANIFEST.split(", ")])

        for b in batches:
            for page, url, payload, ref in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                if bundle is None:
                    name, ids = f"{uuid.uuid4().hex}.warc.zst", []
                    bundle = Bundle(fs.open_output_stream(f"{base}/{name}", compression=None), frame_bytes, level)
                bundle.add(record(page, url, payload, digest(payload), ref, ref is not None))
                ids.append(page)
                if bundle.at >= bundle_bytes:
                    yield done()
                    bundle = None
        if bundle is not None:
            yield done()

    marked.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


MANIFEST = "bundle string, record long, page_id long, frame long, offset long, length long, frame_at long, frame_packed long, frame_bytes long"


def read_bundles(manifest: DataFrame, folder: str, part_bytes: int = 32 << 20) -> DataFrame:
    """Read records by frames: ``(page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload)``.

    A row of work is a frame, read by its place in the bundle; frames are dealt out by their bytes. A response's digest is checked against
    its payload; a revisit's ``payload`` is null and its length is that of its HTTP head.
    """
    work = materialize(manifest.groupBy("bundle", "frame", "frame_at", "frame_packed", "frame_bytes").agg(F.count("*").alias("records")), "frames")
    # The rows are small whatever they stand for: by their own size all would go to one task.
    spark = manifest.sparkSession
    parts = max(-(-(work.agg(F.sum("frame_bytes")).first()[0] or 0) // part_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    work = work.repartition(parts, "bundle", "frame").sortWithinPartitions("bundle", "frame")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        name, f = None, None
        for b in batches:
            for x in b.to_pylist():
                if name != x["bundle"]:
                    name, f = x["bundle"], fs.open_input_file(f"{base}/{x['bundle']}")
                f.seek(x["frame_at"])
                data = zstandard.ZstdDecompressor().decompress(f.read(x["frame_packed"]), max_output_size=x["frame_bytes"])
                out, at = [], 0
                while at < len(data):
                    head, block, at = parse(data, at)
                    http, _, body = block.partition(b"\r\n\r\n")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    sha = head["warc-payload-digest"].removeprefix("sha1:")
                    revisit = head["warc-type"] == "revisit"
                    if not revisit and (len(body) != size or digest(body) != sha):
                        raise ValueError(f"{head['warc-record-id']}: its payload doesn't match its digest")
                    page = head["warc-record-id"][10:-1]
                    out.append((None if page == NO_ID else int(page), head.get("warc-target-uri"), head["warc-type"], int(head["warc-refers-to"][10:-1]) if revisit else None, sha, size, None if revisit else body))
                if len(out) != x["records"]:
                    raise ValueError(f"{x['bundle']}: frame {x['frame']} has {len(out)} records of {x['records']}")
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), KINDS, strict=True)], NAMES)

    return work.mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary")


NAMES = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
KINDS = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages as bundles and read them back. See :func:`write_bundles` for nulls, long payloads and repeated rows."""
    folder = scratch_path(spark, "warc")
    return read_bundles(write_bundles(pages, folder, min_bytes), folder)
