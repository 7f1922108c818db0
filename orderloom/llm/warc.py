"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that decompress on their own. A bundle ends in a
skippable frame with the sizes and checksums of all frames (the seekable
Zstandard format), so any reader finds a frame without reading what is before
it, and any Zstandard tool unpacks the whole file. The index maps a record's
identifier to bundle, frame, offset in the unpacked frame, and length.

Of records with equal payloads (by SHA-256) that have at least ``least_bytes``, the one of
smallest id is a response with the payload; the others are revisits that carry only the
HTTP header and name that response. Contents that repeat are counted by partial sums; the few that hold more than
a ``HOT_SHARE``-th of all rows are joined by broadcast (fewer than ``HOT_SHARE`` rows, whatever the table), so no shuffled key is hot.

Defined cases: a null payload is empty. Rows that repeat both the smallest id and the payload are all responses, with
one identifier. Null ids come last; if a payload has null ids only, its rows are responses. A record longer
than a frame has a frame to itself. A null or empty address is replaced by the record's identifier. An
empty table makes no bundle. Other columns are ignored.

A task writes bundles under names of its own attempt, and a bundle counts only if the index lists it, so
attempts that were lost leave nothing that is read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.sources.staging import fresh_path, stage

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 1 << 28
LEVEL = 3
HOT_SHARE = 1024
# Magic numbers of skippable frames and of the seek table's footer, and the revisit profile.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
IDENTIFIER = "tag:orderloom,2024:"
INDEX = "record_id string, record_type string, bundle string, frame int, offset long, length long"
RECORD = "record_type string, record_id string, page_id string, target_uri string, refers_to string, first_page string, payload_digest string, payload_bytes long, payload binary"


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder or file, for any scheme that Arrow knows."""
    local = re.sub(r"^file:/+", "/", uri)
    if local.startswith("/"):
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_identifier(page_id, digest: str) -> str:
    return f"<{IDENTIFIER}{'unnamed' if page_id is None else 'page/' + quote(str(page_id), safe='')}/{digest}>"


def page_of(identifier: str | None) -> str | None:
    """The id inside a record identifier; None for rows without one."""
    kind, _, rest = (identifier or "").strip("<>").removeprefix(IDENTIFIER).partition("/")
    return unquote(rest.rpartition("/")[0]) if kind == "page" else None


def record_bytes(kind: str, identifier: str, date: str, block: bytes, content_type: str, **more: str) -> bytes:
    fields = {"WARC-Type": kind, "WARC-Record-ID": identifier, "WARC-Date": date, "Content-Type": content_type, **more, "Content-Length": str(len(block))}
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return b"".join([b"WARC/1.1\r\n", head.encode(), b"\r\n", block, b"\r\n\r\n"])


def page_record(page_id, url: str | None, payload: bytes, refers_to, revisit: bool, date: str) -> tuple[str, str, bytes]:
    """(identifier, type, bytes) of a page's record."""
    digest = payload_digest(payload)
    identifier = record_identifier(page_id, digest)
    more = {
        "WARC-Target-URI": quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else identifier.strip("<>"),
        "WARC-Payload-Digest": f"sha1:{digest}",
    }
    header = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if revisit:
        more |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_identifier(refers_to, digest)}
    kind = "revisit" if revisit else "response"
    return identifier, kind, record_bytes(kind, identifier, date, header if revisit else header + payload, "application/http;msgtype=response", **more)


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """(fields by lower-case name, block, end) of the record that starts at ``at``."""
    split = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:split].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no record at byte {at}")
    fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    start = split + 4
    end = start + int(fields["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at byte {at} is cut off")
    return fields, data[start:end], end + 4


class Bundle:
    """One file that is being written: frames, then their seek table."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.path, self.size, self.frames = path, 0, []
        self.out = store.open_output_stream(path, compression=None)
        self.pack = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, data: bytes) -> int:
        """Write one frame and return its number."""
        packed = self.pack.compress(data)
        self.out.write(packed)
        self.size += len(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        return len(self.frames) - 1

    def close(self) -> None:
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        # The descriptor's highest bit says that entries have checksums.
        footer = struct.pack("<IBI", len(self.frames), 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)
        self.out.close()


def seek_table(source: pa.NativeFile) -> list[tuple[int, int, int, int | None]]:
    """(start, packed size, size, checksum) of each frame, from the end of the file."""
    size = source.size()
    source.seek(size - 9)
    count, descriptor, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE:
        raise ValueError("the file has no seek table")
    width = 12 if descriptor & 0x80 else 8
    source.seek(size - 9 - count * width)
    table, start, out = source.read(count * width), 0, []
    for at in range(0, len(table), width):
        packed, plain, *checksum = struct.unpack_from("<" + "I" * (width // 4), table, at)
        out.append((start, packed, plain, checksum[0] if checksum else None))
        start += packed
    return out


def read_frame(source: pa.NativeFile, start: int, packed: int, plain: int, checksum: int | None) -> bytes:
    source.seek(start)
    data = zstandard.ZstdDecompressor().decompress(source.read(packed), max_output_size=plain)
    if checksum is not None and xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
        raise ValueError(f"the frame at byte {start} is damaged")
    return data


def _writer(folder: str, date: str, frame_bytes: int, bundle_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, (store, root) = TaskContext.get(), file_system(folder)
        bundle, held, size, made = None, [], 0, 0

        def flushed() -> pa.RecordBatch:
            nonlocal held, size
            frame, offset, rows = bundle.add(b"".join(r[2] for r in held)), 0, []
            for identifier, kind, data in held:
                rows.append((identifier, kind, f"{folder}/{bundle.path.rpartition('/')[2]}", frame, offset, len(data)))
                offset += len(data)
            held, size = [], 0
            names = ["record_id", "record_type", "bundle", "frame", "offset", "length"]
            types = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            for at in range(batch.num_rows):
                page_id, url, payload, refers_to, revisit = (c[at].as_py() for c in batch.columns)
                if bundle is None:
                    store.create_dir(root, recursive=True)
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{made:04d}.warc.zst"
                    bundle, made = Bundle(store, f"{root}/{name}"), made + 1
                    info = record_bytes("warcinfo", f"<{IDENTIFIER}{name}>", date, b"format: WARC File Format 1.1\r\n", "application/warc-fields")
                    bundle.add(info)
                record = page_record(page_id, url, payload, refers_to, revisit, date)
                if held and size + len(record[2]) > frame_bytes:
                    yield flushed()
                held.append(record)
                size += len(record[2])
                if size >= frame_bytes:
                    yield flushed()
                if bundle.size >= bundle_bytes and not held:
                    bundle.close()
                    bundle = None
        if held:
            yield flushed()
        if bundle:
            bundle.close()

    return write


@dataclass(frozen=True)
class Archive:
    """A folder of bundles and the staged index of their records."""

    folder: str
    index: DataFrame

    def bundles(self) -> DataFrame:
        return self.index.select("bundle").distinct()


def with_response(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """(page_id, url, payload, refers_to, revisit): every page and, if its payload repeats, the response it revisits."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("content", F.unhex(F.sha2("payload", 256)))
    long_enough = F.octet_length("payload") >= least_bytes
    sums = rows.filter(long_enough).groupBy("content").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
    repeated = stage(sums.filter("n > 1"), "warc-repeated")
    total = repeated.agg(F.sum("n")).first()[0] or 0
    hot = repeated.filter(F.col("n") * HOT_SHARE > total).select("content", F.col("first").alias("hot_first"), F.lit(True).alias("is_hot"))
    rest = repeated.filter(F.col("n") * HOT_SHARE <= total).select(F.col("content").alias("shared"), "first", F.lit(True).alias("is_shared"))
    rows = rows.join(F.broadcast(hot), "content", "left")
    # Rows that are settled already go anywhere: a key of their own keeps them from meeting in one task.
    rows = rows.withColumn("sought", F.when(F.col("is_hot"), F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string")).cast("binary")).otherwise(F.col("content")))
    rows = rows.join(rest, F.col("sought") == F.col("shared"), "left")
    first = F.coalesce("hot_first", "first")
    repeats = F.coalesce("is_hot", "is_shared", F.lit(False)) & ~F.col("page_id").eqNullSafe(first)
    return rows.select("page_id", "url", "payload", F.when(repeats, first).alias("refers_to"), repeats.alias("revisit"))


def write_archive(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_bytes: int = 0, captured: datetime | None = None, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
) -> Archive:
    """One record per row, in bundles of about ``bundle_bytes`` in a folder that all executors share."""
    folder = (folder or fresh_path(pages.sparkSession, "warc")).rstrip("/")
    date = (captured or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = with_response(pages, id_col, url_col, payload_col, least_bytes)
    return Archive(folder, stage(rows.mapInArrow(_writer(folder, date, frame_bytes, bundle_bytes), INDEX), "warc-index"))


def _frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for bundle in batch.column(0).to_pylist():
            store, path = file_system(bundle)
            with store.open_input_file(path) as source:
                table = seek_table(source)
            columns = [pa.array([bundle] * len(table)), pa.array(range(len(table)), pa.int32())]
            columns += [pa.array([f[i] for f in table], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(columns, ["bundle", "frame", "start", "packed", "plain", "checksum"])


FRAME_COLUMNS = ["bundle", "frame", "start", "packed", "plain", "checksum"]


def _parsed(fields: dict[str, str], block: bytes, payloads: bool) -> tuple:
    """A row of RECORD. A response's digest and length are worked out from its bytes and must agree with its fields."""
    header, _, payload = block.partition(b"\r\n\r\n")
    stated = fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(re.search(rb"(?im)^content-length: *(\d+)", header)[1])
    if fields["warc-type"] == "response" and (payload_digest(payload) != stated or len(payload) != size):
        raise ValueError(f"the payload of {fields['warc-record-id']} is not what its digest says")
    identifier = fields["warc-record-id"]
    kept = payload if payloads and fields["warc-type"] == "response" else None
    first = fields.get("warc-refers-to")
    return fields["warc-type"], identifier, page_of(identifier), fields["warc-target-uri"], first, page_of(first), stated, size, kept


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [part.split()[0] for part in RECORD.split(", ")]
    types = [pa.string()] * 7 + [pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _reader(payloads: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, _, *place in zip(*(c.to_pylist() for c in batch.columns)):
                store, path = file_system(bundle)
                with store.open_input_file(path) as source:
                    data = read_frame(source, *place)
                at, rows = 0, []
                while at < len(data):
                    fields, block, at = parse_record(data, at)
                    if fields["warc-type"] != "warcinfo":
                        rows.append(_parsed(fields, block, payloads))
                if rows:
                    yield _batch(rows)

    return read


def read_archive(bundles: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record (RECORD) of the bundles named in ``bundles``, a frame at a time; needs no index.

    Frames, not bundles, are dealt to tasks. A revisit has no payload; digest and length are those of the full one.
    """
    spark = bundles.sparkSession
    schema = "bundle string, frame int, start long, packed long, plain long, checksum long"
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frames = bundles.repartition(width, "bundle").mapInArrow(_frames, schema)
    return frames.repartition(width, "bundle", "frame").mapInArrow(_reader(payloads), RECORD)


def _fetcher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records at known places; rows come sorted by bundle and frame, so a frame is unpacked once."""
    at, source, table, data = (None, None), None, None, b""
    for batch in batches:
        for bundle, frame, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
            if bundle != at[0]:
                if source:
                    source.close()
                store, path = file_system(bundle)
                source = store.open_input_file(path)
                table = seek_table(source)
            if (bundle, frame) != at:
                data, at = read_frame(source, *table[frame]), (bundle, frame)
            fields, block, _ = parse_record(data[offset : offset + length], 0)
            yield _batch([_parsed(fields, block, True)])
    if source:
        source.close()


def fetch_records(archive: Archive, wanted: DataFrame, id_col: str = "record_id") -> DataFrame:
    """The records whose identifiers ``wanted`` lists; only their frames are read."""
    ids = wanted.select(F.col(id_col).alias("record_id")).distinct()
    places = archive.index.join(ids, "record_id", "left_semi").select("bundle", "frame", "offset", "length")
    dealt = places.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")
    return dealt.mapInArrow(_fetcher, RECORD)


def page_digests(archive: Archive, id_type: str) -> DataFrame:
    """Per record read back: the page's id, its payload's length and digest, the record's type and what it refers to."""
    found = read_archive(archive.bundles(), payloads=False)
    own, first = F.col("page_id").cast(id_type), F.col("first_page").cast(id_type)
    return found.select(own.alias("page_id"), "payload_bytes", "payload_digest", "record_type", first.alias("refers_to"))
