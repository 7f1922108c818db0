"""WARC bundles: round trips, the seek table read by hand, revisits, look-ups and odd rows."""

import base64
import glob
import hashlib
import io
import struct
from collections import defaultdict

import pytest
import zstandard
from cases import SF, table

from orderloom.llm import warc
from orderloom.llm.queries import QUERIES

ODD = [
    (1, "https://a.example/?q=ä b\r\nX: y", "<p>one</p>"),
    (2, None, None),
    (3, "", ""),
    (4, "https://b.example/", "<p>one</p>"),
    (5, "https://c.example/", "𝒳 ünï\r\n\r\nWARC/1.1\r\n" * 3),
    (6, "https://d.example/", "long " * 60_000),
    (6, "https://d.example/", "long " * 60_000),
    (6, "https://d.example/", "another text with the same id"),
    (7, "https://d.example/", "long " * 60_000),
    (None, "https://e.example/", "<p>one</p>"),
    (None, "https://e.example/", "without ids"),
    (None, "https://f.example/", "without ids"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1, b"y", True) for i, u, h in rows], "page_id long, url string, html string, bundle string, frame int, payload binary, revisit boolean")


def by_brute_force(rows):
    groups = defaultdict(list)
    for i, _, h in rows:
        groups[h or ""].append(i)
    out = []
    for i, _, h in rows:
        payload = (h or "").encode()
        first = min((x for x in groups[h or ""] if x is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((i, len(payload), digest, "response" if i == first else "revisit", None if i == first else first))
    return sorted(out, key=repr)


def got(archive):
    return sorted((tuple(r) for r in warc.page_digests(archive, "long").collect()), key=repr)


def test_pages_query(spark):
    assert sorted((tuple(r) for r in QUERIES["op11_warc"](spark, SF).collect()), key=repr) == by_brute_force(table("pages"))


@pytest.mark.parametrize("frame_bytes, bundle_bytes", [(1, 1), (2000, 3000), (1 << 20, 1 << 28)])
def test_odd_rows(spark, frame_bytes, bundle_bytes):
    archive = warc.write_archive(frame(spark, ODD).repartition(3), frame_bytes=frame_bytes, bundle_bytes=bundle_bytes)
    assert got(archive) == by_brute_force(ODD)
    payloads = {(r.page_id, bytes(r.payload).decode()) for r in warc.read_archive(archive.bundles()).collect() if r.record_type == "response"}
    assert payloads == {("1", "<p>one</p>"), ("2", ""), ("5", ODD[4][2]), ("6", ODD[5][2]), ("6", ODD[7][2]), (None, "without ids")}
    assert warc.page_digests(warc.write_archive(frame(spark, ODD).limit(0)), "long").count() == 0


def test_hot_payloads_and_payloads_in_a_few_copies(spark, monkeypatch):
    monkeypatch.setattr(warc, "HOT_SHARE", 3)
    rows = [(i, "u", "hot" if i % 3 == 0 else f"pair {i // 4}" if i % 3 == 1 else f"single {i}") for i in range(300)]
    assert got(warc.write_archive(frame(spark, rows).repartition(4))) == by_brute_force(rows)


def test_short_payloads_are_all_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    found = warc.page_digests(warc.write_archive(frame(spark, rows), least_bytes=3), "long").collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in found) == [(1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)]


def unpacked_by_hand(path):
    """(frames by the seek table, the whole file unpacked by a plain decompressor)."""
    data = open(path, "rb").read()
    count, descriptor, magic = struct.unpack("<IBI", data[-9:])
    assert magic == 0x8F92EAB1 and descriptor == 0x80
    start_of_table = len(data) - 9 - 12 * count
    assert struct.unpack("<II", data[start_of_table - 8 : start_of_table]) == (0x184D2A5E, 12 * count + 9)
    frames, at = [], 0
    for k in range(count):
        packed, plain, _ = struct.unpack_from("<III", data, start_of_table + 12 * k)
        frames.append(zstandard.ZstdDecompressor().decompress(data[at : at + packed], max_output_size=plain))
        at += packed
    assert at == start_of_table - 8
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data[:at]), read_across_frames=True).read()
    return frames, whole


def test_index_and_seek_table_agree_with_the_files(spark, tmp_path):
    archive = warc.write_archive(frame(spark, ODD).repartition(2), folder=str(tmp_path / "bundles"), frame_bytes=500)
    files = {p: unpacked_by_hand(p) for p in glob.glob(str(tmp_path / "bundles" / "*.warc.zst"))}
    rows = archive.index.collect()
    assert len(rows) == len(ODD) and {r.bundle for r in rows} == set(files)
    for frames, whole in files.values():
        assert b"".join(frames) == whole and whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    for r in rows:
        record = files[r.bundle][0][r.frame][r.offset : r.offset + r.length]
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert f"WARC-Record-ID: {r.record_id}\r\nWARC-Date: ".encode() in record
        assert f"WARC-Type: {r.record_type}\r\n".encode() in record


def test_fetch_reads_the_records_asked_for(spark):
    archive = warc.write_archive(frame(spark, ODD).repartition(2), frame_bytes=800)
    asked = [r.record_id for r in archive.index.collect() if r.record_type == "revisit"][:2] + ["<tag:unknown>"]
    found = warc.fetch_records(archive, spark.createDataFrame([(a, 1) for a in asked], "record_id string, frame int")).collect()
    assert {r.record_id for r in found} == set(asked[:2]) and all(r.record_type == "revisit" and r.payload is None for r in found)
    one = [r.record_id for r in archive.index.collect() if warc.page_of(r.record_id) == "5"]
    assert [bytes(r.payload).decode() for r in warc.fetch_records(archive, spark.createDataFrame([(one[0],)], "record_id string")).collect()] == [ODD[4][2]]


def test_damage_is_noticed(spark, tmp_path):
    archive = warc.write_archive(frame(spark, ODD[4:5]), folder=str(tmp_path / "bundles"))
    path = glob.glob(str(tmp_path / "bundles" / "*.warc.zst"))[0]
    data = bytearray(open(path, "rb").read())
    data[-12] ^= 1  # a checksum in the seek table
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="damaged"):
        got(archive)
