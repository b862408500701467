"""Archives: round trips, damage and revisits."""

import base64
import hashlib
import io
import random

import pytest

from tidewatch.llm import warc


def archive(n, compress):
    rnd = random.Random(3)
    parts = []
    for i in range(n):
        payload = bytes(rnd.randrange(32, 127) for _ in range(rnd.randrange(400)))
        if i == 2:
            payload = b"inside: WARC/1.1\r\n\r\n and \x1f\x8b\x08 more" * 5
        data = warc.record(str(i), f"http://x/{i}", payload, warc.digest32(payload), None)
        parts.append(warc._member(data) if compress else data)
    return parts


def names(data):
    got = list(warc.read_stream(io.BytesIO(data)))
    at = 0
    for kind, start, end, _, _ in got:  # no byte is left out or told twice
        assert start == at and end > start
        at = end
    assert at == len(data)
    return [g[3]["warc-record-id"] if g[0] == "record" else ("gap", g[1], g[2]) for g in got]


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("chunk", [7, 1 << 20])
def test_damage_costs_only_its_record(monkeypatch, compress, chunk):
    monkeypatch.setattr(warc, "CHUNK", chunk)
    parts = archive(7, compress)
    whole = [f"<urn:page:{i}>" for i in range(7)]
    assert names(b"".join(parts)) == whole
    at = sum(map(len, parts[:3]))
    gap = ("gap", at, at + len(parts[3]))
    broken = bytearray(b"".join(parts))
    broken[at + len(parts[3]) // 2] ^= 0xFF
    assert names(bytes(broken)) == whole[:3] + [gap] + whole[4:]
    broken = bytearray(b"".join(parts))
    broken[at] = 0
    assert names(bytes(broken)) == whole[:3] + [gap] + whole[4:]
    junk = b"\x00junk" * 50
    assert names(junk + b"".join(parts[:2]) + junk + b"".join(parts[2:])) == [("gap", 0, 250), *whole[:2], ("gap", 250 + len(parts[0] + parts[1]), 500 + len(parts[0] + parts[1])), *whole[2:]]
    cut = b"".join(parts)[:-5]
    last = sum(map(len, parts[:6]))
    assert names(cut) == whole[:6] + [("gap", last, len(cut))]
    assert names(b"") == []


def brute(rows, least):
    out = []
    for p, h in rows:
        data = (h or "").encode()
        same = [q for q, g in rows if (g or "") == (h or "") and q is not None]
        first = min(same, default=None)
        revisit = len(data) >= least and p is not None and p != first
        out.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 4])
def test_round_trip(spark, least):
    rows = [(5, "<p>a</p>"), (3, "<p>a</p>"), (9, "<p>a</p>"), (1, None), (2, ""), (4, "é" * 70000), (6, "b\r\n\r\nWARC/1.1\r\n"), (None, "<p>a</p>"), (7, "xy"), (8, "xy"), (3, "<p>a</p>")]
    pages = spark.createDataFrame([(p, None if i % 4 == 3 else f"http://x/ {i}\r\n", h, "x") for i, (p, h) in enumerate(rows)], "page_id long, url string, html string, kind string")
    assert sorted((tuple(r) for r in warc.round_trip(spark, pages, least).collect()), key=str) == brute(rows, least)
    assert warc.round_trip(spark, pages.filter("false"), least).count() == 0


def test_query_against_brute_force(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    assert sorted((tuple(r) for r in warc.round_trip(spark, pages).collect()), key=str) == brute([(r.page_id, r.html) for r in pages.collect()], 0)


def test_damaged_files_through_spark(spark, tmp_path):
    parts = archive(5, True)
    data = bytearray(b"".join(parts))
    data[len(parts[0]) + 40] ^= 0x55
    (tmp_path / "a.warc.gz").write_bytes(data)
    (tmp_path / "b.warc").write_bytes(b"".join(archive(3, False)))
    (tmp_path / "c.warc").write_bytes(b"")
    paths = spark.createDataFrame([(f"file://{tmp_path}/{x}",) for x in ("a.warc.gz", "b.warc", "c.warc")], "path string")
    by_path = warc.read(paths)
    by_content = warc.read_content(spark.read.format("binaryFile").load(str(tmp_path)))
    for got in (by_path, by_content):
        rows = got.collect()
        assert sum(r.kind == "record" for r in rows) == 7 and [(r.start, r.end) for r in rows if r.kind == "gap"] == [(len(parts[0]), len(parts[0]) + len(parts[1]))]
        assert all(warc.digest32(r.payload) == r.payload_digest for r in rows if r.kind == "record")
