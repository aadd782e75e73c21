"""WARC archives: round trips, revisits, and salvage of damaged ones."""

import base64
import gzip
import hashlib
import random

import pytest
from harrow.llm import common, warc


def digest(x: bytes) -> str:
    return base64.b32encode(hashlib.sha1(x).digest()).decode()


def brute(rows, least=0):
    first, out = {}, {}
    for page, html in sorted(rows):
        body = (html or "").encode()
        if len(body) >= least:
            first.setdefault(body, page)
        lead = first.get(body, page)
        out[page] = (len(body), digest(body), "response" if lead == page else "revisit", None if lead == page else lead)
    return out


ODD = ["<p>x</p>", None, "", "<p>x</p>", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "line\n" * 50, "a\x00b", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "z" * 200_000]


@pytest.mark.parametrize("least", [0, 9])
def test_round_trip(spark, least):
    rows = [(i, h) for i, h in enumerate(ODD)]
    df = spark.createDataFrame([(i, f"http://e.x/{i}\r\nEvil: 1", h, "clash") for i, h in rows], "page_id long, url string, html string, record_type string")
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df, least).collect()}
    assert got == brute(rows, least)


def test_round_trip_of_repeated_and_null_page_ids(spark):
    rows = [(None, "A"), (None, "B"), (5, "A"), (5, "C"), (5, "D"), (7, "A"), (8, "D"), (9, None), (9, "E"), (None, "B")]
    df = spark.createDataFrame([(i, None, h) for i, h in rows], "page_id long, url string, html string")
    got = sorted(map(repr, ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df).collect())))
    lead = {(7, "A"): 5, (8, "D"): 5}
    want = [(i, len(h or ""), digest((h or "").encode()), "revisit" if (i, h) in lead else "response", lead.get((i, h))) for i, h in rows]
    assert got == sorted(map(repr, want))


def test_round_trip_reports_gaps(spark, monkeypatch):
    monkeypatch.setattr(warc, "VERSION", "WARX/1.1")
    df = spark.createDataFrame([(1, "u", "A")], "page_id long, url string, html string")
    with pytest.raises(RuntimeError, match="no record"):
        warc.round_trip(df).collect()


def test_pages(spark, sf):
    df = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df).collect()}
    assert got == brute([(r.page_id, r.html) for r in df.collect()])
    assert warc.round_trip(df.limit(0)).count() == 0


def record(i: int, body: bytes) -> bytes:
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Payload-Digest: sha1:{digest(body)}\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def read(data: bytes):
    got = list(warc.salvage(data))
    assert [x[1] for x in got] == sorted(x[1] for x in got)
    return [warc_id(h) for k, _, _, h, _ in got if k == "record"], [(s, e) for k, s, e, _, _ in got if k == "gap"]


def warc_id(head: dict) -> int:
    number = head["warc-record-id"][10:-1]
    return int(number) if number.isdigit() else -1


def test_salvage_of_plain_archives():
    parts = [record(i, bytes([65 + i]) * 40) for i in range(5)]
    whole = b"".join(parts)
    assert read(whole) == ([0, 1, 2, 3, 4], [])
    at = len(parts[0])
    for damage in (
        lambda p: p.replace(b"Content-Length: 40", b"Content-Length: x0"), lambda p: p.replace(b"BBBB", b"BBxB", 1), lambda p: p[:60], lambda p: b"\x00" * 90,
        lambda p: p.replace(b"Content-Length: 40", b"Content-Length: 99999"), lambda p: p.replace(b"WARC/1.1", b"WARX/1.1"), lambda p: p + b"junk",
    ):
        bad = damage(parts[1])
        ids, gaps = read(b"".join([parts[0], bad, *parts[2:]]))
        assert ids in ([0, 2, 3, 4], [0, 1, 2, 3, 4]) and len(gaps) == 1
        assert at <= gaps[0][0] and gaps[0][1] == at + len(bad)
    assert read(whole[:-30]) == ([0, 1, 2, 3], [(len(whole) - len(parts[4]), len(whole) - 30)])
    assert read(b"") == ([], [])


def test_salvage_of_gzip_members():
    parts = [gzip.compress(record(i, b"x" * 500)) for i in range(4)]
    bad = bytearray(parts[1])
    bad[len(bad) // 2] ^= 0xFF
    ids, gaps = read(b"".join([parts[0], bytes(bad), *parts[2:]]))
    assert ids == [0, 2, 3] and gaps == [(len(parts[0]), len(parts[0]) + len(bad))]


def test_salvage_inside_gzip_members():
    parts = [record(i, bytes(random.Random(i).choices(range(256), k=400))) for i in range(50)]
    z = gzip.compress(b"".join(parts))
    cut = z[: len(z) * 3 // 4]
    ids, gaps = read(cut + gzip.compress(record(77, b"later")))
    assert ids[-1] == 77 and ids[:-1] == list(range(len(ids) - 1)) and len(ids) > 30 and gaps
    bad = bytearray(z)
    bad[-6] ^= 1  # the checksum alone
    ids, gaps = read(bytes(bad))
    assert ids == list(range(50)) and len(gaps) == 1 and gaps[0][1] == len(z)
    inner = gzip.compress(parts[0] + b"damage" + parts[1])
    got = list(warc.salvage(b"x" * 9 + inner))
    assert [(x[0], x[1], x[2]) for x in got] == [("gap", 0, 9)] + [(k, 9, 9 + len(inner)) for k in ("record", "gap", "record")]
    assert got[2][3] == {"inner-start": str(len(parts[0])), "inner-end": str(len(parts[0]) + 6)}
    assert read(gzip.compress(b"") + gzip.compress(record(3, b"z"))) == ([3], [])


def test_salvage_of_odd_numbers(spark, tmp_path):
    good = record(1, b"ok")
    for size in ("\u00b2", "\u0663", "9" * 5000, "-3", ""):
        bad = good.replace(b"Content-Length: 2", f"Content-Length: {size}".encode())
        assert read(bad + good) == ([1], [(0, len(bad))])
    odd = good.replace(b"page:1>", b"page:" + b"9" * 30 + b">").replace(b"Content-Length", "WARC-Payload-Length: \u00b2\r\nContent-Length".encode())
    (tmp_path / "a.warc").write_bytes(odd)
    (row,) = warc.read_archives(spark, str(tmp_path))[0].collect()
    assert row.page_id is None and row.payload_length is None and bytes(row.body) == b"ok"


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    from pyspark.sql import functions as F

    sizes = [5] * 40 + [3000] * 9 + [70_000] * 3
    df = spark.createDataFrame([(i, "u", "x" * n + str(i)) for i, n in enumerate(sizes)], "page_id long, url string, html string")
    path = str(tmp_path / "out")
    warc.write_archives(df.coalesce(1), path, most_bytes=1 << 16)
    records, gaps = warc.read_archives(spark, path)
    assert gaps.count() == 0 and records.count() == len(sizes)
    per = records.groupBy("file").agg(F.sum(F.octet_length("body")).alias("b"), F.count(F.lit(1)).alias("n")).collect()
    assert all(r.b <= 1 << 16 or r.n == 1 for r in per) and all(r.file.endswith(".gz") for r in per)


def test_salvage_never_loses_whole_records():
    r = random.Random(2)
    for _ in range(200):
        parts = [record(i, bytes(r.choice(b"ab\r\nW") for _ in range(r.randint(0, 60)))) for i in range(6)]
        hit = r.randrange(6)
        p = bytearray(parts[hit])
        p[r.randrange(len(p))] ^= 1 << r.randrange(8)
        ids, _ = read(b"".join([*parts[:hit], bytes(p), *parts[hit + 1 :]]))
        assert set(range(6)) - {hit} <= set(ids)


def test_read_archives_logs_gaps(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(record(7, b"one") + b"damage" + record(8, b"two"))
    records, gaps = warc.read_archives(spark, str(tmp_path))
    assert sorted((r.page_id, bytes(r.body)) for r in records.collect()) == [(7, b"one"), (8, b"two")]
    assert [(g.start, g.end) for g in gaps.collect()] == [(len(record(7, b"one")), len(record(7, b"one")) + 6)]


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(200, 200 + i) for i in range(1, 40)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {x.id: x.component_id for x in common.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert common.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_damaged_archives_take_linear_time():
    """64 MB of records that all fail their digest, and of torn members, with one good record at the end."""
    import gzip
    import time

    good = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    bad = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    torn = gzip.compress(bytes(range(256)) * 40)[:-5]
    for piece, size in ((bad, 64_000_000), (torn, 8_000_000)):
        data = piece * (size // len(piece)) + good
        began = time.time()
        found = list(warc.salvage(data))
        assert [x[0] for x in found] == ["gap", "record"] and found[0][2] == len(data) - len(good) and time.time() - began < 40
