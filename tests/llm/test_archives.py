"""ARC files written, read and converted; what is odd or damaged; the WARC files by a plain reader."""

import base64
import gzip
import hashlib
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tollgate.llm import arc

DATE = "20240101000000"


def head(version, date=DATE):
    return arc.arc_head(version, "old.arc", date) + b"\n"


def record(version, uri, block, date=DATE, mime="text/html", size=None):
    extra = "" if version == 1 else "200 - - 0 old.arc "
    return f"{uri} 10.0.0.1 {date} {mime} {extra}{len(block) if size is None else size}\n".encode() + block + b"\n"


def http(body, name=None):
    named = f"X-Page-Id: {name}\r\n" if name is not None else ""
    return f"HTTP/1.0 200 OK\r\n{named}Server: x\r\n\r\n".encode() + body


def parsed(content):
    return list(arc.parse_arc(content, "d/old.arc", True))


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [False, True])
def test_records_of_both_versions(version, packed):
    parts = [
        head(version), record(version, "http://a.org/x y z", http(b"\n\nfiledesc: http://b.org 1 2\n", 7)),
        record(version, "dns:a.org", b"a.org 1 IN A 1.1.1.1\n", mime="text/dns"), record(version, "http://e.org/", b""),
        record(version, "ftp://b.org/f", bytes(range(256)), "200001", "no-type"),
    ]
    got = parsed(b"".join(gzip.compress(p) for p in parts) if packed else b"".join(parts))
    assert [r[7] for r in got] == ["warcinfo", "response", "response", "resource", "resource"]
    assert [r[2] for r in got] == [version] * 5 and all(r[11] is None for r in got)
    assert got[1][3] == "http://a.org/x y z" and got[1][8] == "7"
    body = b"\n\nfiledesc: http://b.org 1 2\n"
    assert got[1][12].endswith(b"\r\n\r\n" + body) and got[1][9] == len(body)
    assert got[4][12] == bytes(range(256)) and got[4][5] == "2024-01-01T00:00:00Z"  # not a date: the archive's
    starts = [0]
    for p in parts:
        starts.append(starts[-1] + len(p))
    assert [r[1] for r in got] == starts[:5]


def test_damage_is_told_and_the_rest_read():
    good = record(1, "http://a.org/", http(b"x"))
    got = parsed(head(1) + b"no header at all\n" + good + b"http://b.org/ 1.1.1.1 20240101 text/html\n" + good)
    assert [r[11] for r in got] == [None, "skipped", "skipped"]
    got = parsed(head(1) + good + record(1, "http://c.org/", b"HTTP/1.0 200 OK\r\n\r\nabc", size=10**15))
    assert [r[11] for r in got] == [None, None, "truncated"] and got[2][9] == 4
    whole = gzip.compress(head(1)) + gzip.compress(good) + gzip.compress(good * 50)
    got = [r[11] for r in parsed(whole[:-30])]
    assert got[:2] == [None, None] and got[-1] == "unreadable" and 2 <= len(got) <= 53
    spoilt = gzip.compress(head(1)) + gzip.compress(good) + b"\x1f\x8b\x08\x00" + b"\xff" * 40 + gzip.compress(good)
    assert [r[11] for r in parsed(spoilt)] == [None, None, "unreadable"]
    assert [r[11] for r in parsed(gzip.compress(head(1) + good) + b"\0" * 100)] == [None, None]
    assert parsed(b"") == [] and parsed(b"\n\n") == []


@pytest.mark.parametrize(
    "digits, want",
    [
        ("20010203040506", "2001-02-03T04:05:06Z"), ("20010203", "2001-02-03T00:00:00Z"), ("2001020304", "2001-02-03T04:00:00Z"),
        ("200102030405", "2001-02-03T04:05:00Z"), ("20011303", None), ("2001", None), ("-", None), ("20010203250000", None),
    ],
)
def test_times(digits, want):
    assert arc.iso_time(digits) == want


def test_payload_starts_after_the_header():
    assert arc.payload_at(b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nx\n\ny") == 25
    assert arc.payload_at(b"HTTP/1.1 200 OK\nA: b\n\nx\r\n\r\n") == 22
    assert arc.payload_at(b"HTTP/1.1 200 OK") == 15 and arc.payload_at(b"<html>") == 0


def warcs(folder):
    """The records of a folder by a reader of its own, as (header, block)."""
    out = []
    for name in sorted(os.listdir(folder)):
        content = b""
        if name.startswith("part-"):
            content = gzip.decompress(open(f"{folder}/{name}", "rb").read())
        while content:
            lines, _, rest = content.partition(b"\r\n\r\n")
            fields = dict(x.decode().split(": ", 1) for x in lines.split(b"\r\n")[1:])
            size = int(fields["Content-Length"])
            assert lines.startswith(b"WARC/1.1\r\n") and rest[size : size + 4] == b"\r\n\r\n"
            out.append((fields, rest[:size]))
            content = rest[size + 4 :]
    return out


def b32(content):
    return base64.b32encode(hashlib.sha1(content).digest()).decode()


PAGES = [
    (1, "http://a.org/1", "<p>same</p>"), (2, "http://a.org/2", "<p>other</p>"), (3, None, "<p>same</p>"), (4, "a b\n\tc", None),
    (5, "", ""), (6, "http://é.org/ü", "ü" * 30_000), (7, "http://a.org/7", "x\r\n\r\nWARC/1.1\r\n\r\n"), (2, "http://a.org/2", "<p>other</p>"),
    (None, "http://a.org/n", "<p>nameless</p>"), (9, "http://a.org/9", "y" * 3_000_000),
]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("archives"))
    rows = [(*r, "x", 1) for r in PAGES]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, name string, archive int").repartition(3)
    arc.write_arc(pages, f"{base}/arc", archive_bytes=100)
    arc.convert(spark, f"{base}/arc", f"{base}/warc", prefer=F.expr("try_cast(name AS bigint)"))
    return f"{base}/arc", f"{base}/warc"


def test_pages_survive_as_arc(spark, folders):
    rows = arc.read_arc(spark, folders[0]).where("type = 'response'").collect()
    got = Counter((r["name"], bytes(r["block"][arc.payload_at(r["block"]) :])) for r in rows)
    assert got == Counter((None if i is None else str(i), (t or "").encode()) for i, _, t in PAGES)
    assert {r["version"] for r in rows} == {1, 2} and all(r["damage"] is None for r in rows)
    assert {r["uri"] for r in rows if r["name"] in ("3", "4", "5", "6")} == {"about:blank", "a%20b%0A%09c", "http://é.org/ü"}


def test_converted_records_by_a_plain_reader(spark, folders):
    found = warcs(folders[1])
    ids = [f["WARC-Record-ID"] for f, _ in found]
    assert len(set(ids)) == len(ids)
    infos = {f["WARC-Record-ID"] for f, _ in found if f["WARC-Type"] == "warcinfo"}
    by_id = {f["WARC-Record-ID"]: (f, b) for f, b in found}
    kinds = Counter()
    for fields, block in found:
        assert fields["WARC-Block-Digest"] == f"sha1:{b32(block)}" and fields["WARC-Date"] == "2024-01-01T00:00:00Z"
        kinds[fields["WARC-Type"]] += 1
        if fields["WARC-Type"] == "warcinfo":
            continue
        assert fields["WARC-Warcinfo-ID"] in infos and fields["Content-Type"] == arc.HTTP
        if fields["WARC-Type"] == "response":
            assert fields["WARC-Payload-Digest"] == f"sha1:{b32(block[arc.payload_at(block):])}"
        else:
            first, content = by_id[fields["WARC-Refers-To"]]
            assert fields["WARC-Profile"] == arc.REVISIT and block.endswith(b"\r\n\r\n")
            assert first["WARC-Type"] == "response" and first["WARC-Payload-Digest"] == fields["WARC-Payload-Digest"]
            assert first["WARC-Target-URI"] == fields["WARC-Refers-To-Target-URI"]
            assert len(content) - arc.payload_at(content) == int(fields["X-Payload-Length"])
    assert kinds["response"] == 7 and kinds["revisit"] == 3


def test_who_repeats_whom(spark, folders):
    rows = arc.read_warc(spark, folders[1], blocks=False).where("type <> 'warcinfo'")
    rows = rows.withColumn("first", arc.name_of(F.col("refers_to"))).collect()
    got = {(r["name"], r["type"], r["first"]) for r in rows}
    assert {("1", "revisit", "3"), ("3", "response", None), ("4", "revisit", "5"), ("5", "response", None)} <= got
    assert {("2", "response", None), ("2", "revisit", "2"), (None, "response", None)} <= got
    assert all(r["damage"] is None for r in rows) and {r["payload_bytes"] for r in rows if r["name"] == "6"} == {60_000}


def test_short_payloads_and_dates(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [("http://a/1", b"long page", "2003"), ("http://a/2", b"long page", "2001"), ("http://a/3", b"s", "2002"), ("http://a/4", b"s", "2001")]
    parts = [record(1, u, http(b), f"{y}0101") for u, b, y in rows] + [record(1, "http://a/5", http(b"long page"), size=10**6)]
    (tmp_path / "in" / "x.arc").write_bytes(head(1) + b"".join(parts))
    arc.convert(spark, str(tmp_path / "in"), str(tmp_path / "out"), least=5)
    got = {f.get("WARC-Target-URI"): f for f, _ in warcs(str(tmp_path / "out"))}
    assert [got[f"http://a/{i}"]["WARC-Type"] for i in range(1, 6)] == ["revisit", "response", "response", "response", "response"]
    assert got["http://a/1"]["WARC-Refers-To-Date"] == "2001-01-01T00:00:00Z" and got["http://a/1"]["WARC-IP-Address"] == "10.0.0.1"
    assert got["http://a/5"]["WARC-Truncated"] == "unspecified" and "WARC-Truncated" not in got["http://a/2"]


def test_a_page_that_a_third_of_the_rows_hold(spark, path, monkeypatch):
    monkeypatch.setattr(arc, "HEAVY", 10)
    rows = [(i, "u", "same" if i % 3 == 0 else "pair" if i in (1, 2) else f"own {i}") for i in range(300)]
    arc.write_arc(spark.createDataFrame(rows, "page_id long, url string, html string"), path("arc"))
    narrow = arc.read_arc(spark, path("arc"), blocks=False)
    got = arc.repeats(narrow, F.expr("try_cast(name AS bigint)")).groupBy("first.name").count().collect()
    assert {r["name"]: r["count"] for r in got} == {"297": 99, "2": 1}


def test_no_pages(spark, path):
    arc.write_arc(spark.createDataFrame([], "page_id long, url string, html string"), path("arc"))
    arc.convert(spark, path("arc"), path("warc"))
    assert arc.read_arc(spark, path("arc")).count() == 0 and arc.read_warc(spark, path("warc")).count() == 0
