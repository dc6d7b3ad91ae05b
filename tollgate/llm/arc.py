"""Legacy archives: ARC files are read by their declared lengths and rewritten as WARC.

An ARC file opens with a version block, whose second line names the fields of every
record's header line: five in version 1, ten in version 2. A record is that line, as
many bytes as its last field says, and a line end. Addresses may hold spaces, so the
fields are cut off from the right. What WARC wants and ARC lacks is synthesised: an
identifier (archive, position in it, and the page's own name where a header gives one),
an ISO time from 8 to 14 digits, a type from what the block is, and SHA-1 digests of
block and payload.

An archive is read by one task, record by record. Conversion reads archives twice: the
first pass leaves one narrow row a record, which decides who repeats whom; the second
writes. Payloads are shuffled only if the list of repeats is too long for Spark to
broadcast. Digests that more than a thousandth of all records share are joined by a
broadcast of at most a thousand rows, so a page that a third of the rows hold does not
land in one task.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import urllib.parse
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.session import scratch, stored

#: An archive is closed after so many compressed bytes; memory follows it.
ARCHIVE_BYTES = 32 << 20
#: Rows handed on at once.
BATCH_BYTES = 4 << 20
#: Compressed bytes unpacked at once.
READ = 1 << 14
#: A digest of more than one in so many records is joined by broadcast.
HEAVY = 1000
#: The HTTP header that holds a page's own name.
NAME = "X-Page-Id"

# The formats' own names.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"

ARC_SCHEMA = (
    "archive string, position long, version int, uri string, ip string, date string, mime string, type string, "
    "name string, payload_bytes long, payload_digest string, damage string, block binary"
)
WARC_SCHEMA = (
    "archive string, position long, record_id string, type string, date string, uri string, mime string, "
    "name string, refers_to string, payload_bytes long, payload_digest string, damage string, block binary"
)
_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def digest(content: bytes) -> str:
    return base64.b32encode(hashlib.sha1(content).digest()).decode()


def payload_at(block: bytes) -> int:
    """Where the payload of a block starts: after the header of an HTTP response."""
    if not block.startswith(b"HTTP/"):
        return 0
    ends = [at + len(gap) for gap in (b"\r\n\r\n", b"\n\n") if (at := block.find(gap)) >= 0]
    return min(ends, default=len(block))


def header_value(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*?)[ \t]*\r?$", head)
    return found[1].decode("utf-8", "replace") if found else None


def iso_time(digits: str) -> str | None:
    """2001-02-03T04:05:06Z of 20010203040506; hours and less may lack and are then zero."""
    if not re.fullmatch(r"\d{8}(\d\d){0,3}", digits):
        return None
    d = digits.ljust(14, "0")
    if not ("01" <= d[4:6] <= "12" and "01" <= d[6:8] <= "31" and d[8:10] < "24" and d[10:12] < "60" and d[12:] < "61"):
        return None
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


# ---------------------------------------------------------------- writing archives


def _batches(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size; the last column may be large."""
    kinds = pa.schema([(n, _ARROW[t]) for n, t in (c.split() for c in schema.split(", "))])

    def batch(held: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds.types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=kinds)

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + len(row[-1] or b"")
        if size >= BATCH_BYTES:
            yield batch(held)
            held, size = [], 0
    if held:
        yield batch(held)


def _member(content: bytes) -> bytes:
    return gzip.compress(content, compresslevel=1, mtime=0)


def _chunks(members: Iterator[bytes], limit: int) -> Iterator[tuple[bytes]]:
    """Members joined to archives of about ``limit`` bytes."""
    parts, held = [], 0
    for member in members:
        parts.append(member)
        held += len(member)
        if held >= limit:
            yield (b"".join(parts),)
            parts, held = [], 0
    if parts:
        yield (b"".join(parts),)


def _save(archives: DataFrame, path: str) -> None:
    """Each row as a file of its own, by Spark's writer: any file system, safe to retry.

    The writer ends a file with its line separator, here an empty gzip member.
    """
    (
        archives.select(F.col("archive").cast("string").alias("value"))
        .write.option("encoding", "ISO-8859-1").option("lineSep", _member(b"").decode("latin-1"))
        .option("maxRecordsPerFile", 1).text(path)
    )


def arc_head(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 tollgate\n{FIELDS[version]}\n".encode()
    extra = "" if version == 1 else f"200 - - 0 {name} "
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {extra}{len(body)}\n".encode() + body


def write_arc(
    pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url", html: str = "html",
    date: str = "20240101000000", versions: tuple[int, ...] = (1, 2), archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Pages as gzipped ARC files, the archives of a task taking ``versions`` in turn.

    A page becomes an HTTP response whose header names it; a null html is an empty body,
    a null page_id leaves the name out, and a null or empty url is written as
    ``about:blank``. Blanks and control characters of an url are percent-encoded.
    Repeated rows repeat; no rows give no archive.
    """
    chosen = pages.select(
        F.col(page_id).cast("string").alias("id"), F.col(url).alias("url"), F.col(html).cast("binary").alias("html")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def responses() -> Iterator[tuple[str, bytes]]:
            for batch in batches:
                for i in range(batch.num_rows):
                    key, address, body = (batch.column(k)[i].as_py() for k in range(3))
                    named = f"{NAME}: {key}\r\n" if key is not None else ""
                    body = body or b""
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{named}Content-Length: {len(body)}\r\n\r\n"
                    address = re.sub(r"[\x00-\x20\x7f\s]", lambda m: urllib.parse.quote(m[0]), address or "about:blank")
                    yield address, head.encode() + body

        def archives() -> Iterator[tuple[bytes]]:
            parts, held, made, position = [], 0, 0, 0
            for address, block in responses():
                if not parts:
                    version, name = versions[(part + made) % len(versions)], f"pages-{part:06d}-{made:06d}.arc"
                    opening = arc_head(version, name, date) + b"\n"
                    parts, position, made = [_member(opening)], len(opening), made + 1
                    held = len(parts[0])
                extra = "" if version == 1 else f"200 - - {position} {name} "
                line = f"{address} 0.0.0.0 {date} text/html {extra}{len(block)}\n".encode()
                position += len(line) + len(block) + 1
                parts.append(_member(line + block + b"\n"))
                held += len(parts[-1])
                if held >= archive_bytes:
                    yield (b"".join(parts),)
                    parts = []
            if parts:
                yield (b"".join(parts),)

        yield from _batches(archives(), "archive binary")

    _save(chosen.mapInArrow(run, "archive binary"), path)


# ---------------------------------------------------------------- reading archives


class Members(io.RawIOBase):
    """The content of gzip members, one after the other. What lies before damage can be
    read; there the stream ends, and is ``broken``."""

    def __init__(self, content: bytes):
        self.content, self.at, self.member, self.ready = memoryview(content), 0, None, memoryview(b"")
        self.broken = False

    def readable(self) -> bool:
        return True

    def readinto(self, into: memoryview) -> int:
        while not self.ready and not self.broken:
            if self.member is None:
                if self.at == len(self.content) or self.content[self.at] == 0:  # zeros may fill up a file
                    return 0
                self.member = zlib.decompressobj(31)
            some = self.content[self.at : self.at + READ]
            self.at += len(some)
            try:
                self.ready = memoryview(self.member.decompress(some))
            except zlib.error:
                self.broken = True
                break
            if self.member.eof:
                self.at -= len(self.member.unused_data)
                self.member = None
            elif not some:
                self.broken = True
        n = min(len(into), len(self.ready))
        into[:n] = self.ready[:n]
        self.ready = self.ready[n:]
        return n


def _opened(content: bytes) -> tuple[io.BufferedIOBase, Members | None]:
    if content[:2] != b"\x1f\x8b":
        return io.BytesIO(content), None
    members = Members(content)
    return io.BufferedReader(members, 1 << 16), members


def _taken(source: io.BufferedIOBase, size: int) -> bytes:
    """So many bytes, or what is left; a wrong length asks for no memory of its own."""
    if size <= 1 << 24:
        return source.read(size)
    parts = []
    while size > 0 and (part := source.read(min(size, 1 << 24))):
        parts.append(part)
        size -= len(part)
    return b"".join(parts)


def _typed(uri: str, block: bytes) -> str:
    if block.startswith(b"HTTP/") or uri.startswith("dns:"):
        return "response"
    return "resource"


def _fields(line: bytes, names: list[str]) -> dict[str, str] | None:
    """A header line by its field names, cut off from the right; None if it is none."""
    cut = line.rstrip(b"\r\n").decode("utf-8", "replace").rsplit(" ", len(names) - 1)
    if len(cut) != len(names) or not cut[-1].isdigit() or not cut[0]:
        return None
    found = dict(zip(names, cut, strict=True))
    return found if re.fullmatch(r"\d{4,14}|-", found["Archive-date"]) else None


def parse_arc(content: bytes, archive: str, blocks: bool) -> Iterator[tuple]:
    """The records of one archive as rows of ARC_SCHEMA.

    A version block's own length is kept to, and so is each record's. A line that is no
    header is passed over, and so are those after it up to the next header; that is
    reported with the record found (damage ``skipped``). A block that ends early is kept
    as ``truncated``; a broken gzip member ends the archive (``unreadable``).
    """
    (source, members), position, names, version, opened, skipped = _opened(content), 0, FIELDS[1].split(), 1, None, False
    while line := source.readline():
        start = position
        position += len(line)
        if not line.strip():
            continue
        own = line.startswith(b"filedesc:")
        if own:  # its form is known only from the block that follows
            forms = [n.split() for n in (FIELDS[2], FIELDS[1])]
            fields = next((f for f in (_fields(line, n) for n in forms) if f), None)
        else:
            fields = _fields(line, names)
        if fields is None:
            skipped = True
            continue
        size = int(fields["Archive-length"])
        block = _taken(source, size)
        position += len(block)
        damage = "truncated" if len(block) < size else "skipped" if skipped else None
        skipped = False
        uri, kind = fields["URL"], "warcinfo" if own else _typed(fields["URL"], block)
        date = iso_time(fields["Archive-date"]) or opened
        if own:
            opened = date
            lines = block.split(b"\n", 2)
            number = lines[0].split(b" ")[0]
            version = int(number) if number.isdigit() else 1
            if len(lines) > 1 and lines[1].split()[:1] == [b"URL"]:
                names = lines[1].decode("ascii", "replace").split()
        at = payload_at(block)
        name = header_value(block[:at], NAME) if at else None
        yield (
            archive, start, version, uri, fields["IP-address"], date, fields["Content-type"], kind,
            name, len(block) - at, digest(block[at:]), damage, block if blocks else None,
        )
    if members and members.broken:
        yield (archive, position, version, None, None, opened, None, None, None, None, None, "unreadable", None)


def parse_warc(content: bytes, archive: str, blocks: bool) -> Iterator[tuple]:
    """The records of one WARC file as rows of WARC_SCHEMA.

    Digests and sizes are those of the payload found; a revisit, which holds none, gives
    those its header states. A digest that is not the stated one is damage ``digest``.
    """
    (source, members), position = _opened(content), 0
    while line := source.readline():
        start = position
        position += len(line)
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {start} of {archive}")
        head: dict[str, str] = {}
        while (line := source.readline()).strip():
            position += len(line)
            key, _, value = line.decode("utf-8", "replace").partition(":")
            head[key.strip().lower()] = value.strip()
        position += len(line)
        size = int(head["content-length"])
        block = _taken(source, size)
        position += len(block)
        at = payload_at(block) if head.get("content-type", "").startswith("application/http") else 0
        said = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
        damage = "truncated" if len(block) < size else None
        if head["warc-type"] == "revisit":
            length, found = int(head.get("x-payload-length", -1)), said
        else:
            length, found = len(block) - at, digest(block[at:])
            damage = damage or ("digest" if said not in (None, found) else None)
        yield (
            archive, start, head["warc-record-id"], head["warc-type"], head.get("warc-date"),
            head.get("warc-target-uri"), head.get("content-type"), header_value(block[:at], NAME) if at else None,
            head.get("warc-refers-to"), length, found, damage, block if blocks else None,
        )
    if members and members.broken:
        yield (archive, position, None, None, None, None, None, None, None, None, None, "unreadable", None)


def _read(spark: SparkSession, path: str, parse: Callable, schema: str, blocks: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield from parse(batch.column(1)[i].as_py(), batch.column(0)[i].as_py(), blocks)

        return _batches(rows(), schema)

    files = spark.read.format("binaryFile").load(path).where("length > 0")
    found = files.select("path", "content").mapInArrow(run, schema)
    return found if blocks else found.drop("block")


def read_arc(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """Every record of the ARC files in ``path``, gzipped or not, see `parse_arc`."""
    return _read(spark, path, parse_arc, ARC_SCHEMA, blocks)


def read_warc(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """Every record of the WARC files in ``path``, gzipped or not, see `parse_warc`."""
    return _read(spark, path, parse_warc, WARC_SCHEMA, blocks)


# ---------------------------------------------------------------- conversion


def identifier(archive: str, position: int, name: str | None) -> str:
    """The same at every conversion, and another for every record of archives whose file
    names differ."""
    own = urllib.parse.quote(archive.rpartition("/")[2], safe="")
    return f"<urn:arc:{own}:{position}:{urllib.parse.quote(name or '', safe='')}>"


def name_of(record_id: Column) -> Column:
    """The page's own name in an identifier; null if it has none."""
    return F.nullif(F.regexp_extract(record_id, r"^<urn:arc:[^:]*:\d+:([^>]*)>$", 1), F.lit(""))


def repeats(records: DataFrame, prefer: Column, least: int = 0) -> DataFrame:
    """Which records repeat another's payload, and whose: archive, position, first (struct).

    ``records`` has a row for each record, as `read_arc` without blocks. Of responses
    with equal payloads of at least ``least`` bytes, the one of the largest ``prefer``
    stays, ties to the larger archive and position; the rest are returned.
    """
    key = ["payload_digest", "payload_bytes"]
    some = records.where(F.col("type") == "response").where(F.col("damage").isNull() | (F.col("damage") == "skipped"))
    some = some.where(F.col("payload_bytes") >= least)
    best = F.max(F.struct(prefer.alias("prefer"), "archive", "position", "name", "uri", "date"))
    groups = stored(some.groupBy(*key).agg(best.alias("first"), F.count("*").alias("n")).where("n > 1"), "arc-groups")
    heavy = F.col("n") * HEAVY > some.count()
    large = F.broadcast(groups.where(heavy))  # at most HEAVY rows
    rows = some.select("archive", "position", *key)
    both = rows.join(large, key).unionByName(
        rows.join(large.select(*key), key, "left_anti").join(groups.where(~heavy), key)
    )
    other = (F.col("first.archive") != F.col("archive")) | (F.col("first.position") != F.col("position"))
    first = F.struct(*[F.col(f"first.{c}") for c in ("archive", "position", "name", "uri", "date")])
    return both.where(other).select("archive", "position", first.alias("first"))


def warc_record(r: dict, opened: str | None) -> bytes:
    """One record with its header, identifiers and digests; ``opened`` names its archive's."""
    block, kind, first = r["block"] or b"", r["type"], r["first"]
    at = payload_at(block)
    http = block.startswith(b"HTTP/")
    head = [
        ("WARC-Type", "revisit" if first else kind),
        ("WARC-Record-ID", identifier(r["archive"], r["position"], r["name"])),
        ("WARC-Date", r["date"] or "1970-01-01T00:00:00Z"),
    ]
    if kind != "warcinfo":
        head.append(("WARC-Target-URI", r["uri"]))
        if re.fullmatch(r"[0-9a-fA-F:.]+", r["ip"] or "") and r["ip"] != "0.0.0.0":
            head.append(("WARC-IP-Address", r["ip"]))
        head.append(("WARC-Warcinfo-ID", opened))
        head.append(("WARC-Payload-Digest", f"sha1:{r['payload_digest']}"))
    if first:
        head += [
            ("WARC-Profile", REVISIT),
            ("WARC-Refers-To", identifier(first["archive"], first["position"], first["name"])),
            ("WARC-Refers-To-Target-URI", first["uri"]),
            ("WARC-Refers-To-Date", first["date"]),
            ("X-Payload-Length", str(r["payload_bytes"])),
        ]
        block = block[:at]
    if r["damage"] == "truncated":
        head.append(("WARC-Truncated", "unspecified"))
    mime = "application/warc-fields" if kind == "warcinfo" else HTTP if http else r["mime"]
    if kind == "warcinfo":  # the version block, line by line
        lines = block.decode("utf-8", "replace").split("\n")
        block = "".join(f"arc-header: {x}\r\n" for x in lines if x.strip()).encode()
    head += [("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Type", mime), ("Content-Length", str(len(block)))]
    text = "".join(f"{k}: {v}\r\n" for k, v in head if v)
    return f"WARC/1.1\r\n{text}\r\n".encode() + block + b"\r\n\r\n"


def convert(
    spark: SparkSession, arcs: str, out: str, *, prefer: Column | None = None, least: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """The ARC files in ``arcs`` as gzipped WARC files in ``out``, a gzip member a record.

    Responses with equal payloads become one response and revisits of it, see `repeats`;
    by default the earliest record stays. The version block becomes a warcinfo record,
    to which the archive's records refer. Truncated blocks are kept and marked; what
    cannot be read is left out, and `read_arc` names it. Files are Spark's part files:
    readers go by content, not by extension. No archives give none.
    """
    if prefer is None:
        prefer = -F.unix_timestamp(F.to_timestamp("date"))
    narrow = stored(read_arc(spark, arcs, blocks=False), "arc-records")
    known = stored(repeats(narrow, prefer, least), "arc-repeats")
    rows = read_arc(spark, arcs).where(F.col("damage").isNull() | (F.col("damage") != "unreadable"))
    rows = rows.join(known, ["archive", "position"], "left")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def members() -> Iterator[bytes]:
            for batch in batches:
                for i in range(batch.num_rows):
                    r = {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}
                    yield _member(warc_record(r, identifier(r["archive"], 0, None)))

        return _batches(_chunks(members(), archive_bytes), "archive binary")

    _save(rows.mapInArrow(run, "archive binary"), out)


def op11_legacy_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as ARC files of both versions, converted, and read back from the WARC files."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    arcs, warcs = scratch(spark, "arc"), scratch(spark, "warc")
    write_arc(pages, arcs)
    convert(spark, arcs, warcs, prefer=F.expr("try_cast(name AS bigint)"))
    records = read_warc(spark, warcs, blocks=False).where("type IN ('response', 'revisit')")
    return records.select(
        F.col("name").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), name_of(F.col("refers_to")).cast("long").alias("refers_to"),
    )


_SQL = """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), coded AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + (((('0x' || substr(h, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT), 1)), '')
    AS payload_digest
  FROM hashed
), firsts AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM coded
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""

QUERIES = {"op11_legacy_archives": op11_legacy_archives}
ORACLES = {"op11_legacy_archives": _SQL}
