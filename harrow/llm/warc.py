"""Operator 9: WARC archives, written through Spark's text writer and read back by a salvage reader."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of SHA-1: eight times five hex digits give four base32 digits."""
    hexed = F.sha1(payload)
    part = lambda i: F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0")
    return F.translate(
        F.concat(*[part(i) for i in range(8)]), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def _described(pages: DataFrame) -> DataFrame:
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select("page_id", "url", "html", F.octet_length(body).cast("long").alias("payload_bytes"), base32_sha1(body).alias("payload_digest"))


def first_pages(pages: DataFrame, least: int = 0) -> DataFrame:
    """payload_digest, payload_bytes and _first (smallest page_id) of payloads of `least` or more bytes that several rows have."""
    rows = _described(pages).where(F.col("payload_bytes") >= least)
    found = rows.groupBy("payload_digest", "payload_bytes").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return common.materialize(found, "first-pages")


def plan_records(pages: DataFrame, first: DataFrame) -> DataFrame:
    """payload_bytes, payload_digest, record_type and refers_to of every page row, beside its page_id, url and html.

    Among equal payloads (digest and length) of `first`, the smallest page_id is the response; a page without an id is always
    one, as nothing could refer to its payload. All is computed on the row itself, as page_ids may repeat; a payload that a
    third of all pages share is split by skew-join handling.
    """
    other = F.coalesce(F.col("_first") != F.col("page_id"), F.lit(False))
    return _described(pages).join(first, ["payload_digest", "payload_bytes"], "left").select(
        "page_id", "url", "html", "payload_bytes", "payload_digest",
        F.when(other, "revisit").otherwise("response").alias("record_type"), F.when(other, F.col("_first")).alias("refers_to"),
    )


def _record(kind: Column, page: Column, url: Column, digest: Column, refers: Column, full: Column, body: Column) -> Column:
    """A whole record but for its last line feed, which the text writer adds."""
    crlf = "\r\n"
    return F.concat(
        F.lit(VERSION + crlf + "WARC-Type: "), kind, F.lit(crlf + "WARC-Record-ID: <urn:page:"), page.cast("string"), F.lit(">"),
        F.lit(f"{crlf}WARC-Date: {DATE}{crlf}WARC-Target-URI: "), F.regexp_replace(F.coalesce(url, F.lit("")), "[\\r\\n]", "%0A"),
        F.lit(crlf + "WARC-Payload-Digest: sha1:"), digest, F.lit(crlf + "WARC-Payload-Length: "), full.cast("string"),
        F.when(refers.isNotNull(), F.concat(F.lit(crlf + "WARC-Refers-To: <urn:page:"), refers.cast("string"), F.lit(">"))).otherwise(F.lit("")),
        F.lit(crlf + "Content-Length: "), F.octet_length(body).cast("string"), F.lit(crlf + crlf), body, F.lit(crlf + "\r"),
    )


def write_archives(pages: DataFrame, path: str, least: int = 0, most_bytes: int = 64 << 20) -> None:
    """Write one record a page row under path, as gzipped WARC files of about most_bytes of payload at most, or one larger record.

    The text writer puts a record and a line feed after each, which is all a WARC file is; so any store that Spark writes
    to will do, and a retried task replaces its file. It rolls files by number of records, so pages are written in three
    classes of size, each with as many records a file as fit in most_bytes. A null page_id gives an empty id, which reads
    back as null.
    """
    first = first_pages(pages, least)
    size = F.octet_length(F.coalesce(F.col("html"), F.lit("")))
    bounds = [0, most_bytes >> 12, most_bytes >> 6, None]
    for name, lo, hi in zip(("small", "middle", "large"), bounds[:-1], bounds[1:], strict=True):
        plan = plan_records(pages.where((size >= lo) & (size < hi if hi else F.lit(True))), first)
        kind = F.col("record_type")
        text = _record(
            kind, F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.col("url"), F.col("payload_digest"), F.col("refers_to"),
            F.col("payload_bytes"), F.when(kind == "revisit", "").otherwise(F.coalesce(F.col("html"), F.lit(""))),
        )
        out = plan.select(text.alias("value")).write.option("lineSep", "\n").option("compression", "gzip")
        with common.shuffle_files_go(pages.sparkSession):
            out.option("maxRecordsPerFile", most_bytes // hi if hi else 1).text(f"{path}/{name}")
    common.discard(first)


# --- salvage reader ---------------------------------------------------------------------------------------------------

_HEAD = re.compile(rb"WARC/1\.[01]\r\n")
_FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")
_GZIP = b"\x1f\x8b\x08"


def _number(text: str | None) -> int | None:
    """A count in plain ASCII digits that a long can hold, else None."""
    return int(text) if text and len(text) <= 18 and text.isascii() and text.isdigit() else None


def _record_at(data: bytes, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """Headers, block and end of the record that starts at `at`, or None if any check fails."""
    m = _HEAD.match(data, at)
    if not m:
        return None
    at, head = m.end(), {}
    while not data.startswith(b"\r\n", at):
        m = _FIELD.match(data, at)
        if not m:
            return None
        head[m[1].decode("latin-1").strip().lower()] = m[2].decode("utf-8", "replace")
        at = m.end()
    size = _number(head.get("content-length"))
    if size is None or not head.get("warc-type") or not head.get("warc-record-id"):
        return None
    at += 2
    end = at + size
    if end > len(data) or not data.startswith(b"\r\n\r\n", end):
        return None
    block = data[at:end]
    digest = head.get("warc-payload-digest", "")
    if head.get("warc-type") == "response" and digest.startswith("sha1:"):
        if base64.b32encode(hashlib.sha1(block).digest()).decode() != digest[5:]:
            return None
    return head, block, end + 4


def _member(data: bytes, at: int, step: int = 1 << 16) -> tuple[bytes, int, bool]:
    """(what the gzip member at `at` holds, where reading it ended, whether it passed its checks).

    Read a step at a time; the step in which an error comes up is read again in small ones, so nothing before it is lost.
    """
    z, out, view = zlib.decompressobj(31), [], memoryview(data)
    while not z.eof and at < len(data):
        before = z.copy()
        try:
            out.append(z.decompress(view[at : at + step]))
            at = min(len(data), at + step)
        except zlib.error:
            if step == 1:
                return b"".join(out), at, False
            z, step = before, max(1, step >> 8)
    return b"".join(out), at - len(z.unused_data), z.eof


def salvage(data: bytes, offset: int = 0) -> Iterator[tuple[str, int, int, dict[str, str], bytes]]:
    """Records and gaps of one archive: ("record" or "gap", start, end, headers, block).

    Works on plain archives and on gzip members of one or many records. When a check fails (version line, header syntax, fields,
    length, closing blank lines, payload digest, gzip checksum), the bytes up to the next version line or gzip member that itself
    yields a record are logged as a gap and reading goes on from there. A torn or corrupt member gives the good records of
    what could be decompressed; the bytes after that are a gap. Bad bytes between the records inside a member are a gap with the
    member's place as start and end and their own place in its contents as headers inner-start and inner-end.
    """
    at, bad, n = 0, None, len(data)
    ahead = {b"WARC/1.": -1, _GZIP: -1}  # the next place of each mark, looked for again only once it is passed
    while at < n:
        found, end, whole = [], at, True
        if data.startswith(_GZIP, at):
            plain, end, whole = _member(data, at)
            for kind, s, e, head, block in salvage(plain):
                inner = head if kind == "record" else {"inner-start": str(s), "inner-end": str(e)}
                found.append((kind, offset + at, offset + end, inner, block))
            if not any(x[0] == "record" for x in found):
                found = []
            empty = whole and not plain
        else:
            empty = False
            one = _record_at(data, at)
            if one:
                end = one[2]
                found = [("record", offset + at, offset + end, one[0], one[1])]
        if found or empty:
            if bad is not None and bad < at:
                yield "gap", offset + bad, offset + at, {}, b""
            yield from found
            bad = None if whole else end  # a torn member may have run on into the next one, which is looked for from its own start
            if whole:
                at = end
                continue
        bad = at if bad is None else bad
        for mark, place in ahead.items():
            if place <= at:
                place = data.find(mark, at + 1)
                ahead[mark] = n if place < 0 else place
        at = min(ahead.values())
    if bad is not None and bad < n:
        yield "gap", offset + bad, offset + n, {}, b""


def read_archives(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, gaps) of all archives in and below path, see _read().

    records: file, at, page_id, record_type, refers_to, url, payload_digest, payload_length (from the header), body (the
    block; null for a revisit); gaps: file, start, end of quarantined bytes, with inner_start and inner_end where they lie in the
    contents of the gzip member at start. Ids and lengths that aren't plain numbers are null. A folder of empty files gives
    no rows. An archive is one row of Spark's binary source, so writers bound its size.
    """
    every = _read(spark, path)
    records = every.where("kind = 'record'").drop("kind", "end", "inner_start", "inner_end")
    return records, every.where("kind = 'gap'").select("file", F.col("at").alias("start"), "end", "inner_start", "inner_end")


def _page(urn: str | None) -> int | None:
    m = re.search(r"urn:page:(-?[0-9]{1,19})>", urn or "")
    return int(m[1]) if m and -(1 << 63) <= int(m[1]) < 1 << 63 else None


def _read(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all archives under path in one table: the columns of records, kind ("record" or "gap"), end and inner places."""
    schema = (
        "kind string, file string, at long, end long, page_id long, record_type string, refers_to long, url string, "
        "payload_digest string, payload_length long, inner_start long, inner_end long, body binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows, size = [], 0
                for kind, s, e, h, block in salvage(content.as_buffer().to_pybytes()):
                    rows.append((
                        kind, file, s, e, _page(h.get("warc-record-id")), h.get("warc-type"), _page(h.get("warc-refers-to")), h.get("warc-target-uri"),
                        h.get("warc-payload-digest", "sha1:")[5:], _number(h.get("warc-payload-length")), _number(h.get("inner-start")),
                        _number(h.get("inner-end")), block if h.get("warc-type") == "response" else None,
                    ))
                    size += len(block)
                    if size > 8_000_000:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        of = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        names, kinds = zip(*(f.split() for f in schema.split(", ")), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, of[t]) for c, t in zip(zip(*rows), kinds, strict=True)], list(names))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, schema)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write the pages, read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's length and digest are taken from the payload that was read; a revisit's are those of the payload it
    refers to. Null html is an empty payload; an empty table writes nothing and gives no rows; each row gets a record, also
    where page_ids repeat or are null. Raises RuntimeError if the reader logs a gap in what was just written.
    """
    spark = pages.sparkSession
    path = f"{common.shared_dir(spark)}/llm/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, least)
    response = F.col("record_type") == "response"
    own = _read(spark, path).select(
        "kind", F.when(F.col("kind") == "gap", F.col("file")).alias("file"), "at", "page_id", "record_type", "refers_to", "payload_digest", "payload_length",
        F.when(response, F.octet_length("body").cast("long")).alias("payload_bytes"), F.when(response, base32_sha1(F.col("body"))).alias("_own"),
    )
    own = common.materialize(own, "warc-read")
    common.remove(spark, path)
    gaps = own.where("kind = 'gap'").select("file", "at").limit(3).collect()
    if gaps:
        raise RuntimeError(f"archives just written hold bytes that are no record: {', '.join(f'{g.file} at {g.at}' for g in gaps)}")
    own = own.select("page_id", "record_type", "refers_to", "payload_digest", "payload_length", "payload_bytes", "_own")
    full = own.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("_bytes"), F.col("_own").alias("_digest")
    ).dropDuplicates()
    revisit = own.where("record_type = 'revisit'").drop("payload_bytes", "_own").withColumnsRenamed({"payload_digest": "_digest", "payload_length": "_bytes"})
    revisit = revisit.join(full.withColumn("_found", F.lit(True)), ["refers_to", "_digest", "_bytes"], "left")
    return own.where("record_type = 'response'").select(
        "page_id", "payload_bytes", F.col("_own").alias("payload_digest"), "record_type", "refers_to"
    ).unionByName(revisit.select(
        "page_id", F.when(F.col("_found"), F.col("_bytes")).alias("payload_bytes"), F.when(F.col("_found"), F.col("_digest")).alias("payload_digest"),
        "record_type", "refers_to",
    ))
