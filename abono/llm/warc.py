"""WARC archives of pages, and captures put together again from their records.

Writing is SQL throughout. Each page becomes three records: a request, a response or a revisit,
and metadata, linked by WARC-Concurrent-To. Of pages with equal payloads one is the response and
the others revisit it, without the payload. Spark's text writer, with a record's end as line
separator, writes them, so archives are committed like any other output.

Reading parses archives record by record in the tasks, from the bytes that Spark hands out.
`captures` joins request, response and metadata records through their concurrent-to identifiers,
in whichever direction these point, and returns a nested row per capture."""

from __future__ import annotations

import base64
import hashlib
import io
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from abono.llm.store import stored
from abono.llm.text import _quoted

#: Rows of one payload, and revisits of one response, are dealt out over so many keys.
SALTS = 256
#: Records of an archive at most; Spark's partition size keeps most archives well below.
RECORDS = 60_000
#: Fixed values of the format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
NEW_LINE = "\r\n"


def base32_of_hex(digest: Column) -> Column:
    """A digest of 40 hexadecimal digits as 32 of base 32, without padding."""
    digits = [F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(*parts: Column) -> Column:
    h = F.md5(F.to_json(F.array(*[p.cast("string") for p in parts])))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    """Headers whose value is null are left out. The end of the record is the line separator."""
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    return F.concat(
        F.concat_ws(NEW_LINE, F.lit(VERSION), F.concat(F.lit("WARC-Type: "), kind), *lines,
                    F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))),
        F.lit(END), block)


def with_roles(pages: DataFrame, least: int = 0) -> DataFrame:
    """pages: page_id, url, payload, digest, bytes. Adds response (whether the row is one), copy
    (its number among rows alike in page_id, url and payload) and first (page_id and url of the
    response with this payload; null for payloads of fewer than `least` bytes, which all are
    responses).

    The response is the row with the largest page_id, nulls being least, then the largest url; of
    rows alike in both, the first copy. A payload's rows are dealt out by a salt: each salt's
    largest row is found first, then the largest of those few, which each salt's rows are joined
    with. So no task sees all rows of a payload, however many."""
    salted = pages.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)))
    name = F.struct("page_id", "url")
    few = salted.where(F.col("bytes") >= least).groupBy("digest", "salt").agg(F.max(name).alias("most"))
    few = few.select("digest", "salt", F.max("most").over(Window.partitionBy("digest")).alias("first"))
    joined = salted.join(few, ["digest", "salt"], "left")
    # After the join, whose partitioning serves the window too: payloads are shuffled once.
    alike = Window.partitionBy("digest", "salt", "page_id", "url").orderBy("bytes")
    joined = joined.withColumn("copy", F.row_number().over(alike))
    response = F.col("first").isNull() | (name.eqNullSafe(F.col("first")) & (F.col("copy") == 1))
    return joined.withColumn("response", response)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               least: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    """Three records per row of pages, as archives below path. A null payload is an empty one, a
    null url or id leaves its header out. Line ends in a url are written as %0D and %0A. Other
    columns of pages are not read."""
    url = F.replace(F.replace(F.col(_quoted(url_col)).cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    payload = F.coalesce(F.col(_quoted(payload_col)).cast("string"), F.lit(""))
    rows = pages.select(F.col(_quoted(id_col)).cast("long").alias("page_id"), url.alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", base32_of_hex(F.sha1(F.col("payload").cast("binary")))).withColumn("bytes", F.octet_length("payload"))
    rows = with_roles(rows, least)

    capture = [F.col("page_id"), F.col("url"), F.col("digest"), F.col("copy")]
    own = _urn(F.lit("response"), *capture)
    referred = _urn(F.lit("response"), F.col("first.page_id"), F.col("first.url"), F.col("digest"), F.lit(1))
    revisit = ~F.col("response")
    about = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("url"))]
    where = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:]*://([^/?#]*)([^#]*)", 1)
    what = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:]*://([^/?#]*)([^#]*)", 2)
    request = _record(F.lit("request"), [
        ("WARC-Record-ID", _urn(F.lit("request"), *capture)), *about, ("WARC-Concurrent-To", own),
        ("Content-Type", F.lit("application/http;msgtype=request"))],
        F.concat(F.lit("GET "), F.when(what == "", "/").otherwise(what), F.lit(f" HTTP/1.1{NEW_LINE}Host: "), where, F.lit(END)))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{NEW_LINE}Content-Type: text/html; charset=utf-8{NEW_LINE}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(END))
    response = _record(F.when(revisit, "revisit").otherwise("response"), [
        ("WARC-Record-ID", own), *about, ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Profile", F.when(revisit, SAME_PAYLOAD)), ("WARC-Refers-To", F.when(revisit, referred)),
        ("WARC-Refers-To-Target-URI", F.when(revisit, F.col("first.url"))), ("WARC-Refers-To-Date", F.when(revisit, date)),
        ("Content-Type", F.lit("application/http;msgtype=response"))],
        F.when(revisit, head).otherwise(F.concat(head, F.col("payload"))))
    fields = F.concat_ws("", F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(NEW_LINE)))
    metadata = _record(F.lit("metadata"), [
        ("WARC-Record-ID", _urn(F.lit("metadata"), *capture)), *about, ("WARC-Concurrent-To", own),
        ("Content-Type", F.lit("application/warc-fields"))], fields)
    records = rows.select(F.explode(F.array(request, response, metadata)).alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(path)


# Reading.

RECORD = (
    "record_id string, warc_type string, concurrent_to array<string>, target_uri string, date string, content_type string,"
    " refers_to string, profile string, payload_digest string, payload_bytes long, http_status int, request_line string,"
    " fields map<string,string>, payload binary")


class Broken(ValueError):
    """An archive that is not one, or ends inside a record."""


def _opened(content: bytes) -> io.BufferedReader:
    """The archive's bytes, decompressed as they are read, any number of gzip members."""
    if content[:2] != b"\x1f\x8b":
        return io.BufferedReader(io.BytesIO(content))
    return io.BufferedReader(_Members(content), 1 << 16)


class _Members(io.RawIOBase):
    def __init__(self, content: bytes) -> None:
        self.rest, self.at, self.inflate, self.ready = memoryview(content), 0, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while not self.ready:
            if self.inflate.eof:
                self.at -= len(self.inflate.unused_data)
                if self.at >= len(self.rest):
                    return 0
                self.inflate = zlib.decompressobj(31)
            given = self.inflate.unconsumed_tail
            if not given:
                given = self.rest[self.at:self.at + (1 << 16)]
                self.at += len(given)
                if not given:
                    raise Broken("the archive ends inside a compressed member")
            self.ready = self.inflate.decompress(given, 1 << 18)
        n = min(len(into), len(self.ready))
        into[:n], self.ready = self.ready[:n], self.ready[n:]
        return n


def _headers(lines: list[bytes]) -> list[tuple[str, str]]:
    """Names in lower case. A line that begins with white space continues the one before."""
    found: list[tuple[str, str]] = []
    for raw in lines:
        line = raw.decode("utf-8", "replace")
        if line[:1] in (" ", "\t") and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {line.strip()}")
            continue
        name, colon, value = line.partition(":")
        if colon:
            found.append((name.strip().lower(), value.strip()))
    return found


def read_records(content: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """(headers, block) of every record of an archive, one at a time. The block is as long as the
    record says, whatever it contains."""
    source = _opened(content)
    while True:
        line = source.readline()
        while line in (b"\r\n", b"\n"):
            line = source.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise Broken(f"a record begins with {line[:40]!r}")
        lines = []
        while (line := source.readline()) not in (b"\r\n", b"\n"):
            if not line:
                raise Broken("the archive ends inside a record's headers")
            lines.append(line.rstrip(b"\r\n"))
        headers = _headers(lines)
        size = next((v for n, v in headers if n == "content-length"), "")
        if not size.isdigit():
            raise Broken(f"a record's length is {size!r}")
        block = source.read(int(size))
        if len(block) < int(size):
            raise Broken("the archive ends inside a record's block")
        if not any(n == "warc-record-id" and v for n, v in headers):
            raise Broken("a record has no WARC-Record-ID")
        yield headers, block


def parsed(headers: list[tuple[str, str]], block: bytes, with_payload: bool) -> dict[str, object]:
    one = dict(reversed(headers))
    kind, content_type = one.get("warc-type"), one.get("content-type", "")
    out: dict[str, object] = {
        "record_id": one.get("warc-record-id"), "warc_type": kind, "target_uri": one.get("warc-target-uri"),
        "concurrent_to": [v for n, v in headers if n == "warc-concurrent-to"], "date": one.get("warc-date"),
        "content_type": content_type or None, "refers_to": one.get("warc-refers-to"), "profile": one.get("warc-profile")}
    digest = re.sub("^[^:]*:", "", one.get("warc-payload-digest", "")) or None
    payload, http = block, []
    if content_type.startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        first, *lines = head.split(b"\r\n")
        http = _headers(lines)
        if kind == "request":
            out["request_line"] = first.decode("utf-8", "replace")
        else:
            status = first.split(b" ")[1:2]
            out["http_status"] = int(status[0]) if status and status[0].isdigit() else None
    if content_type.startswith("application/warc-fields"):
        out["fields"] = list(dict(reversed(_headers(block.splitlines()))).items())
    size = next((v for n, v in http if n == "content-length"), "")
    if kind == "revisit":
        # The payload is elsewhere; its length is what the server said, its digest the record's.
        out["payload_bytes"], out["payload_digest"] = int(size) if size.isdigit() else None, digest
    else:
        out["payload_bytes"] = len(payload)
        if kind not in ("request", "metadata"):
            out["payload_digest"] = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    out["payload"] = payload if with_payload and kind != "revisit" else None
    return out


def read_warc(spark: SparkSession, path: str, with_payload: bool = False, pieces: int = 1 << 22) -> DataFrame:
    """A row per record of all archives below path, compressed or not; see RECORD. payload_digest
    and payload_bytes are counted from the payload, for a revisit taken from its headers; requests
    and metadata have no digest. Payloads come along only if asked for. An archive is held by one task, compressed; its records are read
    one at a time. One that is no archive, or is cut off, fails with its name."""
    schema = to_arrow_schema(T.StructType.fromDDL(RECORD))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict[str, object]] = []
        size = 0
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                try:
                    for headers, block in read_records(content.as_buffer().to_pybytes()):
                        rows.append(parsed(headers, block, with_payload))
                        size += 500 + (len(block) if with_payload else 0)
                        if size > pieces:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                except (Broken, zlib.error) as e:
                    raise Broken(f"{name.as_py()}: {e}") from e
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, RECORD)


# Captures.

def _key(record_id: Column) -> Column:
    """An identifier in 16 bytes, which is what joins shuffle."""
    return F.unhex(F.md5(record_id))


def captures(records: DataFrame) -> DataFrame:
    """A nested row per capture: capture_id (the response's or revisit's record id), response,
    request, and metadata (a list). Of the records' columns, record_id, warc_type and
    concurrent_to are needed; the others come along.

    A record other than a response belongs to the response that one of them names in
    WARC-Concurrent-To; a metadata record that is linked to a request only, to the request's. Of
    several responses or requests the one with the least key counts. Records that lead to no
    response are captures of their own, with a null response. Other types (warcinfo, resource,
    conversion) are no part of a capture. Two responses with the same id make two captures. Ids
    must not be null, which read_warc sees to."""
    whole = F.struct(*[c for c in records.columns if c != "concurrent_to"]).alias("record")
    kind = F.col("warc_type")
    heads = records.where(kind.isin("response", "revisit")).select(_key(F.col("record_id")).alias("capture"), whole)
    others = records.where(kind.isin("request", "metadata")).select(
        _key(F.col("record_id")).alias("id"), (kind == "request").alias("asks"), whole)
    named = records.where(kind.isin("response", "revisit", "request", "metadata")).select(
        _key(F.col("record_id")).alias("id"), F.explode("concurrent_to").alias("to")).select("id", _key(F.col("to")).alias("to"))
    # Links in both directions, of records that are in the archives.
    links = named.select(F.col("id").alias("a"), F.col("to").alias("b")).unionByName(named.select(F.col("to").alias("a"), F.col("id").alias("b")))
    direct = links.join(heads.select(F.col("capture").alias("b")), "b", "left_semi").groupBy(F.col("a").alias("id")).agg(F.min("b").alias("capture"))
    direct = stored(direct, "warc-links")
    # Metadata records without such a link may have one to a request that has.
    left = others.where(~F.col("asks")).select("id").join(direct, "id", "left_anti").select(F.col("id").alias("a"))
    asked = direct.join(others.where("asks").select("id"), "id", "left_semi").withColumnRenamed("id", "b")
    through = links.join(left, "a", "left_semi").join(asked, "b").groupBy(F.col("a").alias("id")).agg(F.min("capture").alias("capture"))
    home = direct.unionByName(through)
    placed = others.join(home, "id", "left").select(F.coalesce("capture", "id").alias("capture"), "id", "asks", "record")
    placed = placed.groupBy("capture").agg(
        F.min_by(F.when(F.col("asks"), F.col("record")), F.when(F.col("asks"), F.col("id"))).alias("request"),
        F.collect_list(F.when(~F.col("asks"), F.col("record"))).alias("metadata"))
    none = F.array().cast(placed.schema["metadata"].dataType)
    return heads.join(placed, "capture", "full_outer").select(
        F.col("record.record_id").alias("capture_id"), F.col("record").alias("response"), "request", F.coalesce("metadata", none).alias("metadata"))


def with_referred(rows: DataFrame, value: Column, out: str) -> DataFrame:
    """rows: captures. Adds `out`: the value of the capture that a revisit refers to, null for
    others and where that capture is missing. Revisits of one response are dealt out by a salt, so
    that none of them is one task's."""
    salt = F.pmod(F.xxhash64("capture_id"), F.lit(SALTS))
    salted = rows.withColumn("refers", _key(F.col("response.refers_to"))).withColumn("salt", salt)
    wanted = salted.where("refers IS NOT NULL").select("refers", "salt").distinct()
    known = rows.where("capture_id IS NOT NULL").groupBy(_key(F.col("capture_id")).alias("refers")).agg(F.max(value).alias(out))
    found = wanted.join(known, "refers")
    return salted.join(found, ["refers", "salt"], "left").drop("refers", "salt")


def pages_digest(spark: SparkSession, path: str) -> DataFrame:
    """Archives of write_warc, as a row per page: page_id, payload_bytes, payload_digest,
    record_type, refers_to (page_id of the response, for revisits)."""
    columns = ("record_id", "warc_type", "concurrent_to", "refers_to", "payload_bytes", "payload_digest", "fields")
    records = stored(read_warc(spark, path).select(*columns), "warc-records")
    rows = captures(records)
    page = F.try_element_at(F.get(F.col("metadata.fields"), F.lit(0)), F.lit("page-id")).cast("long")
    rows = stored(rows.select("capture_id", "response", page.alias("page_id")), "captures")
    return with_referred(rows, F.col("page_id"), "refers_to").select(
        "page_id", F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.warc_type").alias("record_type"), "refers_to")
