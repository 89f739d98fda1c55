"""WARC archives with revisit resolution.

Headers (id, url, digest, size) are written once, shuffled by payload digest and
reduced to the smallest page id of each repeated payload; joined back to the headers
they give the revisit records, which need no payload. Payloads stay where they are
read: a row whose key is not in a bitmap of the revisits' keys (``BITS`` bits, so at
most 8.4 MB are broadcast at any size of the input) is a response for sure and is
written from its scan. Rows that only share a bit with a revisit are found among the
headers by an anti-join, and those alone carry their payloads through a join; with
many more revisits than bits all rows would, with the same result. Archives are
written by Spark's own writer (gzip, any Hadoop file system, its commit protocol),
one WARC/1.1 record per page with fresh headers (its own id, length and digest, and
the date of writing): the first record of a payload is the response, the others are
revisit records without the payload. Reading streams each archive, and joins revisits
to their responses.

Defined results: a null html is an empty payload (a response or revisit like any
other of at least ``min_bytes``); a null url is empty; rows repeated with the same
id and payload are written alike; a null page_id is a revisit if a row with an id
has the payload, else a response; an empty table gives an empty archive and
result; payloads of any length are kept whole; further columns of the input are
ignored, whatever their names. Archives of one gzip member or of many are read whole;
one that ends inside a member or a record is an error.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_path, written

MIN_BYTES = 0              # smaller payloads are always stored in full
RECORDS_PER_FILE = 50_000  # bounds an archive file
BITS = 1 << 26             # bits of a bitmap of row keys
CHUNK = 1 << 20
INPUT = 1 << 16

# Record layout.
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: Column) -> Column:
    """Upper-case base-32 SHA-1: the 160 bits as eight groups of five hex digits,
    that is four base-32 digits each."""
    hexed = F.sha1(F.encode(payload, "UTF-8"))
    groups = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), _DIGITS, _BASE32)


def _bit(rows: DataFrame) -> Column:
    return F.pmod(F.xxhash64(rows["page_id"], rows["digest"]), F.lit(BITS))


def _bitmap(rows: DataFrame) -> DataFrame:
    """(slot, bitmap): the keys of ``rows`` as at most BITS / 32768 + 1 rows of 4096 bytes."""
    h = _bit(rows)
    return rows.groupBy(F.bitmap_bucket_number(h).alias("slot")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(h)).alias("bitmap"))


def _tested(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` with ``hit``: whether a row's bit is set in the bitmap of ``keys``."""
    bits = _bitmap(keys)
    h = _bit(rows)
    at = F.bitmap_bit_position(h)
    out = rows.join(F.broadcast(bits), F.bitmap_bucket_number(h) == bits["slot"], "left")
    byte = F.conv(F.hex(F.substring(bits["bitmap"], (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    set_there = byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0
    return out.select(*[rows[c] for c in rows.columns], F.coalesce(set_there, F.lit(False)).alias("hit"))


def resolve(pages: DataFrame, min_bytes: int = MIN_BYTES, id_col: str = "page_id", url_col: str = "url",
            payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, size, record_type, refers_to) of every row; a revisit has no payload."""
    rec = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                       F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rec = rec.withColumn("digest", digest(F.col("payload"))).withColumn(
        "size", F.octet_length("payload").cast("long"))
    heads = written(rec.select("page_id", "url", "digest", "size"), "warc-heads")
    long = heads.where(F.col("size") >= min_bytes)
    firsts = long.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.where("n > 1 and first_id is not null").select("digest", "first_id")
    revisits = written(long.join(firsts, "digest").where(~F.col("page_id").eqNullSafe(F.col("first_id"))).select(
        "page_id", "url", "digest", "size", F.col("first_id").alias("refers_to")), "warc-revisits")
    in_place = _tested(rec, revisits)
    # rows that share a revisit's bit without being one; a key is the same kind of record in all its rows
    keys = revisits.select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"))
    alike = _tested(heads, revisits).where("hit").select("page_id", "digest").distinct()
    alike = written(alike.join(keys, alike["page_id"].eqNullSafe(keys["r_id"]) & (alike["digest"] == keys["r_digest"]),
                               "left_anti"), "warc-alike")
    near = _tested(in_place.where("hit").drop("hit"), alike).where("hit")
    near = near.join(alike, near["page_id"].eqNullSafe(alike["page_id"]) & (near["digest"] == alike["digest"]), "left_semi")
    columns = ["page_id", "url", "payload", "digest", "size", "record_type", "refers_to"]
    id_type = rec.schema["page_id"].dataType

    def responses(rows: DataFrame) -> DataFrame:
        return rows.withColumns({"record_type": F.lit("response"), "refers_to": F.lit(None).cast(id_type)}).select(*columns)

    return responses(in_place.where("not hit")).unionByName(responses(near)).unionByName(
        revisits.withColumns({"record_type": F.lit("revisit"), "payload": F.lit(None).cast("string")}).select(*columns))


def _record(r: dict[str, Column], date: str) -> Column:
    """One record without its closing blank lines (the writer's separator)."""
    number = F.coalesce(r["page_id"].cast("string"), F.lit(""))
    http = F.concat(F.lit(_HTTP), r["size"].cast("string"), F.lit("\r\n\r\n"))
    revisit = r["record_type"] == "revisit"
    block = F.when(revisit, http).otherwise(F.concat(http, r["payload"]))
    first = r["refers_to"].cast("string")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), r["record_type"],
        F.lit("\r\nWARC-Record-ID: <urn:page:"), number, F.lit(f">\r\nWARC-Date: {date}"),
        F.lit("\r\nWARC-Target-URI: "), F.regexp_replace(r["url"], r"[\r\n]", " "),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), r["digest"],
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {_PROFILE}\r\nWARC-Refers-To: <urn:page:"), first,
                                 F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, block)


def write(records: DataFrame, path: str, date: str | None = None) -> None:
    """Write resolved records as gzip archives under ``path``, dated ``date`` (ISO 8601 in UTC; now if not given)."""
    date = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    cols = {c: F.col(c) for c in records.columns}
    (records.select(_record(cols, date).alias("value")).write.option("lineSep", "\r\n\r\n")
     .option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def _inflate(content: bytes):
    """The text of an archive, whatever number of gzip members it has (standard archives hold one per
    record). Input goes in by pieces, so a member's end costs no copy of the rest."""
    view, inside, d = memoryview(content), False, zlib.decompressobj(31)
    for at in range(0, len(view), INPUT):
        piece = bytes(view[at:at + INPUT])
        while True:
            if not inside:
                piece = piece.lstrip(b"\0")      # padding between members
                if not piece:
                    break
                d, inside = zlib.decompressobj(31), True
            data = d.decompress(piece, CHUNK)
            if data:
                yield data
            if d.eof:
                piece, inside = d.unused_data, False
            else:
                piece = d.unconsumed_tail
                if not piece and len(data) < CHUNK:
                    break
    if inside:
        raise ValueError("an archive ends inside a gzip member")


def parse(content: bytes):
    """(headers, block) of every record of one gzip archive, streamed."""
    chunks, buf, pos = _inflate(content), bytearray(), 0
    more = True
    while True:
        end = buf.find(b"\r\n\r\n", pos)
        while end < 0 and more:
            got = next(chunks, None)
            more = got is not None
            del buf[:pos]
            pos = 0
            buf += got or b""
            end = buf.find(b"\r\n\r\n")
        if end < 0:
            if bytes(buf[pos:]).strip():
                raise ValueError("an archive ends inside a record's headers")
            return
        lines = bytes(buf[pos:end]).decode().split("\r\n")
        if not lines[0].startswith("WARC/1."):
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        head = {k: v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
        need = end + 4 + int(head["Content-Length"]) + 4
        while len(buf) < need:
            got = next(chunks, None)
            if got is None:
                raise ValueError("an archive ends inside a record")
            buf += got
        yield head, bytes(buf[end + 4:need - 4])
        pos = need
        if pos > CHUNK:
            del buf[:pos]
            pos = 0


def _number(urn: str | None) -> int | None:
    """The page id in a record id; None for other archives' ids."""
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", urn or "")
    return int(found.group(1)) if found else None


def read(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record: page_id, url, record_type, refers_to, digest, size and sound (of a
    response: whether the payload's digest is the header's), and the payload if asked for. Records of
    other archives keep their types; what their headers lack is null."""
    def records(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for head, block in parse(content.as_py()):
                    payload = block.split(b"\r\n\r\n", 1)[-1]
                    full = head["WARC-Type"] == "response"
                    named = head.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None
                    sound = base64.b32encode(hashlib.sha1(payload).digest()).decode() == named if full and named else None
                    row = {"page_id": _number(head.get("WARC-Record-ID")), "url": head.get("WARC-Target-URI"),
                           "record_type": head["WARC-Type"], "refers_to": _number(head.get("WARC-Refers-To")),
                           "digest": named, "size": len(payload) if full else None, "sound": sound}
                    if with_payload:
                        row["payload"] = payload.decode("utf-8", "replace") if full else None
                    rows.append(row)
                    if len(rows) >= (64 if with_payload else 4096):
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    fields = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
              ("digest", pa.string()), ("size", pa.int64()), ("sound", pa.bool_())]
    ddl = "page_id long, url string, record_type string, refers_to long, digest string, size long, sound boolean"
    if with_payload:
        fields, ddl = [*fields, ("payload", pa.string())], ddl + ", payload string"
    schema = pa.schema(fields)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(records, ddl)


def follow(records: DataFrame) -> DataFrame:
    """Revisits get the size (and payload, if read) of the response they refer to."""
    own = records.where("record_type = 'response' and page_id is not null")
    found = own.groupBy(F.col("page_id").alias("o_id"), F.col("digest").alias("o_digest")).agg(
        F.first("size").alias("o_size"),
        *([F.first("payload").alias("o_payload")] if "payload" in records.columns else []))
    out = records.join(found, (records["refers_to"] == found["o_id"]) & (records["digest"] == found["o_digest"]),
                       "left")
    return out.select(*[F.coalesce(records[c], found[f"o_{c}"]).alias(c) if c in ("size", "payload") else records[c]
                        for c in records.columns])


def warc_query(pages: DataFrame) -> DataFrame:
    """The digest the op6 query returns: pages written as archives, read back, followed."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write(resolve(pages), path)
    back = follow(read(spark, path))
    return back.select("page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                       "record_type", "refers_to")
