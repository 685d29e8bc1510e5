"""WARC archives of pages: deduplicated records, segments, chunked transfer framing, and back.

Writing. A page's record is an HTTP response whose body is the page in chunked transfer framing.
A block longer than ``segment_bytes`` is cut into a first record and ``continuation`` records
(``WARC-Segment-Number``, ``WARC-Segment-Origin-ID``; the last one carries
``WARC-Segment-Total-Length``). Of pages with equal payloads the one with the largest id is
written whole, the others as ``revisit`` records that name it. Records are at most one segment
long and an archive file holds at most ``records_per_file`` of them, so files are bounded.
Spark's text writer ends every row with the CR LF CR LF that ends a WARC record, so archives go to
whatever file system the path names, from the executors, gzip-compressed.

Reading. Archive files are parsed record by record by ``Content-Length``. Whole records are decoded where
they are read; continuation records are grouped by origin id, ordered by segment number, checked
against the total length, and decoded. Revisits take length and digest from the record they name.
"""

from __future__ import annotations

import base64
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import Scratch, cut, in_batches

SEGMENT_BYTES = 1 << 12
CHUNK_BYTES = 1 << 11
RECORDS_PER_FILE = 512
CRLF = b"\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed values: the base-32 digits
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def base32_of_hex(hexed: Column, digits: int = 40) -> Column:
    """Base-32 text of a hex text whose length is a multiple of 5 digits (20 bits, 4 characters)."""
    out = []
    for i in range(0, digits, 5):
        v = F.conv(F.substring(hexed, i + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def payload_digest(payload: Column) -> Column:
    return base32_of_hex(F.sha1(payload))


def classify(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest (SHA-1 in hex), refers_to: null for the page that is written whole.

    Pages with a null id never stand for others.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html"), F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    last = p.groupBy("digest").agg(F.max("page_id").alias("_last"))
    refers = F.when(F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last")), F.col("_last"))
    return p.join(last, "digest").select("page_id", "url", F.when(refers.isNull(), F.col("html")).alias("html"), "digest",
                                         refers.alias("refers_to"))


def _chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    out = []
    for i in range(0, len(payload), size):
        piece = payload[i:i + size]
        out += [b"%x\r\n" % len(piece), piece, CRLF]
    return b"".join([*out, b"0\r\n\r\n"])


def _dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(CRLF, at)
        n = int(body[at:end].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        out.append(body[end + 2:end + 2 + n])
        if body[end + 2 + n:end + 4 + n] != CRLF:
            raise ValueError("a chunk doesn't end where its size says")
        at = end + 4 + n


def _record(kind: str, rid: str, block: bytes, **fields) -> bytes:
    head = [b"WARC/1.1", b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <" + rid.encode() + b">"]
    head += [f"WARC-{k.replace('_', '-')}: {v}".encode() for k, v in fields.items() if v is not None]
    head += [b"Content-Length: %d" % len(block)]
    return CRLF.join(head) + CRLF + CRLF + block   # the writer adds the closing CR LF CR LF


def _to_records(segment_bytes: int):
    def run(batches):
        for batch in batches:
            out = []
            for page, url, html, digest, refers in zip(*[batch.column(c).to_pylist() for c in (
                    "page_id", "url", "html", "digest", "refers_to")], strict=True):
                digest = base64.b32encode(bytes.fromhex(digest)).decode()
                # a null id gets a record id of its own payload
                rid = f"urn:page:{page}" if page is not None else f"urn:nopage:{digest}"
                uri = None if url is None else "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
                sha = f"sha1:{digest}"
                if refers is not None:
                    out.append(_record("revisit", rid, b"", Target_URI=uri, Payload_Digest=sha, Refers_To=f"<urn:page:{refers}>",
                                       Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
                    continue
                block = HTTP_HEAD + _chunked(html.encode())
                parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
                out.append(_record("response", rid, parts[0], Target_URI=uri, Payload_Digest=sha,
                                   Segment_Number=1 if len(parts) > 1 else None))
                for n, part in enumerate(parts[1:], 2):
                    out.append(_record("continuation", f"{rid}:{n}", part, Segment_Origin_ID=f"<{rid}>", Segment_Number=n,
                                       Segment_Total_Length=len(block) if n == len(parts) else None))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
    return run


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES,
                   records_per_file: int = RECORDS_PER_FILE) -> None:
    """WARC files (gzip) of ``pages`` (page_id, url, html) under ``path``."""
    records = classify(in_batches(pages)).mapInArrow(_to_records(segment_bytes), "record binary")
    (records.select(F.col("record").cast("string").alias("record")).write.option("lineSep", "\r\n\r\n")
     .option("compression", "gzip").option("maxRecordsPerFile", records_per_file).mode("overwrite").text(path))


def _records(raw: bytes):
    """(fields, block) of every record of an archive file."""
    at = 0
    while at < len(raw):
        end = raw.index(CRLF + CRLF, at)
        version, *lines = raw[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = dict(line.split(": ", 1) for line in lines)
        n = int(fields["Content-Length"])
        yield fields, raw[end + 4:end + 4 + n]
        at = end + 8 + n


def _page_of(urn: str | None):
    urn = (urn or "").strip("<>")
    return int(urn.removeprefix("urn:page:")) if urn.startswith("urn:page:") else None


PARSED = "rid string, page_id long, type string, refers_to long, header_digest string, segment int, total long, body binary"


def _parse(batches):
    """Records of archive files: ``body`` is the decoded payload of a whole record, the block of a segment
    (``segment`` is not null), or null (a revisit)."""
    names = [x.split()[0] for x in PARSED.split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
    for batch in batches:
        for content in batch.column("content"):
            raw = content.as_py()
            raw = zlib.decompress(raw, 31) if raw[:2] == b"\x1f\x8b" else raw
            rows = []
            for f, block in _records(raw):
                rid = (f.get("WARC-Segment-Origin-ID") or f["WARC-Record-ID"]).strip("<>")
                digest = f.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None
                number, total = f.get("WARC-Segment-Number"), f.get("WARC-Segment-Total-Length")
                body = block if number else None if f["WARC-Type"] == "revisit" else _payload(block)
                rows.append((rid, _page_of(rid), "response" if number else f["WARC-Type"], _page_of(f.get("WARC-Refers-To")), digest,
                             int(number) if number else None, int(total) if total else None, body))
            cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)


def _payload(block: bytes) -> bytes:
    head, _, body = block.partition(CRLF + CRLF)
    return _dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _reassemble(batches):
    for batch in batches:
        rows = []
        for rid, parts, total, digest in zip(*[batch.column(c).to_pylist() for c in ("rid", "parts", "total", "header_digest")], strict=True):
            block = b"".join(p["block"] for p in parts)
            if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)) or len(block) != total:
                raise ValueError(f"segments of {rid} are missing or don't add up to {total} bytes")
            rows.append((rid, _page_of(rid), "response", None, digest, _payload(block)))
        cols = list(zip(*rows, strict=True)) if rows else [()] * 6
        types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                         names=["rid", "page_id", "type", "refers_to", "header_digest", "payload"])


WHOLE = "rid string, page_id long, type string, refers_to long, header_digest string, payload binary"


def read_archives(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """rid, page_id, type, refers_to, header_digest, payload of every page record under ``path``.

    Payloads are decoded from their chunks; those of revisits are null. Incomplete segments fail, and so does
    a payload without the digest that its record names. Every archive is read once: its parsed
    records are a table of ``scratch``, from which whole records and segments are taken.
    """
    parsed = scratch.cut(spark.read.format("binaryFile").load(path).select("content").mapInArrow(_parse, PARSED))
    whole = parsed.where("segment is null").select("rid", "page_id", "type", "refers_to", "header_digest", F.col("body").alias("payload"))
    grouped = (parsed.where("segment is not null").groupBy("rid")
               .agg(F.array_sort(F.collect_set(F.struct("segment", F.col("body").alias("block")))).alias("parts"),
                    F.max("total").alias("total"), F.max("header_digest").alias("header_digest")))
    records = whole.unionByName(grouped.mapInArrow(_reassemble, WHOLE))
    right = F.col("payload").isNull() | F.col("header_digest").isNull() | (payload_digest(F.col("payload")) == F.col("header_digest"))
    wrong = F.raise_error(F.concat(F.lit("payload and digest of a record differ: "), F.col("rid"))).cast("binary")
    return records.withColumn("payload", F.when(right, F.col("payload")).otherwise(wrong))


def round_trip(pages: DataFrame, path: str, scratch: Scratch) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to per page, from the archives.

    Defined cases: null html is an empty payload; empty payloads are equal payloads like others; a
    null url writes no target; a null page id is written and read as null, as a response unless a
    page with an id has its payload; rows that agree on id and payload give one row (so do all
    null ids with one payload); an empty table gives no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    write_archives(pages, path)
    back = read_archives(spark, path, scratch)
    whole = back.where("type = 'response'").select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.coalesce("header_digest", payload_digest(F.col("payload"))).alias("payload_digest"), F.lit("response").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to")).distinct()
    visits = back.where("type = 'revisit'").select(F.col("page_id"), "refers_to").distinct()
    named = whole.select(F.col("page_id").alias("_p"), "payload_bytes", "payload_digest")
    visits = visits.join(named, visits["refers_to"] == named["_p"], "inner").select(
        "page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to")
    return whole.unionByName(visits)


def op9_warc(spark, sf_dir):
    """Writes the archives to the shared folder, reads them back, and removes them again."""
    from kestrel.llm.common import table

    scratch = Scratch(spark)
    try:
        return cut(round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"), f"{scratch.folder}/warc", scratch))
    finally:
        scratch.close()


OP9_SQL = """
WITH p AS (SELECT page_id, encode(COALESCE(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS hx, MAX(page_id) OVER (PARTITION BY b) AS last FROM p),
c AS (SELECT *, (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + (('0x' || substr(hx, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) % 32, 1), '' ORDER BY i)
        FROM range(32) r(i)) AS digest FROM d)
SELECT DISTINCT page_id, payload_bytes, digest AS payload_digest,
       CASE WHEN last IS NULL OR page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN last IS NULL OR page_id IS NOT DISTINCT FROM last THEN NULL ELSE last END AS refers_to
FROM c
"""
