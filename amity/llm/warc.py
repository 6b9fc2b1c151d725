"""WARC archives: writing with revisits and segments, reading and reassembly.

*Writing.* Pages with equal payloads (SHA-1 and length) are found by a narrow
aggregation; the one with the smallest page_id becomes a ``response``, the
others become ``revisit`` records that name it and carry no payload. The
payload goes out as an HTTP response in chunked transfer coding; a record
longer than ``segment_bytes`` is cut into a first segment and ``continuation``
records, so no record and, with a bounded number of records a file, no file
grows without bound. Spark's own text writer writes the files (the record
terminator is its line separator), with its commit protocol: a lost executor's
files are written again, never twice.

*Reading.* Files are read by Spark and parsed by Content-Length. Segments are
grouped by the record they continue, ordered by segment number and joined; the
numbers must be gapless and the length the total its last segment states; then
the chunked framing is decoded. A record that fails any of this comes back
with ``complete`` false and no payload. A revisit's length is its response's,
found by a join on the record it refers to.

Defined results: a NULL payload is an empty one; a NULL page_id is archived
(as a response) and comes back NULL; every row of a payload's smallest page_id
is a response; with ``min_revisit_bytes`` shorter payloads are all responses;
repeated rows get a record each; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amity.llm.tables import col_ref, read_table, scratch_path, written

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
RECORDS_PER_FILE = 4096
# The formats' own words
VERSION, CRLF, END = b"WARC/1.1", b"\r\n", b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

# page ids stay text between the two ends: pandas turns nullable longs into doubles
RECORD = ("record_id string, warc_type string, page_id string, refers string, digest string, origin string, "
          "segment int, total bigint, payload_bytes bigint, complete boolean, block binary")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def pieces(data: bytes, size: int) -> list[bytes]:
    """``data`` in pieces of at most ``size`` bytes (size >= 4), never cut
    inside a UTF-8 character, so that each is text by itself."""
    out, at = [], 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80 and end > at + 1:
            end -= 1
        out.append(data[at:end])
        at = end
    return out


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in pieces(payload, size)) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload inside chunked framing; ValueError where it is broken."""
    out, at = [], 0
    while True:
        line = body.index(CRLF, at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != CRLF:
            raise ValueError("chunk without an end")
        out.append(body[at:at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, _, body = block.partition(END)
    fields = dict(x.lower().split(b":", 1) for x in head.split(CRLF)[1:])
    return unchunked(body) if fields.get(b"transfer-encoding", b"").strip() == b"chunked" else body


def record(fields: dict[str, object], block: bytes) -> bytes:
    """One record without its terminator."""
    head = [VERSION, *(f"{k}: {v}".encode() for k, v in fields.items() if v is not None), b"Content-Length: %d" % len(block)]
    return CRLF.join(head) + END + block


def page_records(page_id: str | None, url: str | None, payload: bytes, serial: int, response: str | None,
                 revisit: bool, segment_bytes: int) -> list[bytes]:
    """The records of one page."""
    digest = base32_sha1(payload)
    # a NULL page_id has no number in its name; the serial tells repeated rows apart
    own = f"urn:page:{page_id or ''}:{digest}"
    fields: dict[str, object] = {
        "WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": f"<{own}:{serial}>", "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else "".join(url.split()), "X-Page-ID": page_id,
        "WARC-Payload-Digest": f"sha1:{digest}"}
    if revisit:
        return [record(fields | {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<urn:page:{response}:{digest}>"}, b"")]
    block = HTTP + chunked(payload)
    fields["Content-Type"] = "application/http; msgtype=response"
    if len(block) <= segment_bytes:
        return [record(fields, block)]
    parts = pieces(block, segment_bytes)
    out = [record(fields | {"WARC-Segment-Number": 1}, parts[0])]
    for k, part in enumerate(parts[1:], 2):
        out.append(record({"WARC-Type": "continuation", "WARC-Record-ID": f"<{own}:{serial}:{k}>", "WARC-Date": DATE,
                           "WARC-Segment-Number": k, "WARC-Segment-Origin-ID": f"<{own}:{serial}>",
                           "WARC-Segment-Total-Length": len(block) if k == len(parts) else None}, part))
    return out


def write_archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                  segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE,
                  min_revisit_bytes: int = 0) -> None:
    """Gzipped WARC files under ``path``, one task's records a file or more."""
    payload = F.coalesce(F.col(col_ref(html)).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(col_ref(page_id)).cast("bigint").alias("page_id"), F.col(col_ref(url)).cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("size"),
                       F.monotonically_increasing_id().alias("serial"))
    # written, so that the join's sides are plain scans whose hot payload can be split
    first = written(rows.groupBy("sha1", "size").agg(F.min("page_id").alias("response"))
                    .where(F.col("size") >= min_revisit_bytes), "warc-responses")
    rows = rows.join(first, ["sha1", "size"], "left") \
        .withColumn("revisit", F.coalesce(F.col("page_id") != F.col("response"), F.lit(False)))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cols = (b[c] for c in ("page_id", "url", "payload", "serial", "response", "revisit"))
            yield pd.DataFrame({"value": [r.decode() for row in zip(*cols, strict=True)
                                          for r in page_records(*row, segment_bytes)]})

    ids = [F.col(c).cast("string").alias(c) for c in ("page_id", "response")]
    (rows.select(ids[0], "url", "payload", "serial", ids[1], "revisit").mapInPandas(build, "value string")
     .write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of one file: (header fields in lower case, block)."""
    at = 0
    while at < len(data):
        head = data.index(END, at)
        lines = data[at:head].split(CRLF)
        if not lines[0].startswith(b"WARC/"):
            raise ValueError("no WARC record here")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines[1:])}
        start = head + 4
        end = start + int(fields["content-length"])
        if data[end:end + 4] != END:
            raise ValueError("record without its end")
        yield fields, data[start:end]
        at = end + 4


def _row(fields: dict[str, str], block: bytes) -> tuple:
    name = fields["warc-record-id"].strip("<>")
    number = int(fields["warc-segment-number"]) if "warc-segment-number" in fields else None
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    total = fields.get("warc-segment-total-length")
    out = [name, fields["warc-type"], fields.get("x-page-id"),
           fields.get("warc-refers-to", "").strip("<>") or None, digest,
           fields["warc-segment-origin-id"].strip("<>") if "warc-segment-origin-id" in fields else name if number else None,
           number, None if total is None else int(total)]
    if number is None and fields["warc-type"] == "response":
        return (*out, *_decoded(block, digest), None)
    return (*out, None, fields["warc-type"] == "revisit", block if number else None)


def _decoded(block: bytes, digest: str | None) -> tuple[int | None, bool]:
    """(payload length, True), or (None, False) for a broken block."""
    try:
        payload = http_payload(block)
    except ValueError:
        return None, False
    return (len(payload), True) if digest in (None, base32_sha1(payload)) else (None, False)


def _reassemble(_: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """One record from its segments (of one page, so bounded by its size)."""
    g = group.sort_values("segment").drop_duplicates("segment")
    block, totals = b"".join(g["block"]), g["total"].dropna()
    head = g.iloc[0]
    whole = list(g["segment"]) == list(range(1, len(g) + 1)) and list(totals) == [len(block)] and not pd.isna(g["total"].iloc[-1])
    size, good = _decoded(block, head["digest"]) if whole else (None, False)
    known = head["segment"] == 1
    return pd.DataFrame({"record_id": [head["origin"]], "page_id": [head["page_id"] if known else None],
                         "digest": [head["digest"] if known else None], "payload_bytes": pd.array([size], "Int64"), "complete": [good]})


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every page record under ``path``: ``(page_id, payload_bytes,
    payload_digest, record_type, refers_to, complete)``."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in RECORD.split(", ")]
        for b in batches:
            for content in b["content"]:
                data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                out = pd.DataFrame([_row(*r) for r in parse(data)], columns=names, dtype=object)
                yield out.astype({c: "Int64" for c in ("segment", "total", "payload_bytes")})

    # a file is one row, so the batches handed to Python are kept to a few files by their size
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    found = written(files.mapInPandas(rows, RECORD), "warc-records")
    number = F.col("page_id").cast("bigint").alias("page_id")
    plain = ["record_id", "page_id", "digest", "payload_bytes", "complete"]
    joined = found.where(F.col("segment").isNotNull()).groupBy("origin").applyInPandas(
        _reassemble, "record_id string, page_id string, digest string, payload_bytes bigint, complete boolean")
    whole = found.where(F.col("segment").isNull() & (F.col("warc_type") == "response")).select(*plain)
    responses = written(whole.unionByName(joined), "warc-whole")
    # the name revisits use is the record's without its serial
    target = written(responses.where("complete").groupBy(F.regexp_replace("record_id", ":[^:]*$", "").alias("refers"))
                     .agg(F.min(number).alias("refers_to"), F.min("payload_bytes").alias("payload_bytes")), "warc-targets")
    revisits = found.where(F.col("warc_type") == "revisit").select("page_id", "digest", "refers").join(target, "refers", "left")
    none = F.lit(None).cast(T.LongType())
    return responses.select(number, "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("response").alias("record_type"),
                            none.alias("refers_to"), "complete").unionByName(
        revisits.select(number, "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"),
                        "refers_to", F.col("payload_bytes").isNotNull().alias("complete")))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived and read back."""
    path = scratch_path(spark, "warc")
    write_archive(read_table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path)


QUERIES = {"op4_warc": op4_warc}
SQL: dict[str, str] = {}
