"""Operator 3, WARC archives with resolved revisits.

Writing: every page gets a payload digest; digests, not payloads, are grouped,
and of the records with equal payloads (of at least ``min_bytes``) the one of
the smallest page_id becomes a response, the others become revisits that name
it. Records are written with fresh headers as gzip-compressed WARC 1.1 files by
Spark's own writer, so a lost task is simply written again.

Reading: a file's records are cut by their Content-Length, so a payload may hold
anything; a response's payload is held against its digest. Revisits are joined
to the response that they refer to and take its payload's size.

Defined results: a null html is an empty payload; a null url leaves out the
target line; a page without page_id is a response of its own and is never
referred to; rows that repeat a page_id with one payload are each of the type
of that page; an empty table gives no records; other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftforge.llm.common import STAGED, scratch, text_or_empty

#: Bytes of payload that a file holds on average at most.
ARCHIVE_BYTES = 16 << 20
WARC_DATE = "2024-01-01T00:00:00Z"
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF, END = "\r\n", "\r\n\r\n"
RECORD_ID = "urn:page:"


def payload_digest(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: five hexadecimal digits make four of its digits."""
    hexed = F.sha1(payload.cast("binary"))
    quads = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*quads), HEX32, BASE32)


def headers(pages: DataFrame) -> DataFrame:
    """page_id, url, html, payload_bytes and payload_digest of every page."""
    html = text_or_empty(pages["html"])
    return pages.select(pages["page_id"], pages["url"], html.alias("html"),
                        F.octet_length(html).cast("long").alias("payload_bytes"),
                        payload_digest(html).alias("payload_digest"))


def resolve(rows: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``rows`` with record_type and refers_to."""
    first = (rows.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
             .agg(F.min("page_id").alias("original"), F.count("*").alias("n"))
             .filter("n > 1").drop("n"))
    revisit = F.coalesce(F.col("page_id") != F.col("original"), F.lit(False)) & (F.col("payload_bytes") >= min_bytes)
    return (rows.join(first, "payload_digest", "left")
            .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(revisit, F.col("original"))).drop("original"))


def record(date: str = WARC_DATE) -> Column:
    """A WARC record's text, without the blank lines that end it."""
    revisit = F.col("record_type") == "revisit"

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + ": "), value, F.lit(CRLF))

    def page(col: str) -> Column:
        return F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(F.col(col).cast("string"), F.lit("")), F.lit(">"))

    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    url = F.regexp_replace("url", r"[\x00-\x20]", "%20")
    return F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", page("page_id")),
        line("WARC-Date", F.lit(date)), F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", page("refers_to"))))
        .otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF), block)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = WARC_DATE) -> None:
    """Write the deduplicated archives of ``pages`` (page_id, url, html)."""
    size, n = pages.agg(F.sum(F.octet_length("html")), F.count("*")).first()
    each = max(1, ARCHIVE_BYTES * n // max(size or 0, 1))
    (resolve(headers(pages), min_bytes).select(record(date).alias("value")).write.option("lineSep", END)
     .option("compression", "gzip").option("maxRecordsPerFile", min(each, 1_000_000)).text(path))


def parse(data: bytes):
    """(header fields, block) of each record of a WARC file."""
    at = 0
    while at < len(data):
        top = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:top].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}: {version[:40]!r}")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        end = top + 4 + int(fields["content-length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield fields, data[top + 4:end]
        at = end + 4


def _page(uri: str | None) -> int | None:
    number = uri.strip("<>").removeprefix(RECORD_ID) if uri else ""
    return int(number) if number else None


def _record_rows(batches):
    """File contents -> one row a record; payloads are checked and kept as text."""
    import base64
    import gzip
    import hashlib

    import pyarrow as pa
    for b in batches:
        for content in b.column(0):
            content = content.as_py()
            rows = []
            for fields, block in parse(gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content):
                response = fields["warc-type"] == "response"
                payload = block.partition(b"\r\n\r\n")[2] if response else None
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                if response and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError(f"{fields['warc-record-id']}: the payload does not have the digest {digest}")
                rows.append((_page(fields["warc-record-id"]), fields["warc-type"], fields.get("warc-target-uri"),
                             digest, _page(fields.get("warc-refers-to")),
                             len(payload) if response else None, payload))
            kinds = pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()
            names = ["page_id", "record_type", "url", "payload_digest", "refers_to", "payload_bytes", "payload"]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def read_archives(spark, path: str) -> DataFrame:
    """One row a record, as written: page_id, record_type, url, payload_digest,
    refers_to, and payload_bytes and payload of responses."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_record_rows, "page_id long, record_type string, url string, payload_digest string, "
                                          "refers_to long, payload_bytes long, payload binary")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` whose revisits have the payload_bytes of the response that
    they refer to (null if there is none)."""
    cols = records.columns
    found = (records.filter("record_type = 'response' and page_id is not null")
             .groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.min("payload_bytes").alias("full")))
    return (records.join(found, ["refers_to", "payload_digest"], "left")
            .withColumn("payload_bytes", F.coalesce("payload_bytes", "full")).select(*cols))


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to the shared folder, read the archives back, resolve."""
    spark = pages.sparkSession
    pages = pages.select(pages["page_id"], pages["url"], pages["html"])
    path = scratch(spark, "op3-archives")
    STAGED.append(path)
    write_archives(pages, path, min_bytes)
    records = read_archives(spark, path).drop("payload", "url")
    return resolve_revisits(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
