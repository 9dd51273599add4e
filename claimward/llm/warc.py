"""WARC archives with an index written first and read by coalesced byte ranges.

Writing: every task writes one archive of gzip members, one record each, and returns an
index row per record (file, offset, length, URL, digest). Reading: selected index rows are
sorted by file and offset, neighbouring records are merged into one byte range, and each
range is read once.

Of records with equal payloads of at least ``min_payload`` bytes the smallest page id is
stored, the others become revisit records without payload. Null html is an empty payload.
Rows that repeat the smallest page id are stored again. A null page id counts as the
largest: such a row is a response only where no row of its payload has an id. A null URL is
written as an empty target. Extra columns of the input are left out.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimward.llm.common import attempt_name, folder, open_for_read, open_for_write, stored, table

MIN_PAYLOAD = 100
GAP = 1 << 16
RANGE = 8 << 20
BLOCK = 64 << 20
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122

INDEX = (
    "page_id bigint, url string, digest string, payload_bytes bigint, record_type string, "
    "refers_to bigint, file string, offset bigint, length bigint"
)
RECORD = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, payload binary"
)


def decided(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Payload, digest and record type of every page."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload")
    ).select(
        "*",
        F.sha2("payload", 256).alias("digest"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
    )
    first = (
        rows.select("page_id", "digest", "payload_bytes")
        .filter(F.col("payload_bytes") >= min_payload)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .drop("copies")
    )
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(first, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}')}>"


def _clean(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in value)


def encode_record(row: dict, date: str) -> bytes:
    """One record as a gzip member."""
    revisit = row["record_type"] == "revisit"
    body = b"" if revisit else row["payload"]
    head = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {record_id(row['page_id'])}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_clean(row['url'] or '')}",
        f"WARC-Payload-Digest: sha256:{row['digest']}",
        f"X-Payload-Length: {row['payload_bytes']}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    if row["page_id"] is not None:
        head.append(f"X-Page-Id: {row['page_id']}")
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(row['refers_to'])}",
            f"X-Refers-To-Page: {row['refers_to']}",
        ]
    text = "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(text) + packer.flush()


def decode_record(member: bytes) -> dict:
    """Header fields and body of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    size = int(fields["Content-Length"])
    body = rest[:size]
    if len(body) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("record length does not fit its header")
    return fields | {"body": body}


def write(records: DataFrame, base: str, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """Write decided records under ``base``; returns the stored index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, at = None, None, 0
        try:
            for batch in batches:
                rows = {k: [] for k in ("page_id", "url", "digest", "payload_bytes", "record_type", "refers_to", "file", "offset", "length")}
                columns = [batch.column(n) for n in batch.schema.names]
                for i in range(batch.num_rows):
                    row = {n: c[i].as_py() for n, c in zip(batch.schema.names, columns)}
                    if out is None:
                        name = attempt_name(base, "part") + ".warc.gz"
                        out = open_for_write(name)
                    member = encode_record(row, date)
                    out.write(member)
                    row |= {"file": name, "offset": at, "length": len(member)}
                    at += len(member)
                    for k in rows:
                        rows[k].append(row[k])
                yield pa.RecordBatch.from_pydict(rows, _INDEX_ARROW)
        finally:
            if out is not None:
                out.close()

    return stored(records.mapInArrow(run, INDEX), "warc-index")


_INDEX_ARROW = pa.schema(
    [
        (n, {"bigint": pa.int64(), "string": pa.string()}[k])
        for n, k in (x.split() for x in INDEX.split(", "))
    ]
)
_RECORD_ARROW = pa.schema(
    [
        (n, {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[k])
        for n, k in (x.split() for x in RECORD.split(", "))
    ]
)


def ranges(spots: Iterator[tuple[str, int, int]], gap: int = GAP, most: int = RANGE):
    """Merge sorted (file, offset, length) into (file, start, end, [(offset, length), ...])."""
    now = None
    for file, offset, length in spots:
        if now and now[0] == file and offset - now[2] <= gap and offset + length - now[1] <= most:
            now[2] = max(now[2], offset + length)
            now[3].append((offset, length))
        else:
            if now:
                yield now
            now = [file, offset, offset + length, [(offset, length)]]
    if now:
        yield now


def read(index: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of the given index rows, read back from the archives.

    Digests and lengths of stored payloads are taken from the payload itself and held
    against the header; a difference raises an error. A revisit has them from its header.
    """

    def spots(batches) -> Iterator[tuple[str, int, int]]:
        for batch in batches:
            yield from zip(*(batch.column(n).to_pylist() for n in ("file", "offset", "length")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        try:
            for file, start, end, members in ranges(spots(batches)):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, open_for_read(file)
                source.seek(start)
                data = source.read(end - start)
                rows = {f.name: [] for f in _RECORD_ARROW}
                for offset, length in members:
                    fields = decode_record(data[offset - start : offset - start + length])
                    kind, body = fields["WARC-Type"], fields["body"]
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    size = int(fields["X-Payload-Length"])
                    if kind == "response":
                        found = hashlib.sha256(body).hexdigest()
                        if (found, len(body)) != (digest, size):
                            raise ValueError(f"damaged record in {file} at {offset}")
                    page, refers = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page")
                    rows["page_id"].append(int(page) if page is not None else None)
                    rows["url"].append(fields["WARC-Target-URI"])
                    rows["record_type"].append(kind)
                    rows["refers_to"].append(int(refers) if refers is not None else None)
                    rows["payload_bytes"].append(size)
                    rows["payload_digest"].append(digest)
                    rows["payload"].append(body if payloads and kind == "response" else None)
                yield pa.RecordBatch.from_pydict(rows, _RECORD_ARROW)
        finally:
            if source is not None:
                source.close()

    sorted_rows = (
        index.select("file", "offset", "length")
        .withColumn("block", F.expr(f"offset div {BLOCK}"))
        .repartition("file", "block")
        .sortWithinPartitions("file", "offset")
        .drop("block")
    )
    return sorted_rows.mapInArrow(run, RECORD)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    index = write(decided(pages), folder(spark, "warc"))
    return read(index, payloads=False).drop("url", "payload")


OP3_SQL = """
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest,
    CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes
  FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN f.first_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first_id <> p.page_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
"""
