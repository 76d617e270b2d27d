"""WARC archives from a chunked record table, and back.

A payload becomes rows of (record, chunk number, bytes), cut before Python sees it, each with the digest of
the payload up to there; the last row's is the payload's. Records of equal payloads become one response
and revisits that refer to it. Archives are written and read record by record as streams of chunks, so no
task ever holds a whole payload of unbounded size in Python, and a record is one gzip member of its own.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled, shared_folder, sheltered
from .files import create, open_stream

CHUNK = 1 << 20

#: Payloads of fewer bytes are never revisits.
MIN_BYTES = 0

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Damaged(ValueError):
    """An archive does not hold what its headers say."""


def shown(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunk_table(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Chunks of the payloads of ``pages``: record, page_id, url, chunk_no, size, data, and the digest so far.

    ``record`` numbers the rows. A null or empty payload has one chunk of no bytes. The digest is carried
    from chunk to chunk, also where Arrow batches part them.
    """
    pages, _ = sheltered(pages, "page_id", "url", "html")
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumn("record", F.monotonically_increasing_id())
    size = F.octet_length("payload").cast("long")
    cuts = F.sequence(F.lit(0).cast("long"), F.greatest(size - 1, F.lit(0)), F.lit(chunk).cast("long"))
    cut = rows.select("record", "page_id", "url", size.alias("size"), "payload", F.posexplode(cuts).alias("chunk_no", "at")).select(
        "record", "page_id", "url", F.col("chunk_no").cast("long").alias("chunk_no"), "size",
        F.substring("payload", (F.col("at") + 1).cast("int"), F.lit(chunk)).alias("data"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            sums = []
            data = batch.column(5)
            for i, number in enumerate(batch.column(3).to_pylist()):
                if number == 0:
                    state = hashlib.sha1()
                state.update(data[i].as_buffer())
                sums.append(shown(state.digest()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.string())], [*batch.schema.names, "digest"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return cut.mapInArrow(run, f"record long, page_id {kind}, url string, chunk_no long, size long, data binary, digest string")


def revisits(chunks: DataFrame, min_bytes: int = MIN_BYTES, chunk: int = CHUNK) -> DataFrame:
    """``record`` of each revisit, with ``of_id`` and ``of_record`` of the response it refers to.

    Of equal payloads the smallest page_id is the response, null ids last, then the first row.
    """
    last = F.col("chunk_no") == F.greatest(F.lit(0), F.ceil(F.col("size") / chunk) - 1)
    heads = chunks.where(last & (F.col("size") >= min_bytes)).select("record", "page_id", "digest", "size")
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record")).alias("first")
    responses = heads.groupBy("digest", "size").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1")
    return (
        heads.join(responses, ["digest", "size"])
        .where("record <> first.record")
        .select("record", F.col("first.page_id").alias("of_id"), F.col("first.record").alias("of_record"))
    )


def _name(page_id: object, record: int) -> str:
    return f"<urn:page:{'-' if page_id is None else quote(str(page_id), safe='')}:{record}>"


def _id(name: str) -> str | None:
    held = name.removeprefix("<urn:page:").rsplit(":", 1)[0]
    return None if held == "-" else unquote(held)


class _Member:
    """One record as a gzip member, written as its payload comes in."""

    def __init__(self, out, level: int):
        self.out, self.pack = out, zlib.compressobj(level, zlib.DEFLATED, 31)

    def write(self, data) -> None:
        self.out.write(self.pack.compress(data))

    def close(self) -> None:
        self.out.write(self.pack.compress(b"\r\n\r\n") + self.pack.flush())


def _header(page_id, record: int, url: str | None, size: int, digest: str, date: str, of: str | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if of else 'response'}", f"WARC-Record-ID: {_name(page_id, record)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%-._~"))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if of:
        lines += [f"WARC-Refers-To: {of}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (0 if of else size)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def write(chunks: DataFrame, found: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", level: int = 1) -> DataFrame:
    """Write one archive per task from a chunk table; returns the archives' paths and record counts.

    The payload's digest stands before the payload, so a row with it and the record's revisit comes before
    the chunks, as number -1. All rows of a record meet in one task, in order: an explicit repartition, unlike
    a join's exchange, is neither read locally nor split. Rows out of order raise Damaged.
    """
    sums = chunks.groupBy("record").agg(F.max_by("digest", "chunk_no").alias("sum"))
    described = sums.join(found, "record", "left").withColumn("chunk_no", F.lit(-1).cast("long"))
    kept = (
        chunks.drop("digest")
        .unionByName(described, allowMissingColumns=True)
        .select("record", "page_id", "url", "chunk_no", "size", "data", "sum", "of_id", "of_record")
        .repartition("record")
        .sortWithinPartitions("record", "chunk_no")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = member = now = of = digest = None
        count = due = left = 0

        def close() -> None:
            if left:
                raise Damaged(f"record {now} lacks {left} bytes")
            if member is not None:
                member.close()

        for batch in batches:
            data = batch.column(5)
            fields = [batch.column(i).to_pylist() for i in (0, 1, 2, 3, 4, 6, 7, 8)]
            for i, (record, page_id, url, number, size, total, of_id, of_record) in enumerate(zip(*fields, strict=True)):
                if number == -1:
                    close()
                    now, member, due, digest = record, None, 0, total
                    of = None if of_record is None else _name(of_id, of_record)
                    continue
                if record != now or number != due:
                    raise Damaged(f"chunk {number} of record {record} comes where chunk {due} of record {now} is due")
                due += 1
                if out is None:
                    path, out = create(folder, f"pages-{TaskContext.get().partitionId():06d}", ".warc.gz")
                if number == 0:
                    member, left = _Member(out, level), 0 if of else size
                    member.write(_header(page_id, record, url, size, digest, date, of))
                    count += 1
                if not of:
                    member.write(data[i].as_buffer())
                    left -= len(data[i].as_buffer())
        close()
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [count]})

    return settled(kept.mapInArrow(run, "path string, records long"), "archive-manifest")


def records(stream, chunk: int = CHUNK) -> Iterator[tuple[str | None, int, str, str, str | None]]:
    """page_id, payload bytes, digest, type and refers-to of each record; payloads are checked in passing."""
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise Damaged(f"a record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            key, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[key] = value
        block, size = int(fields["Content-Length"]), 0
        while (line := stream.readline()) not in (b"\r\n", b""):
            block -= len(line)
            if line.startswith(b"Content-Length: "):
                size = int(line[16:])
        block -= len(line)
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if fields["WARC-Type"] == "response":
            if block != size:
                raise Damaged(f"{fields['WARC-Record-ID']} has {block} bytes of {size}")
            state = hashlib.sha1()
            while block:
                data = stream.read(min(block, chunk))
                if not data:
                    raise Damaged(f"{fields['WARC-Record-ID']} ends early")
                state.update(data)
                block -= len(data)
            if shown(state.digest()) != digest:
                raise Damaged(f"{fields['WARC-Record-ID']} differs from its digest")
        if stream.read(4) != b"\r\n\r\n":
            raise Damaged(f"{fields['WARC-Record-ID']} has no end")
        refers = fields.get("WARC-Refers-To")
        yield _id(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], refers and _id(refers)


def read(manifest: DataFrame) -> DataFrame:
    """All records of the archives: page_id and refers_to as text, payload_bytes, payload_digest, record_type."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with open_stream(path) as source, gzip.GzipFile(fileobj=source) as stream:
                    for row in records(stream):
                        rows.append(row)
                        if len(rows) == 10_000:
                            yield table(rows)
                            rows = []
                if rows:
                    yield table(rows)

    files = manifest.select("path").repartition(max(1, manifest.count()), "path")
    return files.mapInArrow(run, schema)


def round_trip(pages: DataFrame, min_bytes: int = MIN_BYTES, chunk: int = CHUNK) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and report what is read back, one row per page.

    Null and empty payloads have no bytes. Equal rows are records of their own, all but the first revisits.
    Only page_id, url and html are read; an empty table gives no archive and no rows.
    """
    chunks = settled(chunk_table(pages, chunk), "payload-chunks")
    found = revisits(chunks, min_bytes, chunk)
    back = read(write(chunks, found, shared_folder(pages.sparkSession, "archives")))
    kind = pages.schema["page_id"].dataType
    return back.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))


#: Base 32 of a SHA-1: four letters for every five hexadecimal digits.
_LETTER = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(hx, 5 * k + 1, 5))::INTEGER >> {s}) % 32 + 1, 1)" for s in (15, 10, 5, 0))

ORACLE_SQL = f"""
WITH p AS (SELECT row_number() OVER () AS row_id, page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hx FROM pages),
firsts AS (SELECT *, first_value(row_id) OVER w AS first_row, first_value(page_id) OVER w AS first_id
           FROM p WINDOW w AS (PARTITION BY hx ORDER BY page_id NULLS LAST, row_id)),
letters AS (SELECT row_id, string_agg({_LETTER}, '' ORDER BY k) AS payload_digest
            FROM p, (SELECT unnest(range(8)) AS k) GROUP BY row_id)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN row_id = first_row OR payload_bytes < {MIN_BYTES} THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN row_id = first_row OR payload_bytes < {MIN_BYTES} THEN NULL ELSE first_id END AS refers_to
FROM firsts JOIN letters USING (row_id)
"""
