"""WARC archives through a chunked record table.

A record's payload is cut into chunks of bounded size; each chunk is a row
(record id, chunk number) that carries the digest of the payload up to its end.
Each chunk is written as one WARC record, the first as the response and the
others as its continuation segments, so neither side ever holds more of a
payload than a chunk plus a running digest. Archives are gzip files cut at a
bounded size; their last separator is the line separator of Spark's text writer.

Equal payloads are stored once: later ones are revisit records that name the
record they repeat.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.llm.common import cut, utf8_length
from silverline.session import scratch_path

CHUNK_BYTES = 1 << 18
ARCHIVE_BYTES = 1 << 26      # uncompressed; an archive ends before the chunk that would exceed it
DEDUP_BYTES = 1000           # shorter payloads are always stored
BATCH_BYTES = 1 << 24        # of chunks passed on at once
INFLATE_BYTES = 1 << 20

# The record separator and version line of the format.
CRLF = b"\r\n"
END = "\r\n\r\n"
VERSION = b"WARC/1.1"

RECORD_ID = "urn:page:"
CHUNK_SCHEMA = ("record_id string, chunk_no int, chunks int, offset long, chunk_bytes long, running_digest string, "
                "record_type string, refers_to string, payload_bytes long, payload_digest string, uri string, data binary")


def originals(pages: DataFrame, dedup_bytes: int = DEDUP_BYTES) -> DataFrame:
    """(payload_digest, original) of the payloads that occur more than once: the largest page_id holds the payload.

    Payloads of fewer than ``dedup_bytes`` are left out. Only digests are
    shuffled, and the largest id is found on the map side first, so large groups
    of copies are cheap.
    """
    return pages.filter(utf8_length(F.col("html")) >= dedup_bytes) \
        .groupBy(F.sha1(F.col("html").cast("binary")).alias("payload_digest")) \
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("copies")) \
        .filter("copies > 1").select("payload_digest", "original")


def chunk_rows(payload: memoryview, chunk_bytes: int):
    """(chunk number, offset, view of the chunk, digest so far); an empty payload has one empty chunk."""
    digest = hashlib.sha1()
    for number, offset in enumerate(range(0, max(len(payload), 1), chunk_bytes)):
        view = payload[offset:offset + chunk_bytes]
        digest.update(view)
        yield number, offset, view, digest.hexdigest()


def header(fields: list[tuple[str, object]]) -> bytes:
    lines = [VERSION] + [f"{k}: {v}".encode() for k, v in fields if v is not None]
    return CRLF.join(lines) + CRLF + CRLF


def _one_line(url: str | None) -> str | None:
    """A URI fit for a header line: control characters percent-encoded."""
    return None if url is None else "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url)


def segments(page_id, row: str, url, payload: bytes, digest: str, original, chunk_bytes: int):
    """The WARC records of one page, without their final separator; ``row`` tells rows of one page_id apart."""
    name, date = f"<{RECORD_ID}{page_id}:{row}>", "1970-01-01T00:00:00Z"
    if original is not None:
        yield header([("WARC-Type", "revisit"), ("WARC-Record-ID", name), ("WARC-Date", date), ("WARC-Target-URI", _one_line(url)),
                      ("WARC-Refers-To", f"<{RECORD_ID}{original}>"), ("WARC-Payload-Digest", f"sha1:{digest}"),
                      ("WARC-Segment-Total-Length", len(payload)), ("Content-Length", 0)])
        return
    for number, offset, view, running in chunk_rows(memoryview(payload), chunk_bytes):
        more = [("WARC-Segment-Number", number + 1), ("X-Offset", offset), ("X-Running-Digest", f"sha1:{running}"),
                ("WARC-Segment-Total-Length", len(payload)), ("WARC-Payload-Digest", f"sha1:{digest}"),
                ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(view))]
        if number == 0:
            yield header([("WARC-Type", "response"), ("WARC-Record-ID", name), ("WARC-Date", date),
                          ("WARC-Target-URI", _one_line(url)), *more]) + bytes(view)
        else:
            yield header([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}#{number}>"),
                          ("WARC-Segment-Origin-ID", name), ("WARC-Date", date), *more]) + bytes(view)


def _archive_rows(chunk_bytes: int, archive_bytes: int, batches):
    """Rows (archive, record text): archives are numbered within the task and cut by size."""
    from pyspark import TaskContext

    task, part, filled = TaskContext.get().partitionId(), 0, 0
    names, texts, held, row = [], [], 0, 0

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(names), pa.array(texts, pa.binary())], ["archive", "value"])

    for batch in batches:
        for i in range(batch.num_rows):
            page_id, url, html, digest, original = (column[i] for column in batch.columns)
            payload = html.as_buffer() if html.is_valid else b""
            row += 1
            for record in segments(page_id.as_py(), f"{task}-{row}", url.as_py(), memoryview(payload), digest.as_py(), original.as_py(), chunk_bytes):
                if filled and filled + len(record) > archive_bytes:
                    part, filled = part + 1, 0
                filled += len(record) + len(END)
                names.append(f"{task:06d}-{part:05d}")
                texts.append(record)
                held += len(record)
                if held >= BATCH_BYTES:
                    yield flush()
                    names, texts, held = [], [], 0
    if names:
        yield flush()


def write_archives(pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, archive_bytes: int = ARCHIVE_BYTES,
                   dedup_bytes: int = DEDUP_BYTES) -> None:
    """Write a record for every row of ``pages`` (page_id, url, html) below ``path``.

    A null html is an empty payload; a null url is left out of the header; a row
    without page_id is always stored in full, as are rows that share the largest
    page_id of their payload. No other columns are read. An empty table writes
    no archive.
    """
    digest = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    rows = pages.select("page_id", "url", F.col("html").cast("binary").alias("html"), digest.alias("payload_digest")) \
        .join(originals(pages, dedup_bytes), "payload_digest", "left") \
        .select("page_id", "url", "html", "payload_digest",
                F.when(F.col("original") != F.col("page_id"), F.col("original")).alias("original"))
    rows.mapInArrow(partial(_archive_rows, chunk_bytes, archive_bytes), "archive string, value binary") \
        .select("archive", F.col("value").cast("string").alias("value")) \
        .write.partitionBy("archive").option("lineSep", END).option("compression", "gzip").text(path)


class Inflated:
    """A gzip file read in pieces: ``line`` and ``take`` hold no more than they return and a piece."""

    def __init__(self, packed):
        self.packed, self.next = memoryview(packed), 0
        self.inflate = zlib.decompressobj(31)
        self.held, self.at = b"", 0

    def _more(self) -> bool:
        if self.inflate.eof:                          # the file may have several members
            left, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
        else:
            left = self.inflate.unconsumed_tail
        if not left:
            left = self.packed[self.next:self.next + INFLATE_BYTES]
            self.next += INFLATE_BYTES
        if not len(left):
            return False
        self.held, self.at = self.held[self.at:] + self.inflate.decompress(left, INFLATE_BYTES), 0
        return True

    def line(self) -> bytes | None:
        while (end := self.held.find(CRLF, self.at)) < 0:
            if not self._more():
                return None
        line, self.at = self.held[self.at:end], end + 2
        return line

    def take(self, n: int) -> bytes:
        while len(self.held) - self.at < n:
            if not self._more():
                raise ValueError("the archive ends within a record")
        out, self.at = self.held[self.at:self.at + n], self.at + n
        return out


def records_of(packed: bytes):
    """(header fields, block) of every record of an archive, one at a time."""
    source = Inflated(packed)
    while (line := source.line()) is not None:
        if line != VERSION:
            raise ValueError("not a WARC record")
        fields = {}
        while line := source.line():
            name, _, value = line.decode().partition(": ")
            fields[name] = value
        yield fields, source.take(int(fields["Content-Length"]))
        if source.take(len(END)) != END.encode():
            raise ValueError("a record does not end where it should")


def _key(name: str) -> str:
    return name[1:-1].removeprefix(RECORD_ID)


def _chunk_batches(keep_data: bool, chunk_bytes: int, batches):
    """Chunk rows of archives, their digests carried on and checked record by record.

    Chunks of a record that begins in another archive have no running digest here.
    """
    columns = [c.split()[0] for c in CHUNK_SCHEMA.split(", ")]
    rows, held = [], 0

    def flush():
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(zip(columns, (
            pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(),
            pa.string(), pa.string(), pa.binary()), strict=True))))

    for batch in batches:
        for content in batch.column(0):
            state, expected = hashlib.sha1(), (None, 0)
            for fields, block in records_of(content.as_buffer()):
                total = int(fields["WARC-Segment-Total-Length"])
                revisit = fields["WARC-Type"] == "revisit"
                number = int(fields.get("WARC-Segment-Number", "1")) - 1
                key = _key(fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"]))
                if number == 0:
                    state, expected = hashlib.sha1(), (key, 0)
                known = expected == (key, number)
                if known:
                    state.update(block)
                    expected = (key, number + 1)
                written = fields.get("X-Running-Digest", "").removeprefix("sha1:")
                if known and not revisit and state.hexdigest() != written:
                    raise ValueError(f"record {key}: chunk {number} does not have its digest")
                rows.append({"record_id": key, "chunk_no": number, "chunks": 1 if revisit else max(1, -(-total // chunk_bytes)),
                             "offset": int(fields.get("X-Offset", "0")), "chunk_bytes": len(block),
                             "running_digest": state.hexdigest() if known and not revisit else None,
                             "record_type": "revisit" if revisit else "response",
                             "refers_to": _key(fields["WARC-Refers-To"]) if revisit else None, "payload_bytes": total,
                             "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                             "uri": fields.get("WARC-Target-URI"), "data": block if keep_data else None})
                held += len(block) if rows[-1]["data"] is not None else 200
                if held >= BATCH_BYTES:
                    yield flush()
                    rows, held = [], 0
    if rows:
        yield flush()


def read_chunks(spark: SparkSession, path: str, keep_data: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of the archives below ``path``: one row per record id and chunk number."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", "*.txt.gz").load(path).select("content")
    return files.mapInArrow(partial(_chunk_batches, keep_data, chunk_bytes), CHUNK_SCHEMA)


def _carry_on(batches):
    """Digests of records whose chunks arrive in order, a chunk at a time."""
    current, state, seen, done = None, hashlib.sha1(), 0, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["record_id"] != current:
                if current is not None:
                    done.append((current, seen, state.hexdigest()))
                current, state, seen = row["record_id"], hashlib.sha1(), 0
            state.update(row["data"])
            seen += row["chunk_bytes"]
    if current is not None:
        done.append((current, seen, state.hexdigest()))
    kinds = (("record_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()))
    yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, (_, t) in enumerate(kinds)], [n for n, _ in kinds])


def read_records(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(record_id, payload_bytes, payload_digest, record_type, refers_to) of every record, digests recomputed.

    Records that lie in one archive have theirs from the scan. Those that span
    archives are put in chunk order by a sort and digested from its stream.
    """
    last = cut(read_chunks(spark, path, keep_data=False, chunk_bytes=chunk_bytes).filter("chunk_no = chunks - 1")
               .select("record_id", "offset", "chunk_bytes", "running_digest", "record_type", "refers_to", "payload_bytes",
                       "payload_digest"), "warc-records")
    revisit = F.col("record_type") == "revisit"
    whole = last.filter(revisit | F.col("running_digest").isNotNull()) \
        .select("record_id", F.when(revisit, F.col("payload_bytes")).otherwise(F.col("offset") + F.col("chunk_bytes")).alias("payload_bytes"),
                F.when(revisit, F.col("payload_digest")).otherwise(F.col("running_digest")).alias("payload_digest"),
                "record_type", "refers_to")
    spanning = last.filter(~revisit & F.col("running_digest").isNull()).select("record_id")
    if spanning.isEmpty():
        return whole
    digests = read_chunks(spark, path, keep_data=True, chunk_bytes=chunk_bytes).filter("chunks > 1") \
        .join(spanning, "record_id", "left_semi").select("record_id", "chunk_no", "chunk_bytes", "data") \
        .repartition("record_id").sortWithinPartitions("record_id", "chunk_no") \
        .mapInArrow(_carry_on, "record_id string, payload_bytes long, payload_digest string")
    return whole.unionByName(digests.select("*", F.lit("response").alias("record_type"), F.lit(None).cast("string").alias("refers_to")))


def _page(record_id: Column) -> Column:
    """The page_id of a record id; null for rows that had none."""
    return F.substring_index(record_id, ":", 1).try_cast("long")


def archive_pages(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages to archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, chunk_bytes, archive_bytes)
    back = read_records(pages.sparkSession, path, chunk_bytes)
    return back.select(_page(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast("long").alias("refers_to"))


WARC_SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT payload_digest, max(page_id) AS original FROM p WHERE payload_bytes >= {DEDUP_BYTES} GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN original <> page_id THEN original END AS refers_to
FROM p LEFT JOIN m USING (payload_digest)
"""
