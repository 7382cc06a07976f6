from __future__ import annotations

import gzip
import hashlib
import glob

import pytest
from pyspark.sql import functions as F

from silverline.llm import warc
from silverline.session import scratch_path

LONG = "<p>" + "x\r\n\r\ny" * 900 + "</p>"
PAGES = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (3, None, None), (4, "http://a/4\nX: y", ""), (5, "http://a/5", "short"),
         (6, "http://a/6", "short"), (7, "http://a/7", "WARC/1.1\r\n\r\n" * 300), (None, "http://a/8", LONG), (9, "u", "é" * 499),
         (10, "u", "é" * 500), (11, "u", "é" * 500)]


def expected(rows):
    largest = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            largest[h] = max(largest.get(h, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        to = largest.get(h) if len(b) >= 1000 and i is not None else None
        revisit = to is not None and to != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk,archive", [(1 << 18, 1 << 26), (700, 1500), (1, 64)])
def test_round_trip(spark, chunk, archive):
    rows = PAGES if chunk > 1 else PAGES[2:6]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload_digest", F.lit("clash"))
    got = warc.archive_pages(pages, chunk, archive).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "u", LONG)] * 3 + [(1, "u", "other")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert [r["record_type"] for r in warc.archive_pages(pages, 600, 2000).collect()] == ["response"] * 4
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_chunk_table_rebuilds_the_payload(spark):
    pages = spark.createDataFrame([(1, "http://a", LONG), (2, "http://b", "")], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages, path, chunk_bytes=1000, archive_bytes=2500)
    chunks = sorted(warc.read_chunks(spark, path, chunk_bytes=1000).collect(), key=lambda r: (r["record_id"], r["chunk_no"]))
    first = [c for c in chunks if c["record_id"].startswith("1:")]
    assert b"".join(bytes(c["data"]) for c in first) == LONG.encode()
    assert [c["chunk_no"] for c in first] == list(range(first[0]["chunks"])) and max(c["chunk_bytes"] for c in first) == 1000
    files = glob.glob(f"{path.removeprefix('file://')}/**/*.txt.gz", recursive=True)
    assert len(files) > 2 and all(gzip.open(f).read().startswith(b"WARC/1.1\r\n") for f in files)


def test_damage_is_found(spark):
    record = next(warc.segments(1, "0-1", "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None, 100))
    bad = gzip.compress(record.replace(b"payload", b"PAYLOAD") + warc.END.encode())
    import pyarrow as pa
    with pytest.raises(ValueError, match="digest"):
        list(warc._chunk_batches(True, 100, [pa.RecordBatch.from_arrays([pa.array([bad], pa.binary())], ["content"])]))
