"""The feed and the source documents on many rows: more partitions, the same rows, nothing derived twice."""

from __future__ import annotations

import glob

from silverline import registry as Rg
from silverline import session
from silverline.fixtures import order_feed as feed
from silverline.session import scratch_path
from silverline.sources import array_documents as A

from .conftest import SMALL_SF


def _lines(df):
    return sorted(r[0] for r in df.collect())


def test_many_rows_get_more_partitions_and_the_same_feed(spark, monkeypatch):
    plain = _lines(feed.feed_lines(spark, SMALL_SF))
    docs = {(r.doc_id, tuple(sorted(r.doc))) for r in feed.feed_documents(spark, SMALL_SF).collect()}
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    many = feed.feed_lines(spark, SMALL_SF)
    assert many.rdd.getNumPartitions() >= 12          # 6,000 line items
    assert _lines(many) == plain
    assert {(r.doc_id, tuple(sorted(r.doc))) for r in feed.feed_documents(spark, SMALL_SF).collect()} == docs


def test_raw_feed_and_the_second_copy_are_compressed_and_whole(spark):
    raw = Rg.raw_feed_path(spark, SMALL_SF)
    assert all(f.endswith(".gz") for f in glob.glob(f"{raw}/part-*"))
    assert _lines(spark.read.text(raw)) == _lines(feed.feed_lines(spark, SMALL_SF))
    root = Rg.source_docs_root(spark, SMALL_SF)
    read = [_lines(spark.read.schema("value STRING").text(f"{root}/{name}")) for name in ("movie_feed", "extra_feed")]
    assert read[0] == read[1] and read[0]
    assert not [f for f in glob.glob(f"{root}/movie_feed/*/part-*") if f.endswith(".gz")]      # splittable
    assert all(f.endswith(".gz") for f in glob.glob(f"{root}/extra_feed/*/part-*"))


def test_a_task_reads_many_small_splits(spark):
    path = scratch_path(spark, "many-splits")
    text = '{"movie": [' + ",".join(f'{{"Id": "{i}", "t": "a}}b]"}}' for i in range(4000)) + "]}"
    spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.text(path)
    written = []
    keep = A._written

    def counted(df, tag):
        written.append(df.rdd.getNumPartitions())
        return keep(df, tag)

    A._written = counted
    try:
        found = A.read_array_elements(spark, path, "movie", split_bytes=1024)
        assert sorted(r.value for r in found.collect()) == sorted(f'{{"Id": "{i}", "t": "a}}b]"}}' for i in range(4000))
    finally:
        A._written = keep
    assert len(text) > 1024 * max(written) * 2         # splits are more than tasks
