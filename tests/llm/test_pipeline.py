from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from silverline.llm import decontaminate, quality_crf
from tests.llm.helpers import SF, docs_of, edit_distance_within, gram_set, least_of_group, words
from tests.llm.test_decontaminate import plain_words
from tests.llm.test_mixing import plain_targets


def test_run_against_brute_force(spark):
    docs, labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    good = {r["doc_id"] for r in quality_crf.quality(docs, labels).collect() if r["predicted"]}
    rows = [r for r in rows if r[0] in good]
    least = least_of_group({i: gram_set(t, 5) for i, t, _ in rows}, 80, 100)
    rows = [r for r in rows if least[r[0]] == r[0]]
    items = [plain_words(r["text"]) for r in bench.collect()]
    rows = [r for r in rows if not any(
        w and set(w) & set(own) and edit_distance_within(w, own) <= decontaminate.budget(len(w)) for w in items for own in [plain_words(r[1])])]
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    goal = plain_targets(sizes)
    got = corpus_pipeline.run(spark, SF).collect()
    copies = Counter(r["doc_id"] for r in got)
    assert copies.keys() <= {r[0] for r in rows} and max(copies.values()) <= 2
    taken = Counter()
    for i, t, s in rows:
        taken[s] += copies[i] * len(words(t))
    longest = {s: max(len(words(t)) for _, t, x in rows if x == s) for s in sizes}
    assert all(abs(taken[s] - goal[s]) <= longest[s] for s in sizes)
    per_shard = Counter(r["shard"] for r in got)
    assert max(per_shard.values()) - min(per_shard[s] for s in range(16)) <= 1
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]]) for r in got)


def test_stages_keep_columns_and_bear_odd_rows(spark):
    odd = docs_of(spark, [(None, None), (1, None), (2, ""), (3, "words of a document " * 9, None), (3, "words of a document " * 9, None), (4, "other text here")]) \
        .withColumn("_score", F.lit(0.0)).withColumn("size", F.lit("x")).drop("_score")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "sharding"]
    for frame in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF)
            if name != "sharding":
                assert out.columns == frame.columns
            assert out.count() <= 2 * odd.count()


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.keep_good(spark, docs, "/root/testdata/sf0.01").select("doc_id").collect()}
    fine = {r["doc_id"] for r in labels.filter("quality = 1").collect()}
    assert len(fine - kept) <= 0.01 * len(fine)
