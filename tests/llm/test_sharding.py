from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from silverline.llm import sharding as S
from tests.llm.helpers import SF, docs_of


def check_rows(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = S.shard_documents(docs).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(texts[r["doc_id"]]) + 1, zlib.crc32(texts[r["doc_id"]]), "rows", None)
    check_rows(rows, 16)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, S.shard_documents(docs.repartition(7)).collect()))


def test_edges(spark):
    rows = [(None, None), (None, ""), (1, "a"), (1, "a"), (1, "b"), (2, "é" * 50000)] + [(7, "same")] * 40
    docs = docs_of(spark, rows).withColumn("shard", F.lit(1)).withColumn("slot", F.lit(1))
    out = S.shard_documents(docs).collect()
    assert len(out) == len(rows) and Counter((r["doc_id"], r["size"]) for r in out) == Counter((d, len((t or "").encode()) + 1) for d, t in rows)
    check_rows(out, 16)
    assert S.shard_documents(docs.limit(0)).count() == 0


def test_overflow_goes_on_clockwise():
    """A row is in the first shard clockwise that is not full."""
    for slack in (0.0, 0.1):
        counts = {c: 1 + (c * 7919) % 13 + 400 * (c == 17) for c in range(0, 512, 3)}
        walk, room = S.clockwise(6, 8, 512), S.capacities(sum(counts.values()), 6, slack)
        placed, used = Counter(), Counter()
        for cell, first, end, shard, slot in S.flows(counts, 6, 8, 512, slack):
            placed[cell] += end - first
            assert slot == used[shard]
            used[shard] += end - first
        assert placed == Counter(counts) and all(used[s] <= room[s] for s in range(6))
        for cell, _, _, shard, _ in S.flows(counts, 6, 8, 512, slack):
            assert all(used[s] == room[s] for s in walk[cell][:walk[cell].index(shard)])


def test_walk_is_clockwise():
    walk = S.clockwise(3, 2, 16)
    at = defaultdict(set)
    for s in range(3):
        for v in range(2):
            at[S._cell_of(s, v, 16)].add(s)
    for cell in range(16):
        seen = []
        for step in range(16):
            seen += [s for s in sorted(at[(cell + step) % 16]) if s not in seen]
        assert walk[cell] == seen


def test_limited_movement(spark):
    keys = spark.range(4000).withColumnRenamed("id", "doc_id")
    two = S.assign(keys, ["doc_id"], 16, slack=0.25).join(
        S.assign(keys, ["doc_id"], 17, slack=0.25).select("doc_id", F.col("shard").alias("grown")), "doc_id")
    assert two.filter("shard <> grown").count() < 4000 * 0.2          # a plain remainder would move 94 %


def test_plan_is_native(spark):
    plan = S.shard_documents(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
