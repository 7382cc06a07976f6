from __future__ import annotations

from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from silverline.llm import mixing as M
from tests.llm.helpers import SF, docs_of, words


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Round by round: share out by weight, stop the sources that are full, share the excess."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, full, left = dict.fromkeys(names, 0.0), set(), share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        rest = left - sum(most * sizes[s] for s in full)
        for s in open_:
            target[s] = rest * weight[s] / sum(weight[x] for x in open_)
        over = [s for s in open_ if target[s] >= most * sizes[s]]
        if not over:
            return target
        for s in over:
            target[s] = most * sizes[s]
            full.add(s)


ROWS = [(i, "w " * (i % 17), f"s{i * i % 7}") for i in range(200)] + [(None, "a b c", None), (300, None, None), (301, "", "zero"),
        (302, "x y z", "é"), (302, "x y z", "é"), (303, "big " * 5000, "s0")]


def test_against_brute_force(spark):
    docs = docs_of(spark, ROWS).withColumn("size", F.lit("clash")).withColumn("taken", F.lit("clash"))
    got = M.mix_documents(docs).collect()
    sizes = defaultdict(int)
    for _, t, s in ROWS:
        sizes[s] += len(words(t))
    goal = plain_targets(sizes)
    by_size = defaultdict(list)
    for r in got:
        assert r["taken"] <= 2 * r["size"]
        by_size[r["source_size"], r["target"]].append(r["taken"])
    assert len(got) == len(ROWS)
    assert sorted(round(t, 6) for _, t in by_size) == pytest.approx(sorted({round(v, 6) for v in goal.values()}))
    full = M.mix(M.sizes_of(docs)).groupBy("source").agg(F.sum("taken").alias("n"), F.max("target").alias("t")).collect()
    for r in full:
        assert r["t"] == pytest.approx(goal[r["source"]]) and r["n"] == int(r["t"] + 1e-9)
    assert sorted(map(str, got)) == sorted(map(str, M.mix_documents(docs.repartition(5)).collect()))


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(M.MIX_SQL).fetchall()
    assert sorted(map(tuple, M.mix_documents(spark.read.parquet(f"{SF}/documents.parquet")).collect())) == sorted(want)


def test_empty(spark):
    assert M.mix_documents(docs_of(spark, ROWS).limit(0)).count() == 0
    only = M.mix_documents(docs_of(spark, [(1, None), (2, "  ")])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in only] == [(0, 0.0, 0)] * 2


def test_rows_follow_the_words_taken(spark):
    docs = docs_of(spark, ROWS[:200] + ROWS[203:])
    taken = {(r["doc_id"], r["size"]): r["taken"] for r in M.mix(M.sizes_of(docs)).collect()}
    rows = M.mixed_rows(docs)
    assert rows.columns == docs.columns
    copies = defaultdict(int)
    for r in rows.collect():
        copies[r["doc_id"], len(words(r["text"]))] += 1
    for key, n in taken.items():
        if key[0] != 302:                   # two rows of one key
            assert copies[key] == (int(n / key[1] + 0.5) if key[1] else 0)


def test_rows_without_a_doc_id_stay_within_the_budget(spark):
    """580 of 600 rows of a source have no doc_id, as many again are equal rows of another source."""
    rows = [(None, f"t{i} " * (1 + i % 20), "a") for i in range(580)] + [(i, "x " * 10, "a") for i in range(20)] \
        + [(7, "y " * 10, "b")] * 580 + [(i, "z " * 9, "b") for i in range(100, 120)] + [(8, "z " * 11, "c")] * 5
    docs = docs_of(spark, rows)
    goal = plain_targets({s: sum(len(words(t)) for _, t, x in rows if x == s) for s in "abc"})
    for most in (2, 1):
        taken = defaultdict(int)
        for r in M.mixed_rows(docs, most=most, share=0.7 if most == 1 else 1.5).collect():
            taken[r["source"]] += len(words(r["text"]))
        want = goal if most == 2 else {r["source"]: r["target"] for r in M.targets(
            M.sizes_of(docs).groupBy("source").agg(F.sum("size").alias("source_size")), share=0.7, most=1).collect()}
        assert all(abs(taken[s] - want[s]) <= 20 for s in "abc"), (taken, want)


def test_large_groups_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(M, "RUN_ROWS", 7)
    rows = [(None, "a b c", "s")] * 100 + [(1, "d e", "s"), (2, "f", "t")]
    got = M.mix(M.sizes_of(docs_of(spark, rows)), share=0.6, most=1).groupBy("source").agg(F.sum("taken").alias("n"), F.max("target").alias("t"),
                                                                                          F.count("*").alias("rows")).collect()
    assert sorted((r["source"], r["n"], r["rows"]) for r in got) == sorted((r["source"], int(r["t"] + 1e-9), {"s": 101, "t": 1}[r["source"]]) for r in got)
