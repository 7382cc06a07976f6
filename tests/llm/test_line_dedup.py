from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from silverline.llm import line_dedup as L
from silverline.llm.cuckoo import CuckooFilter, probe
from tests.llm.helpers import BLANK, SF, docs_of, lower


def expected(rows, min_docs):
    keys = [[lower(x.strip(BLANK)) for x in (t or "").split("\n")] for _, t in rows]
    count = {}
    for ks in keys:
        for k in set(ks):
            count[k] = count.get(k, 0) + 1
    out = []
    for (d, t), ks in zip(rows, keys, strict=True):
        kept = [x for x, k in zip((t or "").split("\n"), ks, strict=True) if not k or count[k] < min_docs]
        out.append((d, len(ks), len(ks) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


ROWS = [(i, "\n".join(["Common line ", f"rare {i}", "", "\tSOME" if i % 2 else "some\r"][: i % 5])) for i in range(40)] + [
    (None, None), (100, ""), (101, "common LINE"), (101, "common LINE"), (102, "x\n" * 30000), (103, " \nÉA\néa")]


def result(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("limit", [L.BROADCAST_BYTES, 0])
def test_against_brute_force(spark, limit):
    docs = docs_of(spark, ROWS).withColumn("kept", F.lit("clash")).withColumn("high", F.lit(1))
    store = L.LineStore.empty(spark, 5).insert(docs)
    assert result(store.clean(docs, limit)) == expected(ROWS, 5)
    assert store.clean(docs.limit(0), limit).count() == 0


def test_updates_are_reversible(spark):
    rng = random.Random(3)
    lines = [f"line {i}" for i in range(25)]
    old = [(i, "\n".join(rng.sample(lines, 4))) for i in range(30)]
    new = [(100 + i, "\n".join(rng.sample(lines, 6))) for i in range(30)]
    first = L.LineStore.empty(spark, 5).insert(docs_of(spark, old))
    both = first.insert(docs_of(spark, new))
    again = both.delete(docs_of(spark, new))
    assert result(both.clean(docs_of(spark, old + new))) == expected(old + new, 5)
    assert result(again.clean(docs_of(spark, old))) == expected(old, 5)
    assert sorted(map(tuple, again.refs.collect())) == sorted(map(tuple, first.refs.collect()))
    with pytest.raises(ValueError, match="not in the store"):
        first.delete(docs_of(spark, [(1, "never seen")]))


def test_filters_are_split_when_full(spark, monkeypatch):
    monkeypatch.setattr(L, "BUCKETS", 4)
    monkeypatch.setattr(L, "SHARD_KEYS", 16)
    rows = [(i, "\n".join(f"l{j}" for j in range(150))) for i in range(2)]
    docs = docs_of(spark, rows)
    store = L.LineStore.empty(spark, 2).insert(docs)
    assert store.shards >= 8 and result(store.clean(docs)) == expected(rows, 2)


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, (900, 2)).astype(np.uint64)
    cuckoo = CuckooFilter(256)
    assert all(cuckoo.insert(int(a), int(b)) for a, b in keys)
    held = lambda k: probe(cuckoo.table[None], np.zeros(len(k), int), k[:, 0], k[:, 1])
    assert held(keys).all()
    assert all(cuckoo.delete(int(a), int(b)) for a, b in keys[:450]) and held(keys[450:]).all()
    assert held(rng.integers(0, 2**63, (5000, 2)).astype(np.uint64)).mean() < 0.01
    assert all(cuckoo.delete(int(a), int(b)) for a, b in keys[450:]) and not cuckoo.table.any()


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(L.LINES_SQL).fetchall()
    got = L.dedup_lines(spark.read.parquet(f"{SF}/documents.parquet")).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_least_is_in_code_points(spark):
    docs = docs_of(spark, [(i, "éé\nabc\nown %d line" % i) for i in range(12)])
    for least, left in ((2, 0), (3, 1), (4, 2)):
        store = L.LineStore.empty(spark, 10, least).insert(docs.select("doc_id", "text"))
        assert {r["kept"].count("\n") for r in store.clean(docs.select("doc_id", "text")).collect()} == {left}


def test_a_repeated_row_counts_as_a_document(spark):
    rows = [(1, "ten times\nthe same")] * 10 + [(2, "ten times\nonly here")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = L.dedup_lines(docs_of(spark, rows)).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
    want = con.execute(L.LINES_SQL)
    order = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(*order).collect())) == sorted(want.fetchall())
    assert {(r["doc_id"], r["n_dropped"]) for r in got.collect()} == {(1, 2), (2, 1)}
