from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from silverline.llm import hamming as H

SF = "/root/testdata/sf0.01"


def expected(rows, k, step):
    bits = max((len(v) for _, v in rows if v is not None), default=0)
    codes = [(i, [bool(x and x > 0) for x in v] + [False] * (bits - len(v))) for i, v in rows if v is not None and i is not None]
    out = []
    for q, a in codes:
        if q % step == 0:
            near = sorted((sum(x != y for x, y in zip(a, b, strict=True)), i) for i, b in codes)[:k]
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("bits,n", [(12, 300), (64, 200), (100, 150)])
def test_against_brute_force(spark, monkeypatch, bits, n):
    monkeypatch.setattr(H, "CHUNK_CODES", 40)
    rng = random.Random(bits)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(bits)]) for i in range(n)]
    rows += [(n + i, rows[i % 3][1]) for i in range(60)]                    # copies, of queries too
    rows += [(5000, None), (None, rows[0][1]), (5001, [None] * bits), (5002, [0.5]), (5003, []), (10, rows[4][1]), (50, rows[4][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("code", F.lit("clash")).withColumn("id", F.lit(1))
    got = H.top_k(table, k=7, query_step=10)
    assert sorted(map(tuple, got.collect())) == expected(rows, 7, 10)


def test_few_rows_and_empty(spark):
    rows = [(0, [1.0, -1.0]), (50, [1.0, 1.0]), (51, [-1.0, -1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, H.top_k(table).collect())) == expected(rows, 10, 50)
    assert H.top_k(table.limit(0)).count() == 0
    assert H.top_k(table.filter("vec_id = 51")).count() == 0


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert sorted(map(tuple, H.top_k(spark.read.parquet(f"{SF}/embeddings.parquet")).collect())) == sorted(con.execute(H.SEARCH_SQL).fetchall())


def test_segments():
    for bits in (1, 7, 64, 100, 1000):
        parts = H.segments(bits, 50000)
        assert sum(w for _, w in parts) == bits and all(a + w == b for (a, w), (b, _) in zip(parts, parts[1:], strict=False))


def test_a_hot_segment_value(spark, monkeypatch):
    """A third of the codes agree on a segment; its chunk is cut, and far steps are compared, not probed."""
    monkeypatch.setattr(H, "CHUNK_CODES", 16)
    rng = random.Random(4)
    fixed = [rng.choice([-1.0, 1.0]) for _ in range(32)]
    rows = [(i, (fixed if i % 3 == 0 else [rng.uniform(-1, 1) for _ in range(32)]) + [rng.uniform(-1, 1) for _ in range(32)]) for i in range(330)]
    rows += [(1000, [-x for x in rows[0][1]]), (1010, [1.0] * 64)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, H.top_k(table, k=9, query_step=10).collect())) == expected(rows, 9, 10)


def test_chunk_flips_are_those_of_the_masks():
    for width in (1, 5, 9):
        for shift in range(width + 1):
            for step in range(width + 1):
                want = sorted(set((H.masks(width, step) >> shift).tolist()))
                assert sorted(H._chunk_flips(width, shift, step).tolist()) == want
