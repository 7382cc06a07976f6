from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from silverline.llm import hard_negatives as H

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, label int, embedding array<float>"


def expected(rows, step):
    seen = set()
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        seen.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    out = []
    for i, label, v in seen:
        if i % step:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in seen if j != i)      # noqa: B905
        for minus, p, _ in [s for s in scored if s[2] == label][:5]:
            fit = [s for s in scored if s[2] != label and 30 * -minus <= 100 * -s[0] <= 90 * -minus][:10]
            out += [(i, p, r + 1, n, -minus, -score) for r, (score, n, _) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("bits,spread", [(3, 1.0), (8, 1.0), (16, 6.0)])
def test_against_brute_force(spark, monkeypatch, bits, spread):
    monkeypatch.setattr(H, "SHARD_VALUES", 60 * bits)
    monkeypatch.setattr(H, "BLOCK_VALUES", 7 * bits)
    rng = random.Random(bits)
    rows = []
    for i in range(300):
        scale = rng.uniform(0.1, spread)
        rows.append((i, rng.choice([1, 1, 1, 2, 3, 9]), [rng.gauss(0.4, 0.5) * scale for _ in range(bits)]))
    rows += [(300 + i, rng.choice([1, 2]), rows[i % 3][2]) for i in range(60)]          # copies
    rows += [(2000, None, rows[0][2]), (2010, 1, None), (None, 1, rows[0][2]), (2020, 1, [None] * bits), (2030, 1, [math.nan] * bits),
             (2040, 1, [math.inf] + [0.0] * (bits - 1)), (2050, 2, []), (2060, 1, [0.0] * bits), (2070, 3, [0.5]), rows[10], rows[10]]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("vec", F.lit("clash")).withColumn("anchor", F.lit(1))
    assert sorted(map(tuple, H.hard_negatives(table, anchor_step=10).collect())) == expected(rows, 10)


def test_pruning_is_used_and_loses_nothing():
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(20, 24))
    whole = np.floor(256 * (centre[rng.integers(0, 20, 4000)] + 0.15 * rng.normal(size=(4000, 24)))).astype(np.int64)
    whole[::3] *= 4
    met, length = 0, 0.0
    for bucket in H.buckets_of(whole):
        for row in range(0, 4000, 400):
            length = float(np.sqrt((whole[row].astype(float) ** 2).sum()))
            scores = bucket.whole @ whole[row]
            reach = float(np.sort(scores)[-10])
            found = bucket.candidates(whole[row], length, reach)
            if found is not None:
                met += len(found) < len(bucket.rows) / 4
                assert set(np.flatnonzero(scores >= reach)) <= set(found.tolist())
                assert (bucket.scores(whole[row], found) == scores[found]).all()
    assert met > 10


def test_large_components():
    big = np.array([[1 << 40, 3], [-(1 << 30), 7]], np.int64)
    assert H.buckets_of(big)[0].scores(np.array([2, 1], np.int64), None).tolist() == [(1 << 41) + 3]
    with pytest.raises(OverflowError):
        H.buckets_of(big)[0].scores(np.array([1 << 40, 0], np.int64), None)


def test_few_rows_and_empty(spark):
    rows = [(0, 1, [1.0, 0.5]), (1, 2, [0.5, 0.5]), (2, 2, [0.5, 0.25])]
    table = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, H.hard_negatives(table).collect())) == expected(rows, 100) == []
    assert H.hard_negatives(table.limit(0)).count() == 0
    more = [*rows, (3, 1, [0.4, 0.25])]
    assert sorted(map(tuple, H.hard_negatives(spark.createDataFrame(more, SCHEMA)).collect())) == expected(more, 100) != []


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = H.hard_negatives(spark.read.parquet(f"{SF}/embeddings.parquet"))
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(H.NEGATIVES_SQL).fetchall())
