from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverline.llm import fast_sketch as S
from tests.llm.helpers import SF, docs_of, gram_set, least_of_group
from tests.llm.test_ngram_join import near_copies


def check(spark, rows, n=4, num=80, den=100):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in S.near_duplicates(docs_of(spark, rows), n, num, den).collect()}
    sets = {i: gram_set(t, n) for i, t in rows}
    least = least_of_group(sets, num, den)
    assert got == {i: (len(sets[i]), least[i], i == least[i]) for i in sets}
    return got


def test_sketch_is_filled_and_concentrated():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for size in (1, 2, 5, 40, 255, 1000, 2000):
        for share in (0.5, 0.8, 0.95):
            common = int(round(2 * size * share / (1 + share)))
            a, b = pool[:size], np.concatenate([pool[:common], pool[size:2 * size - common]])
            similarity = common / (2 * size - common)
            one, two = S.sketches([a, b])
            assert abs((one == two).mean() - similarity) < S.SLACK
    same = S.sketches([pool[:7], pool[6::-1], pool[:300], pool[:300]])
    assert (same[0] == same[1]).all() and (same[2] == same[3]).all()
    # every coordinate is filled, whatever else is sketched with the set, and by the rounds' order
    alone = [S.sketches([pool[:k]])[0] for k in (1, 3, 50)]
    assert (S.sketches([pool[:1], pool[:3], pool[:50]]) == np.array(alone)).all()


def test_plain_rounds():
    """The sketch of a few sets by the plain definition."""
    t, top = 16, (1 << 64) - 1
    for size in (1, 3, 30):
        grams = np.random.default_rng(size).integers(0, 1 << 63, size, dtype=np.uint64)
        bins = [top] * t
        for i in range(2 * t):
            for g in grams:
                h = int(S.mixed(g ^ np.array([i + 1], np.uint64) * S._SEED)[0])
                b = (h >> 32) * t >> 32 if i < t else i - t
                bins[b] = min(bins[b], i << 48 | h & ((1 << 48) - 1))
            if top not in bins:
                break
        assert top not in bins
        assert (S.sketches([grams], t)[0] == (S.mixed(np.array(bins, np.uint64)) >> np.uint64(48)).astype(np.uint16)).all()


@pytest.mark.parametrize("n,num", [(4, 80), (2, 75), (1, 95)])
def test_against_brute_force(spark, n, num):
    got = check(spark, near_copies(n, 25, 9, 120), n, num, 100)
    assert len({c for _, c, _ in got.values()}) < len(got)


def test_strangers_meet_all_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_GRAMS", 800)
    monkeypatch.setattr(S, "SKETCH_BYTES", 512 * 12)
    monkeypatch.setattr(S, "FINEST", 2)
    monkeypatch.setattr(S, "FLUSH_PAIRS", 300)
    monkeypatch.setattr(S, "BROADCAST_ROWS", 10)
    rows = near_copies(11, 3, 40, 150)
    # one family around a common passage that is linked only here and there
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(60)]
    for _ in range(60):
        own = [f"q{rng.randrange(10 ** 6)}" for _ in range(rng.randint(4, 25))]
        rows.append((len(rows), " ".join(passage + own)))
    assert len({c for _, c, _ in check(spark, rows).values()}) > 20


def test_edges_of_input(spark):
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one"), (4, "ONE"), (5, "one two"), (6, "one  two"), (7, "a b c d"), (8, "é a"), (9, "É a"),
            (10, "word " * 50000), (11, "word " * 3), (12, "WORD\n" * 60000)]
    check(spark, rows)
    assert S.near_duplicates(docs_of(spark, [])).count() == 0
    table = docs_of(spark, rows).withColumn("node", F.lit(1)).withColumn("class", F.lit("x")).withColumn("digest", F.lit(0))
    assert S.near_duplicates(table).columns == ["doc_id", "n_shingles", "component_id", "kept"]
    with pytest.raises(ValueError, match="similarity"):
        S.near_duplicates(table, 4, 50, 100)


def test_null_and_repeated_ids(spark):
    text = "the quick brown fox jumps over the lazy dog again and again until night falls on the quiet hills of home"
    other = "nothing of this is the same as any of what the others say about foxes or dogs"
    rows = [(None, text), (None, text + " x"), (None, other), (4, text + " y"), (4, other), (4, text), (9, other), (9, other), (9, other + " z")]
    rows += [(None, "a b c d e f")] * 3 + [(None, f"t{i} u{i} v{i} w{i} x{i}") for i in range(30)]
    got = S.near_duplicates(docs_of(spark, rows))
    found = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in got.collect()), key=str)
    assert found == sorted([(None, 4, False)] * 3 + [(4, 4, True)] * 3 + [(9, 4, False)] * 3 + [(None, None, True)] * 33, key=str)


def test_table(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    got = check(spark, rows)
    assert sum(not kept for _, _, kept in got.values()) > 5
