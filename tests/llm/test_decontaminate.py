from __future__ import annotations

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverline.llm import decontaminate as D
from tests.llm.helpers import docs_of, edit_distance_within


def plain_words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def expected(docs, items, share=D.EDIT_SHARE):
    out = []
    for d, text in docs:
        for i, item in items:
            w = plain_words(item)
            e = D.budget(len(w), share)
            if w and (n := edit_distance_within(w, plain_words(text))) <= e:
                out.append((d, i, n, e))
    return sorted(out)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.lists(st.integers(0, 3), max_size=40))
def test_bit_parallel_distance(pattern, text):
    masks = {}
    for k, w in enumerate(pattern):
        masks[w] = masks.get(w, 0) | 1 << k
    assert D.least_distance(len(pattern), masks, text) == edit_distance_within(pattern, text)


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randint(1, 30))) for i in range(12)]
    docs = []
    for d in range(60):
        body = text(rng.randint(0, 60)).split()
        passage = items[d % 12][1].split()
        for _ in range(rng.randint(0, len(passage) // 4)):
            passage[rng.randrange(len(passage))] = rng.choice(vocabulary)
        at = rng.randint(0, len(body))
        docs.append((d, " ".join(body[:at] + (passage if d % 3 else []) + body[at:])))
    got = D.leaks(docs_of(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect())) == expected(docs, items)
    blocks = D.leaks(docs_of(spark, docs), spark.createDataFrame(items, "item_id long, text string"), block_bytes=200)
    assert sorted(map(tuple, blocks.collect())) == expected(docs, items)


def test_edges(spark):
    items = [(1, "Alpha beta, GAMMA delta; epsilon zeta eta theta."), (2, None), (3, "..."), (4, "one"), (1, "kappa lambda my ny xi"), (None, "omikron pi")]
    docs = [(1, "x ALPHA  beta gamma\ndelta epsilon zeta eta theta y"), (2, None), (3, ""), (4, "one"), (None, "alpha beta gamma delta epsilon zeta eta"),
            (5, "alpha beta " + "filler " * 200000 + "gamma delta"), (1, "x ALPHA  beta gamma\ndelta epsilon zeta eta theta y"), (6, "omikron pi")]
    table = docs_of(spark, docs).withColumn("item_id", F.lit(9)).withColumn("distance", F.lit(9))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    got = sorted(map(tuple, D.leaks(table, bench).collect()), key=str)
    assert got == sorted([(1, 1, 0, 1), (1, 1, 0, 1), (4, 4, 0, 0), (None, 1, 1, 1), (6, None, 0, 0)], key=str)
    kept = D.without_leaks(table, bench)
    assert kept.columns == table.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5]
    assert D.leaks(table.limit(0), bench).count() == 0
    assert D.leaks(table, bench.limit(0)).count() == 0 and D.without_leaks(table, bench.limit(0)).count() == len(docs)


def test_masks_are_those_of_the_plain_table():
    rng = random.Random(3)
    for size in (1, 7, 8, 9, 900, 3000):
        words = D.np.array([rng.randrange(1 + size // 3) for _ in range(size)], D.np.uint64)
        plain, masks = {}, D.Masks(words)
        for k, w in enumerate(words.tolist()):
            plain[w] = plain.get(w, 0) | 1 << k
        for w in [*plain, 10 ** 9, 10 ** 9 + 1]:
            assert masks.get(w, 0) == masks.get(w) == plain.get(w, 0)


def test_long_items_take_memory_by_their_words(spark):
    import pickle

    rng = random.Random(8)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(200_000)]
    block = D.Items([1], [" ".join(words)])
    pieces = sum(a.nbytes for p in block.pieces.values() for a in p[:3])
    assert len(pickle.dumps(block)) < 40 * len(words) + (len(block.pieces) << D.SEEN_BITS) and pieces < 24 * len(words)
    masks = D.Masks(block.own[0])
    masks.get(int(block.own[0][0]))
    assert sum(m.bit_length() for m in masks.kept.values()) // 8 < 40 * len(words)
    # an item of thousands of words, with edits, among others
    item = words[:3000]
    changed = [w if rng.random() > 0.1 else "changed" for w in item]
    docs = [(1, " ".join(["before", *changed, "after"])), (2, " ".join(words[:1500])), (3, " ".join(words[1000:5000]))]
    got = [tuple(r) for r in D.leaks(docs_of(spark, docs), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()]
    assert got == [(1, 7, sum(a != b for a, b in zip(item, changed, strict=True)), 600)]
