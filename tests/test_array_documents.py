"""Splittable array documents against the multi-line reader."""

from __future__ import annotations

import json
import os
import random
import tempfile

import pytest

from silverline.sources import array_documents as A
from silverline.sources.files import read_multiline_json


def _element(rng, i):
    odd = rng.choice(['plain', 'a "quoted" one', "br}ack{ets]in[side", 'back\\slash\\', 'end\\"', "co,m,mas", "né 漢字 🎬", "", "line\nfeed", '\\\\"}', '"},{"'])
    return {"id": i, "title": odd * rng.randint(1, 4), "genres": [{"id": g, "name": odd} for g in range(rng.randint(0, 4))],
            "deep": {"x": [[1, {"y": [odd]}], []]}, "nothing": None}


def _values(df):
    return sorted(json.dumps(json.loads(r["value"]), sort_keys=True) for r in df.collect())


def _write(folder, name, document, **how):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(document if isinstance(document, str) else json.dumps(document, **how))


@pytest.mark.parametrize("split", [700, 4096])
def test_elements_of_documents(spark, split):
    rng, folder = random.Random(split), tempfile.mkdtemp(prefix="arrays-")
    lists = [[_element(rng, 100 * d + i) for i in range(15)] for d in range(4)]
    _write(folder, "compact.json", {"movie": lists[0]}, separators=(",", ":"))
    _write(folder, "pretty.json", {"movie": lists[1]}, indent=2, ensure_ascii=False)
    _write(folder, "others.json", {"meta": {"movie": [{"no": "]}"}]}, "skip": [{"a": 1}, {"b": [2]}], "movie": lists[2], "n": 3, "after": [[{"c": 1}], "x"]})
    _write(folder, "empty.json", {"movie": []})
    _write(folder, "none.json", '{"other": {"movie": [1]}}\n')
    _write(folder, "scalars.json", {"movie": [1, "two, {three}", None, [4, 5], {"six": "]"}]})
    big = {"id": 0, "title": "x}" * 1500, "genres": [], "deep": {}, "nothing": None}
    _write(folder, "long.json", {"movie": [big, lists[3][0], big]})
    got = _values(A.read_array_elements(spark, folder, "movie", split_bytes=split))
    want = [e for part in lists[:3] for e in part] + [1, "two, {three}", None, [4, 5], {"six": "]"}, big, lists[3][0], big]
    assert got == sorted(json.dumps(e, sort_keys=True) for e in want)


@pytest.mark.parametrize("split", [300, 100000])
def test_document_that_is_an_array(spark, split):
    rng, folder = random.Random(9), tempfile.mkdtemp(prefix="roots-")
    rows = [_element(rng, i) for i in range(30)]
    _write(folder, "a.json", rows, indent=1)
    _write(folder, "b.json", {"movie": rows})
    assert _values(A.read_array_elements(spark, f"{folder}/*.json", None, split_bytes=split)) == sorted(json.dumps(e, sort_keys=True) for e in rows)


def test_a_large_array_is_read_in_many_tasks(spark):
    rng, folder = random.Random(1), tempfile.mkdtemp(prefix="large-")
    _write(folder, "one.json", {"movie": [{"id": i, "text": _element(rng, i)["title"] * 20} for i in range(20000)]})
    size = os.path.getsize(f"{folder}/one.json")
    found = A.read_array_elements(spark, folder, "movie", split_bytes=size // 40)
    schema = "movie ARRAY<STRUCT<id: BIGINT, text: STRING>>"
    plain = read_multiline_json(spark, folder, schema=schema).selectExpr("inline(movie)")
    mine = found.selectExpr("from_json(value, 'id BIGINT, text STRING') AS m").select("m.*")
    assert mine.exceptAll(plain).count() == plain.exceptAll(mine).count() == 0 and mine.count() == 20000
    with A._split_size(spark, size // 40):
        assert spark.read.option("lineSep", A.PIECE_END).text(folder).rdd.getNumPartitions() >= 40
