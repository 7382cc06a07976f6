"""Copy-on-write status merge, contract drift and the single parse."""

from __future__ import annotations

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from silverline.contract import ORDER_CONTRACT
from silverline.functions import parsing as P
from silverline.operators import bronze as B
from silverline.operators import merge as M
from silverline.operators import quality as Q
from silverline.operators import routing as R
from silverline.session import scratch_path

BUCKETS = 16


def _bronze(spark, n=200):
    lines = spark.range(n).select(F.concat(F.lit("line "), F.pmod("id", F.lit(n - 20))).alias("value"))       # twenty lines twice
    return B.to_bronze(lines, now="2024-01-01 00:00:00")


def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path.replace('file://', '')}/bucket=*/*.parquet")}


def test_only_touched_buckets_are_rewritten(spark):
    path = M.write_buckets(_bronze(spark), scratch_path(spark, "cow"), BUCKETS)
    before = _files(path)
    updates = spark.createDataFrame([("line 3",), ("line 5",), ("line 5",), ("no such line",), (None,)], "value STRING")
    touched = M.merge_status(spark, path, updates, BUCKETS, B.STATUS_LOADED)
    keys = M.read_buckets(spark, path).where("value IN ('line 3', 'line 5')").select("bucket").distinct()
    assert 1 <= len(touched) <= 2 and set(touched) == {r[0] for r in keys.collect()}
    after = _files(path)
    in_touched = {f for f in before if int(f.split("bucket=")[1].split("/")[0]) in touched}
    assert {f: t for f, t in before.items() if f not in in_touched} == {f: t for f, t in after.items() if f in before}
    rows = M.read_buckets(spark, path)
    assert rows.count() == 200 and sorted(r.value for r in rows.where("status = 'loaded'").collect()) == ["line 3", "line 3", "line 5", "line 5"]
    assert M.merge_status(spark, path, updates, BUCKETS, B.STATUS_LOADED) == [] and _files(path) == after       # again: nothing to do
    whole = B.apply_status(_bronze(spark), updates, B.STATUS_LOADED)
    assert rows.drop("bucket").exceptAll(whole).count() == 0


def test_conflicts_leave_the_table_alone(spark):
    path = M.write_buckets(_bronze(spark), scratch_path(spark, "cow-conflict"), BUCKETS)
    before = _files(path)
    updates = spark.createDataFrame([("line 3", "loaded"), ("line 3", "quarantined")], "value STRING, status STRING")
    with pytest.raises(Exception, match="conflicting statuses"):
        M.merge_status(spark, path, updates, BUCKETS)
    assert _files(path) == before
    assert M.merge_status(spark, path, updates.limit(0), BUCKETS) == []


def _line(**fields):
    return json.dumps({"Id": "1", "Title": "t", "Budget": 2.5, "RunTime": 5, "OriginalLanguage": "en", "ReleaseDate": "2020-01-01",
                       "genres": [{"id": 1, "name": "a"}], **fields})


def test_drift_sees_fields_outside_the_contract(spark):
    values = [_line(), _line(), _line(Extra=1), _line(Extra={"a": 1}), _line(Budget="2.5"), _line(Budget=None), _line(genres=[]),
              _line(genres="x"), '{"Id":"2"}', "junk", "", "[1]", '{"Id":"3"} x', '{"Id":"4"}{"Id":"5"}']
    lines = spark.createDataFrame([(v,) for v in values], "value STRING").withColumn("key", F.lit(1)).withColumn("document", F.lit("clash"))
    got = {(r.column, r.found, r.problem): r.n_lines for r in Q.contract_drift(lines, ORDER_CONTRACT).collect()}
    assert got["Extra", "BIGINT", "unexpected"] == 1 and got["Extra", "OBJECT<a: BIGINT>", "unexpected"] == 1
    assert got["Budget", "STRING", "type"] == 1 and got["Budget", "VOID", "null"] == 1 and got["Budget", "DECIMAL", "none"] == 6
    assert got["genres", "ARRAY<OBJECT<id: BIGINT, name: STRING>>", "none"] == 6
    assert got["genres", "STRING", "type"] == 1 and got["genres", "ARRAY<VOID>", "none"] == 1
    assert got["Title", None, "missing"] == 1 and got["Budget", None, "missing"] == 1
    assert got["*", None, "malformed"] == 3 and got["*", None, "trailing_data"] == 2
    assert Q.contract_drift(lines.limit(0), ORDER_CONTRACT).count() == 0


def test_one_pass_says_what_three_said(spark):
    values = [_line(), _line() + " ", _line() + "x", _line() + _line(), _line() + "}", _line() + "]", _line() + ',0],{"b":2}', _line() + ",", "[" + _line() + "]",
              _line(Budget="9"), _line(RunTime=1.5), _line(genres="x"), _line(genres=None), "null", "12", "", " ", "junk", '{"Id":"1"', "{}", '{"Id":null}',
              _line(Title="_end_of_record"), _line(Title='"_end_of_record":0}'), _line() + ',"_end_of_record":0}', _line(genres=[{"id": 1, "name": "}] ,["}]), None]
    lines = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n INT, value STRING")
    got = {r.n: r for r in R.parse_records(lines, ORDER_CONTRACT).collect()}
    plain = lines.select("n", "value", P.parse_json("value", ORDER_CONTRACT.source_ddl).alias(P.PARSED)) \
        .select("n", F.col(P.PARSED).alias("p"), P.reasons_column(P.record_checks(ORDER_CONTRACT)).alias("checks"))
    for r in plain.collect():
        mine = got[r.n]
        assert mine["_checks"] == r.checks, values[r.n]
        assert (mine["Title"], mine["Budget"], mine["RunTime"], mine["genres"], mine["source_id"]) == (
            (r.p.Title, r.p.Budget, r.p.RunTime, r.p.genres, r.p.Id) if r.p else (None,) * 5), values[r.n]
