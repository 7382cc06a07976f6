"""Hand-made rows, one test per decision of SURVEY §2.12 / FIXTURES §4."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from silverline.contract import MOVIE_CONTRACT, ORDER_CONTRACT
from silverline.functions.parsing import CORRUPT, parse_json
from silverline.operators import bronze as B
from silverline.operators import derive as D
from silverline.operators import quality as Q
from silverline.operators import routing as R
from silverline.session import scratch_path
from silverline.sources import files as S
from silverline.sources import sinks as K

DDL = "Id STRING, Budget DOUBLE, RunTime LONG, genres STRING"


def _parse(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value STRING")
    return df.select("value", parse_json("value", DDL).alias("j")).collect()


def test_from_json_permissive_rules(spark):
    rows = _parse(spark, [
        '{"Id":1,"Budget":1000000,"RunTime":120,"genres":[{"id":1,"name":"x"}]}',
        '{"Id":"2","Budget":"5","RunTime":"120"}',
        '{"Id":3,"Budget":1.5,"RunTime":120.0,"ID":9}',
        '{"id":5}',
        'not json',
        None,
    ])
    j = [r.j for r in rows]
    assert (j[0].Id, j[0].Budget, j[0].RunTime, j[0].genres) == ("1", 1e6, 120, '[{"id":1,"name":"x"}]')
    assert (j[1].Id, j[1].Budget, j[1].RunTime) == ("2", None, None) and j[1][CORRUPT] is not None
    assert (j[2].Id, j[2].Budget, j[2].RunTime) == ("3", 1.5, None)
    assert j[3].Id is None and j[3][CORRUPT] is None      # names match by case
    assert j[4].Id is None and j[4][CORRUPT] == "not json"
    assert j[5] is None


def _route(spark, values, contract=MOVIE_CONTRACT, **kw):
    df = B.to_bronze(spark.createDataFrame([(v,) for v in values], "value STRING"), now="2024-01-01 00:00:00")
    return R.parse_and_route(df, contract, **kw)


def test_routes_are_total_and_reasons_listed(spark):
    vals = ['{"Id":"1","Budget":2000000,"RunTime":120}',
            '{"Id":"4","Budget":2e6,"RunTime":-5}',
            '{"Id":"2","Budget":"5","RunTime":"120"}',
            '{"id":5}',
            'not json',
            '{"Id":"uuid-x","Budget":2000000,"RunTime":1}',
            '{"Id":"7","Budget":2000000,"RunTime":1,"ReleaseDate":"bad"}',
            '{"Id":"8","Budget":2000000,"RunTime":1,"ReleaseDate":"2021-04-03T16:51:30.1633333"}']
    got = {r.value: (r.route, list(r.reasons), r.ReleaseDate) for r in _route(spark, vals).collect()}
    assert got[vals[0]][:2] == ("clean", [])
    assert got[vals[1]][:2] == ("quarantined", ["runtime_non_negative"])
    assert got[vals[2]][:2] == ("quarantined", ["malformed", "runtime_non_negative", "budget_floor"])
    assert got[vals[3]][:2] == ("quarantined", ["missing_key", "runtime_non_negative", "budget_floor"])
    assert got[vals[4]][1][0] == "malformed"
    assert got[vals[5]][:2] == ("quarantined", ["bad_key"])
    assert got[vals[6]][:2] == ("quarantined", ["bad_date"])
    assert got[vals[7]] == ("clean", [], dt.date(2021, 4, 3))


def test_null_policy_unrouted_leaves_null_budget_new(spark):
    vals = ['{"Id":"1","RunTime":5}', '{"Id":"2","Budget":1,"RunTime":5}']
    got = {r.value: r.route for r in _route(spark, vals, null_policy="unrouted").collect()}
    assert got == {vals[0]: "new", vals[1]: "quarantined"}


def test_blank_lines_are_dropped_by_reader(spark):
    path = scratch_path(spark, "blank")
    spark.createDataFrame([("a",), ("",), ("  ",), ("b",)], "value STRING").coalesce(1).write.text(path)
    assert sorted(r.value for r in S.read_text_lines(spark, path).collect()) == ["a", "b"]


def test_dedupe_keeps_one_row_per_line(spark):
    vals = ['{"Id":"1","Budget":2000000,"RunTime":1}'] * 3 + ['{"Id":"2","Budget":2000000,"RunTime":1}']
    assert R.dedupe_records(_route(spark, vals)).count() == 2


def test_apply_status_updates_matches_only(spark):
    bronze = B.to_bronze(spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "value STRING"))
    upd = spark.createDataFrame([("a",), ("a",), (None,)], "value STRING")
    out = B.apply_status(bronze, upd, "loaded")
    got = sorted((r.value or "", r.status) for r in out.collect())
    assert got == [("", "new"), ("a", "loaded"), ("a", "loaded"), ("b", "new")]
    assert out.columns == bronze.columns


def test_apply_status_conflict_raises(spark):
    bronze = B.to_bronze(spark.createDataFrame([("a",)], "value STRING"))
    upd = spark.createDataFrame([("a", "loaded"), ("a", "quarantined")], "value STRING, status STRING")
    with pytest.raises(Exception, match="conflicting statuses"):
        B.apply_status(bronze, upd).collect()


def test_genres_empty_and_null_name(spark):
    vals = ['{"Id":"1","genres":[]}', '{"Id":"2","genres":[{"id":7,"name":null},{"id":8,"name":"x"}]}',
            '{"Id":"3"}']
    parsed = R.parse_records(B.to_bronze(spark.createDataFrame([(v,) for v in vals], "value STRING")),
                             MOVIE_CONTRACT)
    assert [tuple(r) for r in D.genre_rows(parsed, MOVIE_CONTRACT).collect()] == [("2", 2, 8, "x")]
    assert [tuple(r) for r in D.bridge_rows(parsed, MOVIE_CONTRACT).collect()] == [(2, 8)]


def test_repair_expressions(spark):
    vals = ['{"Id":"1","Budget":5,"RunTime":-5}', '{"Id":"2","RunTime":3}', '{"Id":"3","Budget":3e6,"RunTime":3}']
    p = R.parse_records(B.to_bronze(spark.createDataFrame([(v,) for v in vals], "value STRING")), MOVIE_CONTRACT)
    fixed = R.route(R.repair(p, MOVIE_CONTRACT), MOVIE_CONTRACT)
    got = {r.movie_id: (r.Budget, r.RunTime, r.route) for r in fixed.collect()}
    assert got == {1: (1e6, 5, "clean"), 2: (1e6, 3, "clean"), 3: (3e6, 3, "clean")}
    assert dict(fixed.dtypes)["RunTime"] == "bigint" and dict(fixed.dtypes)["Budget"] == "double"


def test_schema_assertion_and_diff(spark):
    df = spark.createDataFrame([(1, "x")], "a INT, b STRING")
    Q.assert_schema(df, "a INT, b STRING")
    with pytest.raises(AssertionError):
        Q.assert_schema(df, "a BIGINT, b STRING")
    diff = {r.column: r.problem for r in Q.schema_diff(spark, df, "a BIGINT, c STRING").collect()}
    assert diff == {"a": "type", "c": "missing", "b": "unexpected"}


def test_create_only_refuses_existing_path(spark):
    path = scratch_path(spark, "create")
    df = spark.range(3)
    K.write_create_only(df, path)
    with pytest.raises(PySparkException):
        K.write_create_only(df, path)
    K.write_batch(df, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 3


def test_typed_contract_ddl():
    assert ORDER_CONTRACT.typed_ddl().startswith("movie_id BIGINT, Title STRING, Budget DOUBLE, RunTime BIGINT")
    assert "CreatedDate DATE" in MOVIE_CONTRACT.typed_ddl() and "movie_id INT" in MOVIE_CONTRACT.typed_ddl()


def test_ingest_time_is_fixed_when_given(spark):
    b = B.to_bronze(spark.createDataFrame([("x",)], "value STRING"), now="2024-05-06 07:08:09")
    r = b.select(F.date_format("ingesttime", "yyyy-MM-dd HH:mm:ss").alias("t"), "p_ingestdate", "status").first()
    assert (r.t, r.p_ingestdate, r.status) == ("2024-05-06 07:08:09", dt.date(2024, 5, 6), "new")


def test_order_by_id_is_sorted(spark):
    from silverline import registry as Rg
    ids = [r.movie_id for r in Rg.QUERIES["order_by_id"](spark, "/root/testdata/sf0.001").collect()]
    assert ids == sorted(ids) and len(ids) > 1000


def test_read_status_since_filters_ingest_date(spark):
    rows = spark.createDataFrame([("a",)], "value STRING")
    old = B.to_bronze(rows, now="2024-01-01 00:00:00")
    new = B.to_bronze(rows, now="2024-03-01 00:00:00")
    both = old.unionByName(new)
    assert B.read_new(both).count() == 2
    assert B.read_new(both, since="2024-02-01").count() == 1


def test_append_refuses_another_schema(spark):
    path = scratch_path(spark, "guard")
    K.append(spark.createDataFrame([(1, "x")], "a INT, b STRING"), path)
    K.append(spark.createDataFrame([("y", 2)], "b STRING, a INT"), path)      # order does not matter
    for ddl, row in (("a INT, c STRING", (1, "x")), ("a BIGINT, b STRING", (1, "x")), ("a INT", (1,))):
        with pytest.raises(ValueError, match="another schema"):
            K.append(spark.createDataFrame([row], ddl), path)
    K.append(spark.createDataFrame([(3, "z")], "a INT, c STRING"), path, allow_schema_change=True)
    assert spark.read.option("mergeSchema", True).parquet(path).where("c = 'z'").count() == 1
    part = scratch_path(spark, "guard-part")
    for _ in range(2):
        K.append(spark.createDataFrame([(1, 7)], "a INT, p BIGINT"), part, partition_by="p")
    assert spark.read.parquet(part).count() == 2


def test_lookup_never_multiplies_records(spark):
    from silverline.operators.lookup import repair_by_lookup
    bad = spark.createDataFrame([(1, None), (None, None)], "k INT, v DOUBLE")
    dim = spark.createDataFrame([(1, 5.0), (1, 5.0), (None, 9.0)], "dk INT, dv DOUBLE")
    out = repair_by_lookup(bad, dim, on=("k", "dk"), replace={"v": "dv"})
    assert [tuple(r) for r in out.collect()] == [(1, 5.0)]
    for other in (6.0, None):
        clash = dim.unionAll(spark.createDataFrame([(1, other)], "dk INT, dv DOUBLE"))
        with pytest.raises(Exception, match="conflicting dimension rows"):
            repair_by_lookup(bad, clash, on=("k", "dk"), replace={"v": "dv"}).collect()


def test_repair_by_lookup_inner_and_left(spark):
    from silverline.operators.lookup import repair_by_lookup
    bad = spark.createDataFrame([(1, None), (2, None), (3, 7.0)], "movie_id BIGINT, Budget DOUBLE")
    dim = spark.createDataFrame([(1, 100.0, "x"), (3, 300.0, "y")], "o_orderkey BIGINT, o_totalprice DOUBLE, other STRING")
    inner = repair_by_lookup(bad, dim, on=("movie_id", "o_orderkey"), replace={"Budget": "o_totalprice"})
    assert sorted(tuple(r) for r in inner.collect()) == [(1, 100.0), (3, 300.0)]
    assert inner.columns == ["movie_id", "Budget"]
    left = repair_by_lookup(bad, dim, on=("movie_id", "o_orderkey"), replace={"Budget": "o_totalprice"}, how="left")
    assert sorted(tuple(r) for r in left.collect()) == [(1, 100.0), (2, None), (3, 300.0)]


def test_columns_are_found_whatever_their_case(spark):
    parsed = R.parse_records(B.to_bronze(spark.createDataFrame([('{"Id":"1","Title":"t"}',)], "value STRING")), MOVIE_CONTRACT)
    assert parsed.select("TITLE", F.col("Movie_ID")).collect() == [("t", 1)]


def test_table_paths_lie_below_the_root():
    from silverline.contract import TablePaths
    paths = TablePaths("/r")
    names = [n for n in dir(TablePaths) if isinstance(getattr(TablePaths, n), property)]
    found = [getattr(paths, n) for n in names]
    assert len(set(found)) == len(names) and all(p.startswith("/r/") for p in found)


def test_conformance_counts(spark):
    lines = spark.createDataFrame([('{"Id":"1","Budget":2.5,"ReleaseDate":"2020-01-01","genres":[{"id":1,"name":"a"}]}',),
                                   ('{"Id":"x","ReleaseDate":"soon","genres":"abc"}',), ("junk",)], "value STRING")
    got = {r.column: (r.expected, r.n_rows, r.n_present, r.n_conform) for r in Q.conformance(lines, ORDER_CONTRACT).collect()}
    assert got["movie_id"] == ("BIGINT", 3, 2, 1) and got["Budget"] == ("DOUBLE", 3, 1, 1)
    assert got["ReleaseDate"] == ("DATE", 3, 2, 1) and got["genres"] == ("STRING", 3, 2, 1)
