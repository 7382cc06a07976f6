"""Property tests over generated records (few examples: each runs Spark jobs)."""

from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverline.contract import ORDER_BUDGET_FLOOR, ORDER_CONTRACT
from silverline.operators import bronze as B
from silverline.operators import routing as R

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

record = st.fixed_dictionaries({
    "Id": st.one_of(st.integers(1, 10**6).map(str), st.just("bad-1"), st.none()),
    "Budget": st.one_of(st.none(), st.floats(-1e6, 1e7, allow_nan=False, allow_infinity=False)),
    "RunTime": st.one_of(st.none(), st.integers(-500, 500)),
    "ReleaseDate": st.one_of(st.none(), st.just("1999-02-03"), st.just("garbage")),
})
lines = st.lists(st.one_of(record.map(lambda d: json.dumps({k: v for k, v in d.items() if v is not None})),
                           st.just("not json")), min_size=1, max_size=25)


def _bronze(spark, vals):
    return B.to_bronze(spark.createDataFrame([(v,) for v in vals], "value STRING"))


def _expected_clean(line: str) -> bool:
    try:
        d = json.loads(line)
    except ValueError:
        return False
    ok_id = d.get("Id") is not None and d["Id"].isdigit()
    ok_date = d.get("ReleaseDate") in (None, "1999-02-03")
    return (ok_id and ok_date and d.get("RunTime") is not None and d["RunTime"] >= 0
            and d.get("Budget") is not None and d["Budget"] >= ORDER_BUDGET_FLOOR)


@SETTINGS
@given(vals=lines)
def test_split_is_total_disjoint_and_follows_rules(spark, vals):
    routed = R.parse_and_route(_bronze(spark, vals), ORDER_CONTRACT)
    got = [(r.value, r.route) for r in routed.collect()]
    assert len(got) == len(vals)
    assert all(route in ("clean", "quarantined") for _, route in got)
    assert all((route == "clean") == _expected_clean(v) for v, route in got)
    clean, bad = R.split(routed)
    assert clean.count() + bad.count() == len(vals)


@SETTINGS
@given(vals=lines, picks=st.lists(st.integers(0, 24), max_size=10))
def test_apply_status_keeps_rows_and_touches_only_matches(spark, vals, picks):
    bronze = _bronze(spark, vals)
    chosen = sorted({vals[i % len(vals)] for i in picks})
    upd = spark.createDataFrame([(v,) for v in chosen], "value STRING")
    out = [(r.value, r.status) for r in B.apply_status(bronze, upd, "loaded").collect()]
    assert len(out) == len(vals)
    assert all(s == ("loaded" if v in chosen else "new") for v, s in out)


@SETTINGS
@given(vals=lines)
def test_repair_output_passes_repaired_rules(spark, vals):
    parsed = R.parse_records(_bronze(spark, vals), ORDER_CONTRACT)
    fixed = R.route(R.repair(parsed, ORDER_CONTRACT), ORDER_CONTRACT)
    for r in fixed.collect():
        assert "runtime_non_negative" not in r.reasons or r.RunTime is None
        assert "budget_floor" not in r.reasons
