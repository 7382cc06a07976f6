"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from silverline import registry

from .conftest import SMALL_SF

NAMES = sorted(registry.QUERIES)


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(queries()) and set(registry.ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SMALL_SF)
    rows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        assert rows  # rows-only check
        return
    res = duck.sql(sql)
    assert sorted(df.columns) == sorted(res.columns)
    assert _canon(df.columns, rows) == _canon(res.columns, res.fetchall())


def test_entry_counts(spark, duck):
    got = {(r.route, r.reason): r.n_records for r in entry(spark).collect()}
    clean = duck.sql(f"{registry.W} SELECT count(*) FROM (SELECT DISTINCT * FROM routed WHERE route = 'clean')").fetchall()[0][0]
    assert {k: v for k, v in got.items() if k[0] == "clean"} == {("clean", "none"): clean}
    assert {reason for route, reason in got if route != "clean"} == {
        "bad_key", "bad_nested", "trailing_data", "runtime_non_negative", "budget_floor"}
