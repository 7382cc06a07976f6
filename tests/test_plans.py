"""Physical-plan checks: one JSON parse per batch, pruning, pushdown, no cartesian joins."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from silverline import registry as Rg
from silverline.contract import ORDER_CONTRACT
from silverline.fixtures import order_feed as feed
from silverline.operators import routing as R
from silverline.plans.store import MedallionStore
from silverline.session import scratch_path

from .conftest import SMALL_SF


def plan_text(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def test_routed_batch_parses_json_once(spark):
    routed = Rg.routed(spark, SMALL_SF)
    txt = plan_text(routed, "extended")
    optimized = txt.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    # one parse of the wrapped line sits in a projection of its own; typing, checks and rules read its result
    assert optimized.count("from_json(StructField(_record") == 1
    # the line is parsed again only where a condition says that the first parse found something odd
    again = [line for line in optimized.splitlines() if "from_json(StructField(Id" in line or "json_array_length" in line]
    assert all("CASE WHEN _single" in line for line in again) and sum(line.count("from_json(StructField(Id") for line in again) <= 1
    assert sum(line.count("json_array_length") + line.count("json_object_keys") for line in optimized.splitlines()) <= 2


def test_a_filter_on_the_route_does_not_repeat_the_parse(spark):
    for df in R.split(Rg.routed(spark, SMALL_SF)):
        optimized = plan_text(df.select("value"), "extended").split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
        assert optimized.count("from_json(StructField(_record") == 1 and optimized.count("from_json(StructField(Id") <= 1


def test_open_bronze_status_filter_is_a_partition_filter(spark):
    store = MedallionStore(spark, scratch_path(spark, "plan"), ORDER_CONTRACT)
    store.ingest_lines(Rg.lines(spark, SMALL_SF))
    txt = plan_text(store.open_rows().where(F.col("status") == "new"))
    part_filters = [ln for ln in txt.splitlines() if ln.startswith("PartitionFilters:")]
    assert part_filters and "status" in part_filters[0]
    assert "Filter" not in txt.split("\n\n")[0]      # no row filter left: pruning did it all


def test_feed_scans_read_only_needed_columns(spark):
    txt = plan_text(feed.order_parts(spark, SMALL_SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in txt
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in txt


def test_no_cartesian_or_nested_loop_joins(spark):
    for name in ["bridge_join", "bridge_dedup", "repair_lookup", "merge_status_loaded", "stage_status",
                 "explode_genres", "route_counts"]:
        txt = plan_text(Rg.QUERIES[name](spark, SMALL_SF))
        assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt, name


def test_silver_write_is_rebalanced_on_partition_column(spark):
    clean, _ = R.split(Rg.routed(spark, SMALL_SF))
    from silverline.operators import derive as D
    df = D.silver_wide(R.dedupe_records(clean), ORDER_CONTRACT).hint("rebalance", ORDER_CONTRACT.partition_column)
    assert "RebalancePartitions" in plan_text(df, "extended")


def test_record_dedupe_aggregates_partially_before_shuffle(spark):
    txt = plan_text(R.dedupe_records(Rg.routed(spark, SMALL_SF)))
    assert txt.count("HashAggregate") + txt.count("SortAggregate") + txt.count("ObjectHashAggregate") >= 2


def test_derived_tables_read_only_needed_staged_columns(spark):
    from silverline.operators import derive as D
    store = MedallionStore(spark, scratch_path(spark, "plan-stage"), ORDER_CONTRACT)
    store.run_batch(raw_path=Rg.raw_feed_path(spark, SMALL_SF))
    txt = plan_text(D.genre_rows(store.table("staging"), ORDER_CONTRACT))
    assert "ReadSchema: struct<source_id:string,movie_id:bigint,genres:string,route:string>" in txt
