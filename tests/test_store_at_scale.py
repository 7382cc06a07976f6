"""What a batch moves and writes: keys of rows follow the shuffles, first batches join nothing, shuffles grow with the lines."""

from __future__ import annotations

import glob
import json
import os
import time

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from silverline import registry as Rg
from silverline import session
from silverline.contract import ORDER_CONTRACT
from silverline.plans import store as store_module
from silverline.plans.store import KEY_TEXT, NARROW, SHUFFLE_PARTITIONS, SPLIT, MedallionStore, row_text
from silverline.session import SHUFFLE_CLEANUP, scratch_path, setting

from .conftest import SMALL_SF


def _plans(spark, monkeypatch):
    """Physical plans and shuffle settings of all writes of one batch over the feed."""
    store, seen, put = MedallionStore(spark, scratch_path(spark, "moved"), ORDER_CONTRACT), {}, MedallionStore._put

    def noted(self, table, rows):
        seen[table] = (rows._jdf.queryExecution().executedPlan().toString(), int(spark.conf.get(SHUFFLE_PARTITIONS)))
        put(self, table, rows)

    monkeypatch.setattr(MedallionStore, "_put", noted)
    store.run_batch(raw=Rg.lines(spark, SMALL_SF))
    return store, seen


def test_a_first_batch_joins_nothing_and_shuffles_no_row_key(spark, monkeypatch):
    store, seen = _plans(spark, monkeypatch)
    for table in ("silver", *NARROW):
        assert "Join" not in seen[table][0], table
    for table in NARROW:
        for line in seen[table][0].splitlines():
            assert "Exchange" not in line or "row_key" not in line, line
    [part, *_] = glob.glob(f"{store.paths.genre}/*/*/part-*")
    assert pq.ParquetFile(part).metadata.row_group(0).column(0).compression == "ZSTD"


def test_shuffles_grow_with_the_lines_and_the_setting_comes_back(spark, monkeypatch):
    before = spark.conf.get(SHUFFLE_PARTITIONS)
    monkeypatch.setattr(session, "TASK_ROWS", 50)
    store, seen = _plans(spark, monkeypatch)
    assert all(seen[t][1] >= 33 for t in ("silver", *NARROW, "batches"))          # 1,650 lines
    assert spark.conf.get(SHUFFLE_PARTITIONS) == before
    keys = store.table("silver").select("record_key").collect()
    bronze = {r[0] for r in store.bronze().select("record_key").collect()}
    assert keys and {r[0] for r in keys} <= bronze


def _row(i, genres, title=None, budget=200000):
    return json.dumps({"Id": str(i), "Title": title or f"t{i}", "Budget": budget, "RunTime": 5, "OriginalLanguage": None,
                       "genres": [{"id": g, "name": n} for g, n in genres]})


# commas, backslashes, a long text and rows that are there twice
LINES = [[_row(i, ((i, "a,\\b"), (9, "z" * (i % 2 * 200 + 1)))) for i in range(20)] + [_row(3, ((3, "a,\\b"),), title="=,\\")] * 2,
         [_row(i, ((i, "a,\\b"), (9, "z" * (i % 2 * 200 + 1))), budget=300000) for i in range(10, 30)] + ["junk"]]


def _loaded(spark, between=lambda store: None):
    store = MedallionStore(spark, scratch_path(spark, "dealt"), ORDER_CONTRACT)
    for lines in LINES:
        store.run_batch(raw=spark.createDataFrame([(v,) for v in lines], "value STRING"), now=Rg.FIXED_NOW)
        between(store)
    return store, {t: sorted(map(str, store._stored(t).drop("row_key").collect())) for t in ("silver", *NARROW)}


def test_keys_are_texts_and_only_long_rows_have_hashes(spark):
    store, _ = _loaded(spark)
    for table in NARROW:
        held = store._stored(table).select("row_key", F.length(row_text(store.table(table).columns)).alias("n")).collect()
        assert held and all((len(r.row_key) == 64 and "," not in r.row_key) if r.n > KEY_TEXT else len(r.row_key) == r.n for r in held), table
    assert store._stored("genre").where(F.length("name") > KEY_TEXT).count() == 15       # odd keys of 0 to 29


def test_a_large_batch_on_a_large_history_is_dealt_once_by_the_whole_row(spark, monkeypatch):
    _, plain = _loaded(spark)
    plans, put = {}, MedallionStore._put

    def noted(self, table, rows):
        plans.setdefault(table, []).append(rows._jdf.queryExecution().executedPlan().toString())
        put(self, table, rows)

    monkeypatch.setattr(MedallionStore, "_put", noted)
    monkeypatch.setattr(session, "TASK_ROWS", 2)
    partitions = spark.conf.get(SHUFFLE_PARTITIONS)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        store, dealt = _loaded(spark)
    assert dealt == plain and spark.conf.get(SHUFFLE_PARTITIONS) == partitions
    for table in ("silver", *NARROW):
        plan = plans[table][1]
        assert "LeftAnti" in plan and "Bucketed: true" not in plan, plan
        left = plan[plan.index("LeftAnti"):]
        assert left.count("Exchange hashpartitioning") == 2, plan                        # one a side: the dedupe's and the stored rows'


def test_rows_with_keys_of_an_earlier_release_are_known(spark):
    _, plain = _loaded(spark)

    def hashed(store):
        for table in NARROW:
            rows = spark.createDataFrame(store._stored(table).collect(), store._stored(table).schema)
            store._put(table, rows.withColumn("row_key", F.sha2(row_text(store.table(table).columns), 256)))

    assert _loaded(spark, hashed)[1] == plain


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [files.apply(i) for i in range(files.size())]
    return {f.getName(): f.length() for f in found if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}


def test_a_write_leaves_no_shuffle_files(spark):
    lines = Rg.lines(spark, SMALL_SF)
    store, before = MedallionStore(spark, scratch_path(spark, "freed"), ORDER_CONTRACT), set(_shuffle_files(spark))
    store.run_batch(raw=lines)
    left, until = 1 << 30, time.time() + 20
    while left > 10000 and time.time() < until:                                           # files are removed in the background
        left = sum(n for name, n in _shuffle_files(spark).items() if name not in before)
        time.sleep(0.2)
    assert left <= 10000 and spark.conf.get(SHUFFLE_CLEANUP, None) is None                # lists of partitions and counts, no rows of the batch


def test_bronze_is_written_from_small_splits(spark, monkeypatch):
    path, files = scratch_path(spark, "gz"), 8
    spark.range(0, files, numPartitions=files).select(F.concat(F.lit("line "), "id").alias("value")).write.option("compression", "gzip").text(path)
    monkeypatch.setattr(store_module, "RAW_SPLIT", "1k")
    with setting(spark, "spark.sql.files.openCostInBytes", "1k"), setting(spark, "spark.sql.files.minPartitionNum", "1"):
        for store, more in ((MedallionStore(spark, scratch_path(spark, "split"), ORDER_CONTRACT), {"raw": spark.read.text(path)}),
                            (MedallionStore(spark, scratch_path(spark, "split"), ORDER_CONTRACT), {"raw_path": path})):
            store.run_batch(**more)
            assert store.bronze().select(F.input_file_name()).distinct().count() == files
    assert spark.conf.get(SPLIT, None) is None


def test_deliveries_are_compressed(spark):
    Rg.q_run_batch_files(spark, SMALL_SF)
    [*_, newest] = sorted(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/silverline/deliveries-*"), key=os.path.getmtime)
    parts = glob.glob(f"{newest}/part-*")
    assert parts and all(f.endswith(".gz") for f in parts)
