"""A medallion deployment on catalog tables, loaded batch by batch.

Every table is a Parquet table of the catalog below ``root`` (see
:class:`~silverline.contract.TablePaths`), partitioned by ``batch_id`` and
``step``. A batch is a delivery of raw lines under a name of its own; its lines
are parsed once and written as its partitions of ``bronze``, and every other
table's partitions of the batch are a function of those. Partitions are written
by dynamic partition overwrite, so a batch that is run again replaces itself:

* Raw files come by a checkpointed file stream. A micro-batch that is run again
  after a failure has the same files and the same name.
* A row that stays open (``new``, or ``quarantined`` and repairable) is routed
  again under the next ``step`` of its batch, and its old partition is emptied
  when all tables have the new ones. A run that dies in between does the same
  again, with the same outcome.
* ``batches`` has a row of counts for each step, written last. Steps without one
  are derived again from bronze before the next run; no raw line is needed.

The narrow tables (genre, genre_dim, language, bridge) hold each row once. They
are bucketed and sorted by a key of the whole row, so leaving out what is there
already needs no exchange of the stored rows, as long as a task can sort a bucket.

One writer at a time. Between the writes of a run readers may see some of its
tables before the others.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import session
from ..contract import ORDER_CONTRACT, Contract, TablePaths
from ..functions.ingest import DEFAULT_SOURCE, STATUS_NEW, STATUS_QUARANTINED
from ..operators import derive
from ..operators.bronze import BRONZE_COLUMNS, BRONZE_DDL, to_bronze
from ..operators.quality import assert_schema
from ..operators.routing import CLEAN, dedupe_records, parse_records, repair, route, with_status
from ..session import SHUFFLE_CLEANUP, partitions_for, setting
from ..sources import catalog
from ..streaming.ingest import raw_lines, run_available

NARROW = ("genre", "genre_dim", "language", "bridge")
DERIVED = ("silver", "silver_movie", *NARROW)
TABLES = ("bronze", *DERIVED, "batches")
# Tables that are registered under their own names.
CATALOG_TABLES = ("bronze", "silver", "silver_movie", "genre", "language", "bridge")
STEP_DDL = "batch_id STRING, step INT"
BUCKETS = 8
OVERWRITE_MODE, SHUFFLE_PARTITIONS = "spark.sql.sources.partitionOverwriteMode", "spark.sql.shuffle.partitions"
COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"
# Compressed raw lines take some ten times their bytes in memory: a task that reads more than this sorts them for its partitions on disk.
SPLIT, RAW_SPLIT = "spark.sql.files.maxPartitionBytes", "32m"
# Up to so many characters a row is its own key; sorted, such keys take a few bytes in a file, a hash takes 32.
KEY_TEXT = 128
_BATCH_NAME = re.compile(r"^[A-Za-z0-9_.-]+$")


class MedallionStore:
    def __init__(self, spark: SparkSession, root: str, contract: Contract = ORDER_CONTRACT,
                 source: str = DEFAULT_SOURCE, population: str = "all", null_policy: str = "quarantine",
                 history_dedupe: bool = True, database: str | None = None, buckets: int = BUCKETS):
        """``buckets`` is the number of buckets of the narrow tables: some per core of the cluster, and always the same for one root."""
        if population not in ("all", "clean"):
            raise ValueError("population is 'all' or 'clean'")
        self.spark = spark
        self.paths = TablePaths(root.rstrip("/"))
        self.contract = contract
        self.source = source
        self.population = population
        self.null_policy = null_policy
        self.buckets = buckets
        # Every append to a silver table leaves out keys the table already has, so a
        # line, a changed line or an open row that is routed again adds nothing twice.
        # Off, a table may repeat keys across batches.
        self.history_dedupe = history_dedupe
        self.database = database or "silverline_" + hashlib.md5(self.paths.root.encode()).hexdigest()[:12]
        catalog.ensure_database(spark, self.database)
        for name in TABLES:
            self._create(name)

    # ------------------------------------------------------------------ tables
    def _partitions(self, name: str) -> list[str]:
        more = {"bronze": ["status", "fixable", "p_ingestdate"], "silver": [self.contract.partition_column]}
        return ["batch_id", "step", *more.get("silver" if name == "silver_movie" else name, [])]

    def _create(self, name: str) -> None:
        ddl = f"{self._ddl(name)}, {STEP_DDL}" + (", row_key STRING" if name in NARROW else "")
        buckets = (["row_key"], self.buckets) if name in NARROW else None
        catalog.ensure_table(self.spark, self.name(name), getattr(self.paths, name), ddl, self._partitions(name), buckets)

    def name(self, table: str) -> str:
        """The table's name in the catalog."""
        return f"{self.database}.{table}"

    def _stored(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def _routed_ddl(self) -> str:
        return (f"{BRONZE_DDL}, fixable INT, source_file STRING, source_id STRING, {self.contract.typed_ddl()}, "
                "reasons ARRAY<STRING>, reasons_before ARRAY<STRING>, route STRING")

    def silver_ddl(self) -> str:
        c = self.contract
        derived = f", {c.partition_column} DATE" if c.partition_expr else ""
        return f"{c.typed_ddl()}{derived}, record_key STRING"

    def _reasons(self) -> list[str]:
        return [r.name for r in self.contract.rules] + ["malformed", "trailing_data", "missing_key", "bad_key", "bad_date", "bad_nested"]

    def _ddl(self, table: str) -> str:
        c = self.contract
        key = f"{c.key_column} {c.key_type}"
        counts = ["n_lines", "n_records", "n_clean", "n_quarantined", *[f"n_{r}" for r in self._reasons()]]
        return {
            "bronze": self._routed_ddl(),
            "silver": self.silver_ddl(),
            "silver_movie": _drop_field(self.silver_ddl(), c.nested_field),
            "genre": f"source_id STRING, {key}, genres_id BIGINT, name STRING",
            "genre_dim": "genres_id BIGINT, name STRING",
            "language": f"source_id STRING, {key}, " + ", ".join(f"{f} STRING" for f in c.language_fields),
            "bridge": f"{key}, genres_id BIGINT",
            "batches": ", ".join(f"{n} BIGINT" for n in counts) + ", records BINARY",
        }[table]

    # ------------------------------------------------------------------ readers
    def bronze(self) -> DataFrame:
        """The bronze table: every ingested row once, with its status."""
        return self._stored("bronze").select(*_names(BRONZE_DDL))

    def open_rows(self) -> DataFrame:
        """Rows whose status is still open, by a filter on partition columns."""
        return self.bronze().where(F.col("status").isin(STATUS_NEW, STATUS_QUARANTINED))

    def table(self, name: str) -> DataFrame:
        """A table's own columns. ``staging`` has every routed line with its reasons, those before its repair, batch and step."""
        if name == "bronze":
            return self.bronze()
        if name == "staging":
            return self._stored("bronze").where(F.col("route").isNotNull()).select(*_names(self._routed_ddl()), "batch_id", "step")
        return self._stored(name).select(*_names(self._ddl(name)))

    def metrics(self) -> DataFrame:
        """Per batch and step: routed lines, distinct records, clean and quarantined lines and
        lines per reason, as the run that wrote them counted them."""
        return self._stored("batches").drop("records")

    def distinct_records(self) -> DataFrame:
        """One row, ``n_records``: about how many distinct records all batches held.

        The HyperLogLog sketches of the batches are merged, so no batch is read
        again; the standard error is 1.04 / sqrt(2^12), 1.6 %."""
        return self._stored("batches").agg(F.hll_sketch_estimate(F.hll_union_agg("records")).alias("n_records"))

    def register(self, database: str) -> list[str]:
        """Views by the tables' names, with the tables' own columns, in ``database``; the names."""
        catalog.ensure_database(self.spark, database)
        for name in CATALOG_TABLES:
            shown = BRONZE_COLUMNS + ["record_key"] if name == "bronze" else _names(self._ddl(name))
            self.spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {', '.join(f'`{c}`' for c in shown)} FROM {self.name(name)}")
        return [f"{database}.{name}" for name in CATALOG_TABLES]

    # ------------------------------------------------------------------ writers
    def _put(self, table: str, rows: DataFrame) -> None:
        """Write partitions by dynamic overwrite: those the rows have are replaced, others stay."""
        columns = self._stored(table).columns
        with ExitStack() as held:
            held.enter_context(setting(rows.sparkSession, OVERWRITE_MODE, "dynamic"))
            held.enter_context(setting(rows.sparkSession, SHUFFLE_CLEANUP, "true"))
            if table == "bronze":
                held.enter_context(_small_splits(rows.sparkSession))
            rows.select(*columns).write.insertInto(self.name(table), overwrite=True)
        self.spark.catalog.refreshTable(self.name(table))

    def _empty(self, table: str, **partition) -> None:
        """Remove all rows of a partition, or of all partitions below it."""
        given = [c for c in self._partitions(table) if c in partition]
        spec = ", ".join([*(f"{c} = {partition[c]!r}" for c in given), *(c for c in self._partitions(table) if c not in partition)])
        columns = [c for c in self._stored(table).columns if c not in partition]
        with setting(self.spark, OVERWRITE_MODE, "static"):
            nothing = self.spark.createDataFrame([], StructType([self._stored(table).schema[c] for c in columns]))
            nothing.createOrReplaceTempView("silverline_nothing")
            self.spark.sql(f"INSERT OVERWRITE TABLE {self.name(table)} PARTITION ({spec}) SELECT {', '.join(f'`{c}`' for c in columns)} "
                           "FROM silverline_nothing")
        self.spark.catalog.refreshTable(self.name(table))

    def _places(self, table: str) -> DataFrame:
        """The partitions of a table, from the catalog alone."""
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}")
        return listed.select(*[F.regexp_extract("partition", f"(?:^|/){c}=([^/]*)", 1).alias(c) for c in self._partitions(table)]) \
            .withColumn("step", F.col("step").cast("int"))

    def _steps(self, table: str, condition: Column | None = None) -> list[tuple[str, int]]:
        """(batch, step) of partitions: as many as batches, whatever they hold."""
        places = self._places(table)
        places = places if condition is None else places.where(condition)
        return [(r["batch_id"], r["step"]) for r in places.select("batch_id", "step").distinct().collect()]

    def _next_batch(self) -> str:
        last = self._places("bronze").where("batch_id RLIKE '^batch-[0-9]+$'").agg(F.max(F.substring("batch_id", 7, 20).cast("long"))).first()[0]
        return f"batch-{(last or 0) + 1:09d}"

    def _land(self, rows: DataFrame, batch_id: str) -> None:
        """Write rows of bronze as the first step of a batch, in place of whatever the batch held."""
        if not _BATCH_NAME.match(batch_id):
            raise ValueError(f"bad batch name {batch_id!r}")
        if any(b == batch_id for b, _ in self._steps("bronze")):
            for table in TABLES:
                self._empty(table, batch_id=batch_id)
        columns = _names(self._routed_ddl())
        blank = [F.col(c) if c in rows.columns else F.lit(None).cast(StructType.fromDDL(self._routed_ddl())[c].dataType).alias(c) for c in columns]
        self._put("bronze", rows.select(*blank, F.lit(batch_id).alias("batch_id"), F.lit(0).alias("step")))

    def ingest_lines(self, raw: DataFrame, now: dt.datetime | str | None = None, batch_id: str | None = None) -> str:
        """Raw lines (``value``) to bronze as ``new`` rows of a batch; its name."""
        batch_id = batch_id or self._next_batch()
        self._land(to_bronze(raw, self.source, now).withColumn("fixable", F.lit(1)), batch_id)
        return batch_id

    def load(self, raw: DataFrame, batch_id: str, now: dt.datetime | str | None = None) -> None:
        """Parse, route and load raw lines (``value``, ``source_file`` if known) as a batch. Run again, it replaces itself."""
        keep = ("source_file",) if "source_file" in raw.columns else ()
        rows = to_bronze(raw.select("value", *keep), self.source, now, keep=keep)
        self._land(self._routed(rows, repairing=False), batch_id)
        self._derive([(batch_id, 0)])

    def run_batch(self, raw_path: str | None = None, raw: DataFrame | None = None, now: dt.datetime | str | None = None,
                  batch_id: str | None = None, max_files_per_trigger: int | None = None) -> list[str]:
        """Route every ``new`` row of bronze, then load raw lines, or the raw files that came since the last
        run, by the folder's checkpointed stream. The names of the batches loaded from raw."""
        self.recover()
        self._route_again(STATUS_NEW, repairing=False)
        if raw is not None:
            batch_id = batch_id or self._next_batch()
            self.load(raw, batch_id, now)
            return [batch_id]
        if raw_path is None:
            return []
        stream = hashlib.md5(raw_path.encode()).hexdigest()[:8]
        loaded: list[str] = []

        def take(lines: DataFrame, number: int) -> None:
            name = f"files-{stream}-{number:09d}"
            self.load(lines, name, now)
            loaded.append(name)

        lines = raw_lines(self.spark, raw_path, max_files_per_trigger, recursive=True)
        with _small_splits(self.spark):
            run_available(lines, take, f"{self.paths.checkpoints}/files-{stream}")
        return loaded

    def fold_arrivals(self, arrivals_path: str) -> int:
        """Take the micro-batches of a streaming arrivals table (W1) that bronze does not have yet into it as
        ``new``, each as a batch; their number.

        Micro-batches are folders, so those taken before are pruned, not joined
        away. Fold a table while no stream is writing it.
        """
        stream = f"arrivals-{hashlib.md5(arrivals_path.encode()).hexdigest()[:8]}"
        done = self._places("bronze").where(F.col("batch_id").startswith(f"{stream}-")) \
            .agg(F.max(F.substring_index("batch_id", "-", -1).cast("long"))).first()[0]
        rows = self.spark.read.schema(f"{BRONZE_DDL}, source_file STRING, batch_id BIGINT").parquet(arrivals_path) \
            .where(F.col("batch_id") > (-1 if done is None else done))
        typed = StructType.fromDDL(self._routed_ddl())
        columns = [F.col(c) if c in rows.columns else F.lit(1).alias(c) if c == "fixable" else F.lit(None).cast(typed[c].dataType).alias(c)
                   for c in typed.fieldNames()]
        named = F.format_string(f"{stream}-%09d", "batch_id").alias("batch_id")
        before = len(self._steps("bronze"))
        self._put("bronze", rows.select(*columns, named, F.lit(0).alias("step")))
        return len(self._steps("bronze")) - before

    def run_repair(self) -> int:
        """Repair quarantined rows that a repair may change (contract repairs), route them again and load
        those that now pass; the rest stay quarantined for good. The number of batches that had such rows."""
        self.recover()
        return self._route_again(STATUS_QUARANTINED, repairing=True)

    def recover(self) -> int:
        """Derive again what bronze has and a dead run left undone; the number of such steps."""
        routed = (F.col("status") != STATUS_NEW) | (F.col("step") > 0)
        undone = sorted(set(self._steps("bronze", routed)) - set(self._steps("batches")))
        if undone:
            self._derive(undone)
        return len(undone)

    def _routed(self, rows: DataFrame, repairing: bool) -> DataFrame:
        c = self.contract
        parsed = parse_records(rows, c)
        assert_schema(parsed.select(*c.typed_fields()), c.typed_ddl())
        if repairing:
            parsed = repair(parsed, c)
        return with_status(route(parsed, c, self.null_policy), final=repairing)

    def _route_again(self, status: str, repairing: bool) -> int:
        """Route the open rows of a status again, as the next step of their batches."""
        opened = sorted(self._steps("bronze", (F.col("status") == status) & (F.col("fixable") == "1")))
        if not opened:
            return 0
        open_rows = self._stored("bronze").where((F.col("status") == status) & (F.col("fixable") == 1) & _in(opened))
        keep = [*_names(BRONZE_DDL), "source_file", F.col("reasons").alias("reasons_before"), "batch_id", (F.col("step") + 1).alias("step")]
        self._put("bronze", self._routed(open_rows.select(*keep), repairing))
        self._derive([(batch, step + 1) for batch, step in opened])
        for batch, step in opened:                  # the rows are in the next step now
            self._empty("bronze", batch_id=batch, step=step, status=status, fixable=1)
        return len(opened)

    def _shuffles(self, rows: int, firm: bool = False) -> ExitStack:
        """While it is open, shuffles have the partitions that so many rows ask for, if those are more than the session's, so that a
        task sorts its rows in memory. ``firm``: adaptive execution does not put them together by their bytes, which are few for short rows."""
        out, partitions = ExitStack(), partitions_for(self.spark, rows)
        if partitions:
            out.enter_context(setting(self.spark, SHUFFLE_PARTITIONS, str(partitions)))
            if firm:
                out.enter_context(setting(self.spark, COALESCE, "false"))
        return out

    def _derive(self, steps: list[tuple[str, int]]) -> None:
        """Write the partitions of these steps in all tables that follow from bronze; the counts last."""
        rows = self._stored("bronze").where(_in(steps) & F.col("route").isNotNull())
        # opening braces of the nested texts: at least as many as they have elements
        nested = F.col(self.contract.nested_field)
        lines, elements = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length(nested) - F.length(F.replace(nested, F.lit("{")))), F.lit(0))).first()
        with self._shuffles(lines):
            self._derive_rows(rows, steps, lines, elements)

    def _derive_rows(self, rows: DataFrame, steps: list[tuple[str, int]], lines: int, elements: int) -> None:
        c = self.contract
        clean, place = rows.where(F.col("route") == CLEAN), ("batch_id", "step")
        self._put("silver", self._wide(clean, steps))
        # The movie table is the wide partitions just written, minus the nested text:
        # its files are already one per partition value, so no shuffle is needed.
        self._put("silver_movie", derive.silver_movie(self._stored("silver").where(_in(steps)), c))
        if self.population == "clean":
            self._put_narrow(clean, steps, lines, elements)
        else:                       # a record is derived when it is first routed, not again when it is repaired
            self._put_narrow(rows.where(F.col("reasons_before").isNull()), steps, lines, elements)
        reasons = [F.count_if(F.array_contains("reasons", r)).alias(f"n_{r}") for r in self._reasons()]
        self._put("batches", rows.groupBy(*place).agg(
            F.count(F.lit(1)).alias("n_lines"), F.count_distinct(F.unhex("record_key")).alias("n_records"), F.count_if(F.col("route") == CLEAN).alias("n_clean"),
            F.count_if(F.col("route") == "quarantined").alias("n_quarantined"), *reasons, F.hll_sketch_agg("record_key").alias("records")))

    def _wide(self, clean: DataFrame, steps: list[tuple[str, int]]) -> DataFrame:
        """Rows of the wide table that no other step has, each record once.

        The key moves as bytes, half of its hexadecimal text, and the dedupe's shuffle is that of the join with the stored keys."""
        c, part = self.contract, self.contract.partition_column
        keep = () if len(steps) == 1 else ("batch_id", "step")
        wide = derive.silver_wide(dedupe_records(clean.withColumn("record_key", F.unhex("record_key"))), c, keep=keep)
        held = self._others("silver", steps)
        if held is not None:
            # equal lines have the same partition, so only partitions of these rows are looked at
            # (their number is bounded by the table's layout, not by its rows)
            present = [r[0] for r in derive.silver_wide(clean, c).select(part).distinct().collect()]
            held = held.where(F.col(part).isin([p for p in present if p is not None]) | F.col(part).isNull())
            wide = wide.join(held.select(F.unhex("record_key").alias("record_key")), "record_key", "left_anti")
        # REBALANCE clusters rows by the partition column (one file per value and
        # task, not one per value in every task) and lets adaptive execution
        # split a value that holds a large share of the rows over several tasks.
        wide = wide.hint("rebalance", part).withColumn("record_key", F.lower(F.hex("record_key")))
        assert_schema(wide.select(*_names(self.silver_ddl())), self.silver_ddl())
        return wide if keep else _placed(wide, steps[0])

    def _put_narrow(self, rows: DataFrame, steps: list[tuple[str, int]], lines: int, elements: int) -> None:
        """Narrow tables: each gets the rows that it does not hold yet; ``lines`` and ``elements`` are not below what ``rows`` and their nested lists hold."""
        c, place = self.contract, ("batch_id", "step")
        self._append_rows("genre", derive.exploded_genres(rows, c, keep=place), steps, elements)
        genres = self._stored("genre").where(_in(steps))
        self._append_rows("genre_dim", genres, steps, elements)
        self._append_rows("language", rows, steps, lines)
        # bridge = key pairs of the genre rows (typed Parquet; no second parse or explode)
        self._append_rows("bridge", genres.where(F.col(c.key_column).isNotNull()), steps, elements)

    def _append_rows(self, table: str, rows: DataFrame, steps: list[tuple[str, int]], most: int) -> None:
        """Each distinct row once, under the first of the steps that has it; ``most`` is not below the number of rows.

        Known rows are left out by a join with the stored keys, bucket by bucket. A bucket is one task: where that would be more
        rows than a task sorts in memory, both sides are dealt by the whole row instead, the batch by the shuffle of its distinct rows.
        So are they if the table has keys that an earlier release made."""
        columns = _names(self._ddl(table))
        held = self._others(table, steps)
        stored = 0 if held is None else held.count()
        dealt = held is not None and (max(stored, most) > self.buckets * session.TASK_ROWS or _other_keys(held, columns))
        with self._shuffles(max(stored, most), firm=table != "genre_dim"):
            # one column with nulls inside is equal for equal rows
            once = rows.select("batch_id", "step", F.struct(*columns).alias("r"))
            if len(steps) > 1:
                once = once.groupBy("r").agg(F.min(F.struct("batch_id", "step")).alias("p")).select("p.*", "r")
            else:
                once = _placed(once.select("r").distinct() if dealt else once.select("r.*").distinct().select(F.struct(*columns).alias("r")), steps[0])
            if stored > session.TASK_ROWS:      # files say little of the size of keys in memory: broadcast a few at most
                once = once.hint("merge")
            if dealt:
                once = once.join(held.select(F.struct(*columns).alias("r")), "r", "left_anti")
            # the key follows the shuffle: it would be most of what is shuffled
            once = once.select("batch_id", "step", "r.*").withColumn("row_key", row_key(columns))
            self._put(table, once if dealt else self._unknown(once, table, "row_key", steps))

    def _others(self, table: str, steps: list[tuple[str, int]]) -> DataFrame | None:
        """The table's rows of other steps, if their keys are to be left out and there are such steps:
        else there is nothing to look at, and no reason to deal the batch's rows again."""
        if not self.history_dedupe or not set(self._steps(table)) - set(steps):
            return None
        return self._stored(table).where(~_in(steps))

    def _unknown(self, rows: DataFrame, table: str, key: str, steps: list[tuple[str, int]]) -> DataFrame:
        """``rows`` whose key no other step of the table holds."""
        held = self._others(table, steps)
        return rows if held is None else rows.join(held.select(key), key, "left_anti")


def row_text(columns: list[str]) -> Column:
    """The text of the whole row, its columns parted by commas: equal for equal rows only, nulls included."""
    parts = [F.coalesce(F.concat(F.lit("="), F.regexp_replace(F.col(c).cast("string"), r"([\\,])", r"\\$1")), F.lit("")) for c in columns]
    return F.concat_ws(",", *parts)


def row_key(columns: list[str]) -> Column:
    """A key of the whole row, never null: its text up to ``KEY_TEXT`` characters, else the SHA-256 of its text."""
    text = row_text(columns)
    return F.when(F.length(text) <= KEY_TEXT, text).otherwise(F.sha2(text, 256))


def _other_keys(held: DataFrame, columns: list[str]) -> bool:
    """Whether rows have a hash for a key although their text is short, as stores had before.

    Texts begin with ``=`` or a comma, so the filter passes by files without hashes by their statistics alone."""
    hashed = F.col("row_key").between("0", ":") | F.col("row_key").between("a", "g")
    return held.where(hashed & (F.length(row_text(columns)) <= KEY_TEXT)).limit(1).count() > 0


def _small_splits(spark: SparkSession) -> ExitStack:
    """Files are read in splits of ``RAW_SPLIT`` while it is open, unless the session has its own size."""
    out = ExitStack()
    if spark.conf.get(SPLIT, None) is None:
        out.enter_context(setting(spark, SPLIT, RAW_SPLIT))
    return out


def _placed(rows: DataFrame, step: tuple[str, int]) -> DataFrame:
    """``rows`` with the batch and step of a single step."""
    return rows.withColumns({"batch_id": F.lit(step[0]), "step": F.lit(step[1])})


def _in(steps: list[tuple[str, int]]) -> Column:
    """Rows of these steps, as a filter on partition columns."""
    by_step: dict[int, list[str]] = {}
    for batch, step in steps:
        by_step.setdefault(step, []).append(batch)
    out = F.lit(False)
    for step, batches in by_step.items():
        out = out | ((F.col("step") == step) & F.col("batch_id").isin(batches))
    return out


def _names(ddl: str) -> list[str]:
    return StructType.fromDDL(ddl).fieldNames()


def _drop_field(ddl: str, name: str) -> str:
    s = StructType.fromDDL(ddl)
    return ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in s.fields if f.name != name)
