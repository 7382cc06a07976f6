"""Every operator as a query over the given tables, with its SQL oracle.

Each query takes ``(spark, sf_dir)``, derives the order feed from the whole
``orders``/``customer``/``lineitem``/``part`` tables, runs one operator (or
stage) on it and returns a DataFrame. Writes go to a new folder below the
shared ``spark.checkpoint.dir``. ``ORACLE`` holds the same result as SQL over
the base tables; column names match one to one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .contract import ORDER_BUDGET_FLOOR, ORDER_CONTRACT
from .fixtures import order_feed as feed
from .functions.parsing import CORRUPT, parse_json, parse_nested, to_date_safe, to_int_safe
from .functions.repair import abs_value, floor_at
from .operators import bronze as B
from .operators import derive as D
from .operators import merge as M
from .operators import quality as Q
from .operators import routing as R
from .operators.lookup import repair_by_lookup
from .plans.land import export_raw, land_source
from .plans.store import MedallionStore
from .session import SHUFFLE_CLEANUP, scratch_path, setting
from .sources import array_documents as A
from .sources import catalog as C
from .sources import files as S
from .sources import sinks as K
from .streaming.ingest import stream_ingest

CONTRACT = ORDER_CONTRACT
FIXED_NOW = "2024-01-01 00:00:00"
# Orders dated before this arrive in the first batch, the rest in the second.
SECOND_BATCH_FROM = "1998-01-01"
DOC_SCHEMA = ("movie ARRAY<STRUCT<Id: STRING, Title: STRING, Budget: DOUBLE, RunTime: BIGINT, "
              "OriginalLanguage: STRING, ReleaseDate: STRING, "
              "genres: ARRAY<STRUCT<id: BIGINT, name: STRING>>>>")
VIEW = ["Id", "movie_id", "Title", "Budget", "RunTime", "OriginalLanguage", "ReleaseDate", "n_genres"]
TYPED = ["movie_id", "Title", "Budget", "RunTime", "OriginalLanguage", "ReleaseDate"]

_CACHE: dict[tuple[str, str, str], str] = {}


# ----------------------------------------------------------------------------- inputs
def _cached(spark: SparkSession, sf_dir: str, name: str, make: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _CACHE:
        path = scratch_path(spark, name)
        make(path)
        _CACHE[key] = path
    return _CACHE[key]


def raw_feed_path(spark: SparkSession, sf_dir: str) -> str:
    """The feed's raw JSON lines, written once per session as compressed text files."""
    def make(path: str) -> None:
        with setting(spark, SHUFFLE_CLEANUP, "true"):
            feed.feed_lines(spark, sf_dir).write.mode("errorifexists").option("compression", "gzip").text(path)
    return _cached(spark, sf_dir, "raw-feed", make)


def source_docs_root(spark: SparkSession, sf_dir: str) -> str:
    """Multi-line source documents in ``<root>/movie_feed``; ``<root>/extra_feed``
    holds a second copy that path selection must leave out."""
    def make(root: str) -> None:
        feed.write_documents(feed.feed_documents(spark, sf_dir), f"{root}/movie_feed")
        feed.copy_documents(spark, f"{root}/movie_feed", f"{root}/extra_feed")
    return _cached(spark, sf_dir, "source-docs", make)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.read_text_lines(spark, raw_feed_path(spark, sf_dir))


def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.to_bronze(lines(spark, sf_dir), now=FIXED_NOW)


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.parse_records(bronze_rows(spark, sf_dir), CONTRACT)


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.route(parsed(spark, sf_dir), CONTRACT)


def n_genres_of_text(col: str = "genres"):
    return F.coalesce(F.size(parse_nested(col, CONTRACT.nested_ddl)), F.lit(0)).cast("bigint")


def view(df: DataFrame) -> DataFrame:
    """Standard projection of parsed-and-typed records; ``Id`` is the source text
    (read from the line when only ``value`` is left, else the typed key)."""
    if "Id" in df.columns:
        idc = F.col("Id")
    elif "value" in df.columns:
        idc = F.get_json_object("value", "$.Id")
    else:
        idc = F.col("movie_id").cast("string")
    return df.select(idc.alias("Id"), *TYPED, n_genres_of_text().alias("n_genres"))


def view_parsed(df: DataFrame) -> DataFrame:
    """Parse a frame with ``value`` and project the standard view."""
    return view(R.parse_records(df.select("value"), CONTRACT))


def view_of_struct(df: DataFrame, prefix: str = "") -> DataFrame:
    """Standard view of records held as structs / columns with ``genres`` as an array."""
    c = (lambda n: F.col(f"{prefix}{n}"))
    return df.select(c("Id").alias("Id"), to_int_safe(c("Id"), "BIGINT").alias("movie_id"), c("Title").alias("Title"),
                     c("Budget").cast("double").alias("Budget"), c("RunTime").cast("bigint").alias("RunTime"),
                     c("OriginalLanguage").alias("OriginalLanguage"),
                     to_date_safe(c("ReleaseDate")).alias("ReleaseDate"),
                     F.coalesce(F.size(c("genres")), F.lit(0)).cast("bigint").alias("n_genres"))


def docs_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = source_docs_root(spark, sf_dir)
    docs = S.read_multiline_json(spark, f"{root}/movie_*", schema=DOC_SCHEMA)
    return S.explode_array(docs, "movie", "movies")


def _store(spark: SparkSession, tag: str) -> MedallionStore:
    return MedallionStore(spark, scratch_path(spark, tag), CONTRACT)


def _is_first(value: str = "value"):
    """Lines of the first batch; a line without a date belongs to the second."""
    return F.coalesce(F.get_json_object(value, "$.ReleaseDate") < SECOND_BATCH_FROM, F.lit(False))


def _first_batch(df: DataFrame) -> DataFrame:
    return df.where(_is_first())


def _second_batch(df: DataFrame) -> DataFrame:
    return df.where(~_is_first())


# ----------------------------------------------------------------------------- scans and sinks
def q_scan_multiline_json(spark, sf_dir):
    root = source_docs_root(spark, sf_dir)
    docs = S.read_multiline_json(spark, f"{root}/movie_feed")        # schema inferred
    return view_of_struct(S.explode_array(docs, "movie", "movies"), "movies.")


# The source documents of the feed are small; real ones take the session's split size.
SPLIT_BYTES = 1 << 18


def q_scan_array_elements(spark, sf_dir):
    """The same documents, each read in splits."""
    root = source_docs_root(spark, sf_dir)
    elements = A.read_array_elements(spark, f"{root}/movie_feed", "movie", split_bytes=SPLIT_BYTES)
    element = StructType.fromDDL(DOC_SCHEMA)["movie"].dataType.elementType
    return view_of_struct(elements.select(F.from_json("value", element).alias("movies")), "movies.")


def q_scan_glob_files(spark, sf_dir):
    return view_of_struct(docs_exploded(spark, sf_dir), "movies.")


def q_scan_text_lines(spark, sf_dir):
    return view_parsed(lines(spark, sf_dir))


def q_scan_table_path(spark, sf_dir):
    path = scratch_path(spark, "bronze-table")
    K.write_create_only(bronze_rows(spark, sf_dir), path, partition_by="p_ingestdate")
    return view_parsed(S.read_table_path(spark, path))


def q_scan_catalog_table(spark, sf_dir):
    path = scratch_path(spark, "bronze-catalog")
    K.write_create_only(bronze_rows(spark, sf_dir), path)
    C.ensure_database(spark, "silverline_db")
    name = "silverline_db.bronze_scan"          # the name is used again by the next call
    C.register_external(spark, name, path)
    return view_parsed(S.read_catalog_table(spark, name))


def source_id(df: DataFrame) -> DataFrame:
    """Add the key as it appears in the line (``Id``), next to the typed ``movie_id``."""
    return df.withColumn("Id", F.get_json_object("value", "$.Id"))


def _typed_view(spark, sf_dir) -> DataFrame:
    """Standard view plus the contract's (monthly) partition column."""
    v = view(parsed(spark, sf_dir))
    return v.withColumn(CONTRACT.partition_column, F.expr(CONTRACT.partition_expr))


def q_sink_create_only(spark, sf_dir):
    path = scratch_path(spark, "create-only")
    K.write_create_only(_typed_view(spark, sf_dir), path)
    return spark.read.parquet(path).select(*VIEW)


def _two_appends(spark, sf_dir, partition_by):
    path = scratch_path(spark, "append")
    v = _typed_view(spark, sf_dir)
    first = v.where(F.col("ReleaseDate") < F.lit(SECOND_BATCH_FROM).cast("date"))
    rest = v.where(~(F.col("ReleaseDate") < F.lit(SECOND_BATCH_FROM).cast("date")) | F.col("ReleaseDate").isNull())
    K.append(first, path, partition_by=partition_by)
    K.append(rest, path, partition_by=partition_by)
    return spark.read.parquet(path).select(*VIEW)


def q_sink_append_partitioned(spark, sf_dir):
    return _two_appends(spark, sf_dir, CONTRACT.partition_column)


def q_sink_append(spark, sf_dir):
    return _two_appends(spark, sf_dir, None)


def q_sink_batch_writer(spark, sf_dir):
    path = scratch_path(spark, "batch-writer")
    p = parsed(spark, sf_dir).withColumns({"n_genres": n_genres_of_text(),
                                           "Id": F.get_json_object("value", "$.Id"),
                                           CONTRACT.partition_column: F.expr(CONTRACT.partition_expr)})
    K.write_batch(p, path, partition_by=CONTRACT.partition_column,
                  exclude=["value", "record_key", "datasource", "ingesttime", "status", "p_ingestdate",
                           "genres", "_checks"])
    return spark.read.parquet(path).select(*VIEW)


def q_sink_json_lines(spark, sf_dir):
    path = scratch_path(spark, "json-lines")
    p = source_id(parsed(spark, sf_dir)).select(
        "Id", "Title", "Budget", "RunTime", "OriginalLanguage",
        F.col("ReleaseDate").cast("string").alias("ReleaseDate"),
        parse_nested("genres", CONTRACT.nested_ddl).alias("genres"))
    K.export_json_lines(p, path)
    return view_parsed(S.read_text_lines(spark, path))


def q_register_external(spark, sf_dir):
    path = scratch_path(spark, "external")
    K.write_create_only(_typed_view(spark, sf_dir), path, partition_by=CONTRACT.partition_column)
    C.ensure_database(spark, "silverline_db")
    name = "silverline_db.typed_external"
    return C.register_external(spark, name, path, partitioned=True).select(*VIEW)


def q_stream_ingest(spark, sf_dir):
    root = scratch_path(spark, "stream")
    stream_ingest(spark, raw_feed_path(spark, sf_dir), f"{root}/arrivals", f"{root}/_checkpoint")
    return view_parsed(spark.read.parquet(f"{root}/arrivals"))


def q_stream_dedupe(spark, sf_dir):
    """The feed's lines once each, whatever micro-batch repeats them; the run is cut in two."""
    root, raw = scratch_path(spark, "stream-dedupe"), scratch_path(spark, "stream-raw")
    for part in (_first_batch(lines(spark, sf_dir)), lines(spark, sf_dir)):
        part.write.mode("append").text(raw)
        stream_ingest(spark, raw, f"{root}/arrivals", f"{root}/_checkpoint", dedupe_within="7 days")
    return view_parsed(spark.read.parquet(f"{root}/arrivals"))


def q_fold_arrivals(spark, sf_dir):
    root = scratch_path(spark, "fold")
    stream_ingest(spark, raw_feed_path(spark, sf_dir), f"{root}/arrivals", f"{root}/_checkpoint", max_files_per_trigger=1)
    store = MedallionStore(spark, f"{root}/store", CONTRACT)
    store.fold_arrivals(f"{root}/arrivals")
    store.fold_arrivals(f"{root}/arrivals")          # nothing new
    return _status_rows(store.bronze())


# ----------------------------------------------------------------------------- projections
def q_explode_source_array(spark, sf_dir):
    return view_of_struct(docs_exploded(spark, sf_dir), "movies.")


def q_explode_genres(spark, sf_dir):
    return D.exploded_genres(parsed(spark, sf_dir), CONTRACT)


def q_struct_star(spark, sf_dir):
    flat = docs_exploded(spark, sf_dir).select("movies.*")
    return flat.select("Id", "Title", "Budget", "RunTime", "OriginalLanguage", "ReleaseDate",
                       F.coalesce(F.size("genres"), F.lit(0)).cast("bigint").alias("n_genres"))


def q_nested_fields(spark, sf_dir):
    d = docs_exploded(spark, sf_dir)
    return d.select(F.col("movies.Id").alias("Id"), F.col("movies.Title").alias("Title"),
                    F.try_element_at(F.col("movies.genres.id"), F.lit(1)).alias("first_genre_id"),
                    F.coalesce(F.size("movies.genres"), F.lit(0)).cast("bigint").alias("n_genres"))


def q_project_silver(spark, sf_dir):
    clean, _ = R.split(routed(spark, sf_dir))
    return view(D.silver_wide(R.dedupe_records(clean), CONTRACT))


def q_drop_columns(spark, sf_dir):
    out = R.drop_columns(parsed(spark, sf_dir), ["value", "record_key", "datasource", "ingesttime",
                                                   "status", "p_ingestdate", "genres"])
    return out.select(*TYPED)


def q_add_ingest_metadata(spark, sf_dir):
    b = bronze_rows(spark, sf_dir)
    return b.select("datasource", F.date_format("ingesttime", "yyyy-MM-dd HH:mm:ss").alias("ingesttime"),
                    "status", "p_ingestdate", F.get_json_object("value", "$.Title").alias("Title"))


def q_stage_bronze(spark, sf_dir):
    store = _store(spark, "stage-bronze")
    store.ingest_lines(lines(spark, sf_dir), now=FIXED_NOW)
    b = store.bronze()
    return b.select("datasource", F.date_format("ingesttime", "yyyy-MM-dd HH:mm:ss").alias("ingesttime"),
                    "status", "p_ingestdate", F.get_json_object("value", "$.Title").alias("Title"))


# ----------------------------------------------------------------------------- filters
def _two_batch_store(spark, sf_dir, tag) -> MedallionStore:
    store = _store(spark, tag)
    ls = lines(spark, sf_dir)
    store.run_batch(raw=_first_batch(ls), now=FIXED_NOW)
    store.ingest_lines(_second_batch(ls), now=FIXED_NOW)
    return store


def q_read_new(spark, sf_dir):
    store = _two_batch_store(spark, sf_dir, "read-new")
    return view_parsed(B.read_new(store.bronze()))


def q_read_quarantined(spark, sf_dir):
    store = _two_batch_store(spark, sf_dir, "read-quarantined")
    return view_parsed(B.read_quarantined(store.bronze()))


def q_split_clean(spark, sf_dir):
    clean, _ = R.split(routed(spark, sf_dir))
    return view(R.dedupe_records(clean))


def q_split_quarantine(spark, sf_dir):
    _, bad = R.split(routed(spark, sf_dir))
    return source_id(R.dedupe_records(bad)).select("Id", "Budget", "RunTime",
                                        F.array_join("reasons", ",").alias("reasons"))


def q_route_counts(spark, sf_dir):
    return Q.route_counts(R.dedupe_records(routed(spark, sf_dir)))


def q_reason_counts(spark, sf_dir):
    return Q.reason_counts(R.dedupe_records(routed(spark, sf_dir)))


def q_drop_null_rows(spark, sf_dir):
    return R.drop_null_rows(parsed(spark, sf_dir).select(*TYPED))


# ----------------------------------------------------------------------------- joins
def _genre_rows_all(spark, sf_dir):
    return D.genre_rows(parsed(spark, sf_dir), CONTRACT)


def q_bridge_join(spark, sf_dir):
    clean, _ = R.split(routed(spark, sf_dir))
    movies = D.silver_movie(D.silver_wide(R.dedupe_records(clean), CONTRACT), CONTRACT)
    return D.bridge_join(movies, _genre_rows_all(spark, sf_dir), CONTRACT)


def q_repair_lookup(spark, sf_dir):
    _, bad = R.split(routed(spark, sf_dir))
    missing_budget = R.dedupe_records(bad).where(F.col("Budget").isNull())
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    fixed = repair_by_lookup(missing_budget, orders, on=("movie_id", "o_orderkey"),
                             replace={"Budget": "o_totalprice"})
    return fixed.select(*TYPED)


def _status_rows(df: DataFrame) -> DataFrame:
    return df.select(F.get_json_object("value", "$.Title").alias("Title"), "status")


def q_merge_status_loaded(spark, sf_dir):
    clean, _ = R.split(routed(spark, sf_dir))
    return _status_rows(B.apply_status(bronze_rows(spark, sf_dir), clean.select("value"), B.STATUS_LOADED))


def q_merge_status_quarantined(spark, sf_dir):
    _, bad = R.split(routed(spark, sf_dir))
    return _status_rows(B.apply_status(bronze_rows(spark, sf_dir), bad.select("value"), B.STATUS_QUARANTINED))


STATUS_BUCKETS = 64


def q_merge_buckets(spark, sf_dir):
    """Two merges in place: what is clean, then what is quarantined."""
    path = M.write_buckets(bronze_rows(spark, sf_dir), scratch_path(spark, "bronze-buckets"), STATUS_BUCKETS)
    clean, bad = R.split(routed(spark, sf_dir))
    M.merge_status(spark, path, clean.select("value"), STATUS_BUCKETS, B.STATUS_LOADED)
    M.merge_status(spark, path, bad.select("value"), STATUS_BUCKETS, B.STATUS_QUARANTINED)
    return _status_rows(M.read_buckets(spark, path))


def q_stage_status(spark, sf_dir):
    updates = B.status_from_route(routed(spark, sf_dir))
    return _status_rows(B.apply_status(bronze_rows(spark, sf_dir), updates))


# ----------------------------------------------------------------------------- aggregates
def q_count_rows(spark, sf_dir):
    return Q.stage_metrics(routed(spark, sf_dir))


def q_count_non_null(spark, sf_dir):
    return Q.count_non_null(parsed(spark, sf_dir), ["value", "movie_id", "Budget", "RunTime", "ReleaseDate"])


def q_completeness(spark, sf_dir):
    return Q.completeness(parsed(spark, sf_dir).select(*TYPED))


def q_dedupe_records(spark, sf_dir):
    r = R.dedupe_records(routed(spark, sf_dir))
    return r.select(*TYPED, "route")


def q_dedupe_languages(spark, sf_dir):
    return D.language_rows(parsed(spark, sf_dir), CONTRACT)


def q_bridge_dedup(spark, sf_dir):
    p = parsed(spark, sf_dir).where(F.col("movie_id").isNotNull())
    return D.bridge_join(p, _genre_rows_all(spark, sf_dir), CONTRACT, dedupe=True)


def q_order_by_id(spark, sf_dir):
    clean, _ = R.split(routed(spark, sf_dir))
    movies = D.silver_movie(D.silver_wide(R.dedupe_records(clean), CONTRACT), CONTRACT)
    return D.order_by_key(movies, CONTRACT).select("movie_id", "Title")


# ----------------------------------------------------------------------------- scalar functions
def q_parse_json(spark, sf_dir):
    p = lines(spark, sf_dir).select(parse_json("value", CONTRACT.source_ddl).alias("j"))
    return p.select("j.Id", "j.Title", "j.Budget", "j.RunTime", "j.OriginalLanguage", "j.ReleaseDate",
                    F.col(f"j.{CORRUPT}").isNotNull().alias("malformed"))


def q_parse_nested_text(spark, sf_dir):
    p = lines(spark, sf_dir).select(parse_json("value", CONTRACT.source_ddl).alias("j"))
    g = p.select(F.col("j.Id").alias("Id"), parse_nested("j.genres", CONTRACT.nested_ddl).alias("g"))
    return g.select("Id", F.size("g").cast("bigint").alias("n_genres"),
                    F.try_element_at("g", F.lit(1))["id"].alias("first_genre_id"),
                    F.try_element_at("g", F.lit(-1))["id"].alias("last_genre_id"))


def q_cast_date(spark, sf_dir):
    p = lines(spark, sf_dir).select(parse_json("value", CONTRACT.source_ddl).alias("j"))
    return p.select(F.col("j.Id").alias("Id"), F.col("j.ReleaseDate").alias("ReleaseDateText"),
                    to_date_safe("j.ReleaseDate").alias("ReleaseDate"))


def q_cast_int(spark, sf_dir):
    p = lines(spark, sf_dir).select(parse_json("value", CONTRACT.source_ddl).alias("j"))
    return p.select(F.col("j.Id").alias("Id"), to_int_safe("j.Id", "INT").alias("id_int"))


def _quarantined_records(spark, sf_dir):
    _, bad = R.split(routed(spark, sf_dir))
    return source_id(R.dedupe_records(bad))


def q_repair_abs(spark, sf_dir):
    q = _quarantined_records(spark, sf_dir)
    return q.select("Id", "RunTime", abs_value("RunTime").alias("RunTimeFixed"))


def q_repair_floor(spark, sf_dir):
    q = _quarantined_records(spark, sf_dir)
    return q.select("Id", "Budget", floor_at("Budget", ORDER_BUDGET_FLOOR).alias("BudgetFixed"))


def q_schema_diff(spark, sf_dir):
    return Q.conformance(lines(spark, sf_dir), CONTRACT)


# The contract before two of the feed's fields were declared and one was text.
OLDER_CONTRACT = replace(CONTRACT, source_ddl="Id STRING, Title STRING, Budget LONG, RunTime LONG, Tagline STRING, genres STRING",
                         date_fields=(), language_fields=("Title",))


def q_contract_drift(spark, sf_dir):
    return Q.contract_drift(lines(spark, sf_dir), OLDER_CONTRACT)


# ----------------------------------------------------------------------------- stages
def _landing(spark, sf_dir) -> str:
    root = source_docs_root(spark, sf_dir)
    landing = scratch_path(spark, "landing")
    land_source(spark, f"{root}/movie_*", landing, schema=DOC_SCHEMA)
    return landing


def q_stage_land(spark, sf_dir):
    landing = _landing(spark, sf_dir)
    return view_of_struct(spark.read.parquet(landing), "movies.")


def q_stage_raw(spark, sf_dir):
    landing = _landing(spark, sf_dir)
    raw = scratch_path(spark, "raw")
    export_raw(spark, landing, raw)
    return view_parsed(S.read_text_lines(spark, raw))


def q_stage_parse(spark, sf_dir):
    store = _store(spark, "stage-parse")
    store.ingest_lines(lines(spark, sf_dir), now=FIXED_NOW)
    return view_parsed(B.read_new(store.bronze()))


def _batched_store(spark, sf_dir, tag) -> MedallionStore:
    store = _store(spark, tag)
    store.run_batch(raw_path=raw_feed_path(spark, sf_dir), now=FIXED_NOW)
    return store


def batched_store(spark, sf_dir) -> MedallionStore:
    """One batch run over the whole feed, shared by the read-only silver queries."""
    root = _cached(spark, sf_dir, "batched-store",
                   lambda p: MedallionStore(spark, p, CONTRACT).run_batch(
                       raw_path=raw_feed_path(spark, sf_dir), now=FIXED_NOW))
    return MedallionStore(spark, root, CONTRACT)


def q_silver_wide(spark, sf_dir):
    return view(batched_store(spark, sf_dir).table("silver"))


def q_silver_movie(spark, sf_dir):
    return batched_store(spark, sf_dir).table("silver_movie").select(*TYPED)


def q_silver_genre(spark, sf_dir):
    return batched_store(spark, sf_dir).table("genre")


def q_genre_dimension(spark, sf_dir):
    return batched_store(spark, sf_dir).table("genre_dim")


def q_silver_language(spark, sf_dir):
    return batched_store(spark, sf_dir).table("language")


def q_silver_bridge(spark, sf_dir):
    return batched_store(spark, sf_dir).table("bridge")


def q_run_batch(spark, sf_dir):
    store = _store(spark, "run-batch")
    ls = lines(spark, sf_dir)
    store.run_batch(raw=_first_batch(ls), now=FIXED_NOW)
    store.run_batch(raw=_second_batch(ls), now=FIXED_NOW)
    return _status_rows(store.bronze())


def q_run_batch_files(spark, sf_dir):
    """Two deliveries of raw files, compressed as the feed's are, through the history path."""
    raw, ls = scratch_path(spark, "deliveries"), lines(spark, sf_dir)
    store = _store(spark, "run-batch-files")
    for part in (_first_batch(ls), _second_batch(ls)):
        part.write.mode("append").option("compression", "gzip").text(raw)
        store.run_batch(raw_path=raw, now=FIXED_NOW)
    store.run_batch(raw_path=raw, now=FIXED_NOW)     # no new file
    return _status_rows(store.bronze())


def q_rerun_batch(spark, sf_dir):
    """The same lines twice: every silver table stays as after the first time."""
    store = _store(spark, "rerun-batch")
    for _ in range(2):
        store.run_batch(raw=lines(spark, sf_dir), now=FIXED_NOW)
    return view(store.table("silver"))


def _die_in_batch(store: MedallionStore, raw: DataFrame, batch_id: str) -> None:
    """A batch that writes its bronze rows and dies before anything else."""
    rows = B.to_bronze(raw, now=FIXED_NOW)
    store._land(store._routed(rows, repairing=False), batch_id)


def q_batch_after_crash(spark, sf_dir):
    """A dead batch that is run again with other lines, then one more that dies and is derived by the next run."""
    ls, store = lines(spark, sf_dir), _store(spark, "after-crash")
    _die_in_batch(store, ls, "one")
    store.run_batch(raw=_first_batch(ls), now=FIXED_NOW, batch_id="one")
    _die_in_batch(store, _second_batch(ls), "two")
    MedallionStore(spark, store.paths.root, CONTRACT).run_batch(now=FIXED_NOW)
    return _status_rows(store.bronze())


def q_register_store_tables(spark, sf_dir):
    """Rows of the six registered tables, after a batch that died and was derived again, and a repair."""
    store = _store(spark, "register")
    _die_in_batch(store, lines(spark, sf_dir), "one")
    store.register("silverline_store")
    store.run_repair()
    names = store.register("silverline_store")       # the same names
    counts = [f"SELECT '{n.split('.')[1]}' AS name, count(*) AS n_rows FROM {n}" for n in names]
    return spark.sql(" UNION ALL ".join(counts))


def q_run_repair(spark, sf_dir):
    store = _batched_store(spark, sf_dir, "run-repair")
    store.run_repair()
    return view(store.table("silver"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


# ============================================================================= oracles
W = feed.feed_ctes(ORDER_BUDGET_FLOOR)
V = "Id, movie_id, Title, Budget, RunTime, OriginalLanguage, ReleaseDate, n_genres"
T = "movie_id, Title, Budget, RunTime, OriginalLanguage, ReleaseDate"
REASONS = ("concat_ws(',', CASE WHEN has_more THEN 'trailing_data' END, CASE WHEN movie_id IS NULL THEN 'bad_key' END, "
           "CASE WHEN bad_nested THEN 'bad_nested' END, "
           "CASE WHEN NOT coalesce(RunTime >= 0, false) THEN 'runtime_non_negative' END, "
           f"CASE WHEN NOT coalesce(Budget >= {ORDER_BUDGET_FLOOR}, false) THEN 'budget_floor' END)")
FIRST = f"TRY_CAST(ReleaseDate AS DATE) < DATE '{SECOND_BATCH_FROM}'"
GENRES = "SELECT t.Id AS source_id, t.movie_id, p.genres_id, p.name FROM typed t JOIN order_parts p ON t.k = p.k WHERE NOT bad_nested"
BRIDGE = f"SELECT DISTINCT movie_id, genres_id FROM ({GENRES}) WHERE movie_id IS NOT NULL"
LANGUAGES = "SELECT DISTINCT Id AS source_id, movie_id, Title, OriginalLanguage FROM typed"
REPAIRED = (f"SELECT {V.replace('Budget', f'greatest(coalesce(Budget, {ORDER_BUDGET_FLOOR}), {ORDER_BUDGET_FLOOR}) AS Budget').replace('RunTime', 'abs(RunTime) AS RunTime')} "
            "FROM routed WHERE route = 'quarantined' AND movie_id IS NOT NULL AND NOT has_more AND NOT bad_nested")
STATUS_NEW_SQL = "SELECT Title, 'new' AS status FROM routed"

ORACLE: dict[str, str] = {
    "scan_multiline_json": f"{W} SELECT {V} FROM typed",
    "scan_glob_files": f"{W} SELECT {V} FROM typed",
    "scan_array_elements": f"{W} SELECT {V} FROM typed",
    "scan_text_lines": f"{W} SELECT {V} FROM typed",
    "scan_table_path": f"{W} SELECT {V} FROM typed",
    "scan_catalog_table": f"{W} SELECT {V} FROM typed",
    "sink_create_only": f"{W} SELECT {V} FROM typed",
    "sink_append_partitioned": f"{W} SELECT {V} FROM typed",
    "sink_append": f"{W} SELECT {V} FROM typed",
    "sink_batch_writer": f"{W} SELECT {V} FROM typed",
    "sink_json_lines": f"{W} SELECT {V} FROM typed",
    "register_external": f"{W} SELECT {V} FROM typed",
    "stream_ingest": f"{W} SELECT {V} FROM typed",
    "stream_dedupe": f"{W} SELECT DISTINCT {V} FROM typed",
    "explode_source_array": f"{W} SELECT {V} FROM typed",
    "explode_genres": f"{W} {GENRES}",
    "struct_star": (f"{W} SELECT f.Id, f.Title, f.Budget, f.RunTime, f.OriginalLanguage, f.ReleaseDate, "
                    "coalesce(g.n_genres, 0) AS n_genres FROM feed f LEFT JOIN genre_count g ON f.k = g.k"),
    "nested_fields": (f"{W} SELECT f.Id, f.Title, m.first_genre_id, coalesce(g.n_genres, 0) AS n_genres "
                      "FROM feed f LEFT JOIN genre_count g ON f.k = g.k "
                      "LEFT JOIN (SELECT k, min(genres_id) AS first_genre_id FROM order_parts GROUP BY k) m ON f.k = m.k"),
    "project_silver": f"{W} SELECT DISTINCT {V} FROM routed WHERE route = 'clean'",
    "drop_columns": f"{W} SELECT {T} FROM typed",
    "add_ingest_metadata": (f"{W} SELECT 'json files' AS datasource, '{FIXED_NOW}' AS ingesttime, 'new' AS status, "
                            "DATE '2024-01-01' AS p_ingestdate, Title FROM feed"),
    "stage_bronze": (f"{W} SELECT 'json files' AS datasource, '{FIXED_NOW}' AS ingesttime, 'new' AS status, "
                     "DATE '2024-01-01' AS p_ingestdate, Title FROM feed"),
    "read_new": f"{W} SELECT {V} FROM typed WHERE NOT coalesce({FIRST}, false)",
    "read_quarantined": f"{W} SELECT {V} FROM routed WHERE route = 'quarantined' AND {FIRST}",
    "split_clean": f"{W} SELECT DISTINCT {V} FROM routed WHERE route = 'clean'",
    "split_quarantine": (f"{W} SELECT Id, Budget, RunTime, {REASONS} AS reasons FROM "
                         "(SELECT DISTINCT Id, movie_id, Budget, RunTime, has_more, bad_nested FROM routed WHERE route = 'quarantined')"),
    "route_counts": f"{W} SELECT route, count(*) AS n_records FROM (SELECT DISTINCT * FROM routed) GROUP BY route",
    "reason_counts": (f"{W}, d AS (SELECT DISTINCT * FROM routed) "
                      "SELECT 'bad_key' AS reason, count(*) AS n_records FROM d WHERE movie_id IS NULL "
                      "UNION ALL SELECT 'trailing_data', count(*) FROM d WHERE has_more "
                      "UNION ALL SELECT 'bad_nested', count(*) FROM d WHERE bad_nested "
                      "UNION ALL SELECT 'runtime_non_negative', count(*) FROM d WHERE NOT coalesce(RunTime >= 0, false) "
                      f"UNION ALL SELECT 'budget_floor', count(*) FROM d WHERE NOT coalesce(Budget >= {ORDER_BUDGET_FLOOR}, false)"),
    "drop_null_rows": (f"{W} SELECT {T} FROM typed WHERE movie_id IS NOT NULL AND Title IS NOT NULL AND Budget IS NOT NULL "
                       "AND RunTime IS NOT NULL AND OriginalLanguage IS NOT NULL AND ReleaseDate IS NOT NULL"),
    "bridge_join": (f"{W} SELECT t.movie_id, p.genres_id FROM (SELECT DISTINCT movie_id, k FROM routed WHERE route = 'clean') t "
                    "JOIN order_parts p ON t.k = p.k"),
    "repair_lookup": (f"{W} SELECT r.movie_id, r.Title, o.o_totalprice AS Budget, r.RunTime, r.OriginalLanguage, r.ReleaseDate "
                      "FROM (SELECT DISTINCT * FROM routed WHERE route = 'quarantined' AND Budget IS NULL) r "
                      "JOIN orders o ON r.movie_id = o.o_orderkey"),
    "merge_status_loaded": f"{W} SELECT Title, CASE WHEN route = 'clean' THEN 'loaded' ELSE 'new' END AS status FROM routed",
    "merge_status_quarantined": f"{W} SELECT Title, CASE WHEN route = 'quarantined' THEN 'quarantined' ELSE 'new' END AS status FROM routed",
    "merge_buckets": f"{W} SELECT Title, CASE WHEN route = 'clean' THEN 'loaded' ELSE 'quarantined' END AS status FROM routed",
    "stage_status": f"{W} SELECT Title, CASE WHEN route = 'clean' THEN 'loaded' ELSE 'quarantined' END AS status FROM routed",
    "count_rows": (f"{W} SELECT count(*) AS n_rows, count(*) AS n_values, count_if(route = 'clean') AS n_clean, "
                   "count_if(route = 'quarantined') AS n_quarantined, CAST(0 AS BIGINT) AS n_unrouted FROM routed"),
    "count_non_null": (f"{W} SELECT count(*) AS n_value, count(movie_id) AS n_movie_id, count(Budget) AS n_Budget, "
                       "count(RunTime) AS n_RunTime, count(ReleaseDate) AS n_ReleaseDate FROM typed"),
    "completeness": (f"{W} SELECT count(*) AS n_rows, "
                     "count_if(movie_id IS NOT NULL AND Title IS NOT NULL AND Budget IS NOT NULL AND RunTime IS NOT NULL "
                     "AND OriginalLanguage IS NOT NULL AND ReleaseDate IS NOT NULL) AS n_complete, "
                     "count_if(movie_id IS NULL) AS null_movie_id, count_if(Title IS NULL) AS null_Title, "
                     "count_if(Budget IS NULL) AS null_Budget, count_if(RunTime IS NULL) AS null_RunTime, "
                     "count_if(OriginalLanguage IS NULL) AS null_OriginalLanguage, "
                     "count_if(ReleaseDate IS NULL) AS null_ReleaseDate FROM typed"),
    "dedupe_records": f"{W} SELECT DISTINCT {T}, route FROM routed",
    "dedupe_languages": f"{W} {LANGUAGES}",
    "bridge_dedup": f"{W} {BRIDGE}",
    "order_by_id": f"{W} SELECT DISTINCT movie_id, Title FROM routed WHERE route = 'clean'",
    "parse_json": (f"{W} SELECT Id, Title, Budget, RunTime, OriginalLanguage, ReleaseDate, false AS malformed FROM feed"),
    "parse_nested_text": (f"{W} SELECT f.Id, coalesce(g.n_genres, 0) AS n_genres, CASE WHEN f.k % 107 <> 0 THEN m.first_genre_id END AS first_genre_id, "
                          "CASE WHEN f.k % 107 <> 0 THEN m.last_genre_id END AS last_genre_id "
                          "FROM feed f LEFT JOIN genre_count g ON f.k = g.k LEFT JOIN "
                          "(SELECT k, min(genres_id) AS first_genre_id, max(genres_id) AS last_genre_id FROM order_parts GROUP BY k) m "
                          "ON f.k = m.k"),
    "cast_date": f"{W} SELECT Id, ReleaseDate AS ReleaseDateText, TRY_CAST(ReleaseDate AS DATE) AS ReleaseDate FROM feed",
    "cast_int": f"{W} SELECT Id, TRY_CAST(Id AS INTEGER) AS id_int FROM feed",
    "repair_abs": (f"{W} SELECT Id, RunTime, abs(RunTime) AS RunTimeFixed FROM "
                   "(SELECT DISTINCT Id, RunTime FROM routed WHERE route = 'quarantined')"),
    "repair_floor": (f"{W} SELECT Id, Budget, greatest(coalesce(Budget, {ORDER_BUDGET_FLOOR}), {ORDER_BUDGET_FLOOR}) "
                     "AS BudgetFixed FROM (SELECT DISTINCT Id, Budget FROM routed WHERE route = 'quarantined')"),
    "stage_land": f"{W} SELECT {V} FROM typed",
    "stage_raw": f"{W} SELECT {V} FROM typed",
    "stage_parse": f"{W} SELECT {V} FROM typed",
    "silver_wide": f"{W} SELECT DISTINCT {V} FROM routed WHERE route = 'clean'",
    "silver_movie": f"{W} SELECT DISTINCT {T} FROM routed WHERE route = 'clean'",
    "silver_genre": f"{W} SELECT DISTINCT * FROM ({GENRES})",
    "genre_dimension": f"{W} SELECT DISTINCT genres_id, name FROM ({GENRES})",
    "silver_language": f"{W} {LANGUAGES}",
    "silver_bridge": f"{W} {BRIDGE}",
    "run_batch": f"{W} SELECT Title, CASE WHEN route = 'clean' THEN 'loaded' ELSE 'quarantined' END AS status FROM routed",
    "run_repair": f"{W} SELECT DISTINCT {V} FROM routed WHERE route = 'clean' UNION ALL SELECT DISTINCT * FROM ({REPAIRED})",
    "rerun_batch": f"{W} SELECT DISTINCT {V} FROM routed WHERE route = 'clean'",
    "run_batch_files": f"{W} SELECT Title, CASE WHEN route = 'clean' THEN 'loaded' ELSE 'quarantined' END AS status FROM routed",
    "batch_after_crash": f"{W} SELECT Title, CASE WHEN route = 'clean' THEN 'loaded' ELSE 'quarantined' END AS status FROM routed",
    "fold_arrivals": f"{W} {STATUS_NEW_SQL}",
    "register_store_tables": (
        f"{W}, s AS (SELECT DISTINCT {V} FROM routed WHERE route = 'clean' UNION ALL SELECT DISTINCT * FROM ({REPAIRED})) "
        "SELECT 'bronze' AS name, count(*) AS n_rows FROM routed UNION ALL SELECT 'silver', count(*) FROM s "
        f"UNION ALL SELECT 'silver_movie', count(*) FROM s UNION ALL SELECT 'genre', count(*) FROM (SELECT DISTINCT * FROM ({GENRES})) "
        f"UNION ALL SELECT 'language', count(*) FROM ({LANGUAGES}) UNION ALL SELECT 'bridge', count(*) FROM ({BRIDGE})"),
    "contract_drift": (
        f"{W}, r AS (SELECT * FROM typed WHERE NOT has_more), "
        "e AS (SELECT * FROM (VALUES ('Id', 'STRING'), ('Title', 'STRING'), ('Budget', 'BIGINT'), ('RunTime', 'BIGINT'), ('Tagline', 'STRING'), "
        "('genres', 'ARRAY<OBJECT<id: BIGINT, name: STRING>>')) v(\"column\", expected)), "
        "f AS (SELECT 'Id' AS \"column\", 'STRING' AS found FROM r UNION ALL SELECT 'Title', 'STRING' FROM r "
        "UNION ALL SELECT 'Budget', CASE WHEN Budget < 1e7 THEN 'DECIMAL' ELSE 'DOUBLE' END FROM r WHERE Budget IS NOT NULL "
        "UNION ALL SELECT 'RunTime', 'BIGINT' FROM r UNION ALL SELECT 'OriginalLanguage', 'STRING' FROM r "
        "UNION ALL SELECT 'ReleaseDate', 'STRING' FROM r WHERE ReleaseDate IS NOT NULL "
        "UNION ALL SELECT 'genres', CASE WHEN n_genres = 0 THEN 'ARRAY<VOID>' WHEN bad_nested THEN 'ARRAY<OBJECT<id: STRING, name: STRING>>' "
        "ELSE 'ARRAY<OBJECT<id: BIGINT, name: STRING>>' END FROM r) "
        "SELECT f.\"column\", expected, found, CASE WHEN expected IS NULL THEN 'unexpected' WHEN found = expected OR found = 'ARRAY<VOID>' THEN 'none' "
        "ELSE 'type' END AS problem, count(*) AS n_lines FROM f LEFT JOIN e USING (\"column\") GROUP BY 1, 2, 3, 4 "
        "UNION ALL SELECT \"column\", expected, NULL, 'missing', (SELECT count(*) FROM r) - (SELECT count(*) FROM f WHERE f.\"column\" = e.\"column\") "
        "FROM e WHERE (SELECT count(*) FROM r) > (SELECT count(*) FROM f WHERE f.\"column\" = e.\"column\") "
        "UNION ALL SELECT '*', NULL, NULL, 'trailing_data', count(*) FROM typed WHERE has_more HAVING count(*) > 0"),
    "schema_diff": f"{W} " + " UNION ALL ".join(
        f"SELECT '{column}' AS \"column\", '{kind}' AS expected, count(*) AS n_rows, count({raw}) AS n_present, {fits} AS n_conform FROM typed"
        for column, kind, raw, fits in (
            ("movie_id", "BIGINT", "Id", "count(movie_id)"), ("Title", "STRING", "Title", "count(Title)"),
            ("Budget", "DOUBLE", "Budget", "count(Budget)"), ("RunTime", "BIGINT", "RunTime", "count(RunTime)"),
            ("OriginalLanguage", "STRING", "OriginalLanguage", "count(OriginalLanguage)"),
            ("ReleaseDate", "DATE", "ReleaseDate", "count(ReleaseDate)"), ("genres", "STRING", "*", "count_if(NOT bad_nested)"))),
}


def route_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: distinct records of the feed per route and reason (``none`` when clean)."""
    r = R.dedupe_records(routed(spark, sf_dir))
    return (r.select("route", F.explode_outer("reasons").alias("reason"))
            .select("route", F.coalesce("reason", F.lit("none")).alias("reason"))
            .groupBy("route", "reason").agg(F.count(F.lit(1)).alias("n_records")))
