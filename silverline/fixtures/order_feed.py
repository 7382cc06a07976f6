"""The dirty order feed: movie-shaped JSON records derived from the TPC-H style tables.

An order stands for a movie (see FIXTURES.md): ``Id`` is the order key as text
(``bad-<key>`` when ``key % 101 = 0``), ``Budget`` the order total (missing when
``key % 97 = 0``), ``RunTime`` the customer's balance floored, ``genres`` the
distinct parts of the order's line items sorted by id. Records with
``key % 10 = 0`` are emitted twice; ``ReleaseDate`` is missing when
``key % 109 = 0``. In the JSON lines a second object follows the record when
``key % 103 = 0``, and the ids in ``genres`` are quoted when ``key % 107 = 0``.
These modulo rules *add* dirt to the whole tables; nothing is left out.

Everything is a Spark job over the full tables: one shuffle for
orders ⨝ customer, one for lineitem ⨝ part and one to collect each order's
parts (partial aggregation runs before that shuffle, unless the line items ask
for more partitions than the session's; then rows are dealt first).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import partitions_for

GENRE_DDL = "ARRAY<STRUCT<id: BIGINT, name: STRING>>"
RECORD_FIELDS = ["Id", "Title", "Budget", "RunTime", "OriginalLanguage", "ReleaseDate", "genres"]
# Keys per multi-line source document: documents are bounded by construction.
KEYS_PER_DOCUMENT = 4096


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dealt(partitions: int | None) -> Callable[[DataFrame, str], DataFrame]:
    """A frame dealt by a column into so many partitions, or left to the session's setting."""
    return lambda df, column: df if partitions is None else df.repartition(partitions, column)


def order_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, genres_id, name): distinct parts of each order's line items."""
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return (li.join(part, li.l_partkey == part.p_partkey)
            .select(F.col("l_orderkey").alias("k"), F.col("p_partkey").alias("genres_id"),
                    F.col("p_name").alias("name"))
            .dropDuplicates())


def feed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per emitted record: ``k``, ``copy`` and the record fields (``genres`` as array)."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    # Sorted rows of a task stay in memory at any size of the tables: the shuffles
    # get more partitions than the session's where the line items ask for them.
    dealt = _dealt(partitions_for(spark, li.count()))
    # collect_set dedupes (id, name); array_sort orders each list by id.
    genres = (dealt(dealt(li, "l_partkey").join(dealt(part, "p_partkey"), F.col("l_partkey") == F.col("p_partkey")), "l_orderkey")
              .groupBy(F.col("l_orderkey").alias("k"))
              .agg(F.array_sort(F.collect_set(F.struct(F.col("p_partkey").alias("id"),
                                                       F.col("p_name").alias("name")))).alias("genres")))
    k = F.col("o_orderkey")
    base = (dealt(orders.join(customer, orders.o_custkey == customer.c_custkey), "o_orderkey")
            .join(genres, k == genres.k, "left")
            .select(
                k.alias("k"),
                F.when(k % 101 == 0, F.concat(F.lit("bad-"), k.cast("string")))
                 .otherwise(k.cast("string")).alias("Id"),
                F.concat(F.lit("Order "), k.cast("string")).alias("Title"),
                F.when(k % 97 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("Budget"),
                F.floor("c_acctbal").cast("bigint").alias("RunTime"),
                F.col("o_orderpriority").alias("OriginalLanguage"),
                F.when(k % 109 != 0, F.col("o_orderdate").cast("date").cast("string")).alias("ReleaseDate"),
                F.coalesce(F.col("genres"), F.array().cast(GENRE_DDL)).alias("genres")))
    copies = F.when(F.col("k") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return base.withColumn("copy", F.explode(copies))


def feed_lines(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """The raw JSON lines (``value``), one per emitted record; ``k`` kept on request."""
    rec = feed_records(spark, sf_dir)
    text = F.to_json(F.struct(*RECORD_FIELDS))
    text = F.when(F.col("k") % 107 == 0, F.regexp_replace(text, r'"id":(\d+)', '"id":"$1"')).otherwise(text)
    value = F.when(F.col("k") % 103 == 0, F.concat(text, F.lit('{"Id":"second"}'))).otherwise(text).alias("value")
    return rec.select("k", value) if with_key else rec.select(value)


def feed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-line source documents ``{"movie": [...]}``: ``doc_id`` and ``doc`` text.

    Records are grouped by key range, so each document holds at most
    ``KEYS_PER_DOCUMENT`` keys (twice that many records) at any scale.
    """
    rec = feed_records(spark, sf_dir)
    doc_id = F.floor(F.col("k") / KEYS_PER_DOCUMENT).cast("bigint")
    dealt = _dealt(partitions_for(spark, _table(spark, sf_dir, "lineitem").count()))
    return (dealt(rec.select(doc_id.alias("doc_id"), F.struct(*RECORD_FIELDS).alias("m")), "doc_id")
            .groupBy("doc_id").agg(F.collect_list("m").alias("movie"))
            .select("doc_id", F.to_json(F.struct("movie")).alias("doc")))


def write_documents(docs: DataFrame, path: str) -> str:
    """Write one document per file: ``path/doc_id=<n>/part-*.txt`` (one line each).

    A row is a document, so it is a file whichever task writes it."""
    docs.write.mode("errorifexists").partitionBy("doc_id").text(path)
    return path


def copy_documents(spark: SparkSession, source: str, path: str) -> str:
    """The documents below ``source`` once more, compressed; nothing is derived or shuffled again."""
    docs = spark.read.schema("value STRING, doc_id BIGINT").option("wholetext", True).text(source)
    (docs.select(F.regexp_replace("value", r"\n$", "").alias("value"), "doc_id")
     .write.mode("errorifexists").option("compression", "gzip").partitionBy("doc_id").text(path))
    return path


# --- SQL twin (DuckDB and Spark SQL both accept it) -------------------------------
ORDER_PARTS_SQL = """
  SELECT DISTINCT l.l_orderkey AS k, p.p_partkey AS genres_id, p.p_name AS name
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""

FEED_BASE_SQL = """
  SELECT o_orderkey AS k,
         CASE WHEN o_orderkey % 101 = 0 THEN concat('bad-', CAST(o_orderkey AS STRING))
              ELSE CAST(o_orderkey AS STRING) END                      AS Id,
         concat('Order ', CAST(o_orderkey AS STRING))                  AS Title,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END AS Budget,
         CAST(floor(c_acctbal) AS BIGINT)                              AS RunTime,
         o_orderpriority                                               AS OriginalLanguage,
         CASE WHEN o_orderkey % 109 <> 0
              THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END       AS ReleaseDate
  FROM orders JOIN customer ON o_custkey = c_custkey"""


def feed_ctes(budget_floor: int = 100_000) -> str:
    """``WITH`` clause naming ``order_parts``, ``base``, ``feed`` (with duplicates),
    ``typed`` (typed fields and dirt of every emitted line), ``routed`` and ``genre_count``."""
    return f"""WITH order_parts AS ({ORDER_PARTS_SQL}),
base AS ({FEED_BASE_SQL}),
feed AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE k % 10 = 0),
genre_count AS (SELECT k, count(*) AS n_genres FROM order_parts GROUP BY k),
typed AS (
  SELECT f.k, f.Id, TRY_CAST(f.Id AS BIGINT) AS movie_id, f.Title, f.Budget, f.RunTime,
         f.OriginalLanguage, TRY_CAST(f.ReleaseDate AS DATE) AS ReleaseDate,
         coalesce(g.n_genres, 0) AS n_genres, f.k % 103 = 0 AS has_more,
         f.k % 107 = 0 AND coalesce(g.n_genres, 0) > 0 AS bad_nested
  FROM feed f LEFT JOIN genre_count g ON f.k = g.k),
routed AS (
  SELECT *,
         CASE WHEN movie_id IS NOT NULL AND NOT has_more AND NOT bad_nested
                   AND RunTime >= 0 AND Budget >= {budget_floor}
              THEN 'clean' ELSE 'quarantined' END AS route
  FROM typed)
"""
