"""Mixing sources to target weights by hash-random order and prefix sums.

Each row gets a hash-random key. Rows are ordered by that key within their
source; the running sum of words says where the source's budget ends. The sum
is built in two levels: ranges of the key (a fixed number per source) are
added up first, then rows within a range, so that no task sorts a source.
Equal rows are counted before, as they may take each other's place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverline.llm.common import WORD_PATTERN, cut, hash60

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
KEY_RANGES_LOG2 = 12
RUN_ROWS = 1 << 16       # equal rows that one task deals out at a time


def word_count(text) -> F.Column:
    """Number of words, null counting as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """Target of every source: (source, source_size) in, (source, source_size, target) out.

    Sources by code point, null last, take the weights in turn. Together they
    get ``share`` times all sizes; a source stops at ``most`` times its size and
    the excess goes to the others by weight. In order of size per weight, a
    source stops if its limit is within its part of what the ones before left.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    ranked = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)) \
        .withColumn("cap", F.col("source_size") * most) \
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(share)) \
        .withColumn("w_all", F.sum("w").over(everything))
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()) \
                   .rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0))) \
                   .withColumn("w_before", F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    level = (F.col("total") - F.col("cap_before")) / (F.col("w_all") - F.col("w_before"))
    ranked = ranked.withColumn("stops", F.col("cap") / F.col("w") <= level)
    rest = F.col("total") - F.sum(F.when(F.col("stops"), F.col("cap")).otherwise(0)).over(everything)
    weight = F.sum(F.when(F.col("stops"), 0.0).otherwise(F.col("w"))).over(everything)
    return ranked.withColumn("target", F.when(F.col("stops"), F.col("cap").cast("double"))
                             .otherwise(F.col("w") * (rest / weight))) \
                 .select("source", "source_size", "target")


def _budgets(rows: DataFrame, key, ties: tuple[str, ...], weights=WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> tuple[DataFrame, int]:
    """Groups of equal rows (with source and size) with _n, _key, source_size, target, _epochs and _left; and the largest _n.

    ``_left`` are the words of the budget beyond whole epochs that are left when
    the group's turn comes. Equal rows are one group, however many they are.
    """
    columns = rows.columns
    keyed = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).withColumn("_key", key) \
        .withColumn("_range", F.shiftright("_key", 60 - KEY_RANGES_LOG2).cast("int")).withColumn("_words", F.col("size") * F.col("_n"))
    keyed = cut(keyed, "mix-groups")
    largest = keyed.agg(F.max("_n").alias("n")).first()["n"] or 0
    ranges = keyed.groupBy("source", "_range").agg(F.sum("_words").alias("_words"))
    in_source = Window.partitionBy("source").orderBy("_range")
    offsets = ranges.withColumn("_offset", F.sum("_words").over(in_source) - F.col("_words"))
    goals = targets(ranges.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, share, most)
    # the null source joins as any other; the table of ranges has a bounded number of rows a source
    plan = offsets.alias("o").join(goals.alias("g"), F.col("o.source").eqNullSafe(F.col("g.source"))) \
        .select(F.col("o.source").alias("_source"), F.col("_range").alias("_at"), "_offset", "source_size", "target")
    in_range = Window.partitionBy("source", "_range").orderBy("_key", *[F.col(c).asc_nulls_first() for c in (*ties, *columns)]) \
                     .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = keyed.withColumn("_inner", F.sum("_words").over(in_range) - F.col("_words"))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    left = F.floor(F.col("target") - F.col("_epochs") * F.col("source_size")).cast("long") - F.col("_offset") - F.col("_inner")
    groups = summed.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_at"))) \
        .withColumn("_epochs", full).withColumn("_left", left)
    return groups, largest


def _one_by_one(groups: DataFrame, count: str, largest: int) -> DataFrame:
    """Every group as often as ``count`` says, with ``_turn`` from 0; large groups are spread over tasks before they are dealt out."""
    dealt = groups.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / RUN_ROWS))))
    last = F.least(F.col(count), (F.col("_run") + 1) * RUN_ROWS) - 1
    if largest > RUN_ROWS:
        dealt = dealt.repartition("_key", "_run")
    return dealt.withColumn("_turn", F.explode(F.sequence(F.col("_run") * RUN_ROWS, last)))


def mix(rows: DataFrame, **options) -> DataFrame:
    """``rows`` (doc_id, source, size) with source_size, target and taken.

    A source is read ``floor(target / source_size)`` times in full and then in
    key order until the budget is spent; the row at the cut gives the words
    still missing. ``rows`` should be slim.
    """
    groups, largest = _budgets(rows, hash60(F.col("doc_id")), ("doc_id", "size"), **options)
    turns = _one_by_one(groups, "_n", largest)
    left = F.col("_left") - F.col("_turn") * F.col("size")
    return turns.withColumn("taken", F.col("_epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))) \
        .select(*rows.columns, "source_size", "target", "taken")


def sizes_of(docs: DataFrame) -> DataFrame:
    """doc_id, source and number of words of each document, written once."""
    return cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """What the mix takes of every document: doc_id, size, source_size, target, taken.

    Null or empty texts have size 0 and nothing of them is taken. A source of
    size 0 has target 0. Repeated rows count each; ties in the random key are
    ordered by doc_id. Only doc_id, source and text of ``docs`` are used.
    """
    return mix(sizes_of(docs), **options).select("doc_id", "size", "source_size", "target", "taken")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: a row for every time a document is read, all columns kept.

    Rows that share a doc_id are read in the order of a hash of all their columns,
    rows without one in the order of that hash alone; equal rows are counted, and
    the budget may end among them. The row at a source's cut is
    read whole if at least half of it is within the budget. Documents without
    words are not read. The table of cuts has a row for each source; it is
    written first, so that its size is known and Spark need not shuffle the
    texts to join it when it is small.
    """
    key = F.when(F.col("doc_id").isNull(), hash60(F.col("doc_id"), F.col("_row"))).otherwise(hash60(F.col("doc_id")))
    place = F.struct("_key", "_row")
    told = docs.withColumn("_row", F.xxhash64(*docs.columns))
    sizes = told.select("doc_id", "source", "_row", word_count(F.col("text")).alias("size"))
    groups, largest = _budgets(sizes, key, ("_row",), **options)
    more = F.greatest(F.lit(0), F.least(F.col("_n"), F.floor(F.try_divide(F.col("_left"), F.col("size")) + 0.5))).cast("long")
    groups = groups.withColumn("_more", F.when(F.col("size") > 0, more).otherwise(0))
    cuts = groups.groupBy(F.col("source").alias("_source")).agg(
        F.max("_epochs").cast("int").alias("_epochs"), F.max(F.when((F.col("_more") == F.col("_n")) & (F.col("size") > 0), place)).alias("_last"),
        F.max(F.when((F.col("_more") > 0) & (F.col("_more") < F.col("_n")), F.struct(place.alias("place"), "_more"))).alias("_part"))
    cuts = cut(cuts, "mix-cuts")
    rows = told.filter(F.col("text").rlike(WORD_PATTERN)).withColumn("_key", key) \
        .join(cuts, F.col("source").eqNullSafe(F.col("_source")))
    copies = F.col("_epochs") + F.when(place <= F.col("_last"), 1).otherwise(0)
    out = rows.withColumn("_copies", copies).filter("_copies > 0") \
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)
    if cuts.filter("_part IS NOT NULL").isEmpty():
        return out
    # where the budget ends among equal rows, one of them is read as often as is still due
    part = rows.filter(place == F.col("_part.place")).dropDuplicates(["_key", "_row"]).withColumn("_more", F.col("_part._more"))
    return out.unionByName(_one_by_one(part, "_more", largest).select(*docs.columns))


MIX_SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), chr(30))), 1, 15) AS BIGINT) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, source_size * {MOST_EPOCHS} AS cap, CAST(sum(source_size) OVER () AS DOUBLE) * {SHARE} AS total,
         sum(w) OVER () AS w_all
  FROM (SELECT *, CAST(([3, 1, 2])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w FROM s)),
b AS (
  SELECT *, coalesce(sum(cap) OVER f, 0) AS cap_before, coalesce(sum(w) OVER f, 0.0) AS w_before FROM r
  WINDOW f AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, cap / w <= (total - CAST(cap_before AS DOUBLE)) / (w_all - w_before) AS stops FROM b),
t AS (
  SELECT source, source_size,
         CASE WHEN stops THEN CAST(cap AS DOUBLE)
              ELSE w * ((total - CAST(sum(CASE WHEN stops THEN cap ELSE 0 END) OVER () AS DOUBLE))
                        / sum(CASE WHEN stops THEN 0.0 ELSE w END) OVER ()) END AS target
  FROM c),
p AS (
  SELECT doc_id, size, source_size, target,
         CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS epochs,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       epochs * size + greatest(0, least(size, CAST(floor(target - epochs * source_size) AS BIGINT) - before)) AS taken
FROM p
"""
