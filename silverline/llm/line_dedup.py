"""Incremental line dedup: sharded cuckoo filters backed by exact reference counts.

A line's key is the line with ASCII blanks stripped at both ends and A-Z
lower-cased. The reference table holds, for every key, the number of documents
that contain it. Keys of ``min_docs`` documents or more are *common*; each
shard's cuckoo filter holds the common keys of its part of the key space.

Inserting documents raises counts, deleting them lowers counts; keys that cross
the limit enter or leave their filter. Every update writes a new version, so an
update can be repeated after a failure and undone by deleting its documents.

Cleaning runs inside the scan: the filters and the exact list of their false
positives among all stored keys are broadcast when their checked size allows;
else lines are joined with the reference table and decisions with the texts.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from silverline.llm.common import cut
from silverline.llm.cuckoo import SLOTS, CuckooFilter, probe

MIN_DOCS = 10
BUCKETS = 1024               # of one shard's filter: 4096 slots, 8 KB
SHARD_KEYS = 2048            # common keys of a shard when shards are laid out
BROADCAST_BYTES = 64 << 20   # beyond this, cleaning joins instead


def line_keys(text: bytes) -> list[bytes]:
    """Keys of all lines of a text, in order."""
    return [line.strip(b" \t\n\x0b\x0c\r").lower() for line in text.split(b"\n")]


def long_enough(key: bytes, least: int) -> bool:
    """Whether a key has that many code points."""
    return len(key) >= least and (least <= 1 or len(key.decode()) >= least)


def key_hashes(keys: list[bytes]) -> np.ndarray:
    """128-bit hashes of keys as an n x 2 array of words."""
    from hashlib import blake2b
    return np.frombuffer(b"".join(blake2b(k, digest_size=16).digest() for k in keys), np.uint64).reshape(-1, 2)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A string column as bytes, null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def _distinct_keys(batches, least: int):
    for batch in batches:
        for text in texts_of(batch, "text"):
            keys = [k for k in dict.fromkeys(line_keys(text)) if long_enough(k, least)]
            if keys:
                words = key_hashes(keys).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(words[:, 0]), pa.array(words[:, 1])], ["high", "low"])


def _joined(batches, rows: int = 100_000):
    """Small batches put together."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def count_keys(docs: DataFrame, least: int) -> DataFrame:
    """(high, low, docs): in how many documents each key occurs; counted before the shuffle as well."""
    return docs.select("text").mapInArrow(lambda batches: _joined(_distinct_keys(batches, least)), "high long, low long") \
        .groupBy("high", "low").agg(F.count(F.lit(1)).alias("docs"))


def _filter_rows(shards: int):
    def build(key, held: pd.DataFrame, crossing: pd.DataFrame) -> pd.DataFrame:
        table = np.frombuffer(held["slots"].iloc[0], np.uint16).reshape(-1, SLOTS).copy() if len(held) else None
        cuckoo = CuckooFilter(BUCKETS, table)
        fits = True
        for high, low, up in zip(crossing["high"].to_numpy().view(np.uint64), crossing["low"].to_numpy().view(np.uint64),
                                 crossing["up"], strict=True):
            fits = fits and (cuckoo.insert(int(high), int(low)) if up else cuckoo.delete(int(high), int(low)))
        return pd.DataFrame({"shard": [key[0]], "slots": [cuckoo.table.tobytes() if fits else None]})
    return build


def _shard(shards: int):
    """Shard of a key: bits of the high word above those that name the bucket."""
    return F.pmod(F.shiftright("high", 20), F.lit(shards)).cast("int")


@dataclass(frozen=True)
class LineStore:
    """One version of the counts and filters; updates return the next version."""

    spark: SparkSession
    refs: DataFrame        # high, low, docs
    filters: DataFrame     # shard, slots
    shards: int
    min_docs: int = MIN_DOCS
    least: int = 1         # code points a key needs to be counted (1: any but the empty one)

    @staticmethod
    def empty(spark: SparkSession, min_docs: int = MIN_DOCS, least: int = 1) -> LineStore:
        refs = spark.range(0).select(F.col("id").alias("high"), F.col("id").alias("low"), F.col("id").alias("docs"))
        filters = spark.range(0).select(F.col("id").cast("int").alias("shard"), F.lit(b"").alias("slots"))
        return LineStore(spark, refs, filters, 1, min_docs, least)

    def insert(self, docs: DataFrame) -> LineStore:
        """Count the documents' lines. Null texts have one empty line, which is never counted."""
        return self._update(docs, 1)

    def delete(self, docs: DataFrame) -> LineStore:
        """Undo the insertion of these documents; an error if some were never inserted."""
        return self._update(docs, -1)

    def _update(self, docs: DataFrame, sign: int) -> LineStore:
        change = count_keys(docs, self.least).select("high", "low", F.lit(0).cast("long").alias("old"),
                                                     (F.col("docs") * sign).alias("delta"))
        old = self.refs.select("high", "low", F.col("docs").alias("old"), F.lit(0).cast("long").alias("delta"))
        merged = cut(old.unionByName(change).groupBy("high", "low").agg(F.sum("old").alias("old"), F.sum("delta").alias("delta"))
                     .withColumn("docs", F.col("old") + F.col("delta")).filter("old > 0 OR delta <> 0"), "line-refs")
        if sign < 0 and not merged.filter("docs < 0").isEmpty():
            raise ValueError("lines of documents that are not in the store cannot be deleted")
        crossing = merged.filter(((F.col("old") >= self.min_docs) != (F.col("docs") >= self.min_docs))) \
                         .select("high", "low", (F.col("docs") >= self.min_docs).alias("up"))
        following = replace(self, refs=merged.filter("docs > 0").select("high", "low", "docs"))
        if self.shards > 1 or not self.filters.isEmpty():
            built = self._build(self.filters, crossing, self.shards)
            if built is not None:
                return replace(following, filters=built)
        return following._lay_out()

    def _build(self, held: DataFrame, crossing: DataFrame, shards: int) -> DataFrame | None:
        keyed = crossing.withColumn("shard", _shard(shards))
        built = cut(held.groupBy("shard").cogroup(keyed.groupBy("shard"))
                    .applyInPandas(_filter_rows(shards), "shard int, slots binary"), "line-filters")
        return None if not built.filter("slots IS NULL").isEmpty() else built

    def _lay_out(self) -> LineStore:
        """Filters from the exact table, with as many shards as the common keys need."""
        common = self.refs.filter(F.col("docs") >= self.min_docs).select("high", "low", F.lit(True).alias("up"))
        shards = 1 << max(0, (common.count() - 1).bit_length() - (SHARD_KEYS - 1).bit_length())
        while (built := self._build(LineStore.empty(self.spark).filters, common, shards)) is None:
            shards *= 2
        return replace(self, filters=built, shards=shards)

    def clean(self, docs: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """``docs`` (which must be in the store) with n_lines, n_dropped and kept.

        kept: the lines whose key is not common, joined by a line feed (empty if
        none is left). Null text: one empty line, kept. Columns of ``docs`` that
        bear one of these names are replaced. Repeated rows each stay a row.
        """
        names = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept", "_lines")]
        docs = docs.select(*names)
        size = self.filters.count() * BUCKETS * SLOTS * 2
        if size <= broadcast_bytes:
            tables = self._tables()
            at = self.spark.sparkContext.broadcast(tables)
            rare = self.refs.filter(F.col("docs") < self.min_docs).select("high", "low")
            false = cut(rare.mapInArrow(partial(_positives, at), "high long, low long"), "line-false")
            if size + 16 * false.count() <= broadcast_bytes:
                listed = false.toPandas()
                spared = np.sort(_pairs(listed["high"].to_numpy(np.int64).view(np.uint64),
                                        listed["low"].to_numpy(np.int64).view(np.uint64)))
                both = self.spark.sparkContext.broadcast((tables, spared))
                schema = _result_schema(docs)
                return docs.mapInArrow(partial(_drop_in_scan, both, self.least), schema)
        return self._clean_by_join(docs, names)

    def _tables(self) -> np.ndarray:
        tables = np.zeros((self.shards, BUCKETS, SLOTS), np.uint16)
        for row in self.filters.toLocalIterator():
            tables[row["shard"]] = np.frombuffer(bytes(row["slots"]), np.uint16).reshape(BUCKETS, SLOTS)
        return tables

    def _clean_by_join(self, docs: DataFrame, names: list[str]) -> DataFrame:
        """Decisions depend on the text alone, so they are joined by the text's digest."""
        digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
        lines = docs.select(digest.alias("_digest"), "text").dropDuplicates(["_digest"]) \
            .mapInArrow(partial(_lines_of_texts, self.least), "_digest string, high long, low long")
        common = self.refs.filter(F.col("docs") >= self.min_docs).select("high", "low")
        found = lines.join(common, ["high", "low"]).groupBy("_digest") \
            .agg(F.collect_list(F.struct("high", "low")).alias("_lines"))
        schema = _result_schema(docs)
        return docs.withColumn("_digest", digest).join(found, "_digest", "left").select(*names, "_lines") \
                   .mapInArrow(_drop_listed, schema)


def _result_schema(docs: DataFrame) -> StructType:
    return StructType([*docs.schema.fields, StructField("n_lines", LongType()), StructField("n_dropped", LongType()),
                       StructField("kept", StringType())])


def _pairs(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    out = np.empty(len(high), [("high", np.uint64), ("low", np.uint64)])
    out["high"], out["low"] = high, low
    return out


def shard_of(high: np.ndarray, shards: int) -> np.ndarray:
    return np.mod(high.view(np.int64) >> 20, shards)


def _positives(at, batches):
    tables = at.value
    for batch in batches:
        high, low = (batch.column(c).to_numpy().view(np.uint64) for c in ("high", "low"))
        yield batch.filter(pa.array(probe(tables, shard_of(high, len(tables)), high, low)))


def _with_result(batch: pa.RecordBatch, columns: list[str], n_lines, n_dropped, kept) -> pa.RecordBatch:
    arrays = [batch.column(c) for c in columns]
    return pa.RecordBatch.from_arrays(
        [*arrays, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
        [*columns, "n_lines", "n_dropped", "kept"])


def _drop_in_scan(both, least: int, batches):
    tables, spared = both.value
    for batch in batches:
        texts = texts_of(batch, "text")
        keys = [line_keys(t) for t in texts]
        flat = [k for ks in keys for k in ks]
        words = key_hashes(flat)
        high, low = words[:, 0].copy(), words[:, 1].copy()
        drop = probe(tables, shard_of(high, len(tables)), high, low) & np.fromiter((long_enough(k, least) for k in flat), bool, len(flat))
        hits = np.flatnonzero(drop)
        if len(spared) and len(hits):
            drop[hits] = ~np.isin(_pairs(high[hits], low[hits]), spared)
        at, n_lines, n_dropped, kept = 0, [], [], []
        for text, ks in zip(texts, keys, strict=True):
            gone = drop[at:at + len(ks)]
            at += len(ks)
            dropped = int(gone.sum())
            n_lines.append(len(ks))
            n_dropped.append(dropped)
            kept.append(b"\n".join(x for x, g in zip(text.split(b"\n"), gone, strict=True) if not g) if dropped else text)
        yield _with_result(batch, batch.schema.names, n_lines, n_dropped, kept)


def _lines_of_texts(least: int, batches):
    for batch in batches:
        for digest, text in zip(batch.column("_digest").to_pylist(), texts_of(batch, "text"), strict=True):
            keys = [k for k in dict.fromkeys(line_keys(text)) if long_enough(k, least)]
            if keys:
                words = key_hashes(keys).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([digest] * len(keys)), pa.array(words[:, 0]), pa.array(words[:, 1])],
                                                 ["_digest", "high", "low"])


def _drop_listed(batches):
    for batch in batches:
        columns = [c for c in batch.schema.names if c != "_lines"]
        n_lines, n_dropped, kept = [], [], []
        for text, listed in zip(texts_of(batch, "text"), batch.column("_lines").to_pylist(), strict=True):
            common = {(x["high"], x["low"]) for x in listed or ()}
            keys = line_keys(text)
            gone = [tuple(w) in common for w in key_hashes(keys).view(np.int64).tolist()] if common else [False] * len(keys)
            n_lines.append(len(keys))
            n_dropped.append(sum(gone))
            kept.append(b"\n".join(x for x, g in zip(text.split(b"\n"), gone, strict=True) if not g))
        yield _with_result(batch, columns, n_lines, n_dropped, kept)


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept of every document, all documents inserted first.

    A document is a row: a document that is there ten times has each of its keys in ten documents.
    """
    slim = docs.select("doc_id", "text")
    store = LineStore.empty(docs.sparkSession, min_docs).insert(slim)
    return store.clean(slim).drop("text")


LINES_SQL = f"""
WITH n AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
l AS (
  SELECT doc_id, r, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, r, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
        FROM (SELECT doc_id, r, string_split(text, chr(10)) AS ls FROM n))),
c AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= {MIN_DOCS})
SELECT any_value(l.doc_id) AS doc_id, count(*) AS n_lines, count(c.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.k IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN c ON l.k = c.k GROUP BY l.r
"""
