"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has the sign of each of its components. Codes are cut into m
segments; an index holds every distinct code under each of its segments. A
search probes, for s = 0, 1, 2, ..., the segment values at Hamming distance s
from the query's. After step s every code within m (s + 1) - 1 of the query has
been met, since one of its segments is within s; a query is done once its k-th
verified distance is within that, which makes its result exact.

Equal codes are one entry, for queries as well, so copies cost nothing. Each
index chunk passes on its k best codes of a query, never its candidates. Codes
that agree on a segment share a chunk; a chunk of too many is cut into salted
parts, and queries go to all of them.
"""

from __future__ import annotations

import math
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverline.llm.common import cut

K = 10
QUERY_STEP = 50              # ids divisible by this are the queries
CHUNK_CODES = 1 << 16        # index entries of a chunk, about
LEAST_BITS, MOST_BITS = 8, 24


def _encode(bits: int, batches):
    for batch in batches:
        keep = [i for i, v in enumerate(batch.column(1).is_valid().to_pylist()) if v]
        signs = np.zeros((len(keep), -(-bits // 64) * 64), np.uint8)
        for row, i in enumerate(keep):
            values = np.array(batch.column(1)[i].as_py(), np.float64)
            signs[row, :len(values)] = values > 0          # nulls and missing components count as not positive
        packed = np.packbits(signs, axis=1)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())),
                                          pa.array([p.tobytes() for p in packed], pa.binary())], ["id", "code"])


def segments(bits: int, entries: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments: about log2(entries) bits each."""
    width = min(max(round(math.log2(max(entries, 2))), LEAST_BITS), MOST_BITS)
    m = max(1, bits // width)
    cuts = [bits * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def code_matrix(codes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1) if codes else np.zeros((0, 8), np.uint8)


def segment_keys(codes: np.ndarray, first: int, width: int) -> np.ndarray:
    """The segment of each code as a number."""
    low, high = first // 8, -(-(first + width) // 8)
    value = np.zeros(len(codes), np.int64)
    for byte in range(low, high):
        value = value << 8 | codes[:, byte]
    return value >> (8 * high - first - width) & ((1 << width) - 1)


def masks(width: int, weight: int) -> np.ndarray:
    """All numbers of ``width`` bits with ``weight`` of them set."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), weight)], np.int64)


def _chunk_bits(entries: int, width: int) -> int:
    return min(width, max(0, math.ceil(math.log2(max(entries, 1) / CHUNK_CODES)))) if entries else 0


def _chunk_flips(width: int, shift: int, step: int) -> np.ndarray:
    """What ``step`` flips of a segment's bits can do to its leading ones: any up to ``step`` flips that leave enough for the rest."""
    leading = width - shift
    return np.concatenate([masks(leading, n) for n in range(max(0, step - shift), min(step, leading) + 1)])


def _index(parts: list, entries: int, batches):
    for batch in batches:
        codes = code_matrix(batch.column(0).to_pylist())
        for j, (first, width) in enumerate(parts):
            chunk = segment_keys(codes, first, width) >> (width - _chunk_bits(entries, width))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), j), pa.int32()), pa.array(chunk), batch.column(0),
                                              batch.column(1)], ["segment", "chunk", "code", "id"])


def _route(parts: list, entries: int, step: int, batches):
    """Each query to the chunks that hold segment values at distance ``step``."""
    for batch in batches:
        queries = batch.column(0).to_pylist()
        codes = code_matrix(queries)
        for j, (first, width) in enumerate(parts):
            if step > width:
                continue
            shift = width - _chunk_bits(entries, width)
            keys, flips = segment_keys(codes, first, width), _chunk_flips(width, shift, step)
            chunk = (keys >> shift)[:, None] ^ flips
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(chunk.size, j), pa.int32()), pa.array(chunk.ravel()),
                 pa.array(np.repeat(np.array(queries, object), len(flips)), pa.binary())], ["segment", "chunk", "query"])


_FOUND = "query binary, code binary, id long, distance int"


def _search(parts: list, step: int, k: int, index: pa.Table, probes: pa.Table) -> pa.Table:
    """The k best codes of each query among those of this chunk whose segment is at distance ``step``."""
    names = [f.split()[0] for f in _FOUND.split(", ")]
    out: list[list] = [[], [], [], []]
    if len(index) and len(probes):
        first, width = parts[index.column("segment")[0].as_py()]
        codes, ids = index.column("code").to_pylist(), index.column("id").to_numpy()
        matrix = code_matrix(codes)
        keys = segment_keys(matrix, first, width)
        order = np.argsort(keys, kind="stable")
        matrix, ids, sorted_keys = matrix[order], ids[order], keys[order]
        words = np.ascontiguousarray(matrix).view(np.uint64)
        held, begin = np.unique(sorted_keys, return_index=True)
        end = np.append(begin[1:], len(sorted_keys))
        # where probes outnumber the values held, the values are compared instead
        listed = math.comb(width, step) <= len(held)
        flips = masks(width, step) if listed else None
        queries = probes.column("query").to_pylist()
        asked = code_matrix(queries)
        for query, key, code in zip(queries, segment_keys(asked, first, width), np.ascontiguousarray(asked).view(np.uint64), strict=True):
            if listed:
                probe = flips ^ key
                at = np.searchsorted(held, probe)
                hit = at[(at < len(held)) & (held[np.minimum(at, len(held) - 1)] == probe)]
            else:
                hit = np.flatnonzero(np.bitwise_count(held ^ key) == step)
            n = end[hit] - begin[hit]
            if not len(n):
                continue
            rows = np.repeat(begin[hit] - np.cumsum(n) + n, n) + np.arange(n.sum())
            distance = np.bitwise_count(words[rows] ^ code).sum(1)
            best = np.lexsort((ids[rows], distance))[:k]
            out[0] += [query] * len(best)
            out[1] += [codes[order[r]] for r in rows[best]]
            out[2] += ids[rows[best]].tolist()
            out[3] += distance[best].tolist()
    kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int32())
    return pa.table([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], names)


def _bits_of(vectors: DataFrame) -> int:
    return vectors.agg(F.max(F.size("embedding")).alias("b")).first()["b"] or 0


def top_k(vectors: DataFrame, k: int = K, query_step: int = QUERY_STEP) -> DataFrame:
    """(query_id, rank, neighbour_id, distance): the k nearest rows of every query row by Hamming distance.

    Queries are the rows whose vec_id is divisible by ``query_step``; all rows
    are searched, the query's own included. Ties go to the smaller vec_id. A
    null embedding has no code and is neither asked nor found; a null vec_id is
    not found; a shorter or null component counts as not positive; with fewer
    than k rows all are returned. Repeated rows are ranked each.
    """
    bits = max(_bits_of(vectors), 1)
    codes = cut(vectors.select(F.col("vec_id").alias("id"), "embedding").filter("vec_id IS NOT NULL")
                .mapInArrow(partial(_encode, bits), "id long, code binary"), "codes")
    # the k least ids of a code are all of it that a result can hold; groups are limited before the shuffle too
    by_code = Window.partitionBy("code").orderBy("id")
    held = cut(codes.withColumn("n", F.row_number().over(by_code)).filter(F.col("n") <= k), "codes-held")
    entries = held.filter("n = 1").select("code", "id")
    size = entries.count()
    parts = segments(bits, size)
    rows = entries.mapInArrow(partial(_index, parts, size), "segment int, chunk long, code binary, id long")
    # chunks that many codes share: there are no more than codes fill, each counted once per segment
    large = cut(rows.groupBy("segment", "chunk").agg(F.ceil(F.count(F.lit(1)) / CHUNK_CODES).cast("int").alias("salts")).filter("salts > 1"), "code-chunks")
    salts = F.coalesce(F.col("salts"), F.lit(1))
    index = cut(rows.join(large, ["segment", "chunk"], "left").withColumn("salt", F.pmod(F.xxhash64("code"), salts).cast("int")).drop("salts"), "code-index")
    asked = cut(codes.filter(F.col("id") % query_step == 0).select(F.col("code").alias("query")).distinct(), "code-queries")
    best, open_queries, step, covered = None, asked, 0, -1
    per_query = Window.partitionBy("query").orderBy("distance", "id")
    while step <= max(width for _, width in parts) and not open_queries.isEmpty():
        probes = open_queries.mapInArrow(partial(_route, parts, size, step), "segment int, chunk long, query binary")
        probes = probes.join(large, ["segment", "chunk"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
        key = ["segment", "chunk", "salt"]
        found = index.groupBy(*key).cogroup(probes.groupBy(*key)) \
            .applyInArrow(partial(_search, parts, step, k), _FOUND)
        merged = found if best is None else best.unionByName(found)
        best = cut(merged.distinct().withColumn("n", F.row_number().over(per_query)).filter(F.col("n") <= k).drop("n"), "codes-best")
        covered = len(parts) * (step + 1) - 1
        done = best.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far")) \
            .filter((F.col("n") >= k) & (F.col("far") <= covered)).select("query")
        open_queries = cut(asked.join(done, "query", "left_anti"), "codes-open")
        step += 1
    if best is None:
        best = vectors.sparkSession.createDataFrame([], _FOUND)
    rows = best.select("query", "code", "distance").join(held.select("code", F.col("id").alias("neighbour_id")), "code")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("distance", "neighbour_id"))) \
        .filter(F.col("rank") <= k).drop("code")
    return codes.filter(F.col("id") % query_step == 0).select(F.col("id").alias("query_id"), F.col("code").alias("query")) \
        .join(ranked, "query").select("query_id", "rank", "neighbour_id", "distance")


SEARCH_SQL = f"""
WITH c AS (
  SELECT vec_id, [coalesce(x, 0) > 0 FOR x IN embedding] AS code FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
d AS (
  SELECT q.vec_id AS query_id, c.vec_id AS neighbour_id,
         CAST(len([z FOR z IN list_zip(q.code, c.code) IF z[1] <> z[2]]) AS INT) AS distance
  FROM (SELECT * FROM c WHERE vec_id % {QUERY_STEP} = 0) q, c),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INT) AS rank FROM d)
SELECT query_id, rank, neighbour_id, distance FROM r WHERE rank <= {K}
"""
