"""Consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of cells. Every shard owns several virtual nodes,
each in the cell its hash names; a row hashes to a cell and belongs to the
first virtual node clockwise of it. No shard takes more than its capacity:
rows that overflow a full shard go on clockwise to the next shard with room.

Rows are placed from counts per cell alone (a table no larger than the ring),
so the only shuffle of rows is the ranking within cells. With ``slack`` 0 the
capacities add up to the number of rows and shard sizes differ by one at most;
a positive slack trades balance for fewer moves when shards are added.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverline.llm.common import cut, utf8_length

RING_CELLS = 4096
VIRTUAL_NODES = 64


def _cell_of(shard: int, node: int, cells: int) -> int:
    return int(hashlib.md5(f"{shard}/{node}".encode()).hexdigest()[:15], 16) % cells


def clockwise(shards: int, virtual_nodes: int = VIRTUAL_NODES, cells: int = RING_CELLS) -> list[list[int]]:
    """For every cell, the distinct shards met when walking clockwise from it."""
    at: list[list[int]] = [[] for _ in range(cells)]
    for shard in range(shards):
        for node in range(virtual_nodes):
            at[_cell_of(shard, node, cells)].append(shard)
    walk: list[list[int]] = [[] for _ in range(cells)]
    behind: list[int] = []
    for cell in range(2 * cells - 1, -1, -1):      # the second lap closes the ring
        here = list(dict.fromkeys(at[cell % cells]))
        if here:
            behind = here + [s for s in behind if s not in here]
        walk[cell % cells] = behind
    return walk


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Most rows of each shard; they always add up to ``rows`` or more."""
    if slack > 0:
        return [-int(-rows * (1 + slack) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def flows(counts: dict[int, int], shards: int, virtual_nodes: int = VIRTUAL_NODES,
          cells: int = RING_CELLS, slack: float = 0.0) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, end rank, shard, first slot): where the rows of each cell go.

    In round r every cell offers what it has left to its r-th shard clockwise;
    a shard takes from the cells in ring order until it is full.
    """
    walk = clockwise(shards, virtual_nodes, cells)
    room = capacities(sum(counts.values()), shards, slack)
    used, done, out = [0] * shards, dict.fromkeys(counts, 0), []
    for step in range(shards):
        for cell in sorted(counts):
            left = counts[cell] - done[cell]
            if left and step < len(walk[cell]):
                shard = walk[cell][step]
                take = min(left, room[shard] - used[shard])
                if take:
                    out.append((cell, done[cell], done[cell] + take, shard, used[shard]))
                    used[shard] += take
                    done[cell] += take
    return out


def _literal_table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small table from a JSON literal, built by the JVM alone."""
    names = [c.split(":")[0] for c in schema.split(",")]
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema}>>")))


def assign(rows: DataFrame, keys: list[str], shards: int, virtual_nodes: int = VIRTUAL_NODES,
           cells: int = RING_CELLS, slack: float = 0.0) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (gapless from 0 within the shard).

    ``keys`` place a row on the ring; nulls are keys like any other and equal
    rows are interchangeable. ``rows`` is read twice and should be slim.
    An empty table stays empty. The collected counts have at most ``cells`` rows.
    """
    on_ring = rows.withColumn("_hash", F.xxhash64(*keys)) \
                  .withColumn("_cell", F.pmod(F.col("_hash"), F.lit(cells)).cast("int"))
    counts = {r["_cell"]: r["n"] for r in on_ring.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = _literal_table(rows.sparkSession, flows(counts, shards, virtual_nodes, cells, slack),
                          "_at:int,_from:long,_to:long,shard:int,_first:long")
    order = Window.partitionBy("_cell").orderBy("_hash", *[F.col(k).asc_nulls_first() for k in keys])
    ranked = on_ring.withColumn("_rank", F.row_number().over(order).cast("long") - 1)
    # at most cells * shards rows: the ring's size bounds the broadcast, not the data's
    placed = ranked.join(F.broadcast(plan), (F.col("_cell") == F.col("_at")) & (F.col("_rank") >= F.col("_from"))
                         & (F.col("_rank") < F.col("_to")))
    return placed.withColumn("slot", F.col("_first") + F.col("_rank") - F.col("_from")) \
                 .select(*rows.columns, "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = 16, slack: float = 0.0) -> DataFrame:
    """Shard of every document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size: UTF-8 bytes plus 1 (null text: 1). text_crc32: of the UTF-8 bytes,
    null text as empty. law is ``rows``: shard counts are at most one apart, so
    grown_shard is null. Repeated documents each keep their row; other columns
    of ``docs``, whatever their names, play no part.
    """
    slim = docs.select(
        F.col("doc_id"), (utf8_length(F.col("text")) + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    placed = assign(cut(slim, "shard-keys"), ["doc_id", "size", "text_crc32"], shards, slack=slack)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
