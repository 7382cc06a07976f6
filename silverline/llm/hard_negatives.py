"""Hard-negative mining by coordinate pruning over length buckets.

Rows are dealt by hash into shards of bounded size, so no label, length or
vector is a hot key. A shard keeps its vectors in buckets of similar length,
longest first; a bucket holds, for every coordinate, its vectors' values on the
unit sphere in sorted order. Anchors come in blocks of bounded size, and a task
searches one shard for one block.

A score that an anchor must reach is, through the bucket's greatest length, a
least cosine. It bounds the angle to the anchor, and so the values that a
vector may have in each coordinate. The anchor's largest coordinates are its
focus: their feasible ranges are looked up in the sorted lists, the shortest
list gives the candidates, the other ranges thin them out, and what is left is
verified by whole integer products. The score to reach is the k-th best so far,
which grows from bucket to bucket; a bucket whose longest vector cannot reach it
is left whole. Ranges are closed and widened by rounding, so no row is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverline.llm.common import cut

ANCHOR_STEP, SCALE = 100, 256
POSITIVES, NEGATIVES = 5, 10
LEAST_PERCENT, MOST_PERCENT, OF = 30, 90, 100    # a negative's score, of the positive's
SHARD_VALUES = 1 << 19       # components of a shard, about
BLOCK_VALUES = 1 << 14       # components of a block of anchors, about
FOCUS = 4                    # focus coordinates of an anchor
BUCKET_RATIO = 0.9           # least length of a bucket, of its greatest
EXACT = 1 << 52              # products below this are exact in doubles
NONE = -1                    # score of a positive that is missing; no score fits between its bounds


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and vec: the distinct rows that take part, components as whole numbers floor(scale * x)."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").filter(~bad) \
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("vec")).distinct()


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of ``width`` whole numbers; missing components are 0."""
    lists = vectors.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _pack(width: int, group: str, columns: list[str], table: pa.Table) -> pa.Table:
    """The rows of a group as one row of arrays."""
    packed = {group: table.column(group).slice(0, 1)}
    for c in columns:
        packed[c] = pa.array([table.column(c).to_numpy().astype(np.int64).tobytes()], pa.binary())
    packed["vec"] = pa.array([_matrix(table.column("vec"), width).tobytes()], pa.binary())
    return pa.table(packed)


def _packed(rows: DataFrame, width: int, group: str, columns: list[str]) -> DataFrame:
    schema = f"{group} int, " + ", ".join(f"{c} binary" for c in [*columns, "vec"])
    return rows.groupBy(group).applyInArrow(lambda table: _pack(width, group, columns, table), schema)


class Bucket:
    """Vectors of similar length with a sorted list of unit values for each coordinate."""

    def __init__(self, rows: np.ndarray, whole: np.ndarray, lengths: np.ndarray):
        self.rows, self.whole, self.longest = rows, whole[rows], float(lengths[rows].max())
        self.most = float(np.abs(self.whole).max(initial=0))
        self.exact = self.whole.astype(np.float64)
        unit = self.whole / np.maximum(lengths[rows], 1e-300)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable").T
        self.lists = np.take_along_axis(unit, self.order.T, 0).T.copy()
        self.unit = unit

    def scores(self, asked: np.ndarray, candidates: np.ndarray | None) -> np.ndarray:
        """Inner products with the candidates (None: all), exact."""
        bound = float(np.abs(asked).max(initial=0)) * self.most * max(len(asked), 1)
        if bound < EXACT:
            held = self.exact if candidates is None else self.exact[candidates]
            return (held @ asked.astype(np.float64)).astype(np.int64)
        held = self.whole if candidates is None else self.whole[candidates]
        if bound < 1 << 62:
            return held @ asked
        return np.array([sum(int(a) * int(b) for a, b in zip(row, asked, strict=True)) for row in held], np.int64)   # too large: fails

    def candidates(self, asked: np.ndarray, length: float, reach: float) -> np.ndarray | None:
        """Rows that may score ``reach`` or more; None if nothing rules any out."""
        if reach <= 0:
            return None
        cosine = reach / max(length * self.longest, 1e-300)
        if cosine > 1 + 1e-9:
            return np.zeros(0, np.int64)
        angle = np.arccos(min(cosine, 1.0)) + 1e-6
        unit = asked / length
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        own = np.arccos(np.clip(unit[focus], -1, 1))
        low, high = np.cos(np.minimum(own + angle, np.pi)) - 1e-6, np.cos(np.maximum(own - angle, 0)) + 1e-6
        spans = [(int(np.searchsorted(self.lists[f], a, "left")), int(np.searchsorted(self.lists[f], b, "right")))
                 for f, a, b in zip(focus, low, high, strict=True)]
        best = min(range(len(spans)), key=lambda i: spans[i][1] - spans[i][0])
        first, last = spans[best]
        if 2 * (last - first) > len(self.rows):
            return None
        found = self.order[focus[best], first:last]
        for i, f in enumerate(focus):
            if i != best:
                value = self.unit[found, f]
                found = found[(value >= low[i]) & (value <= high[i])]
        return found


def buckets_of(whole: np.ndarray) -> list[Bucket]:
    """Buckets of the vectors, longest first."""
    lengths = np.sqrt((whole.astype(np.float64) ** 2).sum(1))
    order, out, first = np.argsort(-lengths, kind="stable"), [], 0
    while first < len(order):
        last = int(np.searchsorted(-lengths[order], -BUCKET_RATIO * lengths[order[first]], "right"))
        out.append(Bucket(order[first:last], whole, lengths))
        first = last
    return out


def _whole(blob: bytes, width: int) -> np.ndarray:
    return np.frombuffer(blob, np.int64).reshape(-1, width)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return np.frombuffer(table.column(name)[0].as_py(), np.int64)


class Best:
    """The k best (score, id) met in a range of scores."""

    def __init__(self, k: int, low: float, high: float):
        self.k, self.low, self.high = k, low, high
        self.scores = self.ids = np.zeros(0, np.int64)

    def reach(self) -> float:
        """A score below this changes nothing."""
        return max(self.low, float(self.scores[-1])) if len(self.scores) == self.k else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = (scores >= self.reach()) & (scores <= self.high)
        if fit.any():
            scores, ids = np.concatenate([self.scores, scores[fit]]), np.concatenate([self.ids, ids[fit]])
            best = np.lexsort((ids, -scores))[:self.k]
            self.scores, self.ids = scores[best], ids[best]


def _search(width: int, k: int, slots: int, shard: pa.Table, block: pa.Table) -> pa.Table:
    """The k best rows of this shard for each anchor of the block.

    Without slots: other rows of its label. Otherwise rows of other labels, for each slot those in the range of its score.
    """
    out: list[list[np.ndarray]] = [[], [], [], []]
    if len(shard) and len(block):
        ids, labels = _column(shard, "vec_id"), _column(shard, "label")
        buckets = buckets_of(_whole(shard.column("vec")[0].as_py(), width))
        asked = _whole(block.column("vec")[0].as_py(), width)
        columns = [_column(block, c) for c in ("anchor", "vec_id", "label")]
        wanted = [_column(block, f"score{i}").tolist() for i in range(slots)]
        for row, (anchor, vec_id, label) in enumerate(zip(*columns, strict=True)):
            length = float(np.sqrt((asked[row].astype(np.float64) ** 2).sum()))
            best = {} if slots else {0: Best(k, -np.inf, np.inf)}
            for slot, scores in enumerate(wanted):
                low, high = -(-LEAST_PERCENT * scores[row] // OF), MOST_PERCENT * scores[row] // OF
                if low <= high:
                    best[slot] = Best(k, low, high)
            for bucket in buckets:
                if not best:
                    break
                found = bucket.candidates(asked[row], length, min(b.reach() for b in best.values()))
                if found is not None and not len(found):
                    continue
                rows = bucket.rows if found is None else bucket.rows[found]
                fit = labels[rows] != label if slots else (labels[rows] == label) & (ids[rows] != vec_id)
                scores = bucket.scores(asked[row], found)[fit]
                for b in best.values():
                    b.add(scores, ids[rows][fit])
            for slot, b in best.items():
                out[0].append(np.full(len(b.ids), anchor))
                out[1].append(np.full(len(b.ids), slot))
                out[2].append(b.ids)
                out[3].append(b.scores)
    names = ("anchor", "slot", "vec_id", "score")
    return pa.table({n: pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for n, c in zip(names, out, strict=True)})


def _k_best(shards: DataFrame, blocks: DataFrame, counts: tuple[int, int], width: int, k: int, slots: int) -> DataFrame:
    """(anchor, slot, rank, vec_id, score): the k best of every range of every anchor, over all shards."""
    every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in counts]
    left, right = shards.withColumn("block", every[1]), blocks.withColumn("shard", every[0])
    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")) \
        .applyInArrow(lambda shard, block: _search(width, k, slots, shard, block), "anchor long, slot long, vec_id long, score long")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """Hard negatives of every anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and vec (array of whole numbers, see ``usable``);
    ``anchors`` are some of them. An anchor's positives are its best other rows
    of the same label; a negative is of another label and scores between
    LEAST_PERCENT and MOST_PERCENT of the positive's score. Higher scores come
    first, ties by smaller vec_id. Equal rows count once; rows of one vec_id
    that differ each take part, but are no positives of each other. Missing
    components count as 0. An anchor without positives, or a positive without
    negatives, gives no rows. A score beyond a long fails the job.
    """
    names = ("vec_id", "label", "vec")
    rows = cut(rows.select(*names).distinct(), "vectors")
    anchors = cut(anchors.select(*names).distinct().withColumn("anchor", F.xxhash64(*names)), "anchors")
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    asked, width = anchors.count(), max(width or 0, 1)
    shard_count, block_count = (max(1, -(-count * width // most)) for count, most in ((n, SHARD_VALUES), (asked, BLOCK_VALUES)))
    shards = cut(_packed(rows.withColumn("shard", F.pmod(F.xxhash64(*names), F.lit(shard_count)).cast("int")), width, "shard",
                         ["vec_id", "label"]), "vector-shards")
    anchors = anchors.withColumn("block", F.pmod("anchor", F.lit(block_count)).cast("int"))
    counts, keys = (shard_count, block_count), ["anchor", "vec_id", "label"]
    good = cut(_k_best(shards, _packed(anchors, width, "block", keys), counts, width, positives, 0), "positives")
    slots = [f"score{i}" for i in range(positives)]
    wanted = good.groupBy("anchor").agg(*[F.coalesce(F.max(F.when(F.col("rank") == i + 1, F.col("score"))), F.lit(NONE)).alias(s)
                                          for i, s in enumerate(slots)])
    blocks = _packed(anchors.join(wanted, "anchor"), width, "block", keys + slots)
    bad = _k_best(shards, blocks, counts, width, negatives, positives)
    named = good.select("anchor", (F.col("rank") - 1).cast("long").alias("slot"), F.col("vec_id").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    return bad.join(named, ["anchor", "slot"]).join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor") \
        .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def hard_negatives(vectors: DataFrame, anchor_step: int = ANCHOR_STEP) -> DataFrame:
    """``mine`` on a table of embeddings whose labels are wrong on every seventh row; ids divisible by ``anchor_step`` are the anchors.

    Rows with a null vec_id, label or embedding, or with a component that is null or not finite, take no part.
    """
    rows = usable(vectors)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", label)
    return mine(rows, rows.filter(F.col("vec_id") % anchor_step == 0))


NEGATIVES_SQL = f"""
WITH e AS (
  SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id AS other, b.label AS other_label,
         CAST(list_sum([z[1] * z[2] FOR z IN list_zip(a.v, b.v)]) AS BIGINT) AS score
  FROM e a, e b WHERE a.vec_id % {ANCHOR_STEP} = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT * FROM s WHERE anchor_label = other_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES})
SELECT anchor_id, p.other AS positive_id, CAST(row_number() OVER w AS INT) AS rank, s.other AS negative_id,
       p.score AS positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE s.anchor_label <> s.other_label
  AND {LEAST_PERCENT} * p.score <= {OF} * s.score AND {OF} * s.score <= {MOST_PERCENT} * p.score
WINDOW w AS (PARTITION BY anchor_id, p.other ORDER BY s.score DESC, s.other)
QUALIFY row_number() OVER w <= {NEGATIVES}
"""
