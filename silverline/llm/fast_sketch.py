"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Sketch. A set of n-grams is thrown into t bins in rounds. In round i every
n-gram goes to a bin that its hash names and offers the value i + (the rest of
the hash); a bin keeps its least value. After the first round in which all bins
are filled the rest changes nothing. From round t on, round i sends all n-grams
to bin i - t, so every coordinate is filled after 2 t rounds at most, however
small the set, and t log t hashes are expected for a set of any size. Two sets
agree on each coordinate with their Jaccard similarity as probability, and the
number of agreeing coordinates is concentrated like that of independent ones:
it is below t (J - 0.2) with a probability of exp(-0.08 t) at most (1e-9).

Banding. r coordinates make a band, and sets that share a band are candidates.
At a similarity of 0.8, 51 bands of 5 miss a pair with a probability of 2e-9.
Candidates are never listed: a band passes on a star, its least class with the
others, and the stars' components are loose families.

Verification is exact, on full sets, and of all pairs of a family that may be
linked: first sketches are compared, which leaves tight families, then sets.
Both go the same way. A family larger than a block is dealt into blocks, each
with the family's least class in it. What a block does not link with that class
are strangers; in a second round they meet all blocks. So copies of one text,
however many, take work in proportion to their number, and no pair is left out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import cut
from silverline.llm.components import Forest, components
from silverline.llm.ngram_join import fingerprint, gram_sets, stars
from silverline.llm.wordhash import WordHasher, mixed, text_slabs

COORDINATES = 256
BAND_ROWS = 5
SLACK = 0.2                    # sketches may agree on so much less than sets
FLUSH_PAIRS = 1 << 20          # (band, class) pairs a task holds before it passes them on
GROUP_PAIRS = 1 << 21          # pairs of one reducing task, about
SKETCH_BYTES = 1 << 21         # sketches of one block, about
BLOCK_GRAMS = 1 << 18          # n-grams of one block, about
FINEST = 16                    # first blocks may be so much smaller, to give every task some
BUNDLE_SHARE = 2               # families of one block share a task up to this part of a block
BROADCAST_ROWS = 1 << 17       # members of tight families that are broadcast at most, at about 200 bytes each

_SEED, _BAND = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F)


def sketches(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """16 bits of every coordinate of every set; sets must not be empty."""
    unfilled = np.iinfo(np.uint64).max
    out = np.full((len(sets), t), unfilled, np.uint64)
    flat, open_ = out.reshape(-1), np.arange(len(sets))
    sizes = np.array([len(s) for s in sets], np.int64)
    grams, owner = np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.repeat(np.arange(len(sets)), sizes)
    salts = np.arange(1, 2 * t + 1, dtype=np.uint64) * _SEED
    for i in range(2 * t):
        if not len(grams):
            break
        rest = mixed(grams ^ salts[i])
        # top bits name the bin, the others are the value within the round
        place = (rest >> np.uint64(32)) * np.uint64(t) >> np.uint64(32) if i < t else np.full(len(grams), i - t, np.uint64)
        value = np.uint64(i) << np.uint64(48) | rest & np.uint64((1 << 48) - 1)
        np.minimum.at(flat, owner * t + place.astype(np.int64), value)
        still = (out[open_] == unfilled).any(1)
        if not still.all():
            wanted = np.zeros(len(sets), bool)
            open_ = open_[still]
            wanted[open_] = True
            grams, owner = grams[wanted[owner]], owner[wanted[owner]]
    return (mixed(out) >> np.uint64(48)).astype(np.uint16)


def bands(rows: np.ndarray, r: int = BAND_ROWS) -> np.ndarray:
    """A 64-bit name of every band of every sketch."""
    count = rows.shape[1] // r
    cut_rows = rows[:, :count * r].reshape(len(rows), count, r).astype(np.uint64)
    name = np.broadcast_to((np.arange(count, dtype=np.uint64) + np.uint64(1)) * _BAND, cut_rows.shape[:2])
    for k in range(r):
        name = mixed(name + cut_rows[:, :, k] + np.uint64(1))
    return name


def _describe(n: int, batches):
    hasher, seen = WordHasher(), set()
    for batch in batches:
        for part, texts in text_slabs(batch):
            sets = gram_sets(texts, n, hasher)
            prints = [fingerprint(grams) for grams in sets]
            new = []
            for row, (grams, name) in enumerate(zip(sets, prints, strict=True)):
                if len(grams) and name not in seen:              # one sketch for each class of the task
                    seen.add(name)
                    new.append(row)
            made: list[bytes | None] = [None] * len(sets)
            for row, sketch in zip(new, sketches([sets[row] for row in new]), strict=True):
                made[row] = sketch.tobytes()
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([len(grams) for grams in sets], pa.int64()),
                 pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()), pa.array(made, pa.binary())],
                ["doc_id", "digest", "size", "class", "check", "sketch"])


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def _sign(groups: int, batches):
    """Rows (group, packed pairs): bands with the least class of this task, and, in negative groups, its own edges."""
    from pyspark import TaskContext

    own = -1 - TaskContext.get().partitionId() % groups
    names, nodes, held = [], [], 0

    def flush():
        sign, node, edges = stars(np.concatenate(names), np.concatenate(nodes))
        group = (sign % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        pairs, cuts = np.stack([sign.view(np.int64), node], 1)[order], np.searchsorted(group[order], np.arange(groups + 1))
        rows = [(g, pairs[cuts[g]:cuts[g + 1]].tobytes()) for g in range(groups) if cuts[g + 1] > cuts[g]]
        if len(edges):
            rows.append((own, edges.tobytes()))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                                          ["grp", "pairs"])

    for batch in batches:
        for first in range(0, batch.num_rows, 1024):
            part = batch.slice(first, 1024)
            sign = bands(_matrix(part.column(1)))
            names.append(sign.ravel())
            nodes.append(np.repeat(part.column(0).to_numpy(), sign.shape[1]))
            held += sign.size
            if held >= FLUSH_PAIRS:
                yield flush()
                names, nodes, held = [], [], 0
    if held:
        yield flush()


def _edges(found: list[np.ndarray]) -> pa.Table:
    rows = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    return pa.table([pa.array(rows[:, 0], pa.int64()), pa.array(rows[:, 1], pa.int64())], ["a", "b"])


def _meet(table: pa.Table) -> pa.Table:
    pairs = np.frombuffer(b"".join(table.column("pairs").to_pylist()), np.int64).reshape(-1, 2)
    return _edges([pairs if table.column("grp")[0].as_py() < 0 else stars(pairs[:, 0].view(np.uint64), pairs[:, 1])[2]])


def _loose(classes: DataFrame) -> DataFrame:
    """(node, family) of the classes that share a band with another."""
    spark, per_class = classes.sparkSession, COORDINATES // BAND_ROWS
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-classes.count() * per_class // GROUP_PAIRS))
    signed = classes.select("node", "sketch").mapInArrow(partial(_sign, groups), "grp int, pairs binary")
    return _with_roots(components(signed.repartition(groups, "grp").groupBy("grp").applyInArrow(lambda table: _meet(table), "a long, b long")))


def _with_roots(found: DataFrame) -> DataFrame:
    members = found.select("node", F.col("root").alias("family"))
    return members.unionAll(members.select(F.col("family").alias("node"), "family").distinct())


def _linked_in(nodes: np.ndarray, families: np.ndarray, roots: np.ndarray, left: np.ndarray, right: np.ndarray, near) -> list[np.ndarray]:
    """(root, new root) of the trees that links between left and right rows of a family hang up; equal roots are one tree before.

    ``near(i, rows)`` says which of the rows are linked to row i. A tree's root is its least row.
    """
    found = []
    order = np.lexsort((roots, nodes, families))
    for members in np.split(order, np.flatnonzero(np.diff(families[order])) + 1):
        forest = Forest(len(members))
        at = np.argsort(roots[members], kind="stable")
        for same in np.split(at, np.flatnonzero(np.diff(roots[members][at])) + 1):
            forest.unite(same)
        targets, everyone = np.flatnonzero(right[members]), np.arange(len(members))
        for i in np.flatnonzero(left[members]):
            up = forest.roots(everyone)
            open_ = targets[up[targets] != up[i]]
            if len(open_):
                forest.unite(np.append(open_[near(members[i], members[open_])], i))
            elif (up == up[0]).all():
                break
        moved = np.stack([roots[members], roots[members[forest.roots(everyone)]]], 1)
        moved = np.unique(moved[moved[:, 0] != moved[:, 1]], axis=0)
        if len(moved):
            found.append(moved)
    return found


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(c).to_numpy() for c in names]


def _near_sketches(num: int, den: int, table: pa.Table) -> pa.Table:
    """Links by sketches, on the safe side: agreement may fall short of the similarity by SLACK."""
    nodes, families, roots, sizes, left, right = _columns(table, "node", "family", "root", "size", "left", "right")
    rows = _matrix(table.column("sketch"))
    least = (num / den - SLACK) * rows.shape[1]

    def near(i, others):
        fit = (sizes[others] * den >= sizes[i] * num) & (sizes[i] * den >= sizes[others] * num)
        out = np.zeros(len(others), bool)
        out[fit] = (rows[others[fit]] == rows[i]).sum(1) >= least
        return out

    return _edges(_linked_in(nodes, families, roots, left, right, near))


def _near_sets(n: int, num: int, den: int, table: pa.Table) -> pa.Table:
    """Links by full sets."""
    nodes, families, roots, left, right = _columns(table, "node", "family", "root", "left", "right")
    hasher, texts = WordHasher(), table.column("text").cast(pa.binary())
    sets = [gram_sets([texts[row].as_py() or b""], n, hasher)[0] for row in range(len(nodes))]
    sizes = np.array([len(s) for s in sets], np.int64)
    held, rank = np.unique(np.concatenate(sets), return_inverse=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    order = np.argsort(rank, kind="stable")
    owner, begin = np.repeat(np.arange(len(sets)), sizes)[order], np.searchsorted(rank[order], np.arange(len(held) + 1))
    ranks = np.split(rank, np.cumsum(sizes)[:-1])

    def near(i, others):
        met = np.concatenate([owner[begin[g]:begin[g + 1]] for g in ranks[i]])
        both = np.bincount(met, minlength=len(sets))[others]
        return den * both >= num * (sizes[others] + sizes[i] - both)

    return _edges(_linked_in(nodes, families, roots, left, right, near))


def _within_families(members: DataFrame, weight: str, block_weight: int, attach: Callable[[DataFrame], DataFrame],
                     link: Callable[[pa.Table], pa.Table], tag: str) -> DataFrame:
    """(node, root) of what is linked within families, roots being the least nodes and left out.

    ``members`` is slim: family (its least node), node and a weight. ``attach``
    brings rows (node, ...) their payload, written once; ``link`` finds links
    between the left and right rows of each family of a table.
    """
    total, parts = (members.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("w")).first()["w"],
                    int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    fine = max(block_weight // FINEST, min(block_weight, total // parts), 1)

    def told(rows: DataFrame, some: DataFrame, size: int, count: str, how: str) -> DataFrame:
        """``rows`` with the number of blocks that the family's rows in ``some`` make."""
        sums = cut(some.groupBy("family").agg(F.ceil(F.sum(weight) / size).cast("int").alias(count))
                   .filter(F.col(count) > (1 if how == "left" else 0)), f"{tag}-{count}")
        return rows.join(F.broadcast(sums) if sums.count() <= BROADCAST_ROWS else sums, "family", how)

    def block_of(count: str, salt: int):
        return F.pmod(F.xxhash64("node", F.lit(salt)), F.col(count)).cast("int")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    placed = told(members, members, fine, "blocks", "left").fillna(1, ["blocks"])
    placed = cut(placed.withColumn("block", block_of("blocks", 0)), f"{tag}-places")
    payload = cut(attach(placed.select("node")), f"{tag}-payload")
    bundles, alone = BUNDLE_SHARE * total // fine + 1, F.col("blocks") == 1
    hubs = placed.filter((F.col("node") == F.col("family")) & (F.col("blocks") > 1)) \
        .withColumn("_to", every("blocks")).filter("_to <> block").withColumn("block", F.col("_to")).drop("_to")
    first = placed.unionByName(hubs).join(payload, "node") \
        .withColumn("bundle", F.when(alone, F.pmod(F.xxhash64("family"), F.lit(bundles))).otherwise(F.col("family"))) \
        .withColumns({"alone": alone, "root": F.col("node"), "left": F.lit(True), "right": F.lit(True)})
    # a row is in one block, and the least class of its family with it: what is linked to that has it as root
    found = first.groupBy("alone", "bundle", "block").applyInArrow(lambda table: link(table), "a long, b long")
    found = cut(found.toDF("node", "root"), f"{tag}-found")
    rooted = placed.filter("blocks > 1").select("family", "node", weight).join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = cut(rooted, f"{tag}-rooted")
    strangers = rooted.filter("root <> family")
    if strangers.isEmpty():
        return found
    rooted = told(told(rooted, strangers, block_weight, "others", "inner"), rooted, block_weight, "blocks", "inner")
    rooted = cut(rooted.withColumns({"block": block_of("blocks", 1), "other": block_of("others", 2)}), f"{tag}-strangers")
    met = rooted.withColumn("other", every("others")).withColumns({"left": F.lit(False), "right": F.lit(True)})
    asked = rooted.filter("root <> family").withColumn("block", every("blocks")).withColumns({"left": F.lit(True), "right": F.lit(False)})
    second = met.unionByName(asked).join(payload, "node").groupBy("family", "block", "other") \
        .applyInArrow(lambda table: link(table), "a long, b long")
    joined = components(second).withColumnsRenamed({"node": "_root", "root": "_new"})
    trees = found.unionAll(joined.select(F.col("_root").alias("node"), F.col("_root").alias("root")))
    return trees.join(joined, F.col("root") == F.col("_root"), "left").select("node", F.coalesce("_new", "root").alias("root")) \
        .filter("node <> root").distinct()


def _texts(docs: DataFrame, repeated: DataFrame, held: DataFrame) -> DataFrame:
    """(node, text) of the classes in ``held`` (node, doc_id, digest): one row that has each one's set."""
    held = held.join(repeated, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("digest") == F.col("_digest")), "left") \
        .select("node", F.col("doc_id").alias("_id"), F.col("digest").alias("_text"), F.col("_digest").isNotNull().alias("again"))
    held = cut(held, "sketch-held")
    if held.count() <= BROADCAST_ROWS:
        held = F.broadcast(held)
    rows = docs.join(held, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_text"))).select("node", "text", "again")
    # equal rows are one text; only these are brought together
    return rows.filter("NOT again").select("node", "text").unionByName(rows.filter("again").groupBy("node").agg(F.max("text").alias("text")))


def near_duplicates(docs: DataFrame, n: int = 4, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id reachable over links of similarity num/den or more) and kept.

    Words are runs of anything but ASCII blanks, A-Z lower-cased. A null, empty
    or wordless text has no n-grams and no links. Equal sets are linked;
    repeated rows each stay a row. A null doc_id takes part but names no
    component unless all of its component's are null; kept is true if doc_id
    and component_id are equal, nulls as well. No other columns are read.
    ``num/den`` has to be 0.75 or more for the bands to miss less than a millionth.
    """
    if not 3 * den <= 4 * num <= 4 * den:
        raise ValueError("the similarity has to be from 0.75 to 1")
    slim = docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("digest"), "text")
    described = cut(slim.mapInArrow(partial(_describe, n), "doc_id long, digest long, size long, class long, check long, sketch binary"),
                    "sketch-documents")
    # ids of the distinct sets, fixed by writing them
    classes = cut(described.filter("size > 0").groupBy("class", "check")
                  .agg(F.min(F.struct("doc_id", "digest")).alias("row"), F.min("doc_id").alias("least"), F.max("size").alias("size"),
                       F.max("sketch").alias("sketch"))
                  .select(F.monotonically_increasing_id().alias("node"), "class", "check", "row.*", "least", "size", "sketch"), "sketch-classes")
    sizes = classes.select("node", "size")
    loose = _loose(classes).withColumn("bytes", F.lit(2 * COORDINATES))
    tight = _within_families(loose, "bytes", SKETCH_BYTES, lambda wanted: wanted.join(classes.select("node", "size", "sketch"), "node"),
                             partial(_near_sketches, num, den), "sketch")
    repeated = described.groupBy(F.col("doc_id").alias("_doc"), F.col("digest").alias("_digest")).agg(F.count(F.lit(1)).alias("n")) \
        .filter("n > 1").drop("n")
    linked = _within_families(_with_roots(tight).join(sizes, "node"), "size", BLOCK_GRAMS,
                              lambda wanted: _texts(slim, repeated, wanted.join(classes.select("node", "doc_id", "digest"), "node")),
                              partial(_near_sets, n, num, den), "sets")
    grouped = classes.select("node", "class", "check", "least").join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = grouped.groupBy("root").agg(F.min("least").alias("component"))
    of_class = grouped.join(named, "root").select("class", "check", "component")
    component = F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return described.join(of_class, ["class", "check"], "left") \
        .select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
