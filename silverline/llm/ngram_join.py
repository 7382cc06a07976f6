"""N-gram Jaccard join with a prefix tree of globally ordered sets.

Documents become sets of word n-grams, ordered everywhere by the n-gram's hash.
Equal sets form one class; classes are what is joined.

Candidates. The hash range is cut into parts, a few more than two sets within
the similarity can differ in. By the pigeonhole principle such a pair agrees on
a whole part, a run of both ordered sets, so classes that share no part of equal
content cannot be linked. Classes are grouped by such shared parts into
families; pairs are never listed, only a star for every shared part. Passages
that many documents share make loose families, so each class also has a sketch:
the parities of its n-grams in a few bits for each. Sketches differ in no more
bits than the sets differ in n-grams, so pairs of a family whose sketches differ
too much are ruled out before any text moves.

Join. Within a family, the ordered sets are stored in a trie. It is walked with
all sets of the family as queries at once: the overlap of a path is counted once
for all sets below it, and a subtree is left when what remains of its sets is
too short for any query. Families larger than a block are joined block by block.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import cut
from silverline.llm.components import Forest, components
from silverline.llm.wordhash import WordHasher, joined, mixed, text_slabs

FLUSH_PAIRS = 1 << 18          # (signature, class) pairs a task holds before it passes them on
PIECE_PAIRS = 1 << 14          # of them in one packed row
GROUP_PAIRS = 1 << 21          # pairs of one reducing task, about
SKETCH_BYTES = 1 << 22         # sketches of one block of a loose family, about
BLOCK_GRAMS = 1 << 18          # n-grams of one block of a family, about
BUNDLE_GRAMS = 1 << 17         # n-grams of families that share a task, about
SMALL = 64                     # up to this size, sets are told apart by single n-grams
BROADCAST_BYTES = 64 << 20     # a larger table of members or kept rows is shuffled
HELD_BYTES = 200               # of one such row in the hash table of a join, about

_A, _B, _C = (np.uint64(x) for x in (0x8CB92BA72F3D8DD7, 0xA24BAED4963EE407, 0x9FB21C651E98DF25))


def gram_sets(texts: list[bytes], n: int, hasher: WordHasher) -> list[np.ndarray]:
    """The ordered set of n-gram hashes of every text; fewer than n words are one gram, none is the empty set."""
    buffer, starts = joined(texts)
    first, _, words = hasher.words(buffer)
    at = np.searchsorted(first, starts)
    grams = np.zeros(len(words), np.uint64)
    if len(words) >= n:
        grams = grams[:len(words) - n + 1]
        for i in range(n):
            grams = mixed(grams + words[i:len(words) - n + 1 + i] * _A + np.uint64(i + 1))
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            short = np.zeros(1, np.uint64)
            for k in range(a, b):
                short = mixed(short + words[k:k + 1] * _B + np.uint64(b - a))
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two signed words."""
    two = mixed(np.array([mixed(grams ^ _A).sum(dtype=np.uint64) + np.uint64(len(grams)), mixed(grams ^ _B).sum(dtype=np.uint64)],
                         np.uint64)).view(np.int64)
    return int(two[0]), int(two[1])


class Scheme:
    """How sets of similar sizes are cut into parts, for a similarity of num/den or more.

    Sizes are cut into bands, each reaching as far as a partner of its least
    size may. A linked pair has its smaller set in some band g and its larger
    one in g or g + 1; both are signed for g.
    """

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.edges = [1]
        self.known: dict[int, tuple[int, int]] = {}

    def band(self, size: int) -> int:
        while self.edges[-1] <= size:
            low = self.edges[-1]
            self.edges.append(max(low + 1, -(-low * self.den // self.num)))
        return bisect_right(self.edges, size) - 1

    def parts(self, band: int) -> tuple[int, int]:
        """(parts, spare): a linked pair agrees on more than ``spare`` parts; about as many may be empty."""
        if band in self.known:
            return self.known[band]
        while len(self.edges) < band + 2:
            self.band(self.edges[-1])
        low, high = self.edges[band], self.edges[band + 1]
        differ = (self.den - self.num) * (high - 1) // self.num
        spare = 0
        for _ in range(8):
            empty = (differ + 1 + spare) * np.exp(-low / (differ + 1 + spare))
            spare = int(np.ceil(empty + 3 * np.sqrt(empty))) if empty > 0.01 else spare
        self.known[band] = differ + 1 + spare, spare
        return self.known[band]

    def sketch_bits(self, band: int) -> int:
        self.parts(band)
        return max(64, 1 << int(self.edges[band]).bit_length())

    def signatures(self, grams: np.ndarray) -> np.ndarray:
        """Words of which linked sets share one at least."""
        own = self.band(len(grams))
        out = []
        for band in {own, max(own - 1, 0)}:
            salt = mixed(np.array([band + 1], np.uint64))[0]
            if self.edges[band] <= SMALL:           # a linked pair shares one of its first n-grams
                least = -(-len(grams) * self.num // self.den)
                out.append(mixed(grams[:len(grams) - least + 1] ^ salt))
                continue
            parts, spare = self.parts(band)
            part = ((grams >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            begin = np.flatnonzero(np.diff(part, prepend=np.uint64(parts + 1)))
            content = np.add.reduceat(mixed(grams ^ _C), begin)
            out.append(mixed(mixed(content ^ salt) + part[begin]))
            if parts - len(begin) > spare:          # agreement might be on empty parts alone
                empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), part[begin])
                out.append(mixed(mixed(np.zeros(1, np.uint64) ^ salt) + empty))
        return np.concatenate(out)


def sketch(grams: np.ndarray, bits: int) -> bytes:
    """Parity of the number of n-grams in each of ``bits`` (a power of two) classes."""
    return np.packbits(np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).tobytes()


def folded(packed: bytes, bits: int) -> bytes:
    """The sketch in fewer bits: its halves, one upon the other."""
    words = np.frombuffer(packed, np.uint8)
    while len(words) * 8 > bits:
        words = words[:len(words) // 2] ^ words[len(words) // 2:]
    return words.tobytes()


def stars(signature: np.ndarray, node: np.ndarray):
    """For pairs in any order: (signatures, their least nodes) and the edges of other nodes to those."""
    order = np.lexsort((node, signature))
    signature, node = signature[order], node[order]
    begin = np.flatnonzero(np.concatenate([[True], signature[1:] != signature[:-1]])) if len(signature) else np.zeros(0, int)
    least = np.repeat(node[begin], np.diff(np.append(begin, len(node))))
    other = node != least
    edges = np.unique(np.stack([node[other], least[other]], 1), axis=0)
    return signature[begin], node[begin], edges


_FOUND = "doc_id long, digest long, size long, class long, check long, sketch binary, pairs binary, edges boolean"
_FOUND_NAMES = [f.split()[0] for f in _FOUND.split(", ")]


def _packed_rows(pairs: np.ndarray, edges: bool) -> pa.RecordBatch:
    """Rows that hold pairs alone, in pieces of bounded size."""
    pieces = [pairs[a:a + PIECE_PAIRS].tobytes() for a in range(0, len(pairs), PIECE_PAIRS)]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([*(pa.nulls(len(pieces), t) for t in kinds), pa.array(pieces, pa.binary()),
                                       pa.array([edges] * len(pieces), pa.bool_())], _FOUND_NAMES)


def _describe(n: int, num: int, den: int, batches):
    """One reading of the texts: a row for each document, and packed rows of (signature, least class of this task's texts).

    Edges from other classes of the task to that one are packed on their own.
    """
    hasher, scheme, seen = WordHasher(), Scheme(num, den), set()
    signatures, nodes, held = [], [], 0
    for batch in batches:
        for part, texts in text_slabs(batch):
            sets = gram_sets(texts, n, hasher)
            prints = [fingerprint(grams) for grams in sets]
            sketches = [sketch(grams, scheme.sketch_bits(scheme.band(len(grams)))) if len(grams) else b"" for grams in sets]
            rows = len(sets)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([len(grams) for grams in sets], pa.int64()), pa.array([p[0] for p in prints], pa.int64()),
                 pa.array([p[1] for p in prints], pa.int64()), pa.array(sketches, pa.binary()), pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.bool_())],
                _FOUND_NAMES)
            for grams, (name, _) in zip(sets, prints, strict=True):
                if not len(grams) or name in seen:  # a copy adds nothing
                    continue
                seen.add(name)
                sign = scheme.signatures(grams)
                signatures.append(sign)
                nodes.append(np.full(len(sign), name, np.int64))
                held += len(sign)
            if held >= FLUSH_PAIRS:
                sign, node, edges = stars(np.concatenate(signatures), np.concatenate(nodes))
                yield _packed_rows(np.stack([sign.view(np.int64), node], 1), False)
                yield _packed_rows(edges, True)
                signatures, nodes, held = [], [], 0
    if held:
        sign, node, edges = stars(np.concatenate(signatures), np.concatenate(nodes))
        yield _packed_rows(np.stack([sign.view(np.int64), node], 1), False)
        yield _packed_rows(edges, True)


def _deal(groups: int, batches):
    """Packed pairs dealt to groups by signature; a task's edges go to a negative group."""
    from pyspark import TaskContext

    own_edges = -1 - TaskContext.get().partitionId() % groups
    for batch in batches:
        for row in range(batch.num_rows):
            pairs = np.frombuffer(batch.column(0)[row].as_py(), np.int64).reshape(-1, 2)
            if batch.column(1)[row].as_py():
                keys, rows = [own_edges], [pairs.tobytes()]
            else:
                group = (pairs[:, 0].view(np.uint64) % np.uint64(groups)).astype(np.int64)
                order = np.argsort(group, kind="stable")
                pairs, cuts = pairs[order], np.searchsorted(group[order], np.arange(groups + 1))
                keys = [g for g in range(groups) if cuts[g + 1] > cuts[g]]
                rows = [pairs[cuts[g]:cuts[g + 1]].tobytes() for g in keys]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(rows, pa.binary())], ["grp", "pairs"])


def _unpacked(blobs) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.int64).reshape(-1, 2)


def _edge_rows(edges: np.ndarray) -> pa.Table:
    return pa.table({"a": pa.array(edges[:, 0], pa.int64()), "b": pa.array(edges[:, 1], pa.int64())})


def _meet(key, table: pa.Table) -> pa.Table:
    """Edges of a group: stars of the signatures that met here, or a task's own edges."""
    pairs = _unpacked(table.column("pairs").to_pylist())
    return _edge_rows(pairs if key[0].as_py() < 0 else stars(pairs[:, 0].view(np.uint64), pairs[:, 1])[2])


def trie_links(stored: list[np.ndarray], queries: list[np.ndarray], num: int, den: int):
    """For every stored set, in turn, (its position, positions of the queries linked to it).

    Sets are ordered alike. Grams that occur in one set only lengthen sets but
    cannot overlap, so they are counted and left out of the trie.
    """
    everything = np.concatenate([*stored, *queries]) if stored or queries else np.zeros(0, np.uint64)
    grams, rank, count = np.unique(everything, return_inverse=True, return_counts=True)
    shared = count[rank] > 1
    cuts = np.cumsum([0, *map(len, stored), *map(len, queries)])
    paths = [rank[a:b][shared[a:b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    paths, asked = paths[:len(stored)], paths[len(stored):]
    sizes = np.array([len(s) for s in stored], np.int64)
    asked_size = np.array([len(q) for q in queries], np.int64)
    owner = np.repeat(np.arange(len(asked)), [len(q) for q in asked])
    flat = np.concatenate(asked) if asked else np.zeros(0, np.int64)
    order = np.argsort(flat, kind="stable")
    posting, begin = owner[order], np.searchsorted(flat[order], np.arange(len(grams) + 1))
    lexical = sorted(range(len(paths)), key=lambda i: paths[i].astype(">u4").tobytes())
    if not lexical or not len(queries):
        return
    lengths = np.array([len(paths[i]) for i in lexical])
    full = sizes[lexical]
    prefix = np.zeros(len(lexical), np.int64)       # common with the path before
    for k in range(1, len(lexical)):
        a, b = paths[lexical[k - 1]], paths[lexical[k]]
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[:m] != b[:m])
        prefix[k] = differ[0] if len(differ) else m
    pending = [(0, len(lexical), 0, np.zeros(len(queries), np.int64))]
    while pending:
        low, high, depth, overlap = pending.pop()
        below = int(prefix[low + 1:high].min()) if high - low > 1 else int(lengths[low])
        path = paths[lexical[low]]
        if below > depth:
            found = np.concatenate([posting[begin[g]:begin[g + 1]] for g in path[depth:below]])
            overlap = overlap + np.bincount(found, minlength=len(queries))
        rest = int(lengths[low:high].max()) - below
        needed = num * (asked_size + int(full[low:high].min()))
        if not ((overlap + rest) * (num + den) >= needed).any():
            continue                                # nothing below is long enough for any query
        if high - low == 1 or below == int(lengths[low:high].max()):
            for k in range(low, high):
                yield lexical[k], np.flatnonzero(overlap * (num + den) >= num * (asked_size + full[k]))
            continue
        start = low
        while start < high and lengths[start] == below:      # paths that end here sort first
            yield lexical[start], np.flatnonzero(overlap * (num + den) >= num * (asked_size + full[start]))
            start += 1
        while start < high:                         # a child for each next gram
            end = start + 1
            while end < high and prefix[end] > below:
                end += 1
            pending.append((start, end, below, overlap))
            start = end


def _join_blocks(n: int, num: int, den: int, table: pa.Table) -> pa.Table:
    """Links of one bundle of families, or between two blocks of one family, as the edges of forests."""
    hasher, found = WordHasher(), []
    names, kept, sets, seen = [], [], [], set()
    classes = table.column("class").to_pylist()
    texts = table.column("text").cast(pa.binary())
    for row, name in enumerate(classes):
        grams = gram_sets([texts[row].as_py() or b""], n, hasher)[0]
        if name in seen or fingerprint(grams)[0] != name:     # another row under the same doc_id
            continue
        seen.add(name)
        names.append(name)
        kept.append(row)
        sets.append(grams)
    ids, blocks, families = np.array(names, np.int64), *(table.column(c).to_numpy()[kept] for c in ("block", "family"))
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    order = np.argsort(families, kind="stable")
    for members in np.split(order, np.flatnonzero(np.diff(families[order])) + 1):
        left, right = (members[blocks[members] == b] for b in (low, high))
        forest = Forest(len(ids))
        for i, linked in trie_links([sets[k] for k in left], [sets[k] for k in right], num, den):
            moved = forest.unite(np.append(right[linked], left[i]))
            if len(moved):
                found.append(np.stack([ids[moved], ids[forest.roots(moved)]], 1))
    return _edge_rows(np.concatenate(found) if found else np.zeros((0, 2), np.int64))


def _by_band(num: int, den: int, batches):
    """Each class of a family once for its own band and once for the one below, its sketch in that band's bits."""
    scheme = Scheme(num, den)
    for batch in batches:
        rows = []
        for family, name, size, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = scheme.band(size)
            rows += [(family, band, name, size, folded(packed, scheme.sketch_bits(band))) for band in {own, max(own - 1, 0)}]
        kinds = (("family", pa.int64()), ("band", pa.int32()), ("class", pa.int64()), ("size", pa.int64()), ("sketch", pa.binary()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)],
                                         [k for k, _ in kinds])


def _near_sketches(num: int, den: int, table: pa.Table) -> pa.Table:
    """Pairs of two blocks of a family and band that the sketches do not rule out, as the edges of a forest."""
    names, sizes, blocks = (table.column(c).to_numpy() for c in ("class", "size", "block"))
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    words = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(len(names), -1)
    left, right = np.flatnonzero(blocks == low), np.flatnonzero(blocks == high)
    right = right[np.argsort(sizes[right], kind="stable")]
    ordered, held = sizes[right], words[right]
    forest, edges = Forest(len(names)), []
    for i in left:
        a = np.searchsorted(ordered, -(-sizes[i] * num // den), "left")
        b = np.searchsorted(ordered, sizes[i] * den // num, "right")
        differ = np.bitwise_count(held[a:b] ^ words[i]).sum(1)
        near = right[a:b][differ * (num + den) <= (den - num) * (ordered[a:b] + sizes[i])]
        moved = forest.unite(np.append(near, i))
        if len(moved):
            edges.append(np.stack([names[moved], names[forest.roots(moved)]], 1))
    return _edge_rows(np.concatenate(edges) if edges else np.zeros((0, 2), np.int64))


def _tightened(loose: DataFrame, num: int, den: int) -> DataFrame:
    """(class, family): the parts of loose families (family, class, size, sketch) that sketches leave together."""
    rows = cut(loose.select("family", "class", "size", "sketch")
               .mapInArrow(partial(_by_band, num, den), "family long, band int, class long, size long, sketch binary"), "gram-sketches")
    blocks = rows.groupBy("family", "band").agg(F.ceil(F.sum(F.octet_length("sketch")) / SKETCH_BYTES).cast("int").alias("blocks"))
    pairs = rows.join(blocks, ["family", "band"]) \
        .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")) \
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("family", "band", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"),
                "block", "class", "size", "sketch")
    edges = pairs.groupBy("family", "band", "low", "high") \
        .applyInArrow(lambda table: _near_sketches(num, den, table), "a long, b long")
    return _with_roots(components(edges))


def _with_roots(stars: DataFrame) -> DataFrame:
    """(class, family) of all members of components, their roots too."""
    members = stars.select(F.col("node").alias("class"), F.col("root").alias("family"))
    return members.unionAll(members.select(F.col("family").alias("class"), "family").distinct())


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, digest (of the text, null as empty) and text: rows are told by the first two."""
    return docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("digest"), "text")


def describe(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """What one reading of the texts (``keyed``) gives, written once.

    Rows without ``edges``: doc_id, digest, size, class and check (128 bits that
    name the set) and sketch of every document. The others hold packed pairs.
    """
    return cut(docs.mapInArrow(partial(_describe, n, num, den), _FOUND), "gram-classes")


def _families(found: DataFrame, total: int, num: int, den: int) -> DataFrame:
    """(class, family) of the classes that share a part with another."""
    groups = max(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-3 * total * (den - num) // num // GROUP_PAIRS))
    dealt = found.filter("edges IS NOT NULL").select("pairs", "edges").mapInArrow(partial(_deal, groups), "grp int, pairs binary")
    met = dealt.repartition(groups, "grp").groupBy("grp").applyInArrow(lambda key, table: _meet(key, table), "a long, b long")
    return _with_roots(components(met))


def linked_classes(docs: DataFrame, found: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(class, root): classes that are linked to another, with the least class of their component."""
    described = found.filter("edges IS NULL")
    classes = described.filter("size > 0").groupBy("class", "check") \
        .agg(F.min(F.struct("doc_id", "digest")).alias("row"), F.max("size").alias("size"), F.max("sketch").alias("sketch")) \
        .select("class", "check", "row.*", "size", "sketch")
    total = described.agg(F.sum("size").alias("s")).first()["s"] or 0
    loose = classes.join(_families(found, total, num, den), "class")
    members = classes.drop("sketch").join(_tightened(loose, num, den), "class").select("class", "doc_id", "digest", "size", "family")
    blocks = members.groupBy("family").agg(F.ceil(F.sum("size") / BLOCK_GRAMS).cast("int").alias("blocks"))
    members = cut(members.join(blocks, "family")
                  .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")), "gram-families")
    size = members.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("grams")).first()
    held = members.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "class", "family", "blocks", "block")
    if size["n"] * HELD_BYTES <= BROADCAST_BYTES:
        held = F.broadcast(held)
    # small families share a group; a larger one has a group for each pair of its blocks
    bundles, alone = -(-size["grams"] // BUNDLE_GRAMS) + 1, F.col("blocks") == 1
    rows = docs.join(held, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))) \
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumn("bundle", F.when(alone, F.pmod(F.xxhash64("family"), F.lit(bundles))).otherwise(F.col("family"))) \
        .select("bundle", alone.alias("alone"), F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"),
                "family", "block", "class", "text")
    links = rows.groupBy("alone", "bundle", "low", "high")\
        .applyInArrow(lambda table: _join_blocks(n, num, den, table), "a long, b long")
    return components(links).select(F.col("node").alias("class"), "root")


def join_documents(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id: the least doc_id reachable over links of similarity num/den or more.

    Words are runs of anything but ASCII blanks, A-Z lower-cased. A null, empty
    or wordless text has no n-grams and no links. Equal sets are linked;
    repeated rows each stay a row. A null doc_id takes part but names no
    component unless all of its component's are null. No other columns are read.
    """
    described = _with_components(keyed(docs), n, num, den)
    return described.select("doc_id", F.col("size").alias("n_shingles"),
                            F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def _with_components(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """doc_id, digest, size, class, check of ``keyed`` rows, with their component: its root, least doc_id and first row."""
    found = describe(docs, n, num, den)
    described = found.filter("edges IS NULL").select("doc_id", "digest", "size", "class", "check")
    roots = linked_classes(docs, found, n, num, den)
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")
    classes = described.filter("size > 0").groupBy("class", "check").agg(F.min("doc_id").alias("least"), F.min(first).alias("first"))
    grouped = classes.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    named = grouped.groupBy("root").agg(F.min("least").alias("component"), F.min("first").alias("first"))
    return described.join(grouped.select("class", "check", "root").join(named, "root"), ["class", "check"], "left")


def one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each linked group; all columns kept.

    It is the row with the least doc_id, null last, and of rows that share it the
    one whose text has the least digest. Linked rows go whatever their doc_id is,
    and rows that share a doc_id but are not linked all stay. Of rows without
    words one of each doc_id and text stays.
    """
    grouped = _with_components(keyed(docs), n, num, den)
    stays = (F.col("size") == 0) | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest")))
    keys = cut(grouped.groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
               .agg(F.count(F.lit(1)).alias("_rows"), F.bool_or(stays).alias("_stays")), "gram-rows")

    def told(rows: DataFrame, some: DataFrame, how: str) -> DataFrame:
        some = F.broadcast(some) if some.count() * HELD_BYTES <= BROADCAST_BYTES else some
        return rows.join(some, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_digest")), how)

    rows = told(docs.withColumn("_text", F.xxhash64(F.coalesce(F.col("text"), F.lit("")))), keys.filter("NOT _stays"), "left_anti")
    repeated = keys.filter("_stays AND _rows > 1")
    if not repeated.isEmpty():                      # only rows that are there more than once are brought together
        again = told(rows, repeated, "left_semi").dropDuplicates(["doc_id", "_text"])
        rows = told(rows, repeated, "left_anti").unionByName(again)
    return rows.select(*docs.columns)
