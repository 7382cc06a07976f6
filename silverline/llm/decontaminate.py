"""Benchmark decontamination by pigeonhole edit matching on words.

An item of m words may differ from a passage by e = floor(share * m) word edits.
Cut into e + 1 pieces, one piece must occur unchanged in any passage within the
budget. Documents are searched for the leading words of all pieces by rolling
word hashes; around each hit, Myers' bit-parallel algorithm gives the least edit
distance between the item and any passage of the window.

The items are broadcast in blocks of bounded size; all documents are matched
against each block, so the number of items is not limited.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from silverline.llm.wordhash import WordHasher, joined, mixed, text_slabs

EDIT_SHARE = 0.2           # edits allowed, as a share of the item's words
BLOCK_BYTES = 16 << 20     # item text broadcast at once
SEEN_BITS = 22
SHORT_WORDS = 1 << 10      # all masks of an item up to this size are kept once they are made
READY_WORDS = 1 << 18      # words of the items whose masks a task holds, unless one item has more


class PassageHasher(WordHasher):
    """Words are runs of letters and digits: ASCII marks separate words as blanks do."""

    def __init__(self):
        super().__init__()
        byte = np.arange(256)
        self.blank = ~((byte >= 128) | (byte >= 48) & (byte <= 57) | (byte >= 65) & (byte <= 90) | (byte >= 97) & (byte <= 122))


def words_by_text(texts: list[str], hasher: PassageHasher) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the lower-cased texts, and where each text's words start (one more entry than texts)."""
    buffer, starts = joined([t.lower().encode() for t in texts])
    first, _, words = hasher.words(buffer)
    return words, np.searchsorted(first, starts)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words."""
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for i in range(n):
        out = mixed(out + words[i:len(words) - n + 1 + i] + np.uint64(i + 1))
    return out


def budget(words: int, share: float = EDIT_SHARE) -> int:
    return int(words * share)


class Masks:
    """Bit masks of the places of every word in an item of m words, made when they are asked for.

    Only those of words with over sqrt(m) places are kept, sqrt(m) of m bits at
    most, so an item takes memory in proportion to its words, not to their square.
    """

    def __init__(self, words: np.ndarray):
        self.order = np.argsort(words, kind="stable")
        self.held, self.begin = np.unique(words[self.order], return_index=True)
        self.end = np.append(self.begin[1:], len(words))
        self.size, self.often, self.kept = len(words) // 8 + 1, int(len(words) ** 0.5), {}
        if len(words) <= SHORT_WORDS:
            self.often = 0                            # all of a short item's masks are small

    def get(self, word: int, _=0) -> int:
        if word in self.kept:
            return self.kept[word]
        at = int(np.searchsorted(self.held, np.uint64(word)))
        if at == len(self.held) or int(self.held[at]) != word:
            return 0
        places = self.order[self.begin[at]:self.end[at]]
        bits = np.zeros(self.size, np.uint8)
        np.bitwise_or.at(bits, places >> 3, (1 << (places & 7)).astype(np.uint8))
        mask = int.from_bytes(bits.tobytes(), "little")
        if len(places) > self.often:
            self.kept[word] = mask
        return mask


class Items:
    """A block of items ready for matching: their words and their pieces by length, some 40 bytes a word in all."""

    def __init__(self, ids: list[int], texts: list[str], share: float = EDIT_SHARE):
        words, at = words_by_text(texts, PassageHasher())
        self.ids, self.words, self.edits, self.own = [], [], [], []
        found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for i, item in enumerate(ids):
            own = words[at[i]:at[i + 1]].copy()
            if not len(own):
                continue
            m, e = len(own), budget(len(own), share)
            size = m // (e + 1)                       # the leading words of each piece
            starts = np.arange(e + 1) * m // (e + 1)
            found.setdefault(size, []).append((gram_hashes(own, size)[starts], np.full(e + 1, len(self.ids), np.int32), starts.astype(np.int32)))
            self.ids.append(item)
            self.words.append(m)
            self.edits.append(e)
            self.own.append(own)
        self.pieces = {}
        for size, parts in found.items():
            hashes, items, offsets = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((offsets, items, hashes))
            seen = np.zeros(1 << SEEN_BITS, bool)     # lets nearly all words pass by without a search
            seen[hashes >> np.uint64(64 - SEEN_BITS)] = True
            self.pieces[size] = (hashes[order], items[order].astype(np.int64), offsets[order].astype(np.int64), seen)
        self.ready: dict[int, Masks] = {}

    def masks(self, item: int) -> Masks:
        """The masks of an item, kept for the items matched last."""
        if item not in self.ready:
            while self.ready and sum(len(self.own[i]) for i in self.ready) + len(self.own[item]) > READY_WORDS:
                self.ready.pop(next(iter(self.ready)))
            self.ready[item] = Masks(self.own[item])
        return self.ready[item]

    def hits(self, words: np.ndarray):
        """(position, item, offset of the piece in the item) of all piece hits in a run of words."""
        out = []
        for size, (hashes, items, offsets, seen) in self.pieces.items():
            grams = gram_hashes(words, size)
            near = np.flatnonzero(seen[grams >> np.uint64(64 - SEEN_BITS)])
            left = np.searchsorted(hashes, grams[near], "left")
            n = np.searchsorted(hashes, grams[near], "right") - left
            which = np.repeat(left, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out.append((np.repeat(near, n), items[which], offsets[which]))
        return (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3

    def match(self, words: np.ndarray, position: np.ndarray, item: np.ndarray, offset: np.ndarray) -> list[tuple[int, int, int]]:
        """(item id, distance, edits allowed) of the items within their budget in one document, given its hits."""
        found = []
        for i in np.unique(item):
            m, e = self.words[i], self.edits[i]
            starts = np.unique((position - offset)[item == i]) - e
            best = e + 1
            at = 0
            while at < len(starts) and best:          # windows that overlap are one
                low = high = int(starts[at])
                while at < len(starts) and int(starts[at]) <= high + m + 2 * e:
                    high = int(starts[at])
                    at += 1
                best = min(best, least_distance(m, self.masks(i), words[max(0, low):high + m + 2 * e].tolist()))
            if best <= e:
                found.append((self.ids[i], best, e))
        return found


def least_distance(m: int, masks: dict[int, int] | Masks, text: list[int]) -> int:
    """Least edit distance between a pattern of m symbols and any part of the text (Myers, bit-parallel)."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best = m
    for symbol in text:
        equal = masks.get(symbol, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        plus = down | ~(horizontal | up) & full
        minus = up & horizontal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            best = min(best, score)
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = minus | ~(vertical | plus) & full, plus & vertical
    return best


def _matches(items, batches):
    block, hasher = items.value, PassageHasher()
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("allowed", pa.int32())]))
    for batch in batches:
        for part, texts in text_slabs(batch):
            words, at = words_by_text([t.decode() for t in texts], hasher)
            position, item, offset = block.hits(words)
            order = np.argsort(position, kind="stable")
            position, item, offset = position[order], item[order], offset[order]
            cuts = np.searchsorted(position, at)
            found = [block.match(words[at[d]:at[d + 1]], position[a:b] - at[d], item[a:b], offset[a:b]) if b > a else []
                     for d, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
            hits = [[{"item_id": i, "distance": e, "allowed": n} for i, e, n in f] for f in found]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(hits, kind)], [*part.schema.names, "_leaks"])


_LEAKS = ArrayType(StructType([StructField("item_id", LongType()), StructField("distance", IntegerType()),
                               StructField("allowed", IntegerType())]))


def _blocks(benchmark: DataFrame, share: float, block_bytes: int):
    """The items in broadcast blocks of bounded size."""
    slim = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    size = slim.agg(F.sum(F.octet_length("text") + 16).alias("b")).first()["b"] or 0
    parts = -(-size // block_bytes)
    for part in range(parts):
        rows = slim.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id").collect()
        yield benchmark.sparkSession.sparkContext.broadcast(Items([r["item_id"] for r in rows], [r["text"] for r in rows], share))


def with_leaks(docs: DataFrame, block) -> DataFrame:
    return docs.mapInArrow(partial(_matches, block), StructType([*docs.schema.fields, StructField("_leaks", _LEAKS)]))


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, distance, allowed) for every document and item it contains within the budget.

    Case, blanks and ASCII marks do not count. Null or wordless texts and items
    match nothing; items too short for an edit match exactly. Repeated rows on
    either side each give their rows. No other columns are read.
    """
    slim, out = docs.select("doc_id", "text"), None
    for block in _blocks(benchmark, share, block_bytes):
        found = with_leaks(slim, block).select("doc_id", F.inline("_leaks"))
        out = found if out is None else out.unionAll(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], "doc_id long, item_id long, distance int, allowed int")


def without_leaks(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the documents that contain an item; decided within the scan, all columns kept."""
    for block in _blocks(benchmark, share, block_bytes):
        docs = with_leaks(docs, block).filter(F.size("_leaks") == 0).drop("_leaks")
    return docs
