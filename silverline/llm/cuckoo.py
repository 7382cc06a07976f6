"""Cuckoo filter over 128-bit keys, with numpy storage and vectorised look-up."""

from __future__ import annotations

import numpy as np

SLOTS = 4
MOST_KICKS = 500


def fingerprints(low: np.ndarray) -> np.ndarray:
    """16-bit fingerprints of keys, never 0 (0 marks a free slot)."""
    f = (low & np.uint64(0xFFFF)).astype(np.uint16)
    return np.where(f == 0, np.uint16(1), f)


def other_bucket(bucket, fingerprint, buckets: int):
    """The second home of a fingerprint; its own inverse."""
    return bucket ^ ((np.asarray(fingerprint, np.int64) * 0x5BD1E995 >> 7) & (buckets - 1))


class CuckooFilter:
    """Set of 128-bit keys, as (high, low) words, without false negatives.

    ``buckets`` is a power of two; the low bits of the high word name the first
    bucket. ``insert`` returns False when the filter is too full.
    """

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    def insert(self, high: int, low: int) -> bool:
        f = int(fingerprints(np.array([low], np.uint64))[0])
        at = int(high & (self.buckets - 1))
        for home in (at, int(other_bucket(at, f, self.buckets))):
            free = np.flatnonzero(self.table[home] == 0)
            if len(free):
                self.table[home, free[0]] = f
                return True
        home = at
        for kick in range(MOST_KICKS):
            slot = kick % SLOTS
            f, self.table[home, slot] = int(self.table[home, slot]), f
            home = int(other_bucket(home, f, self.buckets))
            free = np.flatnonzero(self.table[home] == 0)
            if len(free):
                self.table[home, free[0]] = f
                return True
        return False

    def delete(self, high: int, low: int) -> bool:
        f = int(fingerprints(np.array([low], np.uint64))[0])
        at = int(high & (self.buckets - 1))
        for home in (at, int(other_bucket(at, f, self.buckets))):
            held = np.flatnonzero(self.table[home] == f)
            if len(held):
                self.table[home, held[0]] = 0
                return True
        return False


def probe(tables: np.ndarray, shard: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Which keys the filters of their shards may hold; tables: shards x buckets x slots."""
    buckets = tables.shape[1]
    f = fingerprints(low)
    first = (high & np.uint64(buckets - 1)).astype(np.int64)
    second = other_bucket(first, f, buckets)
    return (tables[shard, first] == f[:, None]).any(1) | (tables[shard, second] == f[:, None]).any(1)
