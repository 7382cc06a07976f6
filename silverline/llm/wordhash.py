"""Vectorised word hashing: words and their 64-bit hashes of many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLAB_BYTES = 1 << 20     # texts are hashed in slabs of about this size; a longer text is a slab of its own

_PRIME = 0x9E3779B97F4A7C15      # odd, so it has an inverse modulo 2^64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit words (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slabs(batch: pa.RecordBatch, most: int = SLAB_BYTES):
    """(rows, texts as bytes, null as empty) of runs of rows whose texts make about ``most`` bytes.

    Only one run's texts are copied out of the batch at a time.
    """
    column = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
    end = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    first = 0
    while first < batch.num_rows:
        done = end[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(end, done + most, "right")))
        yield batch.slice(first, last - first), [t or b"" for t in column.slice(first, last - first).to_pylist()]
        first = last


class WordHasher:
    """Finds and hashes words; made once in a task, as its tables of powers are reused."""

    def __init__(self):
        byte = np.arange(256, dtype=np.uint64)
        lower = np.where((byte >= 65) & (byte <= 90), byte + np.uint64(32), byte)
        self.value = mixed((lower + np.uint64(1)) * np.uint64(_PRIME))
        self.blank = np.isin(byte, [9, 10, 11, 12, 13, 32])
        self.power = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            size = 1 << (n - 1).bit_length()
            self.power, self.inverse = (np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)])
                                        for b in (np.uint64(_PRIME), np.uint64(pow(_PRIME, -1, 1 << 64))))
            np.multiply.accumulate(self.power, out=self.power)
            np.multiply.accumulate(self.inverse, out=self.inverse)

    def words(self, buffer: np.ndarray):
        """(starts, ends, hashes) of the words of a buffer; hashes ignore the case of A-Z.

        A word's hash is a polynomial in its bytes, taken from running sums over the buffer.
        """
        edge = np.diff(self.blank[buffer].view(np.int8), prepend=1, append=1)
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self._grow(len(buffer) + 1)
        total = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(self.value[buffer] * self.power[:len(buffer)], out=total[1:])
        sums = (total[ends] - total[starts]) * self.inverse[starts]
        return starts, ends, mixed(sums + (ends - starts).astype(np.uint64))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a line feed after each, as one buffer, and where each text starts."""
    buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return buffer, starts
