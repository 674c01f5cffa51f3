"""Minimal perfect hashing of a distinct set of longs, built in buckets by Spark tasks.

In each bucket the keys are thrown into a bit array of twice their number; a place hit once
keeps its bit, and keys that met go on to the next, smaller array.  The number of a key is the
rank of its bit among all bits, so n keys get the numbers 0 to n - 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm.text import importable

#: keys of a bucket, about
BUCKET = 50_000
_STEP = 0x9E3779B97F4A7C15
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_WORD = np.uint64(63)
_ONE = np.uint64(1)


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys.view(np.uint64) + np.uint64(_STEP * (level + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _places(keys: np.ndarray, level: int, words) -> np.ndarray:
    return _mix(keys, level) % (np.asarray(words, np.uint64) << np.uint64(6))


def build_bucket(keys: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Bits of all levels as 64-bit words, words of each level, and the keys by number."""
    keys = np.ascontiguousarray(keys, np.int64)
    words, sizes, ordered = [], [], []
    while len(keys):
        size = -(-2 * len(keys) // 64)
        at = _places(keys, len(sizes), size).astype(np.int64)
        alone = np.bincount(at, minlength=size * 64)[at] == 1
        bits = np.zeros(size * 64, np.uint8)
        bits[at[alone]] = 1
        words.append(np.packbits(bits, bitorder="little").view("<u8"))
        sizes.append(size)
        ordered.append(keys[alone][np.argsort(at[alone])])
        keys = keys[~alone]
    if not sizes:
        return np.empty(0, np.uint64), [], keys
    return np.concatenate(words), sizes, np.concatenate(ordered)


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> 32) * 1_000_003 + (keys & 0xFFFFFFFF)) % buckets


@dataclass
class PerfectHash:
    """Numbers 0 to n - 1 of n keys; ``keys`` tells whether a number is that of the key asked for."""

    sizes: np.ndarray  # words of (bucket, level)
    bases: np.ndarray  # first word of (bucket, level)
    words: np.ndarray
    ranks: np.ndarray  # bits before each word
    keys: np.ndarray

    @classmethod
    def of(cls, parts: list[tuple[np.ndarray, list[int], np.ndarray]]) -> PerfectHash:
        """From the buckets in their order."""
        levels = max([1, *(len(sizes) for _, sizes, _ in parts)])
        table = np.zeros((max(1, len(parts)), levels), np.int64)
        for row, (_, sizes, _) in zip(table, parts):
            row[: len(sizes)] = sizes
        ends = np.cumsum(table.ravel()).reshape(table.shape)
        words = np.concatenate([np.empty(0, np.uint64), *(w for w, _, _ in parts)])
        counts = np.bitwise_count(words).astype(np.int64)
        keys = np.concatenate([np.empty(0, np.int64), *(k for _, _, k in parts)])
        return cls(table, ends - table, words, np.cumsum(counts) - counts, keys)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for keys that are not in the set."""
        keys = np.ascontiguousarray(keys, np.int64)
        out = np.full(len(keys), -1, np.int64)
        if not len(self.keys):
            return out
        bucket, left = _bucket_of(keys, len(self.sizes)), np.arange(len(keys))
        for level in range(self.sizes.shape[1]):
            left = left[self.sizes[bucket[left], level] > 0]
            if not len(left):
                break
            of = bucket[left]
            at = _places(keys[left], level, self.sizes[of, level])
            word = self.bases[of, level] + (at >> np.uint64(6)).astype(np.int64)
            bit = _ONE << (at & _WORD)
            held = self.words[word]
            hit = (held & bit) != 0
            below = np.bitwise_count(held & (bit - _ONE)).astype(np.int64)
            out[left[hit]] = (self.ranks[word] + below)[hit]
            left = left[~hit]
        found = out >= 0
        out[found] = np.where(self.keys[out[found]] == keys[found], out[found], -1)
        return out


def perfect_hash(keys: DataFrame, column: str, n: int, bucket: int = BUCKET) -> PerfectHash:
    """The hash of the ``n`` distinct, non-negative longs of ``column``.

    Buckets are built in tasks; bits and keys, under 9 bytes a key, come to the driver, whose
    caller bounds ``n``.
    """
    buckets = max(1, -(-n // bucket))
    importable(keys.sparkSession)
    key = F.col(column)
    # as _bucket_of
    number = F.pmod(F.shiftright(key, 32) * 1_000_003 + key.bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(buckets))

    def build(table: pa.Table) -> pa.Table:
        words, sizes, ordered = build_bucket(table.column("key").to_numpy())
        return pa.table(
            {"bucket": table.column("bucket")[:1], "words": pa.array([words.tobytes()], pa.binary()),
             "sizes": pa.array([sizes], pa.list_(pa.int64())), "keys": pa.array([ordered.tobytes()], pa.binary())}
        )

    built = keys.select(number.cast("long").alias("bucket"), key.alias("key")).groupBy("bucket").applyInArrow(
        build, "bucket bigint, words binary, sizes array<bigint>, keys binary"
    )
    parts = [(np.empty(0, np.uint64), [], np.empty(0, np.int64))] * buckets
    for row in built.toLocalIterator():
        parts[row["bucket"]] = (np.frombuffer(row["words"], np.uint64), list(row["sizes"]), np.frombuffer(row["keys"], np.int64))
    return PerfectHash.of(parts)
