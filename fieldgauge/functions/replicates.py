"""Labels of sites drawn anew for many replicates, and the rank statistic of each.

The work of one task, in Arrow batches: rows come sorted by chunk, stratum and site, one stratum
is held at a time, and of each replicate only sums by cell and label are kept.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# ship these small functions with the task, so workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: where Spark's xxhash64() starts
START = 42
P1, P2, P3, P4, P5 = map(np.uint64, (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
))


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def hasher(rows: np.ndarray) -> Callable[[int], np.ndarray]:
    """A function of the seed: XXH64 of each row of bytes, as Spark's xxhash64() takes it for one value."""
    n, width = rows.shape
    stripes = width // 32
    words = np.ascontiguousarray(rows[:, : width & -8]).view("<u8").T.copy()
    turned = _turn(words * P2, 31) * P1
    at = width & -8
    four = np.ascontiguousarray(rows[:, at : at + 4]).view("<u4")[:, 0].astype(np.uint64) * P1 if width - at >= 4 else None
    rest = rows[:, at + 4 * (four is not None) :].T.astype(np.uint64) * P5

    def run(seed: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            start = np.uint64(seed)
            if stripes:
                lanes = [np.full(n, v) for v in (start + P1 + P2, start + P2, start, start - P1)]
                for i in range(4 * stripes):
                    lanes[i % 4] = _turn(lanes[i % 4] + words[i] * P2, 31) * P1
                h = sum(_turn(v, k) for v, k in zip(lanes, (1, 7, 12, 18)))
                for v in lanes:
                    h = (h ^ (_turn(v * P2, 31) * P1)) * P1 + P4
            else:
                h = np.full(n, start + P5)
            h = h + np.uint64(width)
            for word in turned[4 * stripes :]:
                h = _turn(h ^ word, 27) * P1 + P4
            if four is not None:
                h = _turn(h ^ four, 23) * P2 + P3
            for byte in rest:
                h = _turn(h ^ byte, 11) * P1
            h = (h ^ (h >> np.uint64(33))) * P2
            h = (h ^ (h >> np.uint64(29))) * P3
            return h ^ (h >> np.uint64(32))

    return run


def _fixed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray | list[bytes]]:
    """Places of the values that are not NULL, and the bytes that Spark hashes of them."""
    kind, types = column.type, pa.types
    places = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    known = column.drop_null()
    if types.is_string(kind) or types.is_large_string(kind):
        return places, [v.encode() for v in known.to_pylist()]
    if types.is_binary(kind) or types.is_large_binary(kind):
        return places, known.to_pylist()
    if types.is_decimal(kind):
        whole = [int(v.scaleb(kind.scale)) for v in known.to_pylist()]
        if kind.precision <= 18:
            return places, _fixed(np.array(whole, "<i8"))
        return places, [v.to_bytes((v if v >= 0 else ~v).bit_length() // 8 + 1, "big", signed=True) for v in whole]
    if types.is_floating(kind):
        found = known.to_numpy(zero_copy_only=False) + kind.to_pandas_dtype()(0)  # no negative zero
        found[np.isnan(found)] = np.nan  # one kind of NaN
        return places, _fixed(found)
    if types.is_timestamp(kind):
        return places, _fixed(known.cast(pa.int64()).to_numpy(zero_copy_only=False))
    if types.is_date32(kind):
        known = known.cast(pa.int32())
    elif not (types.is_boolean(kind) or types.is_integer(kind)):
        raise TypeError(f"sites cannot be of type {kind}")
    found = known.to_numpy(zero_copy_only=False)
    return places, _fixed(found.astype("<i8" if found.dtype.itemsize == 8 else "<i4"))


def site_hashes(column: pa.Array) -> Callable[[int], np.ndarray]:
    """A function of the seed: Spark's xxhash64() of each site as a signed long; NULL leaves the seed."""
    places, found = _bytes_of(column)
    if isinstance(found, list):
        lengths = np.array([len(v) for v in found], np.int64)
        groups = [np.flatnonzero(lengths == w) for w in np.unique(lengths)]
        parts = [
            (places[g], hasher(np.frombuffer(b"".join(found[i] for i in g), np.uint8).reshape(len(g), -1) if lengths[g[0]]
                               else np.zeros((len(g), 0), np.uint8)))
            for g in groups
        ]
    else:
        parts = [(places, hasher(found))]

    def run(seed: int) -> np.ndarray:
        out = np.full(len(column), np.uint64(seed))
        for at, hashed in parts:
            out[at] = hashed(seed)
        return out.view(np.int64)

    return run


def replicate_seed(seed: int, replicate: int) -> int:
    """xxhash64(seed, replicate), from which the hash of a site goes on."""
    state = START
    for value in (seed, replicate):
        kind = "<i4" if -(2**31) <= value < 2**31 else "<i8"
        state = int(hasher(_fixed(np.array([value], kind)))(state)[0])
    return state


def _plain(value):
    """Equal for values that Spark groups together."""
    if isinstance(value, float):
        return "NaN" if value != value else value + 0.0
    return value


def _strata(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """(chunk, rows) of each chunk and stratum, which lie in the first two columns."""
    held, name = [], None
    for batch in batches:
        keys = [(a, _plain(b)) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        at = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[at]:
                continue
            if held and keys[at] != name:
                yield name[0], pa.Table.from_batches(held)
                held = []
            name = keys[at]
            held.append(batch.slice(at, i - at))
            at = i
    if held:
        yield name[0], pa.Table.from_batches(held)


class _Sums:
    """Rows and sums of z by replicate, label and cell; labels and cells are numbered as they come."""

    def __init__(self, first: int, last: int):
        self.first, self.replicates = first, last - first
        self.labels, self.cells, self.shown = {}, {}, []
        self.rows, self.z = np.zeros((self.replicates, 0, 0)), np.zeros((self.replicates, 0, 0))

    def room(self) -> None:
        more = len(self.labels) - self.z.shape[1], len(self.cells) - self.z.shape[2]
        if any(more):
            wider = ((0, 0), (0, more[0]), (0, more[1]))
            self.rows, self.z = np.pad(self.rows, wider), np.pad(self.z, wider)

    def add(self, stratum: pa.Table, seeds: list[int]) -> None:
        """The replicates of one stratum: its sites in hash order take its labels in turn."""
        _, _, sites, steps, cells = (pa.concat_arrays(c.chunks) for c in stratum.columns)
        n = len(sites)
        lengths = cells.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        *keys, z = cells.flatten().flatten()
        z = z.to_numpy(zero_copy_only=False).astype(float)
        code = np.zeros(len(z), np.int64)
        for key in keys:
            found = key.dictionary_encode(null_encoding="encode")
            code = code * max(1, len(found.dictionary)) + found.indices.to_numpy(zero_copy_only=False)
        _, examples, code = np.unique(code, return_index=True, return_inverse=True)
        numbers = []
        for i in examples:
            shown = tuple(key[int(i)].as_py() for key in keys)
            name = tuple(map(_plain, shown))
            if name not in self.cells:
                self.shown.append(shown)
            numbers.append(self.cells.setdefault(name, len(self.cells)))
        steps = steps[0].as_py()
        labels = np.array([self.labels.setdefault(_plain(s["label"]), len(self.labels)) for s in steps])
        self.room()
        _, height, width = self.z.shape
        slots = labels[np.searchsorted([s["upto"] for s in steps], np.arange(1, n + 1))] * width
        cell = np.array(numbers, np.int64)[code]
        owner = np.repeat(np.arange(n), lengths)
        hashed = site_hashes(sites)
        given = np.empty(n, np.int64)
        for r, seed in enumerate(seeds):
            given[np.argsort(hashed(seed), kind="stable")] = slots
            at = given[owner] + cell
            self.z[r] += np.bincount(at, z, height * width).reshape(height, width)
            self.rows[r] += np.bincount(at, minlength=height * width).reshape(height, width)

    def h(self) -> np.ndarray:
        """Sum over labels of (sum of z)^2 / n, by replicate and cell; NaN where z is."""
        return np.where(self.rows > 0, self.z * self.z / np.maximum(self.rows, 1), 0).sum(1)


def null_statistics(by: pa.Schema, seed: int, chunk: int, replicates: int):
    """A function for ``mapInArrow``: rows (chunk, stratum, site, steps, cells) to one row per chunk
    and cell with ``_h``, the statistic in each replicate of the chunk; it is empty where z is NULL."""

    def shown(sums: _Sums) -> pa.RecordBatch:
        h = sums.h().T
        columns = [pa.array([s[i] for s in sums.shown], field.type) for i, field in enumerate(by)]
        lists = pa.array([[] if np.isnan(row).any() else row for row in h], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([*columns, lists], [*by.names, "_h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, sums, seeds = None, None, []
        for found, stratum in _strata(batches):
            if found != number:
                if sums is not None:
                    yield shown(sums)
                number, first = found, found * chunk
                last = min(first + chunk, replicates)
                sums, seeds = _Sums(first, last), [replicate_seed(seed, r) for r in range(first, last)]
            sums.add(stratum, seeds)
        if sums is not None:
            yield shown(sums)

    return run
