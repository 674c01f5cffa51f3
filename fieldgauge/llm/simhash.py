"""SimHash near-duplicates within a Hamming radius, by the generalised pigeonhole principle.

64 bits are cut into parts.  If two fingerprints differ in at most ``r`` bits, some part ``i``
differs in at most ``t_i`` bits whenever ``sum(t_i + 1) = r + 1``.  Bits that move together go
into one part; the thresholds, -1 for a part that is not probed, are allocated by dynamic
programming on the numbers of probes and candidates.  Both are judged from all fingerprints:
counts of set pairs of bits and of the values of ``PIECE`` bits are summed over the whole table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldgauge.llm.components import components
from fieldgauge.llm.text import as_bytes, importable, per_batch, unused, words
from fieldgauge.session import materialise

SHINGLE = 3
SEED = 42
BITS = 64
RADIUS = 3
#: bits whose values are counted together, 2 ** PIECE of them
PIECE = 8
#: above so many fingerprints with one part value, balls are joined instead of pairs: as many as a
#: fingerprint has points, so that a probe never meets more candidates than it would make points
CROWD = sum(comb(BITS, k) for k in range(RADIUS - RADIUS // 2 + 1))

_ONE = np.uint64(1)
#: bits in which each value of a piece differs from each
_GAPS = np.bitwise_count(np.arange(1 << PIECE)[:, None] ^ np.arange(1 << PIECE)).ravel()


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Majority bits over the shingles' hashes, repeats included; no words give 0.

    Fewer words than a shingle make one shingle.  A bit set in exactly half is 0.
    """
    found = words(text.lower() if text else None)
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(found) <= shingle:
        return digest(b" ".join(found), SEED)
    # shingles are slices of the words joined by one space
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    ones = np.zeros(BITS, np.int64)
    total = len(starts)
    for at in range(0, total, 65536):
        stop = min(at + 65536, total)
        hashes = np.fromiter(
            (digest(line[a:b], SEED) for a, b in zip(starts[at:stop], stops[at:stop])), "<u8", stop - at
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int((_ONE << np.arange(BITS, dtype=np.uint64))[2 * ones > total].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, print (the fingerprint as a signed long) of every row; null texts have no words."""

    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "print"])

    return per_batch(docs.select("doc_id", as_bytes()), build, f"doc_id {dict(docs.dtypes)['doc_id']}, print bigint")


def _bits(prints: np.ndarray) -> np.ndarray:
    """One row per fingerprint, one column per bit."""
    return np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _totals(prints: DataFrame | np.ndarray, count: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``count`` of all fingerprints; those of a table are counted in its tasks and summed by cell."""
    if not isinstance(prints, DataFrame):
        return count(prints)
    zero = count(np.zeros(0, np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = zero.copy()
        for batch in batches:
            held += count(batch.column("print").to_numpy().view(np.uint64))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held.ravel()[some])], ["cell", "held"])

    importable(prints.sparkSession)
    tasks = 2 * max(1, prints.sparkSession.sparkContext.defaultParallelism)
    counted = prints.select("print").coalesce(tasks).mapInArrow(run, "cell bigint, held bigint")
    total = np.zeros(zero.size, np.int64)
    for cell, held in counted.groupBy("cell").agg(F.sum("held")).collect():
        total[cell] = held
    return total.reshape(zero.shape)


def _together(prints: np.ndarray) -> np.ndarray:
    """Fingerprints in which both of two bits are set; a last bit is set in all."""
    rows = np.hstack([_bits(prints), np.ones((len(prints), 1))])
    return np.rint(rows.T @ rows).astype(np.int64)


def _strength(together: np.ndarray) -> np.ndarray:
    """Absolute correlation of each two bits, 0 with themselves and for bits that never change."""
    share = together / max(1, together[-1, -1])
    mean = share[-1, :-1]
    spread = np.sqrt(mean * (1 - mean))
    spread = np.where(spread > 0, spread, 1)
    strength = np.abs(share[:-1, :-1] - np.outer(mean, mean)) / np.outer(spread, spread)
    np.fill_diagonal(strength, 0)
    return strength


def _group_bits(strength: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of near-equal size; a bit joins the group it is most correlated with."""
    sizes = [BITS // parts + (i < BITS % parts) for i in range(parts)]
    left, groups = set(range(BITS)), []
    for size in sizes:
        pool = sorted(left)
        group = [max(pool, key=lambda b: (strength[b, pool].sum(), -b))]
        left.discard(group[0])
        while len(group) < size:
            group.append(max(sorted(left), key=lambda b: (strength[b, group].sum(), -b)))
            left.discard(group[-1])
        groups.append(group)
    return groups


def _pieces(bits: list[int]) -> list[tuple[int, ...]]:
    return [tuple(bits[at : at + PIECE]) for at in range(0, len(bits), PIECE)]


def _values(prints: np.ndarray, pieces: list[tuple[int, ...]]) -> np.ndarray:
    """One row per piece: how many fingerprints hold each value of its bits."""
    rows = _bits(prints)
    return np.array([
        np.bincount(np.packbits(rows[:, piece], axis=1, bitorder="little")[:, 0], minlength=1 << PIECE)
        for piece in pieces
    ])


def _apart(held: np.ndarray) -> np.ndarray:
    """Share of all pairs of fingerprints that differ in 0 to ``PIECE`` bits of a piece."""
    held = held.astype(float)
    n = held.sum()
    pairs = np.bincount(_GAPS, np.outer(held, held).ravel())
    pairs[0] -= n
    return pairs / max(1.0, n * (n - 1))


def _equal(prints: DataFrame | np.ndarray, groups: list[list[int]]) -> list[int]:
    """For each group of bits, twice the pairs of fingerprints that are equal there."""
    if not isinstance(prints, DataFrame):
        held = [np.unique(prints & np.uint64(_mask(bits)), return_counts=True)[1] for bits in groups]
        return [int((c * (c - 1)).sum()) for c in held]
    masks = F.array(*[F.lit(_signed(_mask(bits))).cast("long") for bits in groups])
    keys = prints.select("print", F.posexplode(masks).alias("group", "mask"))
    held = keys.groupBy("group", F.col("print").bitwiseAND(F.col("mask")).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    pairs = dict(held.groupBy("group").agg(F.sum(F.col("n") * (F.col("n") - 1))).collect())
    return [pairs.get(at, 0) for at in range(len(groups))]


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def allocate(prints: DataFrame | np.ndarray, n: int, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the parts to probe, for ``n`` distinct fingerprints like ``prints``.

    For 1 to ``radius + 1`` parts, ``radius + 1`` units are dealt to the parts; a part with
    ``u`` units has threshold ``u - 1``.  The cost of a part is its probes plus its candidates.
    How many pairs of all ``prints`` are equal in a part is counted, and how many differ in so
    many bits is exact for each piece of a part; beyond that pieces are taken as independent.
    The plan changes the cost and never the result.
    """
    together = _totals(prints, _together)
    strength, seen = _strength(together), int(together[-1, -1])
    groupings = [_group_bits(strength, parts) for parts in range(1, radius + 2)]
    pieces = sorted({piece for groups in groupings for bits in groups for piece in _pieces(bits)})
    held = _totals(prints, lambda some: _values(some, pieces))
    apart = {piece: _apart(row) for piece, row in zip(pieces, held)}
    equal = iter(_equal(prints, [bits for groups in groupings for bits in groups]))
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for groups in groupings:
        cost = []
        for bits in groups:
            gap = np.ones(1)
            for piece in _pieces(bits):
                gap = np.convolve(gap, apart[piece])
            same = next(equal) / max(1, seen * (seen - 1))
            row = [0.0]
            for t in range(min(radius, len(bits)) + 1):
                near = max(same, float(gap[: t + 1].sum()))
                random = sum(comb(len(bits), k) for k in range(t + 1)) / 2.0 ** len(bits)
                probes = sum(comb(len(bits), k) for k in range(t + 1))
                row.append(n * probes + n * n / 2 * max(near, random))
            cost.append(row)
        # least cost of dealing u units to the parts so far
        table: list[tuple[float, list[int]]] = [(0.0, [])] + [(float("inf"), [])] * (radius + 1)
        for row in cost:
            table = [
                min(
                    ((table[u - k][0] + row[k], [*table[u - k][1], k]) for k in range(min(u, len(row) - 1) + 1)),
                    key=lambda x: x[0],
                )
                for u in range(radius + 2)
            ]
        total, units = table[radius + 1]
        if best is None or total < best[0]:
            best = (total, [(g, k - 1) for g, k in zip(groups, units) if k > 0])
    return best[1]


def _flips(bits: list[int], most: int) -> list[int]:
    """Signed masks of up to ``most`` of ``bits``, the empty one first."""
    masks = [_mask(list(c)) for k in range(most + 1) for c in combinations(bits, k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _masks(bits: list[int], most: int):
    """``_flips`` as one literal array."""
    return F.split(F.lit(",".join(map(str, _flips(bits, most)))), ",").cast("array<bigint>")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_links(prints: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that connect the distinct ``print`` values within ``radius`` bits.

    Two prints are connected through links exactly when a chain of prints within the radius
    joins them.  For each probed part, prints are
    indexed by their bits there and probed with up to ``t`` of those bits flipped; candidates
    are verified on all bits.  Spark takes probes and points for as few as the prints they come
    from, so both are merged by sorting and never broadcast.  Part values held by more than ``crowd`` prints would make pairs
    quadratic, so there prints meet at points instead: ``a`` and ``b`` lie within ``radius``
    bits exactly when some point is within ``radius // 2`` of one and ``radius - radius // 2``
    of the other.  All prints within the larger distance of a point belong together as soon as
    one lies within the smaller, so each links to the point's first such print, and the number
    of links follows the prints.
    """
    distinct = materialise(prints.select("print").distinct(), "prints")
    plan = allocate(distinct, distinct.count(), radius)
    found = []
    for bits, threshold in plan:
        mask = F.lit(_signed(_mask(bits)))
        key = F.col("print").bitwiseAND(mask)
        index = distinct.select("print", key.alias("key"))
        crowded = materialise(
            index.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > crowd).select("key"),
            "crowds",
        )
        # a print within reach of a crowded value meets it at points
        reach = distinct.select("print", F.explode(_masks(bits, threshold)).alias("_flip")).select(
            "print", F.col("print").bitwiseXOR(F.col("_flip")).bitwiseAND(mask).alias("key")
        )
        sparse = index.join(crowded, "key", "left_anti")
        pairs = (
            sparse.withColumnRenamed("print", "b")
            .join(reach.withColumnRenamed("print", "a").hint("merge"), "key")
            .where((F.col("a") != F.col("b"))
                   & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
            .select("a", "b")
        )
        found.append(pairs)
        if crowded.isEmpty():
            continue
        visitors = reach.join(crowded, "key", "left_semi").select("print", "key")
        # holders of one value differ in the other bits only
        free = [b for b in range(BITS) if threshold or b not in bits]
        found.append(_meet(visitors, radius, free))
    links = found[0]
    for more in found[1:]:
        links = links.unionAll(more)
    return links


def _meet(visitors: DataFrame, radius: int, bits: list[int]) -> DataFrame:
    """Links of prints that visit the same crowded value, through points that differ in ``bits``.

    The prints at a point are at most as many as a print has points, so a window holds them.
    """
    near, far = radius // 2, radius - radius // 2
    inner = len(_flips(bits, near))
    points = visitors.select("print").distinct().select(
        "print", F.posexplode(_masks(bits, far)).alias("_at", "_mask")
    ).select("print", F.col("print").bitwiseXOR(F.col("_mask")).alias("point"), (F.col("_at") < inner).alias("close"))
    first = F.min(F.when(F.col("close"), F.col("print"))).over(Window.partitionBy("point"))
    return points.select(F.col("print").alias("a"), first.alias("b")).where("a != b").distinct()


def _print_components(marked: DataFrame, radius: int, **options) -> DataFrame:
    """print, component: the group of every distinct fingerprint, named by one of its prints."""
    reached = components(near_links(marked, radius, **options))
    prints = marked.select("print").distinct()
    return prints.join(reached, F.col("print") == F.col("node"), "left").select(
        "print", F.coalesce("component", "print").alias("component")
    )


def near_duplicates(docs: DataFrame, radius: int = RADIUS, **options) -> DataFrame:
    """doc_id, print, component_id of every row.

    component_id is the smallest doc_id reachable over fingerprints within ``radius`` bits, the
    row's own included.  Equal fingerprints are one node, so copies cost no links; texts
    without words have fingerprint 0 and link like any other.  A null doc_id never names a
    component unless all ids there are null; repeated rows share a component.
    """
    marked = materialise(fingerprints(docs), "fingerprints")
    first = marked.groupBy("print").agg(F.min("doc_id").alias("first"))
    together = first.join(_print_components(marked, radius, **options).withColumnRenamed("print", "_print"),
                          F.col("print") == F.col("_print"))
    named = together.groupBy("component").agg(F.min("first").alias("component_id"))
    of_print = together.join(named, "component").select("_print", "component_id")
    return marked.join(of_print, F.col("print") == F.col("_print")).select("doc_id", "print", "component_id")


def keep_first(docs: DataFrame, radius: int = RADIUS, **options) -> DataFrame:
    """The row of each near-duplicate group with the smallest doc_id, all columns kept.

    Null ids come last; rows that share an id are told apart by a hash of their texts, and of
    rows equal in both one stays.
    """
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    marked = materialise(
        fingerprints(docs.select(F.struct(F.col("doc_id").cast("long").alias("id"), key.alias("key")).alias("doc_id"), "text")),
        "fingerprints",
    ).select("doc_id.id", "doc_id.key", "print")
    groups = _print_components(marked, radius, **options).withColumnRenamed("print", "_print")
    first_id, first_key = unused(docs, "_id", "_key")
    first = marked.join(groups, F.col("print") == F.col("_print")).groupBy("component").agg(
        F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "key")).alias("first")
    ).select(F.col("first.id").alias(first_id), F.col("first.key").alias(first_key))
    kept = docs.join(first, F.col("doc_id").eqNullSafe(F.col(first_id)) & (key == F.col(first_key)), "left_semi")
    if marked.groupBy("id", "key").count().where("count > 1").isEmpty():
        return kept
    return kept.withColumn(first_key, key).dropDuplicates(["doc_id", first_key]).drop(first_key)
