"""Substring dedup: suffix automata of reference shards, streamed documents, removed spans.

A window of ``length`` words that also starts earlier in the corpus is removed.  Earlier text
is the reference.  It grows with the corpus, so its shards cannot be broadcast; documents and
reference are routed to each other instead:

1. The smallest 8-gram hash inside a window is its anchor (a minimiser).  Equal windows have
   their anchor at the same offset, so a window repeats only if its anchor does.  Anchors are
   counted, and text whose anchors are single takes no further part.
2. The snippet of words around a repeated anchor, all windows that have it as theirs, goes to
   the anchor's shard.  There the snippets are streamed in corpus order through the suffix
   automaton of the shard's earlier snippets; where the matching statistic reaches ``length``
   a window occurred before.  There words are compared, not hashes.
3. Of documents with one text (by its 128-bit digest) only the first is streamed; every window
   of the others starts earlier there.
4. An anchor of very many snippets would make one large shard, which one task would have to
   stream.  It is split by whole snippets and then by the windows of different ones, each known
   by two 64-bit hashes; their first places are minima aggregated before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm.text import importable, per_batch
from fieldgauge.session import materialise

LENGTH = 20
GRAM = 8
#: snippets in one shard; shards of more are split by windows
CROWD = 2048

_NO_ID = -(1 << 63)
#: the end of a range over the whole text of a copy
_ALL = -1
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * _C
    x = (x ^ (x >> _SHIFT)) * _A
    return x ^ (x >> _SHIFT)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Sums:
    """Hashes of any slice of a sequence by prefix sums: sum of value * base**place, modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.back = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.empty(0, np.uint64)

    def slices(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(values):
            n = max(4096, 2 * len(values))
            self.up, self.down = _powers(self.base, n), _powers(self.back, n)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        return (sums[ends] - sums[starts]) * self.down[starts]


_BYTES = _Sums(0x9E3779B97F4A7C15)
_GRAMS, _WINDOWS, _CHECKS = _Sums(0xC2B2AE3D27D4EB4F), _Sums(0xD6E8FEB86659FD93), _Sums(0xA24BAED4963EE407)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUES = _stir(np.arange(1, 257, dtype=np.uint64) * _B)


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the words, ends exclusive."""
    inside = np.concatenate(([False], ~_SPACE[np.frombuffer(text, np.uint8)], [False]))
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return turns[::2], turns[1::2]


def _word_hashes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    hashes = _BYTES.slices(_VALUES[np.frombuffer(text, np.uint8)], starts, ends)
    return _stir(hashes + (ends - starts).astype(np.uint64) * _B)


def window_anchors(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window the place of its leftmost smallest gram, and all gram hashes."""
    gram = min(GRAM, length)
    at = np.arange(len(hashes) - gram + 1)
    grams = _stir(_GRAMS.slices(hashes, at, at + gram))
    # the smallest of 1, 2, 4, ... grams and its place, until the window is full
    least, place, span, width = grams, at, 1, length - gram + 1
    while span < width:
        step = min(span, width - span)
        lower = least[step:] < least[:-step]
        place = np.where(lower, place[step:], place[:-step])
        least = np.where(lower, least[step:], least[:-step])
        span += step
    return place, grams


def _anchored(text: bytes, length: int):
    """None for fewer words than a window, else word bounds, word hashes, anchors, grams."""
    starts, ends = word_bounds(text)
    if len(starts) < length:
        return None
    hashes = _word_hashes(text, starts, ends)
    return (starts, ends, hashes, *window_anchors(hashes, length))


class SuffixAutomaton:
    """All substrings of the sequences added so far, over any hashable symbols."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.len, self.last = [-1], [0], 0

    def extend(self, symbol) -> None:
        nxt, link, length = self.next, self.link, self.len
        p = self.last
        if symbol in nxt[p]:  # sequences that share a beginning share states
            q = nxt[p][symbol]
            self.last = q if length[q] == length[p] + 1 else self._split(p, q, symbol)
            return
        cur = len(nxt)
        nxt.append({})
        length.append(length[p] + 1)
        link.append(0)
        while p >= 0 and symbol not in nxt[p]:
            nxt[p][symbol] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][symbol]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, q, symbol)
        self.last = cur

    def _split(self, p: int, q: int, symbol) -> int:
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.len.append(self.len[p] + 1)
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, sequence) -> None:
        self.last = 0
        for symbol in sequence:
            self.extend(symbol)

    def matching(self, sequence) -> list[int]:
        """For each end the length of the longest suffix that occurs in what was added."""
        state = size = 0
        out = []
        for symbol in sequence:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                size = self.len[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                size += 1
            out.append(size)
        return out


class _Shard:
    """The snippets of one anchor, in corpus order."""

    def __init__(self, length: int):
        self.length, self.waiting, self.seen = length, [], set()
        self.automaton: SuffixAutomaton | None = None

    def stream(self, snippet: bytes) -> list[tuple[int, int]]:
        """Word ranges (end exclusive) of the snippet that occurred before; it is then added."""
        if snippet in self.seen:
            return [(0, snippet.count(b" ") + 1)]
        self.seen.add(snippet)
        if len(self.seen) == 1:  # most shards never see another snippet
            self.waiting.append(snippet)
            return []
        if self.automaton is None:
            self.automaton = SuffixAutomaton()
            for earlier in self.waiting:
                self.automaton.add(earlier.split())
        words = snippet.split()
        ranges: list[tuple[int, int]] = []
        fresh = False
        for end, size in enumerate(self.automaton.matching(words), 1):
            if size >= self.length:
                if ranges and end - self.length <= ranges[-1][1]:
                    ranges[-1] = (ranges[-1][0], end)
                else:
                    ranges.append((end - self.length, end))
            elif end >= self.length:
                fresh = True
        if fresh:
            self.automaton.add(words)
        return ranges


def _texts(docs: DataFrame) -> DataFrame:
    """Document key (id, 64-bit hash of the text) and text; the same plan wherever it is used."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("d"),
        F.xxhash64("text").alias("t"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )


def _anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        h, q, counts = [np.empty(0, np.int64)], [np.empty(0, np.int32)], []
        for text in batch.column("text").to_pylist():
            found = _anchored(text, length)
            # the places of successive windows never fall
            places = found[3][np.flatnonzero(np.diff(found[3], prepend=-1))] if found else np.empty(0, np.int64)
            counts.append(len(places))
            if found:
                h.append(found[4][places].view(np.int64))
                q.append(places.astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(h)), pa.array(np.repeat(batch.column("d").to_numpy(), counts)),
             pa.array(np.repeat(batch.column("t").to_numpy(), counts)), pa.array(np.concatenate(q))],
            ["h", "d", "t", "q"],
        )

    return per_batch(texts, build, "h bigint, d bigint, t bigint, q int")


def _snippets(held: DataFrame, length: int) -> DataFrame:
    """h, d, t, s (first word of the snippet), words: one row per repeated anchor of ``held``."""
    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[tuple] = []
        for d, t, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("d", "t", "text", "q"))):
            starts, ends, _, anchors, grams = _anchored(text, length)
            # the windows of one anchor are consecutive
            places, first, many = np.unique(anchors, return_index=True, return_counts=True)
            # places of another text with the same key are not among this one's
            chosen = np.flatnonzero(np.isin(places, wanted))
            line = b" ".join(text.split())
            # words keep their lengths, so a slice of the joined line is a slice of the words
            heads = np.concatenate(([0], np.cumsum(ends - starts + 1)))
            lo, hi = first[chosen], first[chosen] + many[chosen] + length - 1
            for h, s, a, b in zip(grams[places[chosen]].view(np.int64).tolist(), lo.tolist(),
                                  heads[lo].tolist(), (heads[hi] - 1).tolist()):
                rows.append((h, d, t, s, line[a:b]))
        h, d, t, s, words = zip(*rows) if rows else ((), (), (), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(h, pa.int64()), pa.array(d, pa.int64()), pa.array(t, pa.int64()), pa.array(s, pa.int32()),
             pa.array(words, pa.binary())], ["h", "d", "t", "s", "words"]
        )

    return per_batch(held, build, "h bigint, d bigint, t bigint, s int, words binary")


def _match(snippets: DataFrame, length: int) -> DataFrame:
    """Removed ranges (d, t, a, b) of snippets, by the automaton of each anchor's shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard, before = None, None, None
        for batch in batches:
            out: list[tuple] = []
            for h, d, t, s, words in zip(*(c.to_pylist() for c in batch.columns)):
                if h != held:
                    held, shard = h, _Shard(length)
                elif (d, t, s) == before:  # the same place of a repeated row
                    continue
                before = d, t, s
                out += [(d, t, s + a, s + b) for a, b in shard.stream(words)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                    ["d", "t", "a", "b"],
                )

    importable(snippets.sparkSession)
    # rows that repeat a document are one document
    routed = snippets.repartition("h").sortWithinPartitions("h", "d", "t", "s")
    return routed.mapInArrow(run, "d bigint, t bigint, a int, b int")


def _crowded_snippets(held: DataFrame, length: int) -> DataFrame:
    """The snippets of crowded anchors: two hashes of the whole and of each of its windows."""
    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        whole, inside, places, counts, sizes = [], [], [], [], []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("q").to_pylist()):
            _, _, hashes, anchors, _ = _anchored(text, length)
            checks = _stir(hashes)
            s = np.flatnonzero(np.isin(anchors, wanted))
            _, first, many = np.unique(anchors[s], return_index=True, return_counts=True)
            lo, hi = s[first], s[first] + many - 1 + length
            whole.append((_WINDOWS.slices(hashes, lo, hi), _CHECKS.slices(checks, lo, hi)))
            inside.append((_WINDOWS.slices(hashes, s, s + length), _CHECKS.slices(checks, s, s + length)))
            places.append(lo)
            sizes.append(many)
            counts.append(len(lo))
        c, e = (pa.array(np.concatenate(x).view(np.int64)) for x in zip(*whole))
        ends = pa.array(np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype(np.int32))
        w, v = (pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x).view(np.int64))) for x in zip(*inside))
        return pa.RecordBatch.from_arrays(
            [c, e, pa.array(np.repeat(batch.column("d").to_numpy(), counts)),
             pa.array(np.repeat(batch.column("t").to_numpy(), counts)),
             pa.array(np.concatenate(places).astype(np.int32)), w, v],
            ["c", "e", "d", "t", "s", "w", "v"],
        )

    return per_batch(held, build, "c bigint, e bigint, d bigint, t bigint, s int, w array<bigint>, v array<bigint>")


def _later(rows: DataFrame, firsts: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of each key but the one in the first place."""
    repeated = firsts.where(F.col("first") != F.col("last")).select(*keys, "first")
    return rows.join(repeated, keys).where(F.struct("d", "t", "s") != F.col("first"))


def _split(snippets: DataFrame, length: int) -> DataFrame:
    """Removed ranges of crowded snippets.

    Of equal snippets only the first can hold a window that is new, so the windows of the
    different ones alone are compared.
    """
    place = F.struct("d", "t", "s")
    ends = [F.min(place).alias("first"), F.max(place).alias("last")]
    different = snippets.groupBy("c", "e").agg(*ends, F.first("w").alias("w"), F.first("v").alias("v"))
    copies = _later(snippets, different, ["c", "e"])
    windows = different.select("first.*", F.posexplode(F.arrays_zip("w", "v")).alias("at", "x")).select(
        "d", "t", (F.col("s") + F.col("at")).alias("s"), "x.w", "x.v"
    )
    later = _later(windows, windows.groupBy("w", "v").agg(*ends), ["w", "v"])
    return copies.select("d", "t", F.col("s").alias("a"), (F.col("s") + F.size("w") - 1 + length).alias("b")).unionAll(
        later.select("d", "t", F.col("s").alias("a"), (F.col("s") + length).alias("b"))
    )


_RANGES = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def _copies(texts: DataFrame) -> DataFrame:
    """Documents (_d, _t) whose whole text is also that of an earlier document."""
    place = F.struct("d", "t")
    slim = texts.select("d", "t", F.unhex(F.md5("text")).alias("m"))
    firsts = slim.groupBy("m").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(
        F.col("first") != F.col("last")
    ).select("m", "first")
    later = slim.join(firsts, "m").where(place != F.col("first"))
    return later.select(F.col("d").alias("_d"), F.col("t").alias("_t")).distinct()


def _cut(joined: DataFrame, length: int) -> DataFrame:
    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, gone, kept, ranges = [], [], [], []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist()):
            words = text.split()
            merged: list[list[int]] = []
            spans = sorted((f["a"], f["b"]) for f in found or ())
            if spans and spans[0][1] == _ALL:
                spans = [(0, len(words))] if len(words) >= length else []
            for a, b in spans:
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            left, at = [], 0
            for a, b in merged:
                left += words[at:a]
                at = b
            left += words[at:]
            n.append(len(words))
            gone.append(len(words) - len(left))
            kept.append(b" ".join(left).decode("utf-8", "replace"))
            ranges.append([{"first": a, "last": b - 1} for a, b in merged])
        return pa.RecordBatch.from_arrays(
            [batch.column("d"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(ranges, _RANGES), pa.array(kept)],
            ["d", "n_words", "n_removed", "removed", "kept"],
        )

    return per_batch(
        joined, build,
        "d bigint, n_words bigint, n_removed bigint, removed array<struct<first:bigint,last:bigint>>, kept string",
    )


def dedup_substrings(docs: DataFrame, length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_words, n_removed, removed (maximal word ranges, inclusive), kept (the text).

    Every row of ``docs`` is returned.  A word goes when a window of ``length`` words over it
    also starts earlier: in a smaller doc_id (null smallest), or in the same document further
    up; all windows are judged on the input.  Texts with fewer words keep them all; null and
    empty texts have none.  Rows that repeat doc_id and text are one document with one result;
    different texts under one doc_id follow in the order of a hash.  Kept words are joined by
    one space.
    """
    texts = _texts(docs)
    anchors = _anchor_rows(texts, length)
    # written first, so that the join deals both sides anew and a hot anchor can be split
    places = materialise(
        anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumnRenamed("h", "_h"), "anchors"
    )
    repeated = anchors.join(places, F.col("h") == F.col("_h")).groupBy("d", "t").agg(
        F.collect_list(F.when(F.col("n") <= crowd, F.col("q"))).alias("few"),
        F.collect_list(F.when(F.col("n") > crowd, F.col("q"))).alias("many"),
    ).select(F.col("d").alias("_d"), F.col("t").alias("_t"), "few", "many")
    same = (F.col("d") == F.col("_d")) & (F.col("t") == F.col("_t"))
    copies = _copies(texts)
    held = texts.join(repeated.join(copies, ["_d", "_t"], "left_anti"), same)
    few = held.where(F.size("few") > 0).select("d", "t", "text", F.col("few").alias("q"))
    many = held.where(F.size("many") > 0).select("d", "t", "text", F.col("many").alias("q"))
    found = _match(_snippets(few, length), length).unionAll(_split(_crowded_snippets(many, length), length)).unionAll(
        copies.select(F.col("_d").alias("d"), F.col("_t").alias("t"), F.lit(0).alias("a"), F.lit(_ALL).alias("b"))
    )
    ranges = found.groupBy("d", "t").agg(F.collect_list(F.struct("a", "b")).alias("found")).select(
        F.col("d").alias("_d"), F.col("t").alias("_t"), "found"
    )
    cut = _cut(texts.join(ranges, same, "left").select("d", "t", "text", "found"), length)
    return cut.select(F.when(F.col("d") != F.lit(_NO_ID), F.col("d")).alias("doc_id"),
                      "n_words", "n_removed", "removed", "kept")
