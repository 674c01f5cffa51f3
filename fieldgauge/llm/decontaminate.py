"""Benchmark decontamination with an Aho-Corasick automaton over test texts.

A window is 13 consecutive words of an item (a shorter item is one window).  The automaton
holds the windows over normalised text; each document is normalised, scanned once, and the
matches are mapped back to its words and to its code points.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import lru_cache, reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm.text import as_bytes, code_points, importable, per_batch, plain_words

WINDOW = 13
#: words of test text in one automaton (about 80 MB in each Python worker)
SHARD_WORDS = 20_000

_ORIGINAL_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_SCHEMA = (
    "doc_id bigint, n_words bigint, hits array<struct<first:bigint,last:bigint>>, "
    "spans array<struct<start:bigint,end:bigint>>, items array<bigint>"
)
_RANGE = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _line(words: list[bytes]) -> str:
    # one character per byte, so that offsets are byte offsets and any byte is allowed
    return " " + b" ".join(words).decode("latin-1") + " "


def windows_of(words: list[bytes], width: int) -> list[list[bytes]]:
    if not words:
        return []
    return [words[i : i + width] for i in range(max(1, len(words) - width + 1))]


@lru_cache(maxsize=2)
def _automaton(items: tuple[tuple[int | None, bytes], ...], width: int) -> ahocorasick.Automaton:
    """Kept by the Python worker, which serves many tasks."""
    owners: dict[str, set] = defaultdict(set)
    lengths: dict[str, int] = {}
    for item, text in items:
        for window in windows_of(plain_words(text), width):
            pattern = _line(window)
            owners[pattern].add(item)
            lengths[pattern] = len(window)
    automaton = ahocorasick.Automaton()
    for pattern, ids in owners.items():
        automaton.add_word(pattern, (lengths[pattern], frozenset(i for i in ids if i is not None)))
    if owners:
        automaton.make_automaton()
    return automaton


def _merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if merged and first <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(last, merged[-1][1]))
        else:
            merged.append((first, last))
    return merged


def scan(text: bytes | None, automaton: ahocorasick.Automaton):
    """Number of words, covered word ranges (inclusive), their code-point spans, item ids."""
    words = plain_words(text)
    if not words or not len(automaton):
        return len(words), [], [], []
    found, items = [], set()
    for end, (length, ids) in automaton.iter(_line(words)):
        found.append((end, length))
        items |= ids
    if not found:
        return len(words), [], [], []
    # the space after word k stands at the summed lengths up to k, each with its space
    closing = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    last = np.searchsorted(closing, [end for end, _ in found])
    ranges = _merge([(int(k) - n + 1, int(k)) for k, (_, n) in zip(last, found)])
    places = [m.span() for m in _ORIGINAL_WORD.finditer(text)]
    spans = [(code_points(text, places[a][0]), code_points(text, places[b][1])) for a, b in ranges]
    return len(words), ranges, spans, sorted(items)


def _shards(bench: DataFrame, most_words: int) -> list[tuple[tuple[int | None, bytes], ...]]:
    """Test texts in shards of bounded size; a test set is small, but may outgrow one automaton."""
    shards: list[list] = [[]]
    held = 0
    for row in bench.select("item_id", as_bytes()).distinct().toLocalIterator():
        text = bytes(row["text"] or b"")
        n = len(plain_words(text))
        if held and held + n > most_words:
            shards.append([])
            held = 0
        shards[-1].append((row["item_id"], text))
        held += n
    return [tuple(s) for s in shards]


def contamination(
    docs: DataFrame, bench: DataFrame, width: int = WINDOW, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """doc_id, n_words, hits, spans, items of every row of ``docs``.

    hits are inclusive ranges of word numbers inside occurrences of test windows, spans the same
    ranges in code points of the original text, items the sorted ids of the tests met.  Null and
    empty texts have no words and no hits; repeated rows are judged alike; an item without words
    has no window, and one without an id marks words but is not listed.  Shards beyond the
    first cost one more scan of ``docs`` each, and their results are united by document.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes())
    shards = _shards(bench, shard_words)
    if len(shards) > 1:  # rows that share an id stay apart
        slim = slim.withColumn("_row", F.monotonically_increasing_id())

    def against(items) -> DataFrame:
        held = spark.sparkContext.broadcast(items)

        def build(batch: pa.RecordBatch) -> pa.RecordBatch:
            automaton = _automaton(held.value, width)
            rows = [scan(t, automaton) for t in batch.column("text").to_pylist()]
            n, hits, spans, ids = zip(*rows)
            columns = [
                batch.column("doc_id"),
                pa.array(n, pa.int64()),
                pa.array([[{"first": a, "last": b} for a, b in h] for h in hits], _RANGE),
                pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], _SPAN),
                pa.array(ids, pa.list_(pa.int64())),
            ]
            names = ["doc_id", "n_words", "hits", "spans", "items"]
            if "_row" in batch.schema.names:
                columns.append(batch.column("_row"))
                names.append("_row")
            return pa.RecordBatch.from_arrays(columns, names)

        return per_batch(slim, build, _SCHEMA + (", _row bigint" if "_row" in slim.columns else ""))

    parts = [against(s) for s in shards]
    if len(parts) == 1:
        return parts[0]
    united = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("_row", "doc_id", "n_words")
        .agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("hits", "spans", "items")])
    )
    join = lambda c, a, b: F.expr(
        f"aggregate(array_sort({c}), cast(array() as array<struct<{a}:bigint,{b}:bigint>>), (m, x) -> "
        f"CASE WHEN size(m) > 0 AND x.{a} <= element_at(m, -1).{b} + 1 THEN "
        f"concat(slice(m, 1, size(m) - 1), array(named_struct('{a}', element_at(m, -1).{a}, "
        f"'{b}', greatest(x.{b}, element_at(m, -1).{b})))) ELSE concat(m, array(x)) END)"
    ).alias(c)
    return united.select("doc_id", "n_words", join("hits", "first", "last"), join("spans", "start", "end"),
                         F.array_sort(F.array_distinct("items")).alias("items"))


def hit_words(hits: str = "hits"):
    return F.expr(f"aggregate({hits}, 0L, (n, h) -> n + h.last - h.first + 1)")


def is_contaminated(n_hit, n_words):
    """At least a twentieth of the words are inside test windows."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def digest(found: DataFrame) -> DataFrame:
    """The counts and digests of ``contamination``'s rows."""
    n_hit = F.col("n_hit")
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.withColumn("n_hit", hit_words()).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        is_contaminated(n_hit, F.col("n_words")).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated rows, all columns kept.

    The verdict is taken in the row itself, so nothing is shuffled.
    """
    spark = docs.sparkSession
    importable(spark)
    shards = _shards(bench, options.get("shard_words", SHARD_WORDS))
    width = options.get("width", WINDOW)
    held = [spark.sparkContext.broadcast(s) for s in shards]

    @F.pandas_udf("boolean")
    def clean(texts):
        import pandas as pd

        hit: list[list] = [[] for _ in texts]
        n_words = [0] * len(texts)
        for shard in held:
            automaton = _automaton(shard.value, width)
            for i, text in enumerate(texts):
                n_words[i], ranges, _, _ = scan(text, automaton)
                hit[i] += ranges
        n_hit = [sum(b - a + 1 for a, b in _merge(h)) for h in hit]
        return pd.Series([not (h > 0 and 20 * h >= n) for h, n in zip(n_hit, n_words)], dtype=bool)

    return docs.where(clean(F.col("text").cast("binary")))
