"""Document fingerprints from closed syncmers.

A k-mer of bytes is an anchor when the smallest of its inner s-mers stands at its first or last
place.  Whether it is one depends on its own bytes alone, so an edit moves no anchor elsewhere.
The fingerprint holds every distinct anchor with its first place, so it grows with the text and
a passage of a window's length leaves its anchors in it wherever it stands.  Two fingerprints
are compared by all the anchors that match in the same order.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldgauge.llm.text import importable

K = 20
S = 8
#: characters of fingerprints in one batch of results
BATCH_CHARS = 8 << 20

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_R1, _R2 = np.uint64(29), np.uint64(32)


def _stir(x: np.ndarray) -> np.ndarray:
    x = x * _M1
    x ^= x >> _R1
    x *= _M2
    x ^= x >> _R2
    return x


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the closed syncmers and their byte offsets.

    A text shorter than a k-mer is one anchor as a whole; an empty text has none.
    """
    n = len(text)
    if not n:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    if n < K:
        return np.array([int.from_bytes(hashlib.md5(text).digest()[:4], "little")], np.uint32), np.zeros(1, np.int64)
    inner = _stir(np.ndarray((n - S + 1,), "<u8", buffer=text, strides=(1,)).copy())
    width = K - S + 1
    low, span = inner, 1
    while span < width:
        step = min(span, width - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    at = np.flatnonzero((inner[: n - K + 1] == low) | (inner[width - 1 :] == low))
    # the s-mers at the ends and in the middle cover all K bytes
    whole = _stir(inner[at] + inner[at + S] * _M2 + inner[at + K - S] * _M3)
    return (whole >> _R2).astype(np.uint32), at


def sketch(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All distinct anchor hashes, ascending, and the first place of each."""
    hashes, at = anchors(text)
    values, first = np.unique(hashes, return_index=True)
    return values, at[first]


def as_string(marks: tuple[np.ndarray, np.ndarray]) -> str:
    return " ".join([f"{h:08x}@{p:x}" for h, p in zip(marks[0].tolist(), marks[1].tolist())])


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Anchors that match in order, as a share of the anchors of both together.

    Two empty fingerprints are alike (1.0).
    """
    _, in_a, in_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    union = len(a[0]) + len(b[0]) - len(in_a)
    if not union:
        return 1.0
    # places are distinct within a fingerprint
    places = b[1][in_b][np.argsort(a[1][in_a])].tolist()
    tails: list[int] = []
    for p in places:  # longest increasing chain of places in b
        if not tails or p > tails[-1]:
            tails.append(p)
        else:
            tails[bisect_left(tails, p)] = p
    return len(tails) / union


_SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(text: str, following: str, marks, next_marks) -> tuple:
    half = len(text) // 2
    edited = (text[: len(text) - half] + following[:half]).encode("utf-8", "replace")
    changed = sketch(edited)
    return (len(text), hashlib.sha256(edited).hexdigest(), as_string(marks), as_string(changed),
            likeness(marks, changed), likeness(marks, next_marks))


def _rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c) if i else pa.array(c, pa.int64()) for i, c in enumerate(zip(*out))],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; the last of a bucket is a guest, the head of the next one."""
    before = None
    for batch in batches:
        out, held = [], 0
        for bucket, guest, doc_id, text in zip(*(batch.column(c) for c in ("bucket", "guest", "doc_id", "text"))):
            bucket, guest, doc_id, text = bucket.as_py(), guest.as_py(), doc_id.as_py(), text.as_py() or ""
            marks = sketch(text.encode("utf-8", "replace"))
            if before is not None and before[0] == bucket:
                out.append((before[1], *_compare(before[2], text, before[3], marks)))
                held += len(out[-1][3]) + len(out[-1][4])
            before = None if guest else (bucket, doc_id, text, marks)
            if held >= BATCH_CHARS:
                yield _rows(out)
                out, held = [], 0
        if out:
            yield _rows(out)


def fingerprint_pairs(docs: DataFrame, per_bucket: int = 200, most_buckets: int = 20000) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how near they are.

    The edited text has its last half replaced by the first half's worth of the next document in
    descending doc_id (null last, after the last the first; rows that repeat a doc_id follow one
    another by a hash of the text).  Texts are dealt to id ranges and sorted there, one shuffle;
    the head of each range is also sent to the range above it, so no range needs another.  A
    null text is empty: no anchors, an empty fingerprint.
    """
    importable(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = slim.count()
    buckets = max(1, min(most_buckets, n // per_bucket))
    splits = np.unique(
        slim.stat.approxQuantile("doc_id", [i / buckets for i in range(1, buckets)], 0.25 / buckets)
    ) if buckets > 1 else np.empty(0)
    edges = np.asarray(splits, np.float64)

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        # a null is NaN here and belongs to the lowest range
        values = ids.to_numpy(np.float64, na_value=np.nan)
        return pd.Series(np.where(np.isnan(values), 0, np.searchsorted(edges, values, "right"))).astype("int32")

    dealt = slim.withColumn("bucket", bucket_of("doc_id"))
    heads = dealt.groupBy("bucket").agg(F.max("doc_id").alias("_head"))
    around = Window.orderBy("bucket")
    above = heads.select("_head", F.coalesce(F.lead("bucket").over(around), F.lit(None)).alias("_up"))
    lowest = heads.agg(F.min("bucket").alias("_lowest"))
    # one row per range: bounded by most_buckets
    guests = F.broadcast(above.join(F.broadcast(lowest)).select("_head", F.coalesce("_up", "_lowest").alias("_up")))
    placed = dealt.join(guests, F.col("doc_id").eqNullSafe(F.col("_head")), "left").select(
        "doc_id", "text",
        F.explode(F.when(F.col("_up").isNull(), F.array(F.struct("bucket", F.lit(False).alias("guest"))))
                  .otherwise(F.array(F.struct("bucket", F.lit(False).alias("guest")),
                                     F.struct(F.col("_up").alias("bucket"), F.lit(True).alias("guest"))))).alias("p"),
    ).select("p.bucket", "p.guest", "doc_id", "text")
    ordered = placed.repartition("bucket").sortWithinPartitions(
        "bucket", "guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text")
    )
    return ordered.mapInArrow(_neighbours, _SCHEMA)
