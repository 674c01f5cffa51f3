"""Quality by Bradley-Terry pairwise ranking.

A document's score is linear in features of its text.  A pair of a good and a bad labelled
document says that the first should score higher; the weights minimise the logistic loss on the
feature differences of all such pairs.  The cut between keeping and rejecting is a quantile of
the scores, and the score shown is shifted so that the cut lies at ``CUT``.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm import pairwise
from fieldgauge.llm.ordering import positions
from fieldgauge.llm.text import as_bytes, importable, per_batch
from fieldgauge.session import materialise

CUT = 0.3
#: share of good fitted documents that may fall below the cut
LOSS = 0.002

_BLOCK = 256


def _classes() -> np.ndarray:
    """Byte -> 0 other, 1 lower, 2 upper, 3 digit, 4 end marks, 5 symbols, 6 bars, 7 white space."""
    kind = np.zeros(256, np.uint8)
    for number, members in enumerate(
        (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?",
         b"#$%&*+/<=>@\\^_`{}~", b"|", b" \t\n\r\x0b\x0c"), 1
    ):
        kind[list(members)] = number
    return kind


_KIND = _classes()
_N_KINDS = 8


def features(text: bytes | None) -> list[float] | None:
    """Shares of character kinds, word and line statistics and repetition, over the whole text
    and in its worst block; None for a text without words."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return None
    kinds = _KIND[np.frombuffer(text, np.uint8)]
    size = len(text)
    blocks = np.arange(0, size, _BLOCK)
    spans = np.diff(np.append(blocks, size))
    shares = np.bincount(kinds, minlength=_N_KINDS) / size
    worst = [float((np.add.reduceat(kinds == k, blocks, dtype=np.int64) / np.maximum(spans, _BLOCK)).max())
             for k in (2, 3, 4, 5, 6)]
    lengths = np.fromiter(map(len, words), np.int64, n)
    same = np.fromiter(map(eq, words, words[1:]), np.int64, n - 1) if n > 1 else np.zeros(1, np.int64)
    runs = np.add.reduceat(same, np.arange(0, len(same), 32)) / 32
    lines = text.split(b"\n")
    packed = len(zlib.compress(text, 1)) / (size + 64)
    heads = bytes(w[0] for w in words)
    capital = float((_KIND[np.frombuffer(heads, np.uint8)] == 2).mean())
    return [
        *shares[1:7].tolist(), *np.sqrt(shares[1:7]).tolist(), *worst, *np.sqrt(worst).tolist(),
        float(same.mean()), float(same.mean()) ** 0.5, float(runs.max()),
        len(set(words)) / n, (len(set(words)) / n) ** 0.5, float(np.log1p(n)), float(np.log1p(n)) ** 2 / 10,
        float(lengths.mean()), float(lengths.std()), float(lengths.max()) ** 0.5, float((lengths > 12).mean()),
        float((lengths == 1).mean()), packed, packed ** 2, capital, capital ** 0.5,
        float(np.log1p(n / len(lines))), len(set(lines)) / len(lines),
    ]


WIDTH = len(features(b"a b"))


@dataclass(frozen=True)
class Ranking:
    """Standardisation, weights and cut of a fitted ranking."""

    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    cut: float

    def standard(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - np.array(self.centre)) / np.array(self.scale), -8, 8)

    def raw(self, rows: np.ndarray) -> np.ndarray:
        # summed row by row, so that a row's score does not depend on its batch
        return (self.standard(rows) * np.array(self.weights)).sum(1)

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        """0 to 1, CUT at the cut; a text without words scores 0."""
        found = [features(t) for t in texts]
        out = np.zeros(len(texts))
        some = [i for i, f in enumerate(found) if f is not None]
        if some:
            x = self.raw(np.array([found[i] for i in some])) - self.cut + np.log(CUT / (1 - CUT))
            out[some] = 1 / (1 + np.exp(-np.clip(x, -500, 500)))
        return out


def in_fit(doc_id: Column) -> Column:
    """Rows that labels may be learnt from; the rest is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def _featured(docs: DataFrame, carried: list[str]) -> DataFrame:
    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [features(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in carried), pa.array(found, pa.list_(pa.float64()))], [*carried, "x"]
        )

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in carried) + ", x array<double>"
    return per_batch(docs.select(*carried, as_bytes()), build, schema).where("x IS NOT NULL")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, WIDTH)


def fit(docs: DataFrame, labels: DataFrame, loss: float = LOSS) -> Ranking:
    """Learn weights and cut from all labelled documents that ``in_fit`` admits.

    A document labelled twice counts as bad if any label says so; null labels and texts without
    words are not used.  Every good document is compared with every bad one.  The cut is the raw
    score of the good document that floor(``loss`` * good ones) others precede in score order.
    Without both classes nothing can be ranked: all weights are 0 and every text with words passes.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
        .where(in_fit(F.col("doc_id")) & F.col("quality").isin(0, 1))
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("good"))
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(in_fit(F.col("doc_id")))
    # labels grow with the documents: features meet them, as texts would be shuffled whole
    rows = materialise(_featured(texts, ["doc_id"]).join(known, "doc_id"), "features")
    sums = rows.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()
    count = {r["good"]: r["n"] for r in sums}
    if not count.get(0) or not count.get(1):
        return Ranking((0.0,) * WIDTH, (1.0,) * WIDTH, (0.0,) * WIDTH, 0.0)
    moments = rows.select(
        *[f(F.col("x")[i]).alias(f"{name}{i}") for name, f in (("m", F.avg), ("s", F.stddev_pop)) for i in range(WIDTH)]
    ).first()
    centre = tuple(moments[f"m{i}"] for i in range(WIDTH))
    scale = tuple(moments[f"s{i}"] or 1.0 for i in range(WIDTH))
    plain = Ranking(centre, scale, (0.0,) * WIDTH, 0.0)
    weights = pairwise.minimise(rows, lambda batch: plain.standard(_matrix(batch)), WIDTH, count[0] * count[1])
    ranking = replace(plain, weights=tuple(weights.tolist()))

    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column("good"), batch.column("doc_id"), pa.array(ranking.raw(_matrix(batch)))], ["good", "doc_id", "raw"]
        )

    # by id within equal scores, so that copies spread over tasks
    ranked = positions(per_batch(rows.where("good = 1"), build, "good int, doc_id bigint, raw double"),
                       ["good"], ["raw", "doc_id"], "i")
    return replace(ranking, cut=ranked.where(F.col("i") == int(loss * count[1])).first()["raw"])


def score(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; null, empty and blank texts score 0."""
    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = ranking.scores(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    scored = per_batch(docs.select("doc_id", as_bytes()), build, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", (~in_fit(F.col("doc_id"))).alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))


def keeps(ranking: Ranking) -> Callable[[Column], Column]:
    """A condition on texts: scored at or above the cut."""
    @F.pandas_udf("boolean")
    def passes(texts: pd.Series) -> pd.Series:
        return pd.Series(ranking.scores(list(texts)) >= CUT)

    return lambda text: passes(text.cast("binary"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    importable(docs.sparkSession)
    return docs.where(keeps(fit(docs, labels, **options))(F.col("text")))
