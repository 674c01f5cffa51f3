"""Word rules and small helpers shared by the text operators.

Texts reach the Python workers as bytes: the word rules split on ASCII only, so UTF-8 needs no
decoding, and offsets become code points only where a result asks for them.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: maximal runs of anything but the ASCII white space 0x20 and 0x09-0x0D
WORD = r"[^\x20\x09-\x0D]+"

_BREAKS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_PLAIN = bytes.maketrans(bytes(range(256)), bytes(range(256)).lower())
_PLAIN = _PLAIN.translate(bytes.maketrans(_BREAKS, b" " * len(_BREAKS)))


def words(text: bytes | None) -> list[bytes]:
    """Words of ``WORD``, unchanged; null has none."""
    # bytes.split() breaks at exactly the six ASCII white-space bytes
    return text.split() if text else []


def plain_words(text: bytes | None) -> list[bytes]:
    """Words of digits, a-z and non-ASCII characters after lower-casing A-Z."""
    return text.translate(_PLAIN).split() if text else []


def count_words(text: Column) -> Column:
    """Number of ``WORD`` matches as a long; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def as_bytes(name: str = "text") -> Column:
    return F.col(name).cast("binary").alias(name)


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver found it."""
    home = str(Path(__file__).resolve().parents[2])
    given = spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in given.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [given, home]))


def per_batch(df: DataFrame, build: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``build`` on each Arrow batch of ``df``, without keeping batches."""

    importable(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield build(batch)

    return df.mapInArrow(run, schema)


def code_points(text: bytes, offset: int) -> int:
    """Code points before a byte offset that lies on a character boundary."""
    return len(text[:offset].decode("utf-8", "replace"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores put before those that ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
