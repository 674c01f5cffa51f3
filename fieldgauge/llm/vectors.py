"""Dense vectors summed over tasks in a tree, one block of entries at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm.text import importable

#: entries of a block (512 kB) and vectors that one task of the tree adds up
BLOCK = 65_536
FAN = 16

#: task is the number of the vector that the block belongs to
SCHEMA = "task bigint, block int, body binary"


def blocks(vector: np.ndarray, task: int) -> Iterator[pa.RecordBatch]:
    """The rows of one task's vector."""
    for block in range(-(-len(vector) // BLOCK)):
        body = np.ascontiguousarray(vector[block * BLOCK : (block + 1) * BLOCK]).tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([task], pa.int64()), pa.array([block], pa.int32()), pa.array([body], pa.binary())],
            ["task", "block", "body"],
        )


def tree_sum(parts: DataFrame, tasks: int, length: int, dtype: str) -> np.ndarray:
    """The sum of the vectors of tasks 0 to ``tasks`` - 1, rows as made by ``blocks``.

    ``FAN`` vectors are added per round, block by block, so a task holds ``FAN`` blocks at most,
    however many tasks there are and however long the vector is.  The caller bounds ``length``:
    the sum itself comes to the driver.  Tasks without rows count as zero.
    """
    importable(parts.sparkSession)

    def add(table: pa.Table) -> pa.Table:
        total = None
        for body in table.column("body"):
            one = np.frombuffer(body.as_py(), dtype)
            total = one.copy() if total is None else total + one
        return pa.table(
            {"task": pa.array([table.column("task")[0].as_py() // FAN], pa.int64()), "block": table.column("block")[:1],
             "body": pa.array([total.tobytes()], pa.binary())}
        )

    while True:
        node = F.floor(F.col("task") / FAN).alias("node")
        parts = parts.groupBy(node, "block").applyInArrow(add, SCHEMA)
        tasks = -(-tasks // FAN)
        if tasks <= 1:
            break
    total = np.zeros(length, dtype)
    for row in parts.toLocalIterator():
        at = row["block"] * BLOCK
        one = np.frombuffer(row["body"], dtype)
        total[at : at + len(one)] = one
    return total
