"""Sums of numeric blocks that tasks have made, added up in two levels.

A task reduces its rows to blocks of numbers, as a matrix of products or a histogram. Blocks of one key meet first
by bucket of the task that made them and then all buckets of a key, so neither step gathers more than about the
square root of the number of tasks, and what is shuffled are whole blocks, not their cells.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: A task's blocks go to one of so many buckets; a million tasks bring a thousand blocks to a bucket.
BUCKETS = 1024


def bucket() -> int:
    """The bucket of the running task."""
    return TaskContext.get().partitionId() % BUCKETS


def tree_sum(parts: DataFrame, keys: Sequence[str], dtype: str) -> DataFrame:
    """(*keys, data): the sum of the blocks ``data`` of each key; parts are (*keys, bucket int, data binary) of one length.

    ``dtype`` is the NumPy type of the numbers. Keys are whole numbers, and their blocks must fit a task.
    """
    keys = list(keys)

    def add(names: list[str]):
        def run(table: pa.Table) -> pa.Table:
            total = None
            for block in table.column("data").to_pylist():
                own = np.frombuffer(block, dtype=dtype)
                total = own.copy() if total is None else np.add(total, own, out=total)
            return pa.table({**{n: table.column(n).slice(0, 1) for n in names}, "data": pa.array([total.tobytes()], pa.binary())})
        return run

    kinds = {f.name: f.dataType.simpleString() for f in parts.schema.fields}
    out = parts
    for names in ([*keys, "bucket"], keys):
        schema = ", ".join(f"{n} {kinds[n]}" for n in names) + ", data binary"
        out = out.groupBy(*names).applyInArrow(add(names), schema)
    return out
