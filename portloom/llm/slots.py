"""A table of one byte per hash slot, made by Spark and handed to every task.

Its size is fixed by ``SLOT_BITS`` and does not depend on the data. Tasks send their used slots as
packed numbers, one row per part of the table, which are added up part by part.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

SLOT_BITS = 24
_PARTS_BITS = 6
_PART_BITS = SLOT_BITS - _PARTS_BITS
_BUNCH = 256  # so many tasks' rows of a part are added in one place before the rest
_SCHEMA = "part int, bunch int, packed binary"


def slot_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int32)


def _pack(slots: np.ndarray, n: np.ndarray) -> bytes:
    gaps = np.diff(slots, prepend=0).astype("<u4")
    return zlib.compress(gaps.tobytes() + n.astype("<i8").tobytes(), 1)


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(packed)
    size = len(raw) // 12
    return np.cumsum(np.frombuffer(raw[: 4 * size], "<u4")), np.frombuffer(raw[4 * size :], "<i8")


def used_slots(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's own counts, for :func:`slot_table`."""
    rows = []
    for part in range(1 << _PARTS_BITS):
        own = total[part << _PART_BITS : (part + 1) << _PART_BITS]
        slots = np.flatnonzero(own)
        if len(slots):
            rows.append((part, TaskContext.get().partitionId() // _BUNCH, _pack(slots, own[slots])))
    columns = zip(*rows, strict=True) if rows else ([], [], [])
    kinds = (pa.int32(), pa.int32(), pa.binary())
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    yield pa.RecordBatch.from_arrays(arrays, names=["part", "bunch", "packed"])


def slot_table(
    df: DataFrame,
    count: Callable[[Iterator[pa.RecordBatch]], np.ndarray],
    level: Callable[[np.ndarray], np.ndarray],
) -> bytes:
    """``count`` gives the counts per slot of a task's rows, ``level`` a byte for the sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from used_slots(count(batches))

    def add(key, rows):
        total = np.zeros(1 << _PART_BITS, dtype=np.int64)
        for packed in rows["packed"].to_pylist():
            slots, n = _unpack(packed)
            total[slots] += n
        slots = np.flatnonzero(total)
        return pa.table(
            [rows["part"][:1].cast(pa.int32()), pa.array([0], pa.int32()), pa.array([_pack(slots, total[slots])], pa.binary())],
            names=["part", "bunch", "packed"],
        )

    sent = df.mapInArrow(run, _SCHEMA).groupBy("part", "bunch").applyInArrow(add, _SCHEMA)
    sums = sent.groupBy("part").applyInArrow(add, _SCHEMA).collect()  # one row per part
    table = np.zeros(1 << SLOT_BITS, dtype=np.uint8)
    for row in sums:
        slots, n = _unpack(bytes(row["packed"]))
        table[(row["part"] << _PART_BITS) + slots] = level(n)
    return table.tobytes()
