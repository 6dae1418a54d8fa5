"""Arrow batches in and out of Python tasks, cut small enough that long texts fit in memory."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BATCH_BYTES = 8 << 20


def small_batches(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose values in a text, binary or list column take about ``most`` bytes."""
    if not batch.num_rows:
        return
    values = batch.column(column)
    ends = np.asarray(values.offsets if hasattr(values, "offsets") else _offsets(values), dtype=np.int64)
    width = 4 if hasattr(values, "offsets") else 1
    place = (ends[1:] - ends[0]) * width // most
    cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def _offsets(values: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type) else np.int32
    return np.frombuffer(values.buffers()[1], dtype=kind)[values.offset : values.offset + len(values) + 1]


def with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    """The batch with a column replaced or added at the end."""
    at = {n: i for i, n in enumerate(batch.schema.names)}
    arrays, names = list(batch.columns), list(batch.schema.names)
    if name in at:
        arrays[at[name]] = values
    else:
        arrays.append(values)
        names.append(name)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def map_arrow(
    df: DataFrame,
    fn: Callable[[pa.RecordBatch], pa.RecordBatch],
    added: dict[str, T.DataType],
    sized_by: str,
) -> DataFrame:
    """``fn`` over small batches; the frame's columns stay, those of ``added`` replace or follow."""
    fields = [f if f.name not in added else T.StructField(f.name, added[f.name]) for f in df.schema.fields]
    fields += [T.StructField(n, t) for n, t in added.items() if n not in df.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, sized_by):
                yield fn(part)

    return df.mapInArrow(run, T.StructType(fields))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column and where each row begins and the last one ends."""
    ends = _offsets(column).astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return flat[ends[0] : ends[-1]], ends - ends[0]


def binary_array(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The binary column of rows that begin and end there; under 2 GB."""
    offsets = pa.py_buffer(ends.astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(flat).tobytes())])
