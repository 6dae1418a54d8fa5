"""Best-fit decreasing packing of documents into sequences of fixed capacity.

Only lengths matter to the packing and there are at most ``capacity`` of them, so the plan is made
from the number of pieces of each length: from the longest on, a segment tree over the remaining
capacities finds the tightest open bins in logarithmic time, and all pieces of a length that go to
such bins one after the other are placed as one run. The runs equal what best-fit decreasing does
piece by piece; their number is bounded by the capacity, not by the data. Spark counts the lengths,
numbers the pieces of each length and places every piece by its number.

Defined results: a null text is empty; every document ends with the end id, so an empty one is a
piece of length 1; repeated rows are packed each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portloom.llm.frames import small_batches
from portloom.llm.staging import staged
from portloom.llm.vocabulary import REMEMBERED, library_encoder, read_vocabulary

CAPACITY = 2048


class Capacities:
    """Segment tree over 0..capacity that knows which remaining capacities have open bins."""

    def __init__(self, capacity: int):
        self._width = 1 << capacity.bit_length()
        self._any = [False] * (2 * self._width)

    def set(self, capacity: int, is_open: bool) -> None:
        at = capacity + self._width
        self._any[at] = is_open
        while at > 1:
            at //= 2
            self._any[at] = self._any[2 * at] or self._any[2 * at + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of at least ``length`` with an open bin."""
        at = length + self._width
        if self._any[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self._any[at + 1]:
                at += 1
                while at < self._width:
                    at = 2 * at if self._any[2 * at] else 2 * at + 1
                return at - self._width
            at //= 2
        return None


def best_fit_runs(counts: Mapping[int, int], capacity: int = CAPACITY) -> Iterator[tuple[int, int, int, int]]:
    """Runs (length, first number, first bin, offset): the pieces of that length numbered from there
    to the next run go to consecutive bins, each at that offset."""
    tree, open_bins, bins = Capacities(capacity), {}, 0

    def reopen(first: int, n: int, room: int) -> None:
        if n and room:
            open_bins.setdefault(room, []).append((first, n))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of length {length} does not fit in {capacity}")
        number, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, each = capacity, capacity // length
                n = -(-left // each)
                first, bins = bins, bins + n
            else:
                each = room // length
                first, n = open_bins[room].pop()
            # a bin that takes one piece is the tightest for the next as long as it has room
            full = min(n, left // each)
            rest = min(left - full * each, each - 1) if full < n else 0
            for k in range(each if full else 0):
                yield length, number, first, capacity - room + k * length
                number += full
            for k in range(rest):
                yield length, number, first + full, capacity - room + k * length
                number += 1
            left -= full * each + rest
            if room < capacity and not open_bins[room]:
                del open_bins[room]
                tree.set(room, False)
            reopen(first, full, room - each * length)
            used = full + (1 if rest else 0)
            if rest:
                reopen(first + full, 1, room - rest * length)
            reopen(first + used, n - used, room)


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """Adds ``sequence_id`` and ``offset``; ``pieces`` have lengths from 1 to the capacity.

    Pieces of one length are interchangeable; ``order`` decides which of them comes first."""
    rows = staged(pieces.withColumn("_part", F.spark_partition_id()), "pieces")
    counted = staged(rows.groupBy("_part", length).count(), "lengths")
    counts = {r[0]: r[1] for r in counted.groupBy(length).agg(F.sum("count")).collect()}  # one per length
    runs = np.array(sorted(best_fit_runs(counts, capacity)), dtype=np.int64).reshape(-1, 4)
    first, bins, offsets = (runs[:, 0] << 48) | runs[:, 1], runs[:, 2], runs[:, 3]

    before = Window.partitionBy(length).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counted.select("_part", length, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("_part", length).orderBy(*order)
    numbered = (
        rows.withColumn("_own", F.row_number().over(own) - 1)
        .join(earlier, ["_part", length])
        .select(*pieces.columns, (F.col("_own") + F.col("_before")).alias("_number"))
    )
    at = pieces.columns.index(length)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(at).to_numpy().astype(np.int64)
            key = (sizes << 48) | batch.column(len(batch.columns) - 1).to_numpy()
            run = np.searchsorted(first, key, side="right") - 1
            sequence = bins[run] + key - first[run]
            columns = [*batch.columns[:-1], pa.array(sequence, pa.int64()), pa.array(offsets[run], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    schema = T.StructType(
        [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return numbered.mapInArrow(place, schema)


def token_pieces(
    docs: DataFrame,
    vocabulary_path: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """Every document's ids with the end id, cut into pieces of at most ``capacity``. A task remembers
    the ids of ``remembered`` words a generation, about 17 MB for 100,000."""
    vocabulary = read_vocabulary(vocabulary_path)
    end = end_id.to_bytes(4, "little")
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
        + ([T.StructField("ids", T.BinaryType())] if with_ids else [])
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocabulary, remembered)
        for whole in batches:
            for batch in small_batches(whole, "text"):
                found = []
                for doc, ids in zip(
                    batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text").to_pylist()), strict=True
                ):
                    ids += end
                    for piece, a in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[a : a + 4 * capacity]
                        row = (doc, piece, a // 4, len(own) // 4, zlib.crc32(own))
                        found.append((*row, own) if with_ids else row)
                kinds = [batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=False)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, schema)


def pack_documents(
    docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end_id: int = 0, remembered: int = REMEMBERED
) -> DataFrame:
    """Pieces of all documents with their place in the sequences."""
    pieces = token_pieces(docs, vocabulary_path, capacity, end_id, remembered=remembered)
    return pack(pieces, ["doc_id", "piece"], capacity)
