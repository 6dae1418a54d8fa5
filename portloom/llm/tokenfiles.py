"""Token ids as files: frequency ranks in byte-aligned variable-length coding.

Each document is one row of two byte strings: control bytes with two bits per id (its number of
bytes less one) and the data bytes of all ids. Frequent ids have small ranks and take one byte. The
files stand in ascending document order: ``shard`` is the file's place, ``before`` the number of ids
before a document in its file. The table of ranks lies beside them and has one row per id of the
vocabulary. Reading looks the byte counts up in a table of 256 rows and works on whole documents.

Defined results: a null text is empty and holds the end id alone; documents without an id come
first; equal document ids stand in the order of their texts' hashes; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portloom.llm.frames import binary_array, bytes_of, map_arrow, small_batches, with_column
from portloom.llm.staging import staged
from portloom.llm.vocabulary import library_encoder, read_vocabulary, vocabulary_size

#: Bytes of each of the four ids that a control byte stands for.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
_PLACES = np.arange(4, dtype=np.uint8)


def _padded(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each number stands if every row is filled up to fours, and the rows' new borders."""
    sizes = np.diff(ends)
    borders = np.append(0, np.cumsum(-(-sizes // 4) * 4))
    at = np.repeat(borders[:-1] - ends[:-1], sizes)
    at += np.arange(ends[-1])
    return at, borders


def encode_rows(values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes and their borders, data bytes and theirs, of rows of unsigned 32-bit numbers."""
    extra = (values > 0xFF).view(np.uint8)
    most = 4 if values.max(initial=0) > 0xFFFF else 2
    if most == 4:
        extra = extra + (values > 0xFFFF) + (values > 0xFFFFFF)
    at, borders = _padded(ends)
    filled = np.zeros(borders[-1], dtype=np.uint8)
    filled[at] = extra
    fours = filled.reshape(-1, 4)
    control = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    raw = values.astype(f"<u{most}").view(np.uint8).reshape(-1, most)
    data_ends = np.append(0, np.cumsum(extra, dtype=np.int64))[ends] + ends
    return control, borders // 4, raw[_PLACES[:most] <= extra[:, None]], data_ends


def decode_rows(control: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all rows, one after the other."""
    at, _ = _padded(np.append(0, np.cumsum(sizes)))
    lengths = LENGTHS[control].ravel()[at]
    most = 4 if lengths.max(initial=0) > 2 else 2
    raw = np.zeros((len(at), most), dtype=np.uint8)
    raw[lengths[:, None] > _PLACES[:most]] = data
    return raw.view(f"<u{most}").ravel().astype("<u4", copy=False)


def _tokenised(docs: DataFrame, vocabulary: str, end_id: int, width: str, doc_id: str, text: str) -> DataFrame:
    """(doc_id, tie, raw): every document's ids with the end id, as numbers of the given width."""
    end = np.array([end_id], dtype=width).tobytes()
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("tie", T.LongType()),
            T.StructField("raw", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocabulary)
        for whole in batches:
            for batch in small_batches(whole, "text"):
                ids = encoder.encode(batch.column("text").to_pylist())
                raw = [np.frombuffer(i, dtype="<u4").astype(width).tobytes() + end for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("tie"), pa.array(raw, pa.binary())], names=schema.names
                )

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text")
    )
    return rows.mapInArrow(run, schema)


def id_counts(tokenised: DataFrame, size: int, width: str) -> DataFrame:
    """Occurrences of each id over all documents; at most one row per id of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for part in small_batches(batch, "raw"):
                ids = bytes_of(part.column("raw"))[0].view(width)
                total += np.bincount(ids, minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["id", "n"])

    return tokenised.select("raw").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(
    docs: DataFrame,
    vocabulary_path: str,
    folder: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Encodes all documents and writes ``folder/blocks`` and ``folder/ranks``."""
    vocabulary = read_vocabulary(vocabulary_path)
    size = max(vocabulary_size(vocabulary), end_id + 1)
    width = "<u2" if size <= 1 << 16 else "<u4"
    tokenised = staged(_tokenised(docs, vocabulary, end_id, width, doc_id, text), "tokenised", compression="zstd")
    found = {r["id"]: r["n"] for r in id_counts(tokenised, size, width).collect()}
    by_count = sorted(range(size), key=lambda i: (-found.get(i, 0), i))
    rank_of = np.empty(size, dtype=np.uint32)
    rank_of[by_count] = np.arange(size)
    docs.sparkSession.createDataFrame(
        [(rank, i, found.get(i, 0)) for rank, i in enumerate(by_count)], "rank long, id long, n long"
    ).coalesce(1).write.parquet(f"{folder}/ranks")

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("shard", T.IntegerType()),
            T.StructField("before", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("control", T.BinaryType()),
            T.StructField("data", T.BinaryType()),
        ]
    )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, before = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in small_batches(whole, "raw"):
                flat, ends = bytes_of(batch.column("raw"))
                ends //= int(width[-1])
                control, control_ends, data, data_ends = encode_rows(rank_of[flat.view(width)], ends)
                columns = [
                    batch.column("doc_id"),
                    pa.array(np.full(len(ends) - 1, shard), pa.int32()),
                    pa.array(before + ends[:-1], pa.int64()),
                    pa.array(np.diff(ends), pa.int64()),
                    binary_array(control, control_ends),
                    binary_array(data, data_ends),
                ]
                before += int(ends[-1])
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    (
        tokenised.repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .drop("tie")
        .mapInArrow(code, schema)
        .write.option("compression", "zstd")
        .parquet(f"{folder}/blocks")
    )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with ``start`` (ids of all documents before), ``n_tokens`` and ``ids`` as
    little-endian unsigned 32-bit numbers."""
    ranks = spark.read.parquet(f"{folder}/ranks").orderBy("rank").select("id").collect()  # the vocabulary
    id_of = np.array([r["id"] for r in ranks], dtype="<u4")
    blocks = spark.read.parquet(f"{folder}/blocks")

    def decode(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = batch.column("n_tokens").to_numpy()
        ranks = decode_rows(bytes_of(batch.column("control"))[0], bytes_of(batch.column("data"))[0], sizes)
        ends = 4 * np.append(0, np.cumsum(sizes))
        return with_column(batch, "ids", binary_array(id_of[ranks].view(np.uint8), ends))

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    shards = shards.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    placed = blocks.join(staged(shards, "shards"), "shard")
    decoded = map_arrow(placed, decode, {"ids": T.BinaryType()}, sized_by="data")
    return decoded.select(
        "doc_id", "shard", (F.col("_base") + F.col("before")).alias("start"), "n_tokens", "ids"
    )
