"""Importance resampling of documents towards a target distribution, over hashed word n-grams.

Separators are collapsed to single spaces. One overlapped scan then stops at every space before a
word, and lookarounds bounded by spaces give the spans of the 1 to ``longest`` words that begin
there; a span's CRC-32 modulo ``buckets`` is its bucket. Counts over all documents and over all
target texts give each bucket a gain, the scaled log of its smoothed target share over its smoothed
raw share. A document's weight is the sum of its spans' gains; with a Gumbel number drawn from a
digest of its id added, the highest scores are a sample without replacement.

Texts are scanned once: each document's bucket counts are written as a sparse table, from which the
corpus counts and then the weights are taken. Only the counts per bucket reach the driver, and they
are ``buckets`` rows at any size. Ranks come from a range partitioning by score and the row counts
of its partitions, so no task orders more than its share.

Defined results: a null or wordless text has no features and weight 0; a null id is hashed as an
empty one and comes last among equal scores; rows of one id and text are scored alike and drawn one
by one; an empty table gives no rows, an empty target counts as one without features.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain
from operator import methodcaller

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portloom.llm.frames import bytes_of, small_batches
from portloom.llm.staging import staged

BUCKETS = 10_000
LONGEST = 3
PERCENT = 5
MIN_WORDS = 20
SEED = 42
SCALE = 1000

_SEPARATORS = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_ROW = "row"
_PARTITION_BITS = 33  # monotonically_increasing_id: partition number above, row in partition below


def span_pattern(longest: int) -> regex.Pattern:
    """Matches the space before each word; group k holds the words from there on, ``longest + 1 - k``
    of them or as many as are left."""
    spans = rb"([^ ]+)"
    for _ in range(longest - 1):
        spans = rb"(" + spans + rb"(?: [^ ]+)?)"
    return regex.compile(rb" (?=" + spans + rb" )")


def span_crcs(text: str | None, pattern: regex.Pattern, longest: int) -> np.ndarray:
    """One row per word: the CRC-32 of the spans of ``longest`` to 1 words that begin with it. In
    the last rows, spans that would pass the end are shorter and repeat the next column."""
    line = b" " + _SEPARATORS.sub(b" ", (text or "").encode().lower()).strip(b" ") + b" "
    spans = chain.from_iterable(map(methodcaller("groups"), pattern.finditer(line, overlapped=True)))
    return np.fromiter(map(zlib.crc32, spans), np.uint32).reshape(-1, longest)


def bucket_counts(text: str | None, pattern: regex.Pattern, longest: int, buckets: int) -> tuple[int, np.ndarray]:
    """The number of words and the number of features in each bucket."""
    crcs = span_crcs(text, pattern, longest)
    n, counts = len(crcs), np.zeros(buckets, dtype=np.int64)
    for column in range(longest):
        whole = crcs[: max(0, n - (longest - 1 - column)), column]
        if len(whole):
            counts += np.bincount(whole % np.uint32(buckets), minlength=buckets)
    return n, counts


def _packed(counts: np.ndarray) -> bytes:
    """Used buckets as gaps and their counts, byte planes apart so that they compress."""
    used = np.flatnonzero(counts)
    gaps = np.diff(used, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4)
    own = counts[used].astype("<u4").view(np.uint8).reshape(-1, 4)
    return gaps.T.tobytes() + own.T.tobytes()


def _unpacked(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    planes = packed.reshape(2, 4, -1)
    numbers = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4")[..., 0].astype(np.int64)
    return np.cumsum(numbers[0]), numbers[1]


def _features(texts: DataFrame, longest: int, buckets: int) -> DataFrame:
    """The rows with ``n_words``, ``n_features`` and their packed bucket counts instead of ``text``."""
    kept = [f for f in texts.schema.fields if f.name != "text"]
    schema = T.StructType(
        [
            *kept,
            T.StructField("n_words", T.LongType()),
            T.StructField("n_features", T.LongType()),
            T.StructField("packed", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = span_pattern(longest)
        for whole in batches:
            for batch in small_batches(whole, "text"):
                words, features, packed = [], [], []
                for text in batch.column("text"):
                    n, counts = bucket_counts(text.as_py(), pattern, longest, buckets)
                    words.append(n)
                    features.append(int(counts.sum()))
                    packed.append(_packed(counts))
                columns = [batch.column(f.name) for f in kept]
                columns += [pa.array(words, pa.int64()), pa.array(features, pa.int64()), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return texts.mapInArrow(run, schema)


def _totals(features: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket over all rows; a task sends one row per bucket it has seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            flat, ends = bytes_of(batch.column("packed"))
            for a, b in zip(ends, ends[1:], strict=False):
                used, own = _unpacked(flat[a:b])
                total[used] += own
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    sums = features.select("packed").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in sums.collect():  # at most one row per bucket
        out[bucket] = n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the scaled log ratio of the target's share to the raw share, one added to each."""
    s_all, t_all, n = int(raw.sum()), int(target.sum()), len(raw)
    pairs = zip(raw.tolist(), target.tolist(), strict=True)
    ratios = (float((t + 1) * (s_all + n)) / float((s + 1) * (t_all + n)) for s, t in pairs)
    return np.array([math.floor(SCALE * math.log(r)) for r in ratios], dtype=np.int64)


def _weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    kept = [f for f in features.schema.fields if f.name != "packed"]
    schema = T.StructType([*kept, T.StructField("weight", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = bytes_of(batch.column("packed"))
            sums = []
            for a, b in zip(ends, ends[1:], strict=False):
                used, own = _unpacked(flat[a:b])
                sums.append(int(gain[used] @ own))
            columns = [*(batch.column(f.name) for f in kept), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return features.mapInArrow(run, schema)


def gumbel(doc_id: Column, seed: int) -> Column:
    """A scaled Gumbel number from the first 32 bits of a digest of the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Adds ``rank``, from 1 on in ``order``. Rows are dealt to tasks by ranges of the order; each
    partition's row count then tells how many rows stand before it. The frame must give the same rows
    each time it is read."""
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    placed = staged(placed.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", _PARTITION_BITS).cast("int")
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before, so_far = [], 0
    for part_no, n in counts:  # one row per task
        before.append((part_no, so_far))
        so_far += n
    starts = spark.createDataFrame(before, "_part int, _before long")
    inside = F.col("_at").bitwiseAND((1 << _PARTITION_BITS) - 1)
    numbered = placed.withColumn("_part", part).join(starts, "_part")
    return numbered.withColumn("rank", F.col("_before") + inside + 1).drop("_part", "_before", "_at")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Every row of ``docs`` with its columns in a struct ``doc`` and ``n_words``, ``n_features``,
    ``weight``, ``score`` and ``rank``. Of the rows of at least ``min_words`` words, ``percent`` in a
    hundred (rounded down) are drawn; they have ranks from 1 on, the others null.

    ``keep`` narrows the columns of ``doc``; all of them, the text included, are carried without it.
    """
    if not 0 < buckets <= 1 << 31 or not 0 < longest:
        raise ValueError("buckets and longest must be positive")
    carried = F.struct(*(docs.columns if keep is None else keep))
    rows = docs.select(carried.alias("doc"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    found = staged(_features(rows, longest, buckets).withColumn(_ROW, F.monotonically_increasing_id()), "features", "zstd")
    wanted = _features(target.select(F.col(target_text).alias("text")), longest, buckets)
    gain = gains(_totals(found, buckets), _totals(wanted, buckets))
    weighed = _weighed(found.drop("doc"), gain)
    scored = staged(weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "scored")
    able = scored.where(F.col("n_words") >= min_words)
    most = percent * able.count() // 100
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col(_ROW).asc()]
    drawn = ranked(able.select("score", "id", _ROW), order).where(F.col("rank") <= most).select(_ROW, "rank")
    return (
        found.select("doc", _ROW)
        .join(scored.select(_ROW, "n_words", "n_features", "weight", "score"), _ROW)
        .join(drawn, _ROW, "left")
        .drop(_ROW)
    )


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents with the columns they came with, in no order."""
    return resample(docs, target, **options).where(F.col("rank").isNotNull()).select("doc.*")
