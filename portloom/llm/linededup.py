"""Line deduplication by an exact set-similarity join.

A line is the set of its distinct words; lines of fewer than ``min_words`` of them stay. A line is
removed if an earlier line (by document id, then line number) has a Jaccard similarity of at least
``threshold``, be it kept itself or not. Equal sets are one set, which stands at its first line; its
later lines go. Different sets are joined:

- Words are ordered by rarity. It is counted over all lines in hash slots of fixed number, so ties
  and collisions only change the order, which is one order for all.
- Two similar sets share a word among the first ``n - ceil(threshold * n) + 1`` of each (prefix);
  a word that occurs once in the corpus cannot be shared and is left out.
- Pairs that share such a word must agree in length, in the overlap their positions still allow, and
  in two 64-bit parity maps of their words, whose differing bits never exceed the differing words.
- What is left is verified on the words of the lines themselves.

A set is verified with its earliest partner first and with the others only if that fails.

Words with more than ``common`` occurrences may have large groups. There every set is first compared
with the group's earliest, one row each, and only sets that this does not decide look for further
partners; so a group of near copies is not paired with itself. The groups of rarer words are bounded.

Defined results: a null text has no lines and stays null; documents without an id come last; repeated
rows of a document are one document and get equal results; a text keeps its other lines in order, an
emptied one is "". Words are compared by hashes of ``WORD_BITS`` until the last step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portloom.llm.frames import small_batches
from portloom.llm.linewords import blocks, line_words, mixed
from portloom.llm.slots import SLOT_BITS, slot_of, slot_table
from portloom.llm.staging import staged
from portloom.llm.vocabulary import forget, release

THRESHOLD = 0.8
MIN_WORDS = 5
COMMON = 512
WORD_BITS = 43  # of a word's hash, beside 13 for the line in its block and 8 for the rarity
_SLACK = 1e-9  # against rounding in products with the threshold
#: Up to so many documents and line numbers to remove, about 100 MB, are sent to every executor; beyond
#: it Spark joins the texts by key.
BROADCAST_NUMBERS = 4_000_000
_ONCE = 1  # level of a slot with one occurrence
#: The groups of narrow words are shuffled in so many parts, one after the other, to need less disk.
PARTS = 2
#: Rows that are packed at once, and those that a bucket of words has on average; both are held by one task.
PACKED_ROWS, BUCKET_ROWS = 1 << 20, 1 << 19
#: A prefix word of a set as it is shuffled.
_ROW = np.dtype(
    [(c, "<u4") for c in ("word", "n", "at", "map2")]
    + [("line", "<i4"), ("doc", "<i8"), ("key", "<i8"), ("map", "<u8")]
)


def word_levels(docs: DataFrame, text: str = "text") -> bytes:
    """Rarity of words over all lines: 1 + 8 * log2(occurrences), rounded down, of their slot."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        forget()
        total = np.zeros(1 << SLOT_BITS, dtype=np.int32)
        for batch in batches:
            for part in small_batches(batch, "text"):
                for block, _, _ in blocks(part.column("text").to_pylist()):
                    slots, n = np.unique(slot_of(line_words(block)[1]), return_counts=True)
                    total[slots] += n.astype(np.int32)
        release()
        return total

    def level(n: np.ndarray) -> np.ndarray:
        return np.minimum(255, 1 + np.floor(8 * np.log2(n))).astype(np.uint8)

    return slot_table(docs.select(F.col(text).alias("text")), count, level)


def _line_sets(docs: DataFrame, levels: bytes, threshold: float, min_words: int, common: int) -> DataFrame:
    """One row per line with enough words: the set's hash, size, parity map and prefix."""
    schema = T.StructType(
        [
            T.StructField("doc", T.LongType()),
            T.StructField("tie", T.LongType()),
            T.StructField("line", T.IntegerType()),
            T.StructField("set", T.LongType()),
            T.StructField("n", T.IntegerType()),
            T.StructField("map", T.LongType()),
            T.StructField("map2", T.LongType()),
            T.StructField("key", T.LongType()),
            T.StructField("words", T.ArrayType(T.IntegerType())),
            T.StructField("at", T.ArrayType(T.IntegerType())),
            T.StructField("wide", T.ArrayType(T.BooleanType())),
        ]
    )
    sent = docs.sparkSession.sparkContext.broadcast(levels)
    common_level = 1 + int(8 * np.log2(common))

    def sets(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rarity = np.frombuffer(sent.value, np.uint8)
        for block, owner, place in blocks(batch.column("text").to_pylist()):
            line, h = line_words(block)
            whole_at = np.flatnonzero(np.append(True, line[1:] != line[:-1])) if len(line) else np.empty(0, np.int64)
            # line, rarity and word in one number: sorting puts each line's set in the words' order
            packed = (line.astype(np.uint64) << np.uint64(WORD_BITS + 8)) | (h >> np.uint64(64 - WORD_BITS))
            packed |= rarity[slot_of(h)].astype(np.uint64) << np.uint64(WORD_BITS)
            packed.sort()
            if len(packed):
                packed = packed[np.append(True, packed[1:] != packed[:-1])]
            line = (packed >> np.uint64(WORD_BITS + 8)).astype(np.int64)
            level = (packed >> np.uint64(WORD_BITS)) & np.uint64(255)
            word = packed & np.uint64((1 << WORD_BITS) - 1)
            first = np.flatnonzero(np.append(True, line[1:] != line[:-1])) if len(line) else np.empty(0, np.int64)
            size = np.diff(np.append(first, len(line)))
            inside = np.arange(len(line)) - np.repeat(first, size)
            if not len(first):
                continue
            whole = np.add.reduceat(mixed(word, 0xD6E8FEB86659FD93), first)
            # short sets have few words to tell them apart, so two of them count with all their bits
            whole += mixed(np.minimum.reduceat(h, whole_at), 0x9FB21C651E98DF25)
            whole += mixed(np.maximum.reduceat(h, whole_at), 0xA0761D6478BD642F)
            maps = [
                np.bitwise_xor.reduceat(np.uint64(1) << ((word >> np.uint64(shift)) & np.uint64(63)), first)
                for shift in (0, 6)
            ]
            prefix = size - np.ceil(threshold * size - _SLACK).astype(np.int64) + 1
            enough = size >= min_words
            # a set that not even one word more may join has equal sets only
            joins = enough & (size >= threshold * (size + 1) - _SLACK)
            use = np.repeat(joins, size) & (inside < np.repeat(prefix, size)) & (level > _ONCE)
            counts = np.add.reduceat(use, first)[enough]
            ends = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
            at_line = line[first][enough]
            raw = block.split(b"\n")
            keys = np.array([xxhash.xxh64_intdigest(raw[i]) for i in at_line.tolist()], dtype=np.uint64)
            own = pa.array(owner[at_line])
            columns = [
                batch.column("doc").take(own),
                batch.column("tie").take(own),
                pa.array(place[at_line], pa.int32()),
                pa.array(whole[enough].view(np.int64)),
                pa.array(size[enough], pa.int32()),
                *(pa.array(m[enough].view(np.int64)) for m in maps),
                pa.array(keys.view(np.int64)),
                pa.ListArray.from_arrays(ends, pa.array((word[use] & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(inside[use], pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(level[use] > common_level)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for part in small_batches(batch, "text"):
                yield from sets(part)
        release()

    return docs.mapInArrow(run, schema)


def _order(prefix: str = "") -> Column:
    return F.struct(f"{prefix}doc", f"{prefix}line", f"{prefix}key")


def _place(doc_id: str) -> Column:
    """Whole numbers in document order; rows without an id come last."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1))


def _needed(na, nb, threshold: float, ceil):
    """Shared words that two sets of these sizes need."""
    return ceil((na + nb) * (threshold / (1 + threshold)) - _SLACK)


def _may_match(threshold: float) -> Column:
    """Length, positional and parity filters for a shared prefix word of a wide group."""
    na, nb = F.col("a_n"), F.col("b_n")
    needed = _needed(na, nb, threshold, F.ceil)
    left = F.least(na - F.col("a_at"), nb - F.col("b_at"))
    differing = F.greatest(*(F.bit_count(F.col(f"a_{m}").bitwiseXOR(F.col(f"b_{m}"))) for m in ("map", "map2")))
    return (
        (F.least(na, nb) >= F.greatest(na, nb) * F.lit(threshold) - _SLACK)
        & (differing <= na + nb - 2 * needed)
        & (left >= needed)
    )


def _named(df: DataFrame, prefix: str) -> DataFrame:
    return df.select("word", *(F.col(c).alias(prefix + c) for c in df.columns if c != "word"))


def _flat_lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, word, place and ``wide`` of all prefix words of a batch of sets."""
    words, at, wide = (batch.column(c) for c in ("words", "at", "wide"))
    of = np.repeat(np.arange(batch.num_rows), np.diff(words.offsets.to_numpy()))
    word = words.flatten().to_numpy().view(np.uint32)
    return of, word, at.flatten().to_numpy(), wide.flatten().to_numpy(zero_copy_only=False)


def _packed(sets: DataFrame, buckets: int, part: int, asked: bytes | None) -> DataFrame:
    """(bucket, rows): the sets' narrow prefix words in buckets of words, those of many sets in one
    row. Rows are stored byte plane by byte plane in the words' order, which compresses well.

    ``part`` of ``PARTS`` takes those words alone, ``asked`` those of the slots that are set there."""
    sent = None if asked is None else sets.sparkSession.sparkContext.broadcast(asked)

    def pack(pieces: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(pieces)
        rows = rows[np.argsort(rows["word"])]
        bucket = (rows["word"].astype(np.uint64) * np.uint64(buckets)) >> np.uint64(32)
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        raw = rows.view(np.uint8).reshape(len(rows), _ROW.itemsize)
        blobs = [raw[i:j].T.tobytes() for i, j in zip(starts, [*starts[1:], len(rows)], strict=True)]
        columns = [pa.array(bucket[starts].astype(np.int32)), pa.array(blobs, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, size = [], 0
        for batch in batches:
            of, word, at, wide = _flat_lists(batch)
            use = ~wide & (word % PARTS == part)
            if sent is not None:
                use &= np.frombuffer(sent.value, np.uint8)[word >> np.uint32(32 - SLOT_BITS)] > 0
            of, own = of[use], np.empty(int(use.sum()), dtype=_ROW)
            own["word"], own["at"] = word[use], at[use]
            for c in ("n", "doc", "line", "key", "map"):
                own[c] = batch.column(c).to_numpy()[of]
            own["map2"] = batch.column("map2").to_numpy()[of] & 0xFFFFFFFF
            pieces.append(own)
            size += len(own)
            if size >= PACKED_ROWS:
                yield pack(pieces)
                pieces, size = [], 0
        if size:
            yield pack(pieces)

    return sets.select("words", "at", "wide", "n", "doc", "line", "key", "map", "map2").mapInArrow(
        run, "bucket int, rows binary"
    )


def _narrow_pairs(
    sets: DataFrame, threshold: float, part: int, buckets: int, asked: bytes | None = None, late_of: bytes | None = None
) -> DataFrame:
    """Pairs (a, b), the earlier set last, within the groups of words of at most ``common`` occurrences:
    the earliest partner that each set has in a bucket of words, or in the words of ``asked`` all of
    them whose later set has its slot in ``late_of``.

    The rows of a bucket are sorted by word and size; each is compared with the following ones of its
    group up to the largest size that may match, for all groups at once."""
    first_only = asked is None
    sent = None if first_only else sets.sparkSession.sparkContext.broadcast(late_of)

    def compare(found: pa.Table) -> pa.Table:
        raw = [np.frombuffer(b.as_buffer(), np.uint8).reshape(_ROW.itemsize, -1).T for b in found.column("rows")]
        rows = np.ascontiguousarray(np.concatenate(raw)).view(_ROW).ravel()
        rows = rows[np.lexsort((rows["n"], rows["word"]))]
        word, key, parity, parity2, doc, line = (np.ascontiguousarray(rows[c]) for c in ("word", "key", "map", "map2", "doc", "line"))
        n, at = rows["n"].astype(np.int64), rows["at"].astype(np.int64)
        largest = np.floor(n / threshold + _SLACK)
        pairs = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        step, near = 1, np.arange(len(word) - 1)
        while len(near):
            near = near[(word[near] == word[near + step]) & (n[near + step] <= largest[near])]
            i, j = near, near + step
            needed = _needed(n[i], n[j], threshold, np.ceil)
            ok = np.minimum(n[i] - at[i], n[j] - at[j]) >= needed
            for p in (parity, parity2):
                ok &= np.bitwise_count(p[i] ^ p[j]) <= n[i] + n[j] - 2 * needed
            pairs.append((i[ok], j[ok]))
            step += 1
            near = near[near + step < len(word)]
        i, j = (np.concatenate(side) for side in zip(*pairs, strict=True))
        same = doc[i] == doc[j]
        after = (doc[i] > doc[j]) | (same & ((line[i] > line[j]) | ((line[i] == line[j]) & (key[i] > key[j]))))
        late, early = np.where(after, i, j), np.where(after, j, i)
        if not first_only:
            open_ = np.frombuffer(sent.value, np.uint8)[slot_of(key[late].view(np.uint64))] > 0
            late, early = late[open_], early[open_]
        else:
            order = np.lexsort((key[early], line[early], doc[early], key[late]))
            late, early = late[order], early[order]
            new = np.append(True, key[late][1:] != key[late][:-1])[: len(late)]
            late, early = late[new], early[new]
        columns = [pa.array(key[late]), pa.array(key[early]), pa.array(doc[early]), pa.array(line[early])]
        return pa.Table.from_arrays(columns, names=["a", "b", "doc", "line"])

    packed = _packed(sets, buckets, part, asked)
    return packed.groupBy("bucket").applyInArrow(compare, "a long, b long, doc long, line int")


def _key_slots(keys: DataFrame) -> bytes:
    """A table of the slots of the keys."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(1 << SLOT_BITS, dtype=np.uint8)
        for batch in batches:
            total[slot_of(batch.column("key").to_numpy().view(np.uint64))] = 1
        return total

    return slot_table(keys.select("key"), count, lambda n: np.ones(len(n), dtype=np.uint8))


def _narrow_words(sets: DataFrame, late_of: bytes) -> bytes:
    """A table of the slots of the narrow prefix words of the sets whose key has its slot in ``late_of``."""
    sent = sets.sparkSession.sparkContext.broadcast(late_of)

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(1 << SLOT_BITS, dtype=np.uint8)
        for batch in batches:
            of, word, _, wide = _flat_lists(batch)
            open_ = np.frombuffer(sent.value, np.uint8)[slot_of(batch.column("key").to_numpy().view(np.uint64))] > 0
            total[word[~wide & open_[of]] >> np.uint32(32 - SLOT_BITS)] = 1
        return total

    return slot_table(sets.select("key", "words", "at", "wide"), count, lambda n: np.ones(len(n), dtype=np.uint8))


def _wide_pairs(late: DataFrame, wide: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of sets of ``late`` with earlier ones in the groups of common words."""
    found = _named(late, "a_").join(_named(wide, "b_"), "word").where((_order("b_") < _order("a_")) & _may_match(threshold))
    return found.select(
        F.col("a_key").alias("a"), F.col("b_key").alias("b"), F.col("b_doc").alias("doc"), F.col("b_line").alias("line")
    )


def _verified(pairs: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """Keys of sets whose first line, the later one of a pair (a, b), reaches the threshold with the
    other's word by word. A key stands for its line; the lines are read from the documents again."""
    pairs = staged(pairs.distinct(), "candidates")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    sent = docs.sparkSession.sparkContext.broadcast(_key_slots(wanted))
    schema = T.StructType(
        [
            T.StructField("doc", T.LongType()),
            T.StructField("line", T.IntegerType()),
            T.StructField("key", T.LongType()),
            T.StructField("text", T.StringType()),
        ]
    )

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.frombuffer(sent.value, np.uint8)
        for batch in batches:
            for part in small_batches(batch, "text"):
                for block, owner, place in blocks(part.column("text").to_pylist()):
                    raw = block.split(b"\n")
                    key = np.array([xxhash.xxh64_intdigest(line) for line in raw], dtype=np.uint64)
                    hit = np.flatnonzero(asked[slot_of(key)])
                    columns = [
                        part.column("doc").take(pa.array(owner[hit])),
                        pa.array(place[hit], pa.int32()),
                        pa.array(key[hit].view(np.int64)),
                        pa.array([raw[i].decode() for i in hit.tolist()], pa.string()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    found = docs.select("doc", "text").mapInArrow(lines, schema)
    texts = staged(
        found.groupBy("key")
        .agg(F.min(_order()).alias("place"), F.first("text").alias("text"))
        .join(wanted, "key", "left_semi"),
        "lines",
        "zstd",
    )
    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole, "text_a"):
                reached = []
                for key, a, b in zip(*(batch.column(c).to_pylist() for c in ("key", "text_a", "text_b")), strict=True):
                    words_a, words_b = set(a.encode().split()), set(b.encode().split())  # bytes part at ASCII blanks alone
                    shared = len(words_a & words_b)
                    if shared >= (len(words_a) + len(words_b) - shared) * threshold - _SLACK:
                        reached.append(key)
                yield pa.RecordBatch.from_arrays([pa.array(reached, pa.int64())], names=["key"])

    # whole lines are shuffled, not their words one by one, which take several times the room
    a = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"), F.col("place").alias("place_a"))
    b = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"), F.col("place").alias("place_b"))
    later = F.when(F.col("place_a") > F.col("place_b"), F.col("a")).otherwise(F.col("b"))
    both = pairs.join(a, "a").join(b, "b").select(later.alias("key"), "text_a", "text_b")
    return both.mapInArrow(similar, "key long").distinct()


def repeated_sets(sets: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """Keys of the sets whose first line has a similar line before it."""
    each = F.explode(F.filter(F.arrays_zip("words", "at", "wide"), lambda w: w["wide"])).alias("w")
    columns = ["doc", "line", "key", "n", "map", "map2"]
    wide = sets.where(F.array_contains("wide", True)).select(*columns, each)
    wide = staged(wide.select(*columns, F.col("w.words").alias("word"), F.col("w.at").alias("at")), "wide", "zstd")
    earliest = wide.groupBy("word").agg(F.min_by(F.struct(*columns, "at"), _order()).alias("e")).select("word", "e.*")
    earliest = staged(earliest, "earliest")
    decided = staged(_verified(_wide_pairs(wide, earliest, threshold).select("a", "b"), docs, threshold), "decided")

    # each set that may have earlier partners is verified with the first of them
    open_ = wide.join(decided, "key", "left_anti").select(wide.columns)
    tried = _wide_pairs(open_, wide, threshold)
    buckets = 1 + sets.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0] // PARTS // BUCKET_ROWS
    for part in range(PARTS):
        tried = tried.unionAll(staged(_narrow_pairs(sets, threshold, part, buckets), "narrow-pairs"))
    tried = staged(tried.groupBy("a").agg(F.min_by("b", F.struct("doc", "line", "b")).alias("b")), "first-partners")
    found = staged(decided.unionAll(_verified(tried.select("a", "b"), docs, threshold)).distinct(), "found")

    # the few that this did not decide, with all of their partners
    rest = staged(tried.select(F.col("a").alias("key")).join(found, "key", "left_anti"), "rest")
    if rest.isEmpty():
        return found
    late_of = _key_slots(rest)
    asked = _narrow_words(sets, late_of)
    pairs = _wide_pairs(wide.join(rest, "key", "left_semi").select(wide.columns), wide, threshold)
    for part in range(PARTS):
        pairs = pairs.unionAll(staged(_narrow_pairs(sets, threshold, part, buckets, asked, late_of), "narrow-pairs"))
    pairs = pairs.join(rest.select(F.col("key").alias("a")), "a", "left_semi").select("a", "b")
    return found.unionAll(_verified(pairs, docs, threshold)).distinct()


def removed_lines(
    docs: DataFrame, threshold: float = THRESHOLD, min_words: int = MIN_WORDS, common: int = COMMON
) -> DataFrame:
    """(doc, tie, removed): the line numbers to remove from each text; ``docs`` has doc, tie, text."""
    lines = staged(_line_sets(docs, word_levels(docs), threshold, min_words, common), "line-sets", "zstd")
    order = F.struct("doc", "line", "key", "tie")  # texts of one id may have equal lines at one place
    first = F.min_by(F.struct("doc", "tie", "line", "n", "map", "map2", "key", "words", "at", "wide"), order).alias("f")
    sets = staged(lines.groupBy("set").agg(first, F.count(F.lit(1)).alias("lines")).select("set", "f.*", "lines"), "sets", "zstd")
    repeated = repeated_sets(sets, docs, threshold).withColumn("gone", F.lit(True))
    marks = (
        sets.select("set", "key", "lines", *(F.col(c).alias(f"f_{c}") for c in ("doc", "tie", "line")))
        .join(repeated, "key", "left")
        .where("gone or lines > 1")
        .select("set", "f_doc", "f_tie", "f_line", "gone")
    )
    is_first = (F.col("doc") == F.col("f_doc")) & (F.col("tie") == F.col("f_tie")) & (F.col("line") == F.col("f_line"))
    gone = lines.select("doc", "tie", "line", "set").join(staged(marks, "marks"), "set")
    gone = gone.where(~is_first | F.col("gone"))
    return gone.groupBy("doc", "tie").agg(F.collect_set("line").alias("removed"))


def dedup_lines(
    df: DataFrame,
    threshold: float = THRESHOLD,
    min_words: int = MIN_WORDS,
    common: int = COMMON,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents without their repeated lines, with ``n_lines`` and ``n_removed``."""
    tie = F.xxhash64(text)
    if not isinstance(df.schema[doc_id].dataType, T.IntegralType):
        raise TypeError("document ids are whole numbers; their order says which line is the earlier one")
    docs = df.select(_place(doc_id).alias("doc"), tie.alias("tie"), F.col(text).alias("text"))
    gone = staged(removed_lines(docs, threshold, min_words, common), "removed")
    size = gone.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.size("removed")), F.lit(0))).first()[0]
    if size <= BROADCAST_NUMBERS:
        gone = F.broadcast(gone)
    gone = gone.select(F.col("doc").alias("_doc"), F.col("tie").alias("_tie2"), F.col("removed").alias("_removed"))
    both = df.withColumn("_tie1", tie).withColumn("_doc1", _place(doc_id))
    out = both.join(gone, (F.col("_doc1") == F.col("_doc")) & (F.col("_tie1") == F.col("_tie2")), "left")
    lines = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_removed")
    rebuilt = F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n")
    return (
        out.withColumn("_lines", lines)
        .withColumn("n_lines", F.greatest(F.size("_lines"), F.lit(0)).cast("long"))
        .withColumn("n_removed", F.coalesce(F.size("_removed"), F.lit(0)).cast("long"))
        .withColumn(text, F.when(F.col("_removed").isNull(), F.col(text)).otherwise(rebuilt))
        .select(*df.columns, "n_lines", "n_removed")
    )
