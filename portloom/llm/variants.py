"""Spelling variants: words one edit apart, found through an index of variable-length grams.

A gram dictionary is counted over the distinct words: from all substrings of ``QMIN`` to ``QMAX``
characters those stay that are frequent enough, and one is lengthened only while its shorter form is
too frequent to tell words apart. A word is decomposed from left to right into the longest dictionary
gram at each place (a plain gram of ``QMIN`` where there is none), grams inside another one left out.

For every place of an edit the grams that it can change are bounded: those that contain the place,
those to the left that a longer dictionary gram across the place could swallow, and those to the
right that such a gram could cover. The largest of these numbers is the word's own bound. So two
words one edit apart share at least ``grams - bound`` grams, by either word's count; each has one of
them among its ``bound + 1`` rarest, and it stands at the same distance from the start or from the
end in both. That is the key by which the words' lists are merged. What is left must differ in two
letters at most, have enough grams in common, and is then verified by the edit distance itself.

Words whose bound leaves nothing to share are also indexed by plain grams of ``QMIN``, of which an
edit changes ``QMIN`` at most, and meet each other there. No pair is lost, and there is no cap.

Only the dictionary passes through the driver. Its size is limited by ``GRAMS`` for each length,
whatever the number of words, as only grams of at least 1 / ``GRAMS`` of all windows enter.

Defined results: a null text has no words; repeated rows count each time; an empty table gives no
rows. Columns besides the id and the text are not read.
"""

from __future__ import annotations

import functools
import math
import operator
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portloom.llm.frames import small_batches
from portloom.llm.staging import staged

QMIN, QMAX = 2, 5
GRAMS = 1 << 14
#: A gram is lengthened while it is this many times as frequent as the rarest one that may enter.
EXTEND = 4
RATIO = 5
MIN_LENGTH = 6
MIN_COUNT = 5
SHORT_WORD = 256
_HALVINGS = 32
_LETTERS = "A-Za-zÀ-ÿ"
_NAMES = ["word", "n", "length", "letters", "plain", "weak", "least", "grams", "keys"]
_HELD = 200_000  # distinct strings a task holds before it sends their counts


def _sent(counts: Counter, name: str) -> pa.RecordBatch:
    arrays = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
    counts.clear()
    return pa.RecordBatch.from_arrays(arrays, names=[name, "n"])


def word_counts(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    rewrite: Callable[[object, str], str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(word, n) of the runs of letters of all texts, A-Z in lower case. ``rewrite`` may replace a
    run of a document, given its id, by another one of the same length or shorter."""
    run_of = re.compile(f"[{_LETTERS}]{{{min_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for whole in batches:
            for batch in small_batches(whole, "text"):
                for doc, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                    lowered = (text.as_py() or "").encode().lower().decode()  # bytes: only A-Z change
                    own = Counter(map(operator.itemgetter(0), run_of.finditer(lowered)))
                    if rewrite is None:
                        total.update(own)
                        continue
                    for word, n in own.items():
                        word = rewrite(doc, word)
                        if len(word) >= min_length:
                            total[word] += n
                if len(total) > _HELD:
                    yield _sent(total, "word")
        yield _sent(total, "word")

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    sums = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return sums.where(F.col("n") >= min_count)


def letter_lost(one_in: int) -> Callable[[object, str], str]:
    """A rewriting that deletes a letter from one run in ``one_in``, chosen by the CRC-32 of id and run."""

    def rewrite(doc: object, run: str) -> str:
        h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
        at = h % len(run)
        return run[:at] + run[at + 1 :] if h % one_in == 0 else run

    return rewrite


class Dictionary:
    """Dictionary grams longer than ``QMIN``, what they begin with, and what they hold after a first character."""

    def __init__(self, frequent: dict[str, int], lengthened_above: float):
        self.frequent, self.lengthened_above = frequent, lengthened_above
        self.grams = {g for g in frequent if len(g) > QMIN and frequent[g[:-1]] > lengthened_above}
        self.heads = {g[:k] for g in self.grams for k in range(1, len(g))}
        self.inner = {g[j:k] for g in self.grams for j in range(1, len(g)) for k in range(j + 1, len(g) + 1)}

    def decompose(self, word: str) -> list[tuple[int, int]]:
        """(start, end) of the word's grams; starts and ends both increase."""
        spans, covered = [], 0
        for at in range(len(word) - QMIN + 1):
            end = at + QMIN
            for longer in range(min(len(word), at + QMAX), end, -1):
                if word[at:longer] in self.grams:
                    end = longer
                    break
            if end > covered:
                spans.append((at, end))
                covered = end
        return spans

    def affected(self, word: str, spans: list[tuple[int, int]]) -> int:
        """The most grams of the word that one inserted, deleted or replaced character can change."""
        starts, ends = [s for s, _ in spans], [e for _, e in spans]
        most, size = 0, len(word)

        def covered_from(at: int) -> int:
            return next((e for e in range(min(size, at + QMAX - 1), at, -1) if word[at:e] in self.inner), at)

        for i in range(size + 1):
            swallowed = next((p for p in range(max(0, i - QMAX + 1), i) if word[p:i] in self.heads), i)
            first = min(bisect_left(starts, swallowed), bisect_right(ends, i))
            inserted = max(bisect_left(starts, i), bisect_right(ends, covered_from(i)))
            most = max(most, inserted - first)
            if i < size:
                changed = max(bisect_right(starts, i), bisect_right(ends, covered_from(i + 1)))
                most = max(most, changed - first)
        return most


def gram_dictionary(words: DataFrame, grams: int = GRAMS) -> Dictionary:
    """The dictionary of a table of distinct words; at most ``grams`` of each length are frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for word in batch.column("word").to_pylist():
                for q in range(QMIN, QMAX + 1):
                    total.update(word[i : i + q] for i in range(len(word) - q + 1))
                if len(total) > _HELD:
                    yield _sent(total, "gram")
        yield _sent(total, "gram")

    windows = words.agg(F.sum(F.char_length("word") - (QMIN - 1))).first()[0] or 0
    least = max(2, -(-windows // grams))
    counted = words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    frequent = {r.gram: r.n for r in counted.where(F.col("n") >= least).collect()}  # at most grams rows a length
    return Dictionary(frequent, EXTEND * least)


def _hash(kind: str, offset: int, gram: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}{offset}:{gram}") - (1 << 63)


def _entry(word: str, dictionary: Dictionary, kind: str) -> tuple[int, list[int], list[int]]:
    """The number of grams a near word must share, all grams (numbered where they repeat) and the
    keys of the rarest ones, at their distance from the start and from the end."""
    spans = dictionary.decompose(word)
    bound = dictionary.affected(word, spans)
    texts = [word[a:b] for a, b in spans]
    seen: Counter = Counter()
    numbered = []
    for gram in texts:
        numbered.append(_hash(kind, seen[gram], gram))
        seen[gram] += 1
    # of equal grams the first comes first, in either word: an edit keeps the order of those it leaves
    chosen = sorted((dictionary.frequent.get(g, 0), g, a) for (a, _), g in zip(spans, texts, strict=True))[: bound + 1]
    keys = {_hash(f"{kind}<", a, g) for _, g, a in chosen} | {_hash(f"{kind}>", len(word) - a, g) for _, g, a in chosen}
    return len(spans) - bound, numbered, sorted(keys)


_ENTRY = "word string, n long, length int, letters long, plain boolean, weak boolean, least int, grams array<long>, keys array<long>"


def _index(words: DataFrame, dictionary: Dictionary) -> DataFrame:
    """One row per word, and one more by plain grams for a word that must share none of the others."""
    frequent, above = dictionary.frequent, dictionary.lengthened_above

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        variable, fixed = Dictionary(frequent, above), Dictionary(frequent, math.inf)
        for whole in batches:
            for batch in small_batches(whole, "word", 1 << 18):
                rows = []
                for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                    least, grams, keys = _entry(word, variable, "v")
                    letters = functools.reduce(operator.or_, (1 << ord(c) % 63 for c in word), 0)
                    rows.append((word, n, len(word), letters, False, least <= 0, least, grams, keys))
                    if least <= 0:
                        least, grams, keys = _entry(word, fixed, "p")
                        rows.append((word, n, len(word), letters, True, False, least, grams, keys))
                longs = pa.list_(pa.int64())
                kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.int32(), longs, longs]
                arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=_NAMES)

    return words.select("word", "n").mapInArrow(run, _ENTRY)


def _one_edit(a: str, b: str, size_a: str, size_b: str) -> Column:
    """Whether two different words whose lengths differ by one at most are one edit apart.

    Spark's bounded edit distance takes time with the square of the length; long words are compared
    by what follows their longest common beginning, which is found by halving."""
    first, other, m, n = F.col(a), F.col(b), F.col(size_a), F.col(size_b)

    def halve(found: Column, _: Column) -> Column:
        middle = F.floor((found["low"] + found["high"] + 1) / 2).cast("int")
        same = F.substring(first, F.lit(1), middle) == F.substring(other, F.lit(1), middle)
        low, high = F.when(same, middle).otherwise(found["low"]), F.when(same, found["high"]).otherwise(middle - 1)
        return F.when(found["low"] < found["high"], F.struct(low.alias("low"), high.alias("high"))).otherwise(found)

    whole = F.struct(F.lit(0).alias("low"), F.least(m, n).alias("high"))
    common = F.aggregate(F.sequence(F.lit(1), F.lit(_HALVINGS)), whole, halve)["low"]
    rest = [F.substring(word, common + 1 + longer.cast("int"), size) for word, longer, size in ((first, m >= n, m), (other, n >= m, n))]
    return F.when(F.greatest(m, n) <= SHORT_WORD, F.levenshtein(first, other, 1) == 1).otherwise(rest[0] == rest[1])


def near_pairs(words: DataFrame, grams: int = GRAMS) -> DataFrame:
    """(word, n, near, near_n), each pair of words one edit apart in both directions.

    ``words`` holds distinct words of at least ``2 * QMIN`` characters in ``word``, their counts in ``n``."""
    index = staged(_index(words, gram_dictionary(words, grams)), "gram-index")
    lists = index.withColumn("key", F.explode("keys")).drop("keys")
    other = lists.select("key", *(F.col(c).alias(f"{c}_b") for c in lists.columns if c not in ("key", "plain")))
    shared = F.size(F.array_intersect("grams", "grams_b"))
    merged = lists.join(other, "key").where(
        (F.col("word") < F.col("word_b"))
        & (F.abs(F.col("length") - F.col("length_b")) <= 1)
        & ~(F.col("weak") & F.col("weak_b"))
        & (F.bit_count(F.col("letters").bitwiseXOR(F.col("letters_b"))) <= 2)
        & (shared >= F.greatest("least", "least_b"))
        & _one_edit("word", "word_b", "length", "length_b")
    )
    pairs = staged(merged.select("word", "n", F.col("word_b").alias("near"), F.col("n_b").alias("near_n")).distinct(), "near")
    turned = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.unionAll(turned)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms are followed to the last, twice as far in each round.
    Counts grow along a chain by ``ratio``, so there are few rounds and no circles."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        now = staged(now.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root")), "roots")
        if now.join(now.select(F.col("word").alias("root")), "root", "left_semi").isEmpty():
            return now


def variant_groups(words: DataFrame, ratio: int = RATIO, grams: int = GRAMS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word. The form is the near word of the largest
    count, of several the smallest, if it is at least ``ratio`` times as frequent."""
    near = near_pairs(words, grams)
    best = near.groupBy("word").agg(
        F.first("n").alias("n"),
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near"))).alias("best"),
    )
    enough = -F.col("best.m") >= ratio * F.col("n")
    judged = staged(
        best.select("word", "n_near", F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n")),
        "forms",
    )
    roots = _roots(judged.where("form is not null"))
    return (
        words.join(judged, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )


def group_variants(docs: DataFrame, ratio: int = RATIO, **counting) -> DataFrame:
    """:func:`variant_groups` of the words of all texts; ``counting`` as in :func:`word_counts`."""
    least = counting.get("min_length", MIN_LENGTH)
    if least < 2 * QMIN:
        raise ValueError(f"words need at least {2 * QMIN} letters")
    return variant_groups(staged(word_counts(docs, **counting), "words"), ratio)
