"""Quality rules: base counts, and the likelihood of a text under trusted against raw text.

Words and pairs of neighbouring words are hashed into ``buckets`` classes. Two multinomials are
counted over them, one from the trusted documents and one from all documents, with one added to
each class. A document's score is the mean over its words and pairs, and ``ADDED_GRAMS`` neutral
ones, of log(trusted / raw); it is kept if its base counts pass and the score reaches the threshold. Everything is made of Spark
functions. Only the table of classes, whose size is fixed, passes through the driver.

Words are runs of characters other than space and U+0009 to U+000D. Windows of five words are
compared by a 64-bit hash within their text.

Defined results: a null text has no words and fails the base counts; without any trusted text the
score of every document is zero; repeated rows get equal results; documents without an id are
judged like others but are never trusted; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
BUCKETS = 10_000
THRESHOLD = -0.05
#: Words and pairs of ratio zero that are added to each text, so that a few odd words do not decide
#: about a short one.
ADDED_GRAMS = 30
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Up to so many trusted ids (8 bytes each) are sent to every executor; beyond it Spark joins by key.
BROADCAST_IDS = 2_000_000

BASE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def _chars_without(text: Column, chars: str) -> Column:
    return F.char_length(F.translate(text, chars, "")).cast("long")


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base columns; ``_words`` (the words) and ``_hashes`` (theirs) stay for the score."""
    whole = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("_words", word_list(whole))
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    n = F.size("_words")
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    windows = F.transform(
        F.sequence(F.lit(1), n - (WINDOW - 1)),
        lambda i: F.xxhash64(*(F.element_at("_hashes", i + k) for k in range(WINDOW))),
    )
    df = df.withColumn("_lines", lines).withColumn(
        "_windows", F.when(n >= WINDOW, windows).otherwise(F.expr("array()").cast("array<bigint>"))
    )
    # places of the windows that occur again, in order
    sorted_windows = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_sorted", F.when(repeats, sorted_windows))
    again = F.filter(
        "_sorted",
        lambda x, k: (F.get("_sorted", k - 1)["h"].eqNullSafe(x["h"]))
        | (F.get("_sorted", k + 1)["h"].eqNullSafe(x["h"])),
    )
    df = df.withColumn("_again", F.sort_array(F.transform(again, lambda x: x["i"])))
    overlap = F.aggregate(
        F.transform("_again", lambda i, k: F.greatest(F.lit(0), WINDOW - (F.get("_again", k + 1) - i))),
        F.lit(0).cast("long"),
        lambda total, x: total + F.coalesce(x, F.lit(0)),
    )
    covered = F.size("_again") * WINDOW - overlap
    return (
        df.withColumn("n_words", n.cast("long"))
        .withColumn("word_chars", _chars_without(whole, BLANKS))
        .withColumn("n_symbols", F.char_length(whole) - _chars_without(whole, SYMBOLS))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", F.when(F.col("_again").isNull(), F.lit(0)).otherwise(covered).cast("long"))
        .drop("_lines", "_windows", "_sorted", "_again")
    )


def _bucket(value: Column, buckets: int) -> Column:
    return F.pmod(value, F.lit(buckets)).cast("int")


def class_counts(docs: DataFrame, trusted_ids: DataFrame, buckets: int, doc_id: str, text: str) -> list[tuple]:
    """(bucket, occurrences in all documents, occurrences in the trusted ones); at most ``buckets`` rows."""
    trusted = trusted_ids.select(F.col(trusted_ids.columns[0]).alias("_id")).dropna().distinct()
    if trusted.count() <= BROADCAST_IDS:
        trusted = F.broadcast(trusted)
    words = docs.select(F.col(doc_id).alias("_id"), word_list(F.coalesce(F.col(text), F.lit(""))).alias("_w"))
    pairs = F.arrays_zip(F.col("_w").alias("a"), F.slice("_w", 2, F.greatest(F.size("_w") - 1, F.lit(1))).alias("b"))
    marked = words.join(trusted.withColumn("_good", F.lit(1)), "_id", "left")
    each = marked.select("_good", F.explode(pairs).alias("p")).select(
        "_good", F.xxhash64("p.a").alias("h"), F.when(F.col("p.b").isNotNull(), F.xxhash64(F.xxhash64("p.a"), F.xxhash64("p.b"))).alias("hh")
    )
    classes = each.select("_good", F.explode(F.array("h", "hh")).alias("h")).where("h is not null")
    return (
        classes.groupBy(_bucket(F.col("h"), buckets).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"), F.count("_good").alias("good"))
        .collect()
    )


def log_ratios(counts: list[tuple], buckets: int) -> list[float]:
    """log(trusted / raw) of each class, zero everywhere if nothing is trusted."""
    raw, good = [1] * buckets, [1] * buckets
    for bucket, n, trusted in counts:
        raw[bucket] += n
        good[bucket] += trusted
    if sum(good) == buckets:
        return [0.0] * buckets
    a, b = math.log(sum(raw)), math.log(sum(good))
    return [(math.log(g) - b) - (math.log(r) - a) for r, g in zip(raw, good, strict=True)]


def judged(
    docs: DataFrame,
    trusted_ids: DataFrame,
    threshold: float = THRESHOLD,
    buckets: int = BUCKETS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents with base counts, ``score``, ``base_failed`` and ``kept``."""
    ratios = log_ratios(class_counts(docs, trusted_ids, buckets, doc_id, text), buckets)
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")  # folded once
    df = base_counts(docs, text)

    def ratio(h: Column) -> Column:
        return F.coalesce(F.get(table, _bucket(h, buckets)), F.lit(0.0))

    single = F.aggregate("_hashes", F.lit(0.0), lambda s, h: s + ratio(h))
    paired = F.aggregate(
        F.zip_with("_hashes", F.slice("_hashes", 2, F.greatest(F.size("_hashes") - 1, F.lit(1))), _pair_hash),
        F.lit(0.0),
        lambda s, h: s + F.when(h.isNull(), F.lit(0.0)).otherwise(ratio(h)),
    )
    grams = 2 * F.col("n_words") - 1 + ADDED_GRAMS
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    df = df.withColumn("score", (single + paired) / grams)
    # the row number is always at hand; as it is not deterministic, Spark does not copy the word
    # arrays into a filter on ``kept``
    verdict = ~F.col("base_failed") & (F.col("score") >= threshold) & (F.monotonically_increasing_id() >= 0)
    return df.withColumn("base_failed", failed).withColumn("kept", verdict).drop("_words", "_hashes")


def _pair_hash(a: Column, b: Column) -> Column:
    return F.when(b.isNotNull(), F.xxhash64(a, b))


def keep_good(
    docs: DataFrame,
    trusted_ids: DataFrame,
    threshold: float = THRESHOLD,
    buckets: int = BUCKETS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents that are kept, with the columns they came with."""
    rows = docs.select(F.struct("*").alias("_row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return judged(rows, trusted_ids, threshold, buckets).where("kept").select("_row.*")
