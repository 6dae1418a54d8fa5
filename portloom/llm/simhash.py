"""SimHash near-duplicates: fingerprints by majority, links by pigeonring filtering, components.

The 64 bits of a fingerprint are a ring of eight segments. If two fingerprints differ in at most
``max_bits`` bits, then from some segment on every chain of l segments differs in at most
``l * max_bits / 8`` bits. Candidates are found by equal keys: the first three segments of a chain,
where the first is equal and the next two differ in one bit at most, tried on one side only (a
difference of one bit changes the parity, so the even side tries). The longer chains are checked
before the full distance.

Equal fingerprints are one node. Tight clusters of different ones are first tied to a pivot of each
bucket, which takes one row per member; after that only pairs of different components are
compared, and in a large bucket nothing is compared inside its main component. So no group is
paired with itself, and no link between components is lost.

Defined results: a null text is empty; a text without words has fingerprint zero and links like any
other; rows without a document id get the smallest id of their component, null if it has none;
repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portloom.llm.components import components
from portloom.llm.frames import small_batches
from portloom.llm.staging import staged

SEED = 42
SEGMENTS, SEGMENT_BITS = 8, 8
KEY_BITS = 3 * SEGMENT_BITS
PIVOT_ROUNDS = 2
LARGE_BUCKET = 64  # buckets with more members are compared by component
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """Bit by bit the majority of the XXH64 hashes of all word shingles, as a signed number."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return 0
    joined, size = b" ".join(words), min(shingle, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - size]]
    n = len(starts)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _BLOCK):
        spans = zip(starts[at : at + _BLOCK], ends[size - 1 + at : size - 1 + at + _BLOCK], strict=False)
        hashes = np.array([xxhash.xxh64_intdigest(joined[a : b - 1], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole, "text"):
                fps = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(fps, pa.int64())], names=["doc_id", "fp"]
                )

    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("fp", T.LongType())]
    )
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _rings(fps: DataFrame) -> DataFrame:
    """Each fingerprint from each start on the ring, with the key of its first three segments."""
    turned = [
        F.struct(
            F.lit(i).cast("tinyint").alias("turn"),
            (
                F.shiftrightunsigned("fp", i * SEGMENT_BITS)
                .bitwiseOR(F.shiftleft("fp", (64 - i * SEGMENT_BITS) % 64))
                if i
                else F.col("fp")
            ).alias("ring"),
        )
        for i in range(SEGMENTS)
    ]
    return (
        fps.withColumn("_t", F.explode(F.array(*turned)))
        .select("*", "_t.turn", "_t.ring")
        .drop("_t")
        .withColumn("key", F.col("ring").bitwiseAND((1 << KEY_BITS) - 1).cast("int"))
    )


def _shuffled(rings: DataFrame) -> DataFrame:
    """Joined by a shuffle: Spark sizes unfolded rows by the table that they come from, a fraction of what they
    take, and would send them through the driver."""
    return rings.hint("merge")


def _pivot_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links of members of a bucket to one of its members, in several rounds with other pivots."""
    members, links = _rings(fps.select("fp")), None
    for n in range(PIVOT_ROUNDS):
        pivots = (
            members.groupBy("turn", "key")
            .agg(F.min_by("fp", F.xxhash64("fp", F.lit(n))).alias("pivot"), F.count(F.lit(1)).alias("n"))
            .where("n > 1")
            .drop("n")
        )
        found = (
            _shuffled(members).join(pivots, ["turn", "key"])
            .where((F.col("fp") != F.col("pivot")) & (_distance("fp", "pivot") <= max_bits))
            .select("fp", "pivot")
        )
        links = found if links is None else links.unionAll(found)
    return links.distinct()


def _chain_holds(ring: Column, other: Column, max_bits: int) -> Column:
    """From the start on, the differences of every chain stay within their share of the budget."""
    x, ok = ring.bitwiseXOR(other), F.lit(True)
    for n in range(1, SEGMENTS + 1):
        mask = (1 << (n * SEGMENT_BITS)) - 1 if n < SEGMENTS else -1
        ok = ok & (F.bit_count(x.bitwiseAND(F.lit(mask).cast("long"))) <= n * max_bits // SEGMENTS)
    return ok


def _cross_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links between fingerprints of different components (column ``root``)."""
    rings = _rings(fps)
    large = staged(
        rings.groupBy("turn", "key", "root")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("turn", "key")
        .agg(F.sum("n").alias("n"), F.max_by("root", "n").alias("main"))
        .where(F.col("n") > LARGE_BUCKET)
        .drop("n"),
        "buckets",
    )
    # in a large bucket, lane 1 lets the others meet all members, lane 2 the main component the others
    inside = F.col("main") == F.col("root")
    index = (
        rings.join(large, ["turn", "key"], "left")
        .withColumn(
            "lane",
            F.explode(
                F.when(F.col("main").isNull(), F.array(F.lit(0)))
                .when(inside, F.array(F.lit(1)))
                .otherwise(F.array(F.lit(1), F.lit(2)))
            ),
        )
        .select("turn", "key", "lane", F.col("ring").alias("ring_b"), F.col("root").alias("root_b"), F.col("fp").alias("fp_b"))
    )
    flips = F.array(*(F.lit(0 if b is None else 1 << b) for b in [None, *range(SEGMENT_BITS, KEY_BITS)]))
    even = F.pmod(F.bit_count(F.shiftright("key", SEGMENT_BITS)), F.lit(2)) == 0
    probe = (
        rings.withColumn("flip", F.explode(F.when(even, flips).otherwise(F.array(F.lit(0)))))
        .withColumn("key", F.col("key").bitwiseXOR(F.col("flip")))
        .join(large, ["turn", "key"], "left")
        .withColumn("lane", F.when(F.col("main").isNull(), 0).when(inside, 2).otherwise(1))
        .select("turn", "key", "lane", "flip", "ring", "root", "fp")
    )
    pair = probe.join(_shuffled(index), ["turn", "key", "lane"]).where(
        (F.col("root") != F.col("root_b"))
        & ((F.col("flip") != 0) | (F.col("fp") < F.col("fp_b")) | (F.col("lane") != 0))
        & _chain_holds(F.col("ring"), F.col("ring_b"), max_bits)
        & (_distance("fp", "fp_b") <= max_bits)
    )
    return pair.select(F.col("fp").alias("a"), F.col("fp_b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, shingle: int, max_bits: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fp, component_id): the smallest document id that a document's links reach."""
    if not 0 <= max_bits <= 5:
        raise ValueError("the keys serve up to five differing bits")
    printed = staged(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    nodes = staged(printed.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    tied = staged(components(_pivot_links(nodes, max_bits)), "tied")
    rooted = nodes.join(tied, nodes["fp"] == tied["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )
    rooted = staged(rooted, "rooted")
    cross = _cross_links(rooted, max_bits)
    found = components(tied.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(cross))
    linked = staged(found.join(nodes, F.col("node") == F.col("fp")).select("fp", "root", "first"), "linked")
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    of_linked = linked.join(least, "root").select("fp", "component_id")
    label = nodes.join(of_linked, "fp", "left").select(
        "fp", F.coalesce("component_id", "first").alias("component_id")
    )
    return printed.join(label, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int, max_bits: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest id of each component; repeated rows of an id count once.
    Rows without an id cannot be told apart by one and stay."""
    found = near_duplicates(docs, shingle, max_bits, doc_id, text)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_kept"))
    chosen = docs.join(kept, docs[doc_id] == kept["_kept"], "left_semi").dropDuplicates([doc_id])
    return chosen.unionByName(docs.where(F.col(doc_id).isNull()))


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
