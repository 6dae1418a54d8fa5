"""MinHash near-duplicates: an LSH forest of sorted signature orders, verified links, components.

A document is the set of its distinct word shingles; equal sets are one node. ``TREES`` trees order the
nodes by their own ``DEPTH`` min-hashes each. Nodes that share the first ``FIRST`` hashes of a tree are
a region of it; a pair of similarity s is in one with probability s ** FIRST (0.64 at 0.8), so all
trees part a pair of 0.8 or more with probability below 1e-7. Candidates come from the regions:

- Neighbours. In each tree's order every node meets the node before it (in the next round the one
  behind it) that is not of its component yet, which is the one of the longest common prefix. The
  ``NEAREST`` of them over all trees by sketch are compared. That takes a few rows a node, however
  large a group of near copies is, and ties such groups into components.
- Regions. What is compared after that are all pairs of different components in a region, whatever its
  size: those of at most ``CROWDED`` nodes by a join, larger ones in blocks of ``PER_BLOCK`` nodes of like size,
  block against block. A component that fills blocks is not compared with itself, so a large group of near
  copies costs a row for each of the nodes it lies among. Only a large group of texts that are similar below
  the threshold is paired in full; its tasks hold two blocks at a time.

No pair of a region is left out, so a link is missed only by the bounds above and by the sketches.

Candidates must agree in size and in a sketch of four bits of each min-hash; a pair of 0.8 differs in
more than ``SKETCH_MISSES`` of the ``HASHES`` with probability below 1e-5. They are then confirmed on the
full sets of their texts' shingles.

Defined results: a null or wordless text has an empty set and is linked with nothing; rows without an
id get the smallest id of their component, null if it has none, and are kept only then; repeated rows
get equal results; an empty table gives no rows. Columns besides the id and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portloom.llm.components import components
from portloom.llm.frames import small_batches
from portloom.llm.staging import staged

SHINGLE, PERCENT = 5, 80
TREES, DEPTH, FIRST = 16, 8, 2
HASHES = TREES * DEPTH
_HASH_BYTES = 2
CROWDED = 128
PER_BLOCK = 4096
_CELLS = 1 << 20
NEAREST = 3
ROUNDS = 2
PLANES = 4
SKETCH_MISSES = 46
_HALVES = HASHES // 64
SKETCH = [f"s{i}" for i in range(PLANES * _HALVES)]  # plane by plane, 64 hashes in each number
#: Texts of candidates are looked up through a broadcast list of up to so many rows (8 bytes each).
BROADCAST_ROWS = 2_000_000
#: Pairs with one document on the right side that go to one task.
PAIRS_PER_SLICE = 256
_BLOCK = 1 << 11
_draw = np.random.default_rng(20240229)
_MASKS = _draw.integers(0, 1 << 63, HASHES, dtype=np.uint64)[:, None]
_ODDS = (_draw.integers(0, 1 << 63, HASHES, dtype=np.uint64) << np.uint64(1) | np.uint64(1))[:, None]
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Bytes lower-case only A-Z and split only at ASCII blanks."""
    return (text or "").encode().lower().split()


def shingles(text: str | None, size: int) -> set[bytes]:
    """The distinct shingles; fewer words are one, no words none."""
    words = words_of(text)
    if not words:
        return set()
    joined, size = b" ".join(words), min(size, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    return {joined[a : b - 1] for a, b in zip(starts, ends[size - 1 :], strict=False)}


def signature(hashes: np.ndarray) -> np.ndarray:
    """The min-hashes of a set of 64-bit hashes, as mixed 64-bit numbers."""
    least = np.full((HASHES, 1), np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), _BLOCK):
        turned = (hashes[None, at : at + _BLOCK] ^ _MASKS) * _ODDS
        least = np.minimum(least, turned.min(axis=1, keepdims=True))
    mixed = (least[:, 0] ^ (least[:, 0] >> np.uint64(32))) * _MIX
    return mixed ^ (mixed >> np.uint64(29))


def _sketched(text: str | None, size: int) -> tuple:
    """(size of the set, its digest, labels of all trees, the numbers of the sketch)."""
    found = shingles(text, size)
    if not found:
        return 0, None, None, *(None for _ in SKETCH)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    hashes.sort()
    mixed = signature(hashes)
    labels = (mixed >> np.uint64(48)).astype(">u2").tobytes()
    planes = np.array([(mixed >> np.uint64(i)) & np.uint64(1) for i in range(PLANES)], dtype=np.uint8)
    digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
    return len(found), digest, labels, *np.packbits(planes, axis=1).view("<i8").ravel().tolist()


def _sketches(docs: DataFrame, size: int, doc_id: str, text: str) -> DataFrame:
    names = ["doc_id", "text", "n", "digest", "labels", *SKETCH]
    kinds = [pa.int64(), pa.binary(), pa.binary(), *(pa.int64() for _ in SKETCH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole, "text"):
                rows = [_sketched(t.as_py(), size) for t in batch.column("text")]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), *columns], names=names)

    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, text string, n long, digest binary, labels binary, "
    schema += ", ".join(f"{c} long" for c in SKETCH)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
    return staged(rows.withColumn("row", F.monotonically_increasing_id()), "sketches", "zstd")


def _alike(percent: int) -> Column:
    """Sizes that allow the similarity, and sketches that do not speak against it."""
    misses = F.lit(0)
    for half in range(_HALVES):
        differing = F.lit(0).cast("long")
        for c in SKETCH[half::_HALVES]:
            differing = differing.bitwiseOR(F.col(c).bitwiseXOR(F.col(f"{c}_b")))
        misses = misses + F.bit_count(differing)
    return (100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b")) & (misses <= SKETCH_MISSES)


def _prefix(depth: int) -> Column:
    return F.substring("label", 1, depth * _HASH_BYTES)


def _members(nodes: DataFrame) -> DataFrame:
    """One row per tree and node, with the tree's label; only nodes that share a region with others."""
    trees = F.array(*(F.lit(t).cast("tinyint") for t in range(TREES)))
    width = DEPTH * _HASH_BYTES

    def label(hashes: int) -> Column:
        return F.substring(F.col("labels"), F.col("tree").cast("int") * width + 1, F.lit(hashes * _HASH_BYTES))

    rows = nodes.select("node", "labels", F.explode(trees).alias("tree")).select("node", "tree", label(FIRST).alias("key"))
    regions = rows.groupBy("tree", "key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = rows.join(regions.drop("members"), ["tree", "key"])  # sketches join only nodes that are in one
    shared = shared.groupBy("node").agg(F.collect_list("tree").alias("trees"))
    found = nodes.join(shared, "node").withColumn("tree", F.explode("trees")).withColumn("label", label(DEPTH))
    return staged(found.drop("labels", "trees"), "members")


def _misses(rows: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros(len(a), dtype=np.int64)
    for half in range(_HALVES):
        differing = np.zeros(len(a), dtype=np.int64)
        for c in SKETCH[half::_HALVES]:
            differing |= rows[c][a] ^ rows[c][b]
        total += np.bitwise_count(differing.view(np.uint64))  # of a signed number it would count the magnitude
    return total


def _neighbours(members: DataFrame, percent: int, behind: bool) -> DataFrame:
    """(a, b) of each node and the ``NEAREST`` of its next nodes of other components, before it or
    behind it in the orders of the trees. ``members`` has the component in ``root``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: dict[str, np.ndarray] | None = None  # the last row and the next one of another component
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("tree", "node", "root", "n", *SKETCH)}
            rows["key"] = np.array([k[: FIRST * _HASH_BYTES] for k in batch.column("label").to_pylist()], dtype=object)
            if carried is not None:
                rows = {c: np.concatenate([carried[c], v]) for c, v in rows.items()}
            size, at = len(rows["n"]), np.arange(len(rows["n"]))
            begins = np.ones(size, dtype=bool)
            begins[1:] = (rows["tree"][1:] != rows["tree"][:-1]) | (rows["key"][1:] != rows["key"][:-1])
            other = np.zeros(size, dtype=bool)
            other[1:] = rows["root"][1:] != rows["root"][:-1]
            next_of = np.maximum.accumulate(np.where(other, at - 1, -1))
            next_of[next_of < np.maximum.accumulate(np.where(begins, at, 0))] = -1
            mine = at[(next_of >= 0) & (at >= size - batch.num_rows)]
            theirs = next_of[mine]
            small, large = np.minimum(rows["n"][mine], rows["n"][theirs]), np.maximum(rows["n"][mine], rows["n"][theirs])
            misses = _misses(rows, mine, theirs)
            fits = (100 * small >= percent * large) & (misses <= SKETCH_MISSES)
            columns = [rows["node"][mine[fits]], rows["node"][theirs[fits]], misses[fits]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["x", "y", "misses"])
            last = [size - 1] if next_of[-1] < 0 else [next_of[-1], size - 1]
            carried = {c: v[last] for c, v in rows.items()}

    order = [c.desc() if behind else c.asc() for c in (F.col("tree"), F.col("label"), F.xxhash64("node"))]
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    found = dealt.mapInArrow(run, "x long, y long, misses long").distinct()
    nearest = F.row_number().over(Window.partitionBy("x").orderBy("misses", "y"))  # a row per tree at most
    found = found.withColumn("nth", nearest).where(F.col("nth") <= NEAREST)
    return found.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def _compared(rows: dict[str, np.ndarray], others: dict[str, np.ndarray], percent: int) -> np.ndarray:
    """Index pairs (row, other) of different components whose sizes and sketches allow the similarity."""
    both = {c: np.concatenate([rows[c], others[c]]) for c in rows}
    first, found = len(rows["n"]), [np.empty((0, 2), dtype=np.int64)]
    step = max(1, _CELLS // max(1, len(others["n"])))
    for at in range(0, first, step):
        here = slice(at, min(first, at + step))
        small = np.minimum(rows["n"][here, None], others["n"][None, :])
        large = np.maximum(rows["n"][here, None], others["n"][None, :])
        fits = (100 * small >= percent * large) & (rows["root"][here, None] != others["root"][None, :])
        x, y = np.nonzero(fits)
        close = _misses(both, x + at, y + first) <= SKETCH_MISSES
        found.append(np.stack([x[close] + at, y[close]], axis=1))
    return np.concatenate(found)


def _crowded_pairs(rows: DataFrame, percent: int, per_block: int) -> DataFrame:
    """(a, b) of different components in regions of any size, block against block.

    A region is dealt into blocks of about ``per_block`` nodes: by size, in classes so wide that a pair meets
    in one or in two next to each other, then by component. A component that fills blocks has blocks of its own,
    which are not compared with each other; so a large group of near copies costs as much as what it lies among.
    """
    wide = float(np.log(100 / percent)) + 1e-3
    rows = rows.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / F.lit(wide)).cast("int"))
    region, group = ["tree", "key"], ["tree", "key", "class"]
    roots = rows.groupBy(*group, "root").agg(F.count(F.lit(1)).alias("held"))
    large = roots.where(F.col("held") > per_block)
    rest = roots.where(F.col("held") <= per_block).groupBy(*group).agg(F.sum("held").alias("held"))
    none = F.lit(None).cast("long")
    blocks = large.unionByName(rest.withColumn("root", none)).withColumn("blocks", F.ceil(F.col("held") / per_block).cast("int"))
    blocks = staged(blocks.withColumnRenamed("root", "own").drop("held"), "blocks")
    of_large = blocks.where("own IS NOT NULL").select(*group, F.col("own").alias("root"), F.col("blocks").alias("of_own"))
    of_rest = blocks.where("own IS NULL").select(*group, F.col("blocks").alias("of_rest"))
    dealt = rows.join(of_large, [*group, "root"], "left").join(of_rest, group, "left")
    mine = F.col("of_own").isNotNull()
    dealt = dealt.withColumn("own", F.when(mine, F.col("root"))).withColumn(
        "block",
        F.when(mine, F.pmod(F.xxhash64("node"), F.col("of_own"))).otherwise(F.pmod(F.xxhash64("root"), F.col("of_rest"))).cast("int"),
    )
    place = ["class", "own", "block"]
    each = blocks.select(*group, "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    met = each.join(each.select(*region, *(F.col(c).alias(f"{c}_b") for c in place)), region)
    rank = [F.struct("own", "block"), F.struct(F.col("own_b").alias("own"), F.col("block_b").alias("block"))]
    following = (F.col("class_b") == F.col("class") + 1) | ((F.col("class_b") == F.col("class")) & (rank[0] <= rank[1]))
    met = met.where(following & ~F.coalesce(F.col("own") == F.col("own_b"), F.lit(False)))
    met = staged(met.withColumn("meeting", F.monotonically_increasing_id()), "meetings")

    def side(suffix: str) -> DataFrame:
        keys = [*region, *place]
        at = met.select("meeting", *(F.col(c if c in region else f"{c}{suffix}").alias(f"{c}_m") for c in keys))
        same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"{c}_m")) for c in keys))
        held = ("meeting", "node", "root", "n", *SKETCH)
        return dealt.join(at, same).select(*(F.col(c).alias(f"{c}{suffix}") for c in held))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, others = (
            {c: t.column(f"{c}{suffix}").to_numpy() for c in ("node", "root", "n", *SKETCH)}
            for t, suffix in ((left, ""), (right, "_b"))
        )
        at = _compared(rows, others, percent)
        x, y = rows["node"][at[:, 0]], others["node"][at[:, 1]]
        return pa.table({"a": pa.array(np.maximum(x, y), pa.int64()), "b": pa.array(np.minimum(x, y), pa.int64())})

    return side("").groupBy("meeting").cogroup(side("_b").groupBy("meeting_b")).applyInArrow(run, "a long, b long")


def _region_pairs(members: DataFrame, percent: int, crowded: int) -> DataFrame:
    """(a, b) of different components that share a region and whose sizes and sketches allow the
    similarity: those of at most ``crowded`` nodes by a join, the others block against block."""
    rows = members.withColumn("key", _prefix(FIRST)).drop("label")
    regions = rows.groupBy("tree", "key").agg(
        F.count(F.lit(1)).alias("members"), (F.min("root") < F.max("root")).alias("mixed")
    )
    found = staged(rows.join(regions.where("mixed").drop("mixed"), ["tree", "key"]), "regions")
    fitting = found.where(F.col("members") <= crowded).drop("members")
    other = fitting.select("tree", "key", *(F.col(c).alias(f"{c}_b") for c in ("node", "root", "n", *SKETCH)))
    pairs = fitting.join(other, ["tree", "key"]).where(
        (F.col("node") > F.col("node_b")) & (F.col("root") != F.col("root_b")) & _alike(percent)
    )
    pairs = pairs.select(F.col("node").alias("a"), F.col("node_b").alias("b"))
    left = found.where(F.col("members") > crowded).drop("members")
    if not left.isEmpty():
        pairs = pairs.unionAll(_crowded_pairs(left, percent, PER_BLOCK))
    return pairs.distinct()


def _confirmed(pairs: DataFrame, sketches: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of rows whose full shingle sets are similar. A text goes once to each of its
    pairs as ``a``, and once to each slice of the pairs that have it as ``b``."""
    pairs = staged(pairs, "candidates")
    wanted = pairs.select(F.col("a").alias("row")).unionAll(pairs.select(F.col("b").alias("row"))).distinct()
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = staged(sketches.select("row", "text").join(wanted, "row", "left_semi"), "texts", "zstd")
    slices = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_SLICE).cast("int").alias("slices"))
    right = (
        texts.withColumnRenamed("row", "b")
        .join(slices, "b")
        .select("b", F.col("text").alias("text_b"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    )
    left = (
        pairs.join(slices, "b")
        .withColumn("slice", F.pmod(F.xxhash64("a"), F.col("slices")).cast("int"))
        .join(texts.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = None, frozenset()
        for whole in batches:
            for batch in small_batches(whole, "text_a"):
                found = []
                for a, b, t, u in zip(*(batch.column(c) for c in ("a", "b", "text_a", "text_b")), strict=True):
                    if b.as_py() != known:
                        known, own = b.as_py(), shingles(u.as_py(), size)
                    other = shingles(t.as_py(), size)
                    both = len(own & other)
                    if 100 * both >= percent * (len(own) + len(other) - both):
                        found.append((a.as_py(), known))
                columns = zip(*found, strict=True) if found else ([], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    joined = left.drop("slices").join(right, ["b", "slice"]).select("a", "b", "text_a", "text_b")
    return staged(joined.mapInArrow(run, "a long, b long"), "confirmed")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    crowded: int = CROWDED,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row: documents of at least ``percent`` per
    cent Jaccard similarity are linked, and a component is named by its smallest document id."""
    if not 80 <= percent <= 100:
        raise ValueError("the trees and sketches are made for similarities of 80 per cent or more")
    sketches = _sketches(docs, shingle, doc_id, text)
    nodes = staged(
        sketches.where("n > 0")
        .groupBy("digest")
        .agg(
            F.min("row").alias("node"),
            F.min("doc_id").alias("first"),
            *(F.first(c).alias(c) for c in ("n", "labels", *SKETCH)),  # equal in all rows of a digest
        ),
        "nodes",
    )
    members = _members(nodes.drop("digest", "first"))

    def rooted(joined: DataFrame | None) -> DataFrame:
        if joined is None:
            return members.withColumn("root", F.col("node"))
        return members.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))

    joined = None
    for turn in range(ROUNDS + 1):
        now = rooted(joined)
        pairs = _neighbours(now, percent, turn % 2 == 1) if turn < ROUNDS else _region_pairs(now, percent, crowded)
        found = _confirmed(pairs, sketches, shingle, percent)
        links = found if joined is None else joined.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(found)
        joined = staged(components(links), "tied").select("node", "root")
    of_linked = staged(joined.join(nodes.select("node", "digest", "first"), "node"), "linked")
    least = of_linked.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = of_linked.join(least, "root").select("digest", "component_id")
    labels = nodes.join(linked, "digest", "left").select("digest", F.coalesce("component_id", "first").alias("component_id"))
    found = sketches.select("doc_id", "n", "digest").join(labels, "digest", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
