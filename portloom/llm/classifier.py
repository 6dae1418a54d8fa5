"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Words (runs of letters, digits or other signs) fall into ``SLOTS`` hash slots. Every slot has a fixed
sparse random index vector; its context vector is the sum of the index vectors of the words up to
``REACH`` places before and after its own words, counted over all documents. A word vector is the
slot's mean context less the corpus mean, at length one. A document is pooled to the mean and the
mean square of its word vectors and to the length of that mean.

A network with one hidden layer is fitted in numpy on at most ``MAX_ROWS`` labelled documents, the
ones with the smallest hashes of their ids; a fifth of them is set apart to fit the temperature that
calibrates the probabilities. Word vectors and network have fixed sizes and travel to the tasks.

Defined results: a null text is empty; a text without words has zero features and is scored like any
other; repeated rows get equal scores; without labels of both kinds every score is the share of
label 1, or 0.5 without labels; documents without an id are scored but never learned from.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portloom.llm.frames import map_arrow, small_batches
from portloom.llm.linewords import blocks, line_words
from portloom.llm.staging import staged

SLOT_BITS, WIDTH, NONZERO, REACH = 15, 64, 4, 2
SLOTS = 1 << SLOT_BITS
WORDS_AT_ONCE = 1 << 20  # words whose contexts are added together
FEATURES = 2 * WIDTH + 1
MAX_ROWS = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 3e-3, 1e-4
SEED = 11


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero components of every slot's index vector."""
    draw = np.random.default_rng(SEED)
    return draw.integers(0, WIDTH, (SLOTS, NONZERO)), draw.choice([-1, 1], (SLOTS, NONZERO))


def _slots(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    line, h = line_words(block, by_kind=True)
    return line, (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def add_contexts(total: np.ndarray, slots: np.ndarray, owner: np.ndarray, index: tuple) -> None:
    """Adds the contexts of a run of words to the (slots, width + 1) sums; the last column counts."""
    places, signs = index
    flat = np.zeros(SLOTS * WIDTH)
    for off in range(1, REACH + 1):
        same = owner[off:] == owner[:-off]
        after, before = slots[off:][same], slots[:-off][same]
        for word, near in ((after, before), (before, after)):
            for j in range(NONZERO):
                flat += np.bincount(word * WIDTH + places[near, j], weights=signs[near, j], minlength=SLOTS * WIDTH)
    total[:, :WIDTH] += flat.reshape(SLOTS, WIDTH).astype(np.int64)
    total[:, WIDTH] += np.bincount(slots, minlength=SLOTS)


def _packed(total: np.ndarray) -> bytes:
    return zlib.compress(total.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype=np.int64).reshape(SLOTS, WIDTH + 1)


def context_sums(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Contexts of all documents; whole numbers, so the order of adding does not matter. The partial
    sums of the tasks have a fixed size and are added in a tree on the executors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, index = np.zeros((SLOTS, WIDTH + 1), dtype=np.int64), _index_vectors()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def add() -> None:
            if held:
                add_contexts(total, *map(np.concatenate, zip(*held, strict=True)), index)
                held.clear()

        for batch in batches:
            for part in small_batches(batch, "text"):
                for block, owner, _ in blocks(part.column("text").to_pylist()):
                    line, slots = _slots(block)
                    held.append((slots, owner[line]))
                    if sum(len(s) for s, _ in held) >= WORDS_AT_ONCE:
                        add()
                add()  # documents are numbered within a part
        yield pa.RecordBatch.from_arrays([pa.array([_packed(total)], pa.binary())], names=["sums"])

    parts = docs.select(F.col(text).alias("text")).mapInArrow(count, "sums binary").rdd
    if parts.getNumPartitions() == 0:
        return np.zeros((SLOTS, WIDTH + 1), dtype=np.int64)
    whole = parts.map(lambda r: bytes(r[0])).treeReduce(lambda a, b: _packed(_unpacked(a) + _unpacked(b)), depth=3)
    return _unpacked(whole)


def word_vectors(sums: np.ndarray) -> np.ndarray:
    context, n = sums[:, :WIDTH].astype(np.float64), sums[:, WIDTH]
    mean = context.sum(axis=0) / max(1, n.sum())
    own = context / np.maximum(1, n)[:, None] - mean
    own[n == 0] = 0
    return (own / np.maximum(1e-9, np.linalg.norm(own, axis=1, keepdims=True))).astype(np.float32)


def pooled(texts: list[str | None], vectors: np.ndarray) -> np.ndarray:
    """One row of features per text."""
    sums, counts = np.zeros((len(texts), 2 * WIDTH), dtype=np.float64), np.zeros(len(texts))
    both = np.hstack([vectors, vectors * vectors])
    for block, owner, _ in blocks(texts):
        line, slots = _slots(block)
        if not len(slots):
            continue
        rows = owner[line]
        cuts = [0, *(np.flatnonzero(rows[1:] != rows[:-1]) + 1).tolist(), len(rows)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            sums[rows[a]] += both[slots[a:b]].sum(axis=0)
            counts[rows[a]] += b - a
    mean = sums / np.maximum(1, counts)[:, None]
    return np.hstack([mean, np.linalg.norm(mean[:, :WIDTH], axis=1, keepdims=True)]).astype(np.float32)


@dataclass(frozen=True)
class Network:
    """Standardised input, one hidden layer of rectifiers, a logit and its temperature."""

    mean: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum((x - self.mean) / self.scale @ w1 + b1, 0) @ w2 + b2[0]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x.astype(np.float64)) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def fit_network(x: np.ndarray, y: np.ndarray, for_temperature: np.ndarray) -> Network:
    """Fits on the rows that are not ``for_temperature`` and the temperature on those that are."""
    if not len(y) or y.min() == y.max() or not 0 < y[~for_temperature].mean() < 1:
        share = min(max(y.mean(), 1e-6), 1 - 1e-6) if len(y) else 0.5
        logit = np.array([np.log(share / (1 - share))])
        empty = (np.zeros((FEATURES, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), logit)
        return Network(np.zeros(FEATURES), np.ones(FEATURES), empty)
    x = x.astype(np.float64)
    own, target = x[~for_temperature], y[~for_temperature]
    mean, scale = own.mean(axis=0), own.std(axis=0) + 1e-6
    own = (own - mean) / scale
    draw = np.random.default_rng(SEED)
    weights = [
        draw.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)),
        np.zeros(HIDDEN),
        draw.normal(0, HIDDEN**-0.5, HIDDEN),
        np.zeros(1),
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(own))
        for at in range(0, len(own), BATCH):
            rows = order[at : at + BATCH]
            hidden = own[rows] @ weights[0] + weights[1]
            active = np.maximum(hidden, 0)
            error = (_sigmoid(active @ weights[2] + weights[3]) - target[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (hidden > 0)
            slopes = [own[rows].T @ back + DECAY * weights[0], back.sum(axis=0), active.T @ error, error.sum(keepdims=True)]
            step += 1
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                move = first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
                weights[i] = weights[i] - RATE * move
    network = Network(mean, scale, tuple(weights))
    if not for_temperature.any():
        return network
    z, target = network.logits(x[for_temperature]), y[for_temperature]
    choices = np.exp(np.linspace(np.log(0.25), np.log(8), 101))
    best = min(choices, key=lambda t: _loss(z / t, target))
    return Network(mean, scale, network.weights, float(best))


def document_features(docs: DataFrame, vectors: np.ndarray, text: str = "text", into: str = "features") -> DataFrame:
    """Adds the pooled features as little-endian 32-bit floats."""
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = pooled(batch.column(text).to_pylist(), sent.value)
        out = pa.array([r.tobytes() for r in rows], pa.binary())
        return pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, into])

    return map_arrow(docs, add, {into: T.BinaryType()}, sized_by=text)


def fit(features: DataFrame, labels: DataFrame, doc_id: str = "doc_id", max_rows: int = MAX_ROWS) -> Network:
    """``labels``: (doc_id, label 0 or 1) of the documents to learn from."""
    id_col, label = labels.columns
    known = labels.select(F.col(id_col).alias("_id"), F.col(label).alias("_label")).dropna().dropDuplicates(["_id"])
    known = known.withColumn("_mix", F.xxhash64("_id"))
    ids = features.select(F.col(doc_id).alias("_id"))
    # only ids are shuffled; of the features, those of at most ``max_rows`` ids are looked up
    first = ids.join(known, "_id").orderBy("_mix").limit(max_rows).dropDuplicates(["_id"])
    rows = (
        features.select(F.col(doc_id).alias("_id"), "features")
        .join(F.broadcast(first), "_id")
        .orderBy("_mix", "features")
        .limit(max_rows)
        .select("features", "_label", (F.pmod(F.col("_mix"), F.lit(5)) == 0).alias("_apart"))
        .collect()
    )
    x = np.frombuffer(b"".join(bytes(r["features"]) for r in rows), dtype="<f4").reshape(-1, FEATURES)
    return fit_network(x, np.array([float(r["_label"]) for r in rows]), np.array([r["_apart"] for r in rows], dtype=bool))


def score(features: DataFrame, network: Network, into: str = "score") -> DataFrame:
    """Replaces the features by the calibrated probability of label 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index("features")
            x = np.frombuffer(b"".join(batch.column(at).to_pylist()), dtype="<f4").reshape(-1, FEATURES)
            columns = [c for i, c in enumerate(batch.columns) if i != at] + [pa.array(network.probabilities(x))]
            names = [n for i, n in enumerate(batch.schema.names) if i != at] + [into]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [f for f in features.schema.fields if f.name != "features"] + [T.StructField(into, T.DoubleType())]
    return features.mapInArrow(run, T.StructType(fields))


def scored(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of all documents, after learning from ``labels``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    vectors = word_vectors(context_sums(rows))
    features = staged(document_features(rows, vectors).select("doc_id", "features"), "features")
    return score(features, fit(features, labels))


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the checksum of the id as text falls into the fold; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))
