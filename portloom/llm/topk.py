"""Exact search for the largest inner products by elimination with a pivot table.

Every candidate gets one more component that brings all to the same length, every query a zero; then
the nearest candidates are those of the largest inner product. The distances of all vectors to the
pivots are computed first; by the triangle inequality the largest difference over the pivots bounds
a distance from below, and so a score from above. A query takes candidates in the order of their
bounds and stops for good where the bound falls under the k-th best score found; bounded seeds give
every query such a score before it starts.

Queries and candidates meet in blocks of fixed size, each block pair in one task.

Defined results: rows without an id, and vectors that are null, hold a null or a value that is not
finite, or have another length than the commonest one (the longer of two), take no part. A query's
own id is no candidate for it. Repeated candidate rows count each; a repeated query row is one
query. Equal scores go to the smaller id. Fewer candidates than k give fewer rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portloom.llm.staging import staged

PIVOTS, SEEDS = 64, 1024
QUERY_BLOCK, CANDIDATE_BLOCK = 8192, 8192
AT_ONCE = 64  # queries whose bounds stand in memory together
FIRST_LOOK = 128  # candidates of the best bounds that are evaluated before the rest
_SLACK = 1e-9  # relative, for the rounding of distances


def usable(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, x) of the vectors that take part."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("x")).where(
        F.col("id").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    )
    size = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return rows.where(F.size("x") == (size[0]["n"] if size else 0))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]).to_numpy() if column.num_chunks else np.empty(0)
    return flat.reshape(len(column), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


class Elimination:
    """Pivots and seeds of a search, shared by all its tasks."""

    def __init__(self, seeds: np.ndarray, seed_ids: np.ndarray, longest: float, k: int):
        self.k, self.longest = k, longest
        self.seeds, self.seed_ids = seeds, seed_ids
        self.pivots = self.lifted(seeds[:PIVOTS])

    def lifted(self, candidates: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.longest - (candidates * candidates).sum(axis=1), 0)
        return np.hstack([candidates, np.sqrt(rest)[:, None]])

    def floor_scores(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """A score that k seeds reach, for each query."""
        scores = np.where(ids[:, None] == self.seed_ids[None], -np.inf, queries @ self.seeds.T)
        if scores.shape[1] < self.k:
            return np.full(len(queries), -np.inf)
        return np.partition(scores, -self.k, axis=1)[:, -self.k]

    def best(self, queries: np.ndarray, ids: np.ndarray, candidates: np.ndarray, candidate_ids: np.ndarray):
        """(query row, candidate row, score) of the k best of these candidates that may be among the k
        best of all, equal scores by id."""
        to_candidates = _distances(self.lifted(candidates), self.pivots).astype(np.float32)
        by_id = np.argsort(candidate_ids, kind="stable")
        place = np.empty(len(by_id), dtype=np.int64)
        place[by_id] = np.arange(len(by_id))
        found = []
        for at in range(0, len(queries), AT_ONCE):
            q, own = queries[at : at + AT_ONCE], ids[at : at + AT_ONCE, None] == candidate_ids[None]
            to_q = _distances(np.hstack([q, np.zeros((len(q), 1))]), self.pivots).astype(np.float32)
            lower = np.zeros(own.shape, dtype=np.float32)
            for p in range(len(self.pivots)):
                np.maximum(lower, np.abs(to_q[:, p, None] - to_candidates[None, :, p]), out=lower)
            scale = (q * q).sum(axis=1)[:, None] + self.longest
            # single precision distances are lowered by more than they may be off
            lower = np.maximum(lower.astype(np.float64) - 1e-6 * np.sqrt(scale) - 1e-12, 0)
            bound = np.where(own, -np.inf, (scale - lower * lower) / 2 + _SLACK * scale)
            floor = self.floor_scores(q, ids[at : at + AT_ONCE])
            for row, column, score in self._in_bound_order(q, candidates, bound, floor):
                if len(column) > self.k:  # a group of ties is cut to its smallest ids
                    order = np.lexsort((place[column], -score))[: self.k]
                    column, score = column[order], score[order]
                found.append((np.full(len(column), at + row), column, score))
        return tuple(map(np.concatenate, zip(*found, strict=True))) if found else None

    def _in_bound_order(self, q: np.ndarray, candidates: np.ndarray, bound: np.ndarray, floor: np.ndarray):
        score = np.full(bound.shape, -np.inf)
        look = min(FIRST_LOOK, bound.shape[1])
        first = np.argpartition(-bound, look - 1, axis=1)[:, :look]
        seen = np.einsum("qd,qmd->qm", q, candidates[first])
        near = np.take_along_axis(bound, first, axis=1)
        eligible = (near >= floor[:, None]) & (near > -np.inf)
        np.put_along_axis(score, first, np.where(eligible, seen, -np.inf), axis=1)
        if look >= self.k:
            floor = np.maximum(floor, np.partition(score, -self.k, axis=1)[:, -self.k])
        # whoever has a bound left that reaches its floor goes on, with those candidates only
        left = (bound >= floor[:, None]) & (bound > -np.inf)
        np.put_along_axis(left, first, False, axis=1)
        rows, columns = np.flatnonzero(left.any(axis=1)), np.flatnonzero(left.any(axis=0))
        if len(rows) and len(columns):
            grid = np.ix_(rows, columns)
            score[grid] = np.where(left[grid], q[rows] @ candidates[columns].T, score[grid])
        if score.shape[1] > self.k:
            floor = np.maximum(floor, np.partition(score, -self.k, axis=1)[:, -self.k])
        keep = (score >= floor[:, None]) & (score > -np.inf)
        for row in range(len(q)):
            column = np.flatnonzero(keep[row])
            if len(column):
                yield row, column, score[row, column]


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "id", vector: str = "x") -> DataFrame:
    """(query_id, rank, id, score) of the ``k`` largest inner products of each query.

    ``queries`` has one column of ids; the vectors are those of ``vectors``."""
    rows = staged(usable(vectors, id_col, vector).withColumn("seat", F.monotonically_increasing_id()), "vectors")
    asked = queries.select(F.col(queries.columns[0]).alias("id")).dropna().distinct()
    chosen = staged(rows.join(asked, "id", "left_semi").dropDuplicates(["id"]).select(rows.columns), "queries")
    n, n_queries = rows.count(), chosen.count()
    kind = dict(rows.dtypes)["id"]
    schema = f"query_id {kind}, id {kind}, score double"
    names = ["query_id", "id", "score"]
    if not n_queries:
        return chosen.select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), "id", F.lit(0.0).alias("score")
        ).where("false")
    longest = rows.agg(F.max(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))).first()[0]
    seeds = rows.orderBy(F.xxhash64("seat")).limit(SEEDS).select("id", "x").collect()  # a fixed number
    plan = Elimination(np.array([r["x"] for r in seeds]), np.array([r["id"] for r in seeds]), float(longest), k)
    sent = rows.sparkSession.sparkContext.broadcast(plan)

    query_blocks, blocks = -(-n_queries // QUERY_BLOCK), -(-n // CANDIDATE_BLOCK)
    each = F.xxhash64("seat")
    candidates = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"),
        F.pmod(each, F.lit(blocks)).cast("int").alias("cb"),
        F.lit(False).alias("query"),
        "id",
        "x",
    )
    asking = chosen.select(
        F.pmod(each, F.lit(query_blocks)).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("cb"),
        F.lit(True).alias("query"),
        "id",
        "x",
    )

    def meet(key, block):
        is_query = block["query"].to_numpy()
        ids, x = block["id"].to_numpy(), _matrix(block["x"])
        found = None
        if is_query.any() and not is_query.all():
            found = sent.value.best(x[is_query], ids[is_query], x[~is_query], ids[~is_query])
        if found is None:
            return pa.table([pa.array([], block["id"].type)] * 2 + [pa.array([], pa.float64())], names=names)
        q, c, score = found
        return pa.table([ids[is_query][q], ids[~is_query][c], score], names=names)

    found = candidates.unionAll(asking).groupBy("qb", "cb").applyInArrow(meet, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score"
    )
