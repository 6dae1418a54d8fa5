"""Staleness of partitions and the state of upstream tables seen from their consumers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portloom.operators.closure import reachability
from portloom.session import cut_lineage

#: From the best state to the worst; a relation without a state never arrived.
STATES = ("pass", "warn", "error", "never")


def stale_partitions(up: DataFrame, down: DataFrame, part: str, ts: str) -> DataFrame:
    """Upstream partitions that the target lacks or that were loaded after the target's."""
    newest = up.groupBy(part).agg(F.max(ts).alias("upstream_loaded_at"))
    built = down.groupBy(part).agg(F.max(ts).alias("target_loaded_at"))
    joined = newest.join(built, part, "left")
    behind = F.col("target_loaded_at").isNull() | (F.col("upstream_loaded_at") > F.col("target_loaded_at"))
    reason = F.when(F.col("target_loaded_at").isNull(), "missing").otherwise("outdated")
    return joined.where(behind).withColumn("reason", reason)


def upstream_status(edges: DataFrame, status: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(consumer, waiting_for, depth, status): which direct or indirect inputs have not arrived.

    ``edges`` is (upstream, downstream); ``status`` holds (relation, status) as given by the
    freshness check, and a relation not listed there never arrived. The closure starts at the late
    relations only, so tables whose inputs are all in cost nothing.
    """
    relations = (
        edges.select(F.col("upstream").alias("relation"))
        .unionAll(edges.select(F.col("downstream").alias("relation")))
        .distinct()
    )
    late = relations.join(status, "relation", "left").select(
        "relation", F.coalesce("status", F.lit("never")).alias("status")
    )
    late = late.where(F.col("status") != "pass")
    seeds = late.select(F.col("relation").alias("node"))
    reached = reachability(edges, seeds, "upstream", "downstream", max_depth=max_depth).where(F.col("depth") > 0)
    return reached.join(late.withColumnRenamed("relation", "root"), "root").select(
        F.col("node").alias("consumer"), F.col("root").alias("waiting_for"), "depth", "status"
    )


def downstream_freshness(edges: DataFrame, status: DataFrame) -> DataFrame:
    """(consumer, status, waiting_for, depth): the worst state among the direct and indirect inputs of
    each table that has a late one, and its nearest cause, of several the first by name.

    ``edges`` and ``status`` as in :func:`upstream_status`. Every table holds one state, and a round
    passes on those that got worse or nearer; depths only grow along an edge, so rounds end on cycles
    too. The work of a round is the edges of the tables that changed, never causes times consumers.
    """
    hops = cut_lineage(edges.select(F.col("upstream").alias("node"), F.col("downstream").alias("_to")).dropna().distinct())
    every = hops.select(F.col("node").alias("relation")).unionAll(hops.select(F.col("_to").alias("relation"))).distinct()
    known = F.create_map(*(F.lit(v) for i, s in enumerate(STATES) for v in (s, i)))
    rank = F.coalesce(known[F.coalesce("status", F.lit(STATES[-1]))], F.lit(len(STATES) - 1))
    late = every.join(status, "relation", "left").select(F.col("relation").alias("node"), rank.alias("rank"))
    # the smallest state is the worst and nearest one
    state = F.struct((-F.col("rank")).alias("better"), F.lit(0).alias("depth"), F.col("node").alias("cause"))
    own = cut_lineage(late.where("rank > 0").select("node", state.alias("state")))
    inherited, fresh = own.limit(0), own
    while not fresh.isEmpty():
        passed = fresh.join(hops, "node").select(
            F.col("_to").alias("node"),
            F.struct(F.col("state.better"), (F.col("state.depth") + 1).alias("depth"), F.col("state.cause")).alias("state"),
        )
        offered = passed.groupBy("node").agg(F.min("state").alias("_new"))
        merged = inherited.join(offered, "node", "full").select(
            "node", F.least("state", "_new").alias("state"), (F.col("state").isNull() | (F.col("_new") < F.col("state"))).alias("moved")
        )
        merged = cut_lineage(merged.withColumn("moved", F.coalesce("moved", F.lit(False))))
        inherited = merged.select("node", "state")
        # a table that is late itself passes on whatever is worse, its own state or the inherited one
        held = own.withColumnRenamed("state", "_own")
        moved = merged.where("moved").join(held, "node", "left")
        fresh = cut_lineage(moved.where(F.col("_own").isNull() | (F.col("state") < F.col("_own"))).select("node", "state"))
    names = F.array(*(F.lit(s) for s in STATES))
    return inherited.select(
        F.col("node").alias("consumer"),
        F.get(names, -F.col("state.better")).alias("status"),
        F.col("state.cause").alias("waiting_for"),
        F.col("state.depth").alias("depth"),
    )
