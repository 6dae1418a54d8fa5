"""Streams drained in batches, arrival-driven refresh and lineage state."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from portloom.catalog.registry import query, table
from portloom.operators import quality as K
from portloom.plans import lineage
from portloom.session import workspace
from portloom.sources.tables import read_table
from portloom.streaming.arrivals import Arrivals
from portloom.streaming.partials import Measure, PartialMart, land_partitions
from portloom.streaming.tumbling import current_rows, drain, tumbling


def ntz(text):
    return F.to_timestamp_ntz(F.lit(text))


@query(
    "tumbling_5min",
    """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, count(*) AS n_samples,
      sum(value::DECIMAL(15,2))::DOUBLE AS total_value, max(value) AS top_value FROM events GROUP BY 1, 2""",
)
def tumbling_5min(spark, sf):
    """Five-minute grain, drained in two batches as if the extract ran twice."""
    events = table(spark, sf, "events")
    landing, out, progress = (workspace(spark, n) for n in ("samples", "windows", "progress"))
    cut = ntz("2024-01-15 12:02:30")
    measures = {
        "n_samples": F.count(F.lit(1)),
        "total_value": F.sum(F.col("value").cast("decimal(15,2)")).cast("double"),
        "top_value": F.max("value"),
    }
    for part in (events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut)):
        part.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(events.schema).parquet(landing)
        windows = tumbling(stream, "ts", ["event_type"], measures, watermark="1 hour")
        drain(windows, out, progress, ["window_start", "event_type"])
    return current_rows(spark, out, windows.schema)


@query(
    "late_rows_upsert",
    """SELECT event_id, user_id, CASE WHEN event_id % 13 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS ts,
      CASE WHEN event_id % 13 = 0 THEN value + 1 ELSE value END AS value FROM events""",
)
def late_rows_upsert(spark, sf):
    """A stream of rows into a keyed table: rows of old days come late, some rows come again corrected
    and on another day; the table ends as one batch over everything would leave it."""
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    landing, out, progress = (workspace(spark, n) for n in ("arriving", "keyed", "progress"))
    late, corrected = F.col("event_id") % 5 == 0, F.col("event_id") % 13 == 0
    again = events.where(corrected).withColumns({"ts": F.col("ts") + F.expr("INTERVAL 1 DAY"), "value": F.col("value") + 1})
    for part in (events.where(~late), events.where(late & ~corrected).unionAll(again)):
        part.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(events.schema).parquet(landing)
        drain(stream, out, progress, ["event_id"], "ts", moving=True)
    return current_rows(spark, out, events.schema)


@query(
    "arrival_refresh",
    """SELECT c_mktsegment, event_type, count(*) AS n_events, 1 AS version
    FROM events JOIN customer ON c_custkey = user_id GROUP BY ALL""",
)
def arrival_refresh(spark, sf):
    """Events arrive twice, customers once: only then is the mart built, from everything landed."""
    events, customers = table(spark, sf, "events"), table(spark, sf, "customer")
    root, mart = workspace(spark, "arrivals"), workspace(spark, "mart")
    folders = {name: f"{root}/landing/{name}" for name in ("events", "customer")}
    state = Arrivals(
        spark, root, {"events": (folders["events"], events.schema), "customer": (folders["customer"], customers.schema)}
    )

    def build(bronze):
        joined = bronze["events"].join(
            bronze["customer"].select(F.col("c_custkey").alias("user_id"), "c_mktsegment"), "user_id"
        )
        return joined.groupBy("c_mktsegment", "event_type").agg(F.count(F.lit(1)).alias("n_events"))

    cut = ntz("2024-01-15 00:00:00")
    customers.limit(0).write.parquet(folders["customer"])
    events.where(F.col("ts") < cut).write.mode("append").parquet(folders["events"])
    state.drain()
    early = state.refresh(build, mart)
    events.where(F.col("ts") >= cut).write.mode("append").parquet(folders["events"])
    customers.write.mode("append").parquet(folders["customer"])
    state.drain()
    load = state.refresh(build, mart)
    again = state.refresh(build, mart)
    if early is not None or again is not None:
        raise AssertionError("refreshed without new data in every source")
    return read_table(spark, mart).withColumn("version", F.lit(load.version))


@query(
    "partial_refresh",
    """WITH now AS (SELECT user_id % 10 AS user_group, event_type, CASE WHEN day(ts) = 7 THEN value + 1 ELSE value END::DECIMAL(15,2) AS value,
      ts FROM events WHERE day(ts) <> 3)
    SELECT user_group, event_type, count(*) AS n_events, sum(value)::DOUBLE AS total_value, min(value)::DOUBLE AS least_value,
      max(value)::DOUBLE AS top_value, max(ts) AS last_at, 15 AS n_refreshed FROM now GROUP BY ALL""",
)
def partial_refresh(spark, sf):
    """A mart of partial aggregates after late rows, corrected rows, a withdrawn day and new days."""
    source, path = workspace(spark, "days"), workspace(spark, "partials")
    value = F.col("value").cast("decimal(15,2)")
    events = table(spark, sf, "events").select("user_id", "event_type", "ts", "value", F.to_date("ts").alias("day"))
    number = F.dayofmonth("day")
    late = (number == 5) & (F.col("user_id") % 4 == 0)
    land_partitions(events.where((number <= 18) & ~late), source, "day")
    mart = PartialMart(
        spark,
        path,
        source,
        events.schema,
        "day",
        {"user_group": F.col("user_id") % 10, "event_type": F.col("event_type")},
        {
            "n_events": Measure("count", F.lit(1)),
            "total_value": Measure("sum", value),
            "least_value": Measure("min", value),
            "top_value": Measure("max", value),
            "last_at": Measure("max", F.col("ts")),
        },
    )
    mart.refresh()
    corrected = events.withColumn("value", F.when(number == 7, F.col("value") + 1).otherwise(F.col("value")))
    land_partitions(corrected.where(number.isin(5, 7) | (number > 18)), source, "day", withdrawn=[date(2024, 1, 3)])
    refreshed = mart.refresh()
    if mart.refresh():
        raise AssertionError("refreshed without a new load")
    return mart.read().withColumns(
        {c: F.col(c).cast("double") for c in ("total_value", "least_value", "top_value")} | {"n_refreshed": F.lit(len(refreshed))}
    )


@query(
    "stale_partitions",
    """WITH up AS (SELECT strftime(l_shipdate, '%Y-%m') AS part_month, max(l_shipdate) AS u FROM lineitem GROUP BY 1),
    down AS (SELECT strftime(o_orderdate, '%Y-%m') AS part_month, max(o_orderdate) AS t FROM orders
             WHERE o_orderstatus <> 'P' OR o_orderkey % 3 = 0 GROUP BY 1)
    SELECT part_month, u AS upstream_loaded_at, t AS target_loaded_at,
      CASE WHEN t IS NULL THEN 'missing' ELSE 'outdated' END AS reason
    FROM up LEFT JOIN down USING (part_month) WHERE t IS NULL OR u > t""",
)
def stale_partitions(spark, sf):
    month = lambda c: F.date_format(c, "yyyy-MM")
    up = table(spark, sf, "lineitem").select(month("l_shipdate").alias("part_month"), F.col("l_shipdate").alias("at"))
    built = (F.col("o_orderstatus") != "P") | (F.col("o_orderkey") % 3 == 0)
    down = table(spark, sf, "orders").where(built)
    down = down.select(month("o_orderdate").alias("part_month"), F.col("o_orderdate").alias("at"))
    return lineage.stale_partitions(up, down, "part_month", "at")


@query(
    "upstream_status",
    """WITH RECURSIVE e AS (SELECT DISTINCT user_id // 3 AS up, user_id AS down FROM events WHERE user_id > 0),
    st AS (SELECT user_id AS r, CASE WHEN max(ts) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOUR THEN 'error'
             WHEN max(ts) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 6 HOUR THEN 'warn' ELSE 'pass' END AS s
           FROM events WHERE user_id % 17 <> 1 GROUP BY 1),
    late AS (SELECT rel, coalesce(s, 'never') AS status FROM (SELECT up AS rel FROM e UNION SELECT down FROM e)
             LEFT JOIN st ON r = rel WHERE coalesce(s, 'never') <> 'pass'),
    walk AS (SELECT rel AS root, rel AS node, 0 AS depth FROM late
             UNION ALL SELECT root, down, depth + 1 FROM walk JOIN e ON up = node)
    SELECT node AS consumer, root AS waiting_for, depth, status FROM walk JOIN late ON rel = root WHERE depth > 0""",
)
def upstream_status(spark, sf):
    return lineage.upstream_status(*user_lineage(spark, sf))


def user_lineage(spark, sf):
    """A lineage tree over the users: user n reads from user n / 3 and is as fresh as its last event."""
    events = table(spark, sf, "events")
    users = events.where(F.col("user_id") > 0).select("user_id").distinct()
    edges = users.select(F.floor(F.col("user_id") / 3).alias("upstream"), F.col("user_id").alias("downstream"))
    loaded = events.where(F.col("user_id") % 17 != 1)
    status = K.freshness(loaded, "ts", ntz("2024-01-31 00:00:00"), "6 HOURS", "24 HOURS", ["user_id"])
    return edges, status.select(F.col("user_id").alias("relation"), "status")


@query(
    "downstream_freshness",
    """WITH RECURSIVE e AS (SELECT DISTINCT user_id // 3 AS up, user_id AS down FROM events WHERE user_id > 0),
    st AS (SELECT user_id AS r, CASE WHEN max(ts) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOUR THEN 'error'
             WHEN max(ts) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 6 HOUR THEN 'warn' ELSE 'pass' END AS s
           FROM events WHERE user_id % 17 <> 1 GROUP BY 1),
    late AS (SELECT rel, coalesce(s, 'never') AS status FROM (SELECT up AS rel FROM e UNION SELECT down FROM e)
             LEFT JOIN st ON r = rel WHERE coalesce(s, 'never') <> 'pass'),
    walk AS (SELECT rel AS root, rel AS node, 0 AS depth FROM late
             UNION ALL SELECT root, down, depth + 1 FROM walk JOIN e ON up = node)
    SELECT node AS consumer, status, root AS waiting_for, depth FROM walk JOIN late ON rel = root WHERE depth > 0
    QUALIFY row_number() OVER (PARTITION BY node ORDER BY CASE status WHEN 'never' THEN 0 WHEN 'error' THEN 1 ELSE 2 END,
      depth, root) = 1""",
)
def downstream_freshness(spark, sf):
    return lineage.downstream_freshness(*user_lineage(spark, sf))
