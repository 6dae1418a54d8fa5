"""Versions, changes, intervals and point-in-time lookups over the event stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from portloom.catalog.registry import query, table
from portloom.operators import history as H
from portloom.operators.intervals import intersect_histories
from portloom.operators.marts import entity_dimension
from portloom.operators.pick import latest_version
from portloom.session import workspace
from portloom.sources.histories import apply_snapshots, read_history

STAGES = ["view", "signup", "click", "purchase", "error"]


@query(
    "latest_version_dedup",
    """SELECT user_id, event_type, event_id, mod_dt, data_ver FROM (
      SELECT user_id, event_type, event_id, CASE WHEN event_id % 11 <> 0 THEN ts::DATE::VARCHAR END AS mod_dt,
             CASE WHEN event_id % 13 = 0 THEN 'n/a' ELSE (event_id % 5)::VARCHAR END AS data_ver FROM events)
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY mod_dt DESC NULLS LAST,
      TRY_CAST(data_ver AS INTEGER) DESC NULLS LAST, event_id DESC) = 1""",
)
def latest_version_dedup(spark, sf):
    rows = table(spark, sf, "events").select(
        "user_id",
        "event_type",
        "event_id",
        F.when(F.col("event_id") % 11 != 0, F.to_date("ts").cast("string")).alias("mod_dt"),
        F.when(F.col("event_id") % 13 == 0, "n/a").otherwise((F.col("event_id") % 5).cast("string")).alias("data_ver"),
    )
    return latest_version(rows, ["user_id", "event_type"], "mod_dt", "data_ver", ["event_id"])


@query(
    "change_detection",
    """SELECT event_id, user_id, ts, event_type, lag(event_type) OVER w AS prev_event_type,
      lag(event_id) OVER w IS NOT NULL AND event_type <> lag(event_type) OVER w AS is_event_type_changed,
      value - lag(value) OVER w AS value_delta
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def change_detection(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")
    out = H.change_flags(rows, ["user_id"], ["ts", "event_id"], ["event_type"], ["value"])
    return out.drop("value", "prev_value")


@query(
    "scd_transitions",
    """SELECT * FROM (SELECT user_id, ts, event_id, lag(event_type) OVER w AS from_event_type, event_type AS to_event_type
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE from_event_type IS NOT NULL AND from_event_type <> to_event_type""",
)
def scd_transitions(spark, sf):
    return H.transitions(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], ["event_type"])


INTERVALS = """
  SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
  FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
  WHERE p IS NULL OR p <> event_type"""


@query("scd2_intervals", f"SELECT *, valid_to IS NULL AS is_current FROM ({INTERVALS})")
def scd2_intervals(spark, sf):
    return H.scd2(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], ["event_type"])


@query(
    "point_in_time_join",
    f"""WITH hist AS ({INTERVALS}), fact AS (
      SELECT o_orderkey, (o_orderkey * 7 + o_custkey) % (SELECT max(user_id) + 5 FROM events) AS user_id,
        TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 MINUTE * (o_orderkey * 131 % 43200) AS asked_at FROM orders)
    SELECT o_orderkey, f.user_id, asked_at, event_type FROM fact f
    LEFT JOIN hist h ON h.user_id = f.user_id AND h.valid_from <= f.asked_at AND (f.asked_at < h.valid_to OR h.valid_to IS NULL)""",
)
def point_in_time_join(spark, sf):
    events = table(spark, sf, "events")
    hist = H.scd2(events, ["user_id"], ["ts", "event_id"], ["event_type"])
    users = events.agg(F.max("user_id").alias("m")).first().m + 5
    minute = F.col("o_orderkey") * 131 % 43200
    fact = table(spark, sf, "orders").select(
        "o_orderkey",
        ((F.col("o_orderkey") * 7 + F.col("o_custkey")) % users).alias("user_id"),
        (F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(mins=minute.cast("int"))).alias("asked_at"),
    )
    return H.point_in_time_join(fact, hist, ["user_id"], "asked_at", ["event_type"])


@query(
    "accumulating_snapshot",
    "SELECT user_id, "
    + ", ".join(f"min(CASE WHEN event_type = '{s}' THEN ts END) AS {s}_at" for s in STAGES)
    + " FROM events GROUP BY user_id",
)
def accumulating_snapshot(spark, sf):
    return H.accumulating_snapshot(table(spark, sf, "events"), ["user_id"], "event_type", "ts", STAGES)


@query(
    "relation_snapshot",
    """WITH seen AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00'),
    kind AS (SELECT user_id, event_type FROM seen QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
    band AS (SELECT user_id, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS value_band FROM seen
             QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT user_id, event_type, value_band, value_band || '>' || event_type AS relation_path FROM kind JOIN band USING (user_id)""",
)
def relation_snapshot(spark, sf):
    """Two historised dimensions of a user, both as they held at the start of one day."""
    events = table(spark, sf, "events").withColumn("value_band", F.when(F.col("value") > 50, "high").otherwise("low"))
    order = ["ts", "event_id"]
    kinds, bands = (H.scd2(events, ["user_id"], order, [c]) for c in ("event_type", "value_band"))
    day = F.to_timestamp_ntz(F.lit("2024-01-15 23:59:59.999999"))
    found = H.relation_snapshot(kinds, bands, ["user_id"], day, {"path": ["value_band", "event_type"]})
    return found.withColumn("relation_path", F.array_join("path", ">")).drop("path")


@query(
    "dim_latest_conformed",
    """SELECT DISTINCT o_custkey::VARCHAR AS customer_id, o_orderpriority AS priority_name,
      CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS state_type FROM (
      SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1)""",
)
def dim_latest_conformed(spark, sf):
    return entity_dimension(
        table(spark, sf, "orders"),
        ["o_custkey"],
        "o_orderdate",
        {"o_custkey": "customer_id", "o_orderpriority": "priority_name", "o_orderstatus": "state_type"},
        tiebreak=["o_orderkey"],
        casts={"customer_id": "string"},
        enums={"state_type": {"F": 1, "O": 2}},
    )


@query(
    "point_in_time_ties",
    """WITH coarse AS (SELECT user_id, date_trunc('hour', ts) AS h, event_id, event_type FROM events),
    last AS (SELECT * FROM coarse QUALIFY row_number() OVER (PARTITION BY user_id, h ORDER BY event_id DESC) = 1),
    held AS (SELECT user_id, h, event_type, lead(h) OVER (PARTITION BY user_id ORDER BY h) AS until FROM last)
    SELECT e.event_id, e.user_id, e.ts, held.event_type AS type_then FROM events e
    LEFT JOIN held ON held.user_id = e.user_id AND held.h <= e.ts AND (held.until IS NULL OR e.ts < held.until)""",
)
def point_in_time_ties(spark, sf):
    """History at hour grain, where several changes of a user share one time and the last one holds."""
    events = table(spark, sf, "events")
    coarse = events.select("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h"), "event_id", "event_type")
    hist = H.scd2(coarse, ["user_id"], ["h", "event_id"], ["event_type"])
    hist = hist.withColumnRenamed("event_type", "type_then")
    return H.point_in_time_join(events.select("event_id", "user_id", "ts"), hist, ["user_id"], "ts", ["type_then"])


BANDS = INTERVALS.replace("event_type", "value_band").replace(
    "FROM events)", "FROM (SELECT *, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS value_band FROM events))"
)
OVERLAP = "a.valid_from < coalesce(b.valid_to, 'infinity') AND b.valid_from < coalesce(a.valid_to, 'infinity')"
COMMON = """greatest(a.valid_from, b.valid_from) AS valid_from, least(a.valid_to, b.valid_to) AS valid_to,
      a.valid_to IS NULL AND b.valid_to IS NULL AS is_current"""


@query(
    "temporal_relation",
    f"""SELECT a.user_id, event_type, value_band, {COMMON}
    FROM ({INTERVALS}) a JOIN ({BANDS}) b ON a.user_id = b.user_id AND {OVERLAP}""",
)
def temporal_relation(spark, sf):
    """Two historised dimensions of a user as one history, for all times."""
    events = table(spark, sf, "events").withColumn("value_band", F.when(F.col("value") > 50, "high").otherwise("low"))
    kinds, bands = (H.scd2(events, ["user_id"], ["ts", "event_id"], [c]) for c in ("event_type", "value_band"))
    return intersect_histories(kinds, bands, ["user_id"], ["event_type"], ["value_band"])


@query(
    "temporal_overlaps",
    f"""WITH held AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_returnflag, l_shipdate AS valid_from,
      CASE WHEN l_orderkey % 97 <> 0 THEN l_shipdate + INTERVAL 1 DAY * (l_orderkey % 40) END AS valid_to FROM lineitem),
    a AS (SELECT * FROM held WHERE l_returnflag = 'R' AND (valid_to IS NULL OR valid_from < valid_to)),
    b AS (SELECT * FROM held WHERE l_returnflag = 'A' AND (valid_to IS NULL OR valid_from < valid_to))
    SELECT a.l_suppkey, a.l_orderkey AS returned_order, a.l_linenumber AS returned_line, b.l_orderkey AS accepted_order,
      b.l_linenumber AS accepted_line, {COMMON} FROM a JOIN b ON a.l_suppkey = b.l_suppkey AND {OVERLAP}""",
)
def temporal_overlaps(spark, sf):
    """Claims of a supplier that run at the same time, where those of one kind overlap each other too."""
    days = F.make_dt_interval(days=(F.col("l_orderkey") % 40).cast("int"))
    held = table(spark, sf, "lineitem").select(
        "l_suppkey",
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        F.col("l_shipdate").alias("valid_from"),
        F.when(F.col("l_orderkey") % 97 != 0, F.col("l_shipdate") + days).alias("valid_to"),
    )

    def of(flag, kind):
        return held.where(F.col("l_returnflag") == flag).withColumnsRenamed(
            {"l_orderkey": f"{kind}_order", "l_linenumber": f"{kind}_line"}
        )

    names = [[f"{kind}_order", f"{kind}_line"] for kind in ("returned", "accepted")]
    return intersect_histories(of("R", "returned"), of("A", "accepted"), ["l_suppkey"], *names)


@query(
    "scd2_incremental",
    """WITH daily AS (SELECT user_id, ts::DATE AS d, event_type FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id, d ORDER BY ts DESC, event_id DESC) = 1),
    starts AS (SELECT * FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY d) AS p FROM daily)
      WHERE p IS NULL OR p <> event_type)
    SELECT user_id, event_type, d::VARCHAR AS valid_from, (lead(d) OVER w)::VARCHAR AS valid_to, lead(d) OVER w IS NULL AS is_current
    FROM starts WINDOW w AS (PARTITION BY user_id ORDER BY d)""",
)
def scd2_incremental(spark, sf):
    """A history that takes in daily snapshots: a first load, single days, and days that come late."""
    events, path, landed = table(spark, sf, "events"), workspace(spark, "history"), workspace(spark, "snapshots")
    last = F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type")
    daily = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(last)
    daily.write.partitionBy("day").parquet(landed)
    snapshots = spark.read.schema("user_id long, event_type string, day date").parquet(landed)
    for days in (range(1, 19), [20], [21], [19], range(22, 32)):
        came = [f"2024-01-{d:02d}" for d in days]
        batch = snapshots.where(F.col("day").isin(*(F.lit(d).cast("date") for d in came)))
        seen = snapshots.where(F.col("day") <= F.lit(max(came[-1], "2024-01-21")).cast("date"))
        apply_snapshots(path, batch, ["user_id"], "day", ["event_type"], observed=seen, buckets=4)
    text = {c: F.col(c).cast("string") for c in ("valid_from", "valid_to")}
    return read_history(spark, path, ["user_id"], ["event_type"]).withColumns(text)
