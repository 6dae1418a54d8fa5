"""Declared scans, contracts, bronze landing, replaceable tables, control tables and publishing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from portloom.catalog.registry import query, table
from portloom.functions.text import to_messages
from portloom.operators.shape import union_sources
from portloom.session import workspace
from portloom.sources import control, jdbc, landing, loader, tables
from portloom.sources.merge import merge_partitions
from portloom.sources.spec import SourceSpec

LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


def ntz(text):
    return F.to_timestamp_ntz(F.lit(text))


@query(
    "snapshot_scan",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_shipdate
    FROM lineitem WHERE l_returnflag <> 'N' AND l_linestatus IN ('O', 'F')""",
)
def snapshot_scan(spark, sf):
    spec = SourceSpec(
        name="order_lines",
        location=f"{sf}/lineitem.parquet",
        expected_columns=LINE_COLUMNS,
        select_columns=(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate",
        ),
        filter="l_returnflag <> 'N' AND l_linestatus IN ('O', 'F')",
        target="brz.order_lines",
    )
    return landing.snapshot_scan(spark, spec)


_CONTRACT = [c for c in LINE_COLUMNS if c != "l_tax"] + ["l_comment"]


@query(
    "schema_contract_report",
    " UNION ALL ".join(
        [
            f"SELECT '{c}' AS column_name, '{s}' AS status, count(*) AS n_rows, "
            + ("CAST(NULL AS BIGINT)" if s == "missing" else f"count(*) - count({c})")
            + " AS n_null FROM lineitem"
            for c, s in [*((c, "present") for c in LINE_COLUMNS if c != "l_tax"),
                         ("l_comment", "missing"), ("l_tax", "unexpected")]
        ]
    ),
)
def schema_contract_report(spark, sf):
    return landing.check_contract(table(spark, sf, "lineitem"), _CONTRACT)


@query(
    "bronze_text_landing",
    """SELECT l_orderkey::VARCHAR AS l_orderkey, l_partkey::VARCHAR AS l_partkey, l_linenumber::VARCHAR AS l_linenumber,
    l_returnflag, l_linestatus, TIMESTAMP '2024-01-31 01:00:00' AS loaded_at FROM lineitem""",
)
def bronze_text_landing(spark, sf):
    cols = ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    return landing.to_bronze(table(spark, sf, "lineitem"), cols, ntz("2024-01-31 01:00:00"))


@query(
    "snapshot_load",
    """SELECT l_orderkey::VARCHAR AS l_orderkey, l_suppkey::VARCHAR AS l_suppkey, l_returnflag, 'success' AS status,
      count(*) OVER () AS row_count, 1 AS n_runs, 1 AS n_marks
    FROM lineitem WHERE l_returnflag IN ('A', 'R')""",
)
def snapshot_load(spark, sf):
    """The whole extract, run and retried: bronze rows with what audit and watermark say of it."""
    root = workspace(spark, "warehouse")
    spec = SourceSpec(
        name="order_lines",
        location=f"{sf}/lineitem.parquet",
        expected_columns=LINE_COLUMNS,
        select_columns=("l_orderkey", "l_suppkey", "l_returnflag"),
        filter="l_returnflag IN ('A', 'R')",
        target="brz.order_lines",
    )
    for run in ("first", "retry"):
        loader.load_snapshot(spark, spec, root, "extract_order_lines", datetime(2024, 1, 31), run)
    audit = tables.read_table(spark, f"{root}/ctl/job_audit")
    run, n_runs = audit.first(), audit.count()
    n_marks = tables.read_table(spark, f"{root}/ctl/watermark").count()
    bronze = tables.read_table(spark, f"{root}/brz/order_lines").drop("loaded_at")
    said = {"status": run.status, "row_count": run.row_count, "n_runs": n_runs, "n_marks": n_marks}
    return bronze.withColumns({k: F.lit(v) for k, v in said.items()}).withColumn(
        "row_count", F.col("row_count").cast("long")
    )


@query("snapshot_replace_twice", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 2 AS n_versions FROM orders")
def snapshot_replace_twice(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path = workspace(spark, "replace")
    tables.replace_table(rows, path)
    again = tables.replace_table(rows, path)
    return tables.read_table(spark, path).withColumn("n_versions", F.lit(again.version))


@query("empty_guard_preserves", "SELECT o_orderkey, o_orderstatus, true AS refused FROM orders")
def empty_guard_preserves(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    path = workspace(spark, "guarded")
    tables.replace_table(rows, path)
    try:
        tables.replace_table(rows.where(F.col("o_orderstatus") == "no such status"), path)
        refused = False
    except tables.EmptySnapshot:
        refused = True
    return tables.read_table(spark, path).withColumn("refused", F.lit(refused))


@query(
    "keyed_upsert",
    """WITH delta AS (
      SELECT o_orderkey + 1000 AS k, 'X' AS s, o_orderdate + INTERVAL 1 DAY AS d FROM orders),
    base AS (SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderdate FROM orders)
    SELECT coalesce(b.k, d.k) AS o_orderkey, b.o_custkey,
           CASE WHEN d.k IS NULL THEN b.o_orderstatus ELSE d.s END AS o_orderstatus,
           CASE WHEN d.k IS NULL THEN b.o_orderdate ELSE d.d END AS o_orderdate
    FROM base b FULL JOIN delta d ON b.k = d.k""",
)
def keyed_upsert(spark, sf):
    base = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    delta = base.select(
        (F.col("o_orderkey") + 1000).alias("o_orderkey"),
        F.lit("X").alias("o_orderstatus"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("o_orderdate"),
    )
    return control.upsert(base, delta, ["o_orderkey"])


@query(
    "audit_upsert",
    """WITH m AS (
      SELECT 'load_' || user_id::VARCHAR AS dag_id, date_trunc('day', ts) AS logical_date, ts AS said_at, event_id,
             event_type IN ('view', 'signup', 'click') AS is_start, event_type,
             'run_' || event_id::VARCHAR AS run_id, value FROM events),
    kept AS (
      SELECT *, bool_or(is_start) OVER w AS started
      FROM m WINDOW w AS (PARTITION BY dag_id, logical_date ORDER BY said_at, event_id ROWS UNBOUNDED PRECEDING)),
    closing AS (SELECT * FROM kept WHERE NOT is_start AND started
                QUALIFY row_number() OVER (PARTITION BY dag_id, logical_date ORDER BY said_at DESC, event_id DESC) = 1),
    opening AS (SELECT * FROM kept WHERE is_start
                QUALIFY row_number() OVER (PARTITION BY dag_id, logical_date ORDER BY said_at DESC, event_id DESC) = 1)
    SELECT o.dag_id, o.logical_date, o.run_id,
      CASE WHEN c.said_at > o.said_at THEN CASE c.event_type WHEN 'error' THEN 'failed' ELSE 'success' END
           ELSE 'running' END AS status,
      CASE WHEN c.event_type = 'purchase' THEN c.event_id END AS row_count, o.said_at AS started_at,
      CASE WHEN c.said_at > o.said_at THEN c.said_at END AS finished_at,
      CASE WHEN c.said_at > o.said_at AND c.event_type = 'error' THEN left(repeat('failed at ' || c.event_id::VARCHAR || ' ', 300), 2000) END AS detail
    FROM opening o LEFT JOIN closing c USING (dag_id, logical_date)""",
)
def audit_upsert(spark, sf):
    kind = F.col("event_type")
    messages = table(spark, sf, "events").select(
        F.concat(F.lit("load_"), F.col("user_id").cast("string")).alias("dag_id"),
        F.to_date("ts").cast("timestamp_ntz").alias("logical_date"),
        F.when(kind.isin("view", "signup", "click"), "start").otherwise("finish").alias("kind"),
        F.concat(F.lit("run_"), F.col("event_id").cast("string")).alias("run_id"),
        F.when(kind == "error", "failed").otherwise("success").alias("status"),
        F.when(kind == "purchase", F.col("event_id")).alias("row_count"),
        F.col("ts").alias("at"),
        "event_id",
        F.when(
            kind == "error",
            F.repeat(F.concat(F.lit("failed at "), F.col("event_id").cast("string"), F.lit(" ")), F.lit(300)),
        ).alias("detail"),
    )
    return control.fold_audit(messages, ["at", "event_id"])


@query(
    "incremental_lookback",
    """WITH loaded AS (SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-20 00:00:00' AND event_id % 10 <> 0),
    mark AS (SELECT max(ts) - INTERVAL 3 DAY AS since FROM loaded)
    SELECT event_id, user_id, ts, CASE WHEN ts > since THEN value ELSE 0.0 END AS value
    FROM events, mark WHERE ts > since OR event_id IN (SELECT event_id FROM loaded)""",
)
def incremental_lookback(spark, sf):
    source = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    # what an earlier load left behind: first values, without the rows that came late
    loaded = source.where((F.col("ts") <= ntz("2024-01-20 00:00:00")) & (F.col("event_id") % 10 != 0))
    loaded = loaded.withColumn("value", F.lit(0.0))
    return control.incremental_load(source, loaded, "ts", ["event_id"], "3 DAYS")


@query(
    "incremental_bronze",
    """WITH a AS (SELECT event_id, user_id, event_type, CASE WHEN event_id % 101 = 0 THEN NULL ELSE ts END AS t
      FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00' AND event_id % 10 <> 0),
    mark AS (SELECT max(t) - INTERVAL 2 DAY AS since FROM a),
    b AS (SELECT event_id, user_id, event_type,
        CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 7 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS t FROM events),
    d AS (SELECT b.* FROM b, mark WHERE t > since),
    held AS (SELECT * FROM d UNION ALL SELECT * FROM a WHERE event_id NOT IN (SELECT event_id FROM d))
    SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS user_id, event_type, t::DATE::VARCHAR AS part_date FROM held""",
)
def incremental_bronze(spark, sf):
    """An accumulating source loaded twice: late rows of the lookback come in, older ones do not, a
    key whose time moves to another day stays one row, rows without a time stay as first loaded."""
    root, src = workspace(spark, "accumulating"), workspace(spark, "source")
    columns = ("event_id", "user_id", "event_type", "ts")
    key = F.col("event_id")
    timed = F.when(key % 101 != 0, F.col("ts"))
    moved = F.when(key % 101 != 0, F.when(key % 7 == 0, F.col("ts") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("ts")))
    events = table(spark, sf, "events").select(*columns)
    first = events.where((F.col("ts") < ntz("2024-01-20 00:00:00")) & (key % 10 != 0)).withColumn("ts", timed)
    for day, seen in ((20, first), (31, events.withColumn("ts", moved))):
        seen.write.mode("overwrite").parquet(src)
        spec = SourceSpec("event_log", src, columns, target="brz.event_log", mode="watermark")
        loader.load_incremental(
            spark, spec, root, "ts", ["event_id"], "2 DAYS", "extract_event_log", datetime(2024, 1, day), f"run_{day}"
        )
    schema = "event_id string, user_id string, event_type string, part_date date"
    bronze = spark.read.schema(schema).parquet(f"{root}/brz/event_log")
    return bronze.withColumn("part_date", F.col("part_date").cast("string"))


@query(
    "merge_touched_partitions",
    """SELECT coalesce(b.o_orderkey, d.k) AS o_orderkey, coalesce(b.y, d.y) AS order_year,
      CASE WHEN d.k IS NULL THEN b.o_orderstatus ELSE 'M' END AS o_orderstatus
    FROM (SELECT o_orderkey, year(o_orderdate)::INTEGER AS y, o_orderstatus FROM orders WHERE o_orderstatus <> 'P') b
    FULL JOIN (SELECT o_orderkey AS k, year(o_orderdate)::INTEGER AS y FROM orders
               WHERE year(o_orderdate) IN (1996, 1999)) d ON d.k = b.o_orderkey AND d.y = b.y""",
)
def merge_touched_partitions(spark, sf):
    path = workspace(spark, "merged")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("order_year"))
    merge_partitions(rows.where(F.col("o_orderstatus") != "P"), path, ["o_orderkey"], "order_year")
    delta = rows.where(F.col("order_year").isin(1996, 1999)).withColumn("o_orderstatus", F.lit("M"))
    merge_partitions(delta, path, ["o_orderkey"], "order_year")
    return spark.read.schema(rows.schema).parquet(path)


@query("seed_csv_roundtrip", "SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part")
def seed_csv_roundtrip(spark, sf):
    path = workspace(spark, "seed")
    table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size").write.csv(path, header=True)
    return landing.load_seed(spark, path, "p_partkey long, p_name string, p_brand string, p_type string, p_size int")


@query(
    "multi_source_union",
    """SELECT l_orderkey, l_suppkey, l_linenumber, l_returnflag, 'even_site' AS source_tag FROM lineitem
    WHERE l_suppkey % 2 = 0
    UNION ALL SELECT l_orderkey, l_suppkey, l_linenumber, NULL, 'odd_site' FROM lineitem WHERE l_suppkey % 2 = 1""",
)
def multi_source_union(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag")
    odd = lines.where(F.col("l_suppkey") % 2 == 1).drop("l_returnflag")
    return union_sources({"even_site": lines.where(F.col("l_suppkey") % 2 == 0), "odd_site": odd})


@query(
    "daily_snapshot_partition",
    """SELECT o_orderkey, o_orderstatus, '2024-01-01' AS part_date FROM orders
    UNION ALL SELECT o_orderkey, 'S', '2024-01-02' FROM orders""",
)
def daily_snapshot_partition(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    path = workspace(spark, "daily")
    tables.write_partition(rows, path, "2024-01-01")
    tables.write_partition(rows, path, "2024-01-02")
    tables.write_partition(rows.withColumn("o_orderstatus", F.lit("S")), path, "2024-01-02")
    daily = spark.read.schema("o_orderkey long, o_orderstatus string, part_date date").parquet(path)
    return daily.withColumn("part_date", F.col("part_date").cast("string"))


@query(
    "publish_window_replace",
    """SELECT o_orderkey, year(o_orderdate)::INTEGER AS order_year,
      CASE WHEN year(o_orderdate) = 1997 THEN 'R' ELSE o_orderstatus END AS o_orderstatus
    FROM orders WHERE year(o_orderdate) <> 1998""",
)
def publish_window_replace(spark, sf):
    """1997 is replaced; 1998 lies in the window too and has no rows any more."""
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("order_year"), "o_orderstatus"
    )
    path = workspace(spark, "window")
    window = F.col("order_year").between(1997, 1998)
    tables.publish(rows, path, "order_year")
    newer = rows.where(F.col("order_year") == 1997).withColumn("o_orderstatus", F.lit("R"))
    tables.publish(newer, path, "order_year", window)
    return spark.read.schema("o_orderkey long, o_orderstatus string, order_year int").parquet(path)


@query(
    "publish_payload",
    """SELECT o_orderstatus || '|' || o_orderkey::VARCHAR AS key,
      '{"o_orderkey":' || o_orderkey::VARCHAR || ',"o_custkey":' || o_custkey::VARCHAR || ',"o_orderstatus":"'
      || o_orderstatus || '","o_orderpriority":"' || o_orderpriority || '"}' AS value FROM orders""",
)
def publish_payload(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return to_messages(rows, ["o_orderstatus", "o_orderkey"])


@query(
    "balanced_extract_ranges",
    """SELECT column_name, n AS n_rows, 16 AS n_ranges, true AS is_balanced FROM (
      SELECT 'l_orderkey' AS column_name, count(*) AS n FROM lineitem UNION ALL SELECT 'l_shipdate', count(*) FROM lineitem)""",
)
def balanced_extract_ranges(spark, sf):
    """Ranges for a parallel extract cut by row counts, on a skewed key and on a time: each row is in one
    range and none has more than twice the mean."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    # a quarter of the keys far from the others, and some missing
    skewed = F.when(F.col("l_orderkey") % 50 != 0, F.when(F.col("l_orderkey") % 4 == 0, F.col("l_orderkey") * 1000).otherwise(F.col("l_orderkey")))
    lines, out = lines.withColumn("l_orderkey", skewed), None
    for column in ("l_orderkey", "l_shipdate"):
        conditions = jdbc.range_predicates(column, jdbc.balanced_bounds(lines, column, 16))
        counts = lines.agg(F.array(*(F.count(F.when(F.expr(c), 1)) for c in conditions)).alias("n"))
        total = F.aggregate("n", F.lit(0).cast("long"), lambda s, x: s + x)
        found = counts.select(
            F.lit(column).alias("column_name"),
            total.alias("n_rows"),
            F.size("n").alias("n_ranges"),
            (F.array_max("n") * F.size("n") <= 2 * total).alias("is_balanced"),
        )
        out = found if out is None else out.unionAll(found)
    return out
