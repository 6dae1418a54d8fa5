"""Conforming, calendars, keys, JSON and unfolding."""

from __future__ import annotations

from pyspark.sql import functions as F

from portloom.catalog.registry import query, table
from portloom.functions.calendar import local_time, with_fiscal
from portloom.functions.text import parse_json, surrogate_key
from portloom.operators.marts import join_details
from portloom.operators.shape import conform, melt, soft_delete_flag, unify_versions

# fixed values
SEGMENT_CODES = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}


@query(
    "conform_dim_single",
    """SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey::VARCHAR AS nation_code,
      c_acctbal::DECIMAL(15,2)::DOUBLE AS balance_amount,
      CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
        WHEN 'HOUSEHOLD' THEN 4 WHEN 'MACHINERY' THEN 5 END AS segment_type,
      c_acctbal < 0 AS is_overdrawn FROM customer""",
)
def conform_dim_single(spark, sf):
    return conform(
        table(spark, sf, "customer"),
        renames={
            "c_custkey": "customer_id", "c_name": "customer_name", "c_nationkey": "nation_code",
            "c_acctbal": "balance_amount", "c_mktsegment": "segment_type",
        },
        casts={"nation_code": "string"},
        enums={"segment_type": SEGMENT_CODES},
        flags={"is_overdrawn": F.col("balance_amount") < 0},
    )


@query(
    "conform_event_multi",
    """WITH evidence AS (
      SELECT l_orderkey, count(*) AS evidence_count FROM lineitem WHERE l_returnflag NOT IN ('R') GROUP BY 1)
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS order_amount,
      coalesce(CASE WHEN c_mktsegment <> 'MACHINERY' THEN c.c_name END, s.s_name, n.n_name) AS merchant_name, evidence_count,
      CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN o_orderdate END AS deleted_at,
      (o_orderstatus = 'F' AND o_orderpriority = '5-LOW') AS is_deleted
    FROM orders
    LEFT JOIN customer c ON c.c_custkey = o_custkey
    LEFT JOIN supplier s ON s.s_suppkey = o_custkey
    LEFT JOIN nation n ON n.n_nationkey = o_custkey % 25
    LEFT JOIN evidence e ON e.l_orderkey = o_orderkey""",
)
def conform_event_multi(spark, sf):
    closed = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")
    base = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("order_amount"),
        (F.col("o_custkey") % 25).cast("int").alias("n_nationkey"),
        F.when(closed, F.col("o_orderdate")).alias("deleted_at"),
    )
    evidence = table(spark, sf, "lineitem").where(~F.col("l_returnflag").isin("R"))
    evidence = evidence.groupBy(F.col("l_orderkey").alias("order_id")).agg(F.count(F.lit(1)).alias("evidence_count"))
    # the source gives no names for one segment
    name = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name"))
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), name.alias("c_name"))
    supplier = table(spark, sf, "supplier")
    out = join_details(
        base,
        [
            (customer, ["customer_id"]),
            (supplier.select(F.col("s_suppkey").alias("customer_id"), "s_name"), ["customer_id"]),
            (table(spark, sf, "nation").select("n_nationkey", "n_name"), ["n_nationkey"]),
            (evidence, ["order_id"]),
        ],
        {"merchant_name": ["c_name", "s_name", "n_name"]},
    )
    return soft_delete_flag(out).drop("n_nationkey")


@query(
    "kst_timestamps",
    """SELECT event_id, ts AS db_created_at, ts + INTERVAL 9 HOUR AS created_at,
      CASE WHEN event_type = 'click' THEN ts + INTERVAL 1 HOUR END AS db_updated_at,
      coalesce(CASE WHEN event_type = 'click' THEN ts + INTERVAL 1 HOUR END, ts) + INTERVAL 9 HOUR AS updated_at
    FROM events""",
)
def kst_timestamps(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id",
        F.col("ts").alias("db_created_at"),
        F.when(F.col("event_type") == "click", F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("db_updated_at"),
    )
    rows = rows.withColumn("_changed", F.coalesce("db_updated_at", "db_created_at"))
    local = {"created_at": local_time(rows, "db_created_at"), "updated_at": local_time(rows, "_changed")}
    return rows.withColumns(local).drop("_changed")


@query(
    "surrogate_key_md5",
    """SELECT l_orderkey, l_linenumber, l_partkey,
      md5(l_orderkey::VARCHAR || '||' || l_linenumber::VARCHAR || '||' || coalesce(
          CASE WHEN l_partkey % 7 <> 0 THEN l_partkey::VARCHAR END, chr(0))) AS line_sk FROM lineitem""",
)
def surrogate_key_md5(spark, sf):
    part = F.when(F.col("l_partkey") % 7 != 0, F.col("l_partkey"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", surrogate_key("l_orderkey", "l_linenumber", part).alias("line_sk")
    )


@query(
    "json_event_parse",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
      json_extract_string(props, '$.none') AS absent,
      value / (CAST(json_extract_string(props, '$.k') AS INTEGER) + 1) AS value_per_k,
      value > CAST(json_extract_string(props, '$.k') AS INTEGER) AS is_above FROM events""",
)
def json_event_parse(spark, sf):
    parsed = parse_json(table(spark, sf, "events"), "props", {"k": ("$.k", "int"), "absent": ("$.none", "string")})
    return parsed.select(
        "event_id",
        "k",
        "absent",
        (F.col("value") / (F.col("k") + 1)).alias("value_per_k"),
        (F.col("value") > F.col("k")).alias("is_above"),
    )


@query(
    "melt_costs",
    """SELECT l_orderkey, l_linenumber, l_partkey, cost_type, cost_amount FROM (
      SELECT l_orderkey, l_linenumber, l_partkey, unnest(['quantity', 'extendedprice', 'discount', 'tax']) AS cost_type,
        unnest([l_quantity, l_extendedprice, CASE WHEN l_discount >= 0.05 THEN l_discount END, l_tax]) AS cost_amount
      FROM lineitem) WHERE cost_amount IS NOT NULL""",
)
def melt_costs(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("extendedprice"),
        F.when(F.col("l_discount") >= 0.05, F.col("l_discount")).alias("discount"),
        F.col("l_tax").alias("tax"),
    )
    ids = ["l_orderkey", "l_linenumber", "l_partkey"]
    return melt(rows, ids, ["quantity", "extendedprice", "discount", "tax"], "cost_type", "cost_amount")


FISCAL = """
  SELECT *, CASE WHEN day(d) >= 16 THEN date_trunc('month', d) + INTERVAL 1 MONTH
                 ELSE date_trunc('month', d) END::DATE AS fm FROM ({0})"""


@query(
    "fiscal_calendar",
    f"""SELECT o_orderkey, year(fm)::INTEGER AS fiscal_year, month(fm)::INTEGER AS fiscal_month,
      (date_diff('day', (fm - INTERVAL 1 MONTH + INTERVAL 15 DAY)::DATE, d) // 7 + 1)::INTEGER AS fiscal_week
    FROM ({FISCAL.format("SELECT o_orderkey, o_orderdate::DATE AS d FROM orders")})""",
)
def fiscal_calendar(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return with_fiscal(rows, "o_orderdate").drop("o_orderdate")


@query(
    "version_unify",
    """SELECT event_id, user_id, ts AS occurred_at, event_type, value AS amount, NULL AS note, 'v1' AS schema_version
    FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'
    UNION ALL SELECT event_id, user_id, ts, upper(event_type), NULL, props, 'v3'
    FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'""",
)
def version_unify(spark, sf):
    events, cut = table(spark, sf, "events"), F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))
    v1 = events.where(F.col("ts") < cut).drop("props")
    v3 = events.where(F.col("ts") >= cut).select(
        "event_id", "user_id", F.col("ts").alias("at"), F.upper("event_type").alias("kind"), "props"
    )
    return unify_versions(
        {"v1": v1, "v3": v3},
        {
            "v1": {"event_id": "event_id", "user_id": "user_id", "occurred_at": "ts", "event_type": "event_type", "amount": "value"},
            "v3": {"event_id": "event_id", "user_id": "user_id", "occurred_at": "at", "event_type": "kind", "note": "props"},
        },
    )
