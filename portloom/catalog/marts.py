"""Facts, dimensions, merged lists and declared metrics over the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from portloom.catalog.cleaning import FISCAL
from portloom.catalog.registry import query, table
from portloom.functions.calendar import with_fiscal
from portloom.operators import marts as M
from portloom.operators.closure import hierarchy
from portloom.operators.pick import latest_version, representative
from portloom.operators.shape import canonical_merge, melt
from portloom.session import workspace
from portloom.sources.tables import write_partition


def money(name: str):
    """Exact sums: cents as decimals."""
    return F.col(name).cast("decimal(15,2)")


@query(
    "dim_with_preagg",
    """SELECT c_custkey, c_name, coalesce(n_orders, 0) AS n_orders, total_amount, status_list FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice::DECIMAL(15,2))::DOUBLE AS total_amount,
                 string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS status_list
               FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
)
def dim_with_preagg(spark, sf):
    return M.with_preagg(
        table(spark, sf, "customer").select("c_custkey", "c_name"),
        table(spark, sf, "orders"),
        {"c_custkey": "o_custkey"},
        [
            F.count(F.lit(1)).alias("n_orders"),
            F.sum(money("o_totalprice")).cast("double").alias("total_amount"),
            F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("status_list"),
        ],
        zero=["n_orders"],
    )


TREE = """tree AS (
  SELECT c_custkey AS node, NULL::BIGINT AS parent, c_custkey AS root, 1 AS level, ''::VARCHAR AS all_parents
  FROM customer WHERE c_custkey = 0
  UNION ALL
  SELECT c.c_custkey, t.node, t.root, t.level + 1,
         CASE WHEN t.all_parents = '' THEN '' ELSE t.all_parents || ',' END || t.node::VARCHAR
  FROM tree t JOIN customer c ON c.c_custkey // 10 = t.node AND c.c_custkey <> 0)"""


@query("hierarchy_levels", f"WITH RECURSIVE {TREE} SELECT node, parent, root, level, all_parents FROM tree")
def hierarchy_levels(spark, sf):
    key = F.col("c_custkey")
    accounts = table(spark, sf, "customer").select("c_custkey", F.when(key != 0, F.floor(key / 10)).alias("parent_custkey"))
    out = hierarchy(accounts, "c_custkey", "parent_custkey")
    return out.withColumn("all_parents", F.array_join(F.col("all_parent_list").cast("array<string>"), ",")).drop(
        "all_parent_list"
    )


@query(
    "hierarchy_path_array",
    """SELECT o_orderkey, array_to_string(list_sort(list_distinct(list_filter(
        [cr.r_name, cn.n_name, sr.r_name, sn.n_name], lambda x: x IS NOT NULL))), '|') AS all_place_list
    FROM orders JOIN customer ON c_custkey = o_custkey
    JOIN nation cn ON cn.n_nationkey = c_nationkey JOIN region cr ON cr.r_regionkey = cn.n_regionkey
    LEFT JOIN supplier ON s_suppkey = o_orderkey
    LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey LEFT JOIN region sr ON sr.r_regionkey = sn.n_regionkey""",
)
def hierarchy_path_array(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.array("r_name", "n_name").alias("places")
    )

    def placed(df, key, nation_key, into):
        joined = df.join(places, df[nation_key] == places.n_nationkey)
        return joined.select(F.col(key).alias(f"{into}_key"), F.col("places").alias(into))

    bought = placed(table(spark, sf, "customer"), "c_custkey", "c_nationkey", "buyer")
    sold = placed(table(spark, sf, "supplier"), "s_suppkey", "s_nationkey", "seller")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey"), F.col("o_custkey").alias("buyer_key"))
    orders = orders.withColumn("seller_key", F.col("o_orderkey"))
    out = orders.join(bought, "buyer_key").join(sold, "seller_key", "left")
    none = F.array().cast("array<string>")
    merged = F.array_sort(F.array_distinct(F.concat("buyer", F.coalesce("seller", none))))
    return out.select("o_orderkey", F.array_join(merged, "|").alias("all_place_list"))


@query(
    "work_order_enriched",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, p_name AS equipment_name, p_brand AS equipment_brand,
      s_name AS vendor_name, o_orderstatus AS order_status, year(fm)::INTEGER AS fiscal_year,
      month(fm)::INTEGER AS fiscal_month,
      (date_diff('day', (fm - INTERVAL 1 MONTH + INTERVAL 15 DAY)::DATE, d) // 7 + 1)::INTEGER AS fiscal_week
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
    LEFT JOIN ({FISCAL.format("SELECT o_orderkey, o_orderstatus, o_orderdate::DATE AS d FROM orders")})
      ON o_orderkey = l_orderkey""",
)
def work_order_enriched(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_name").alias("equipment_name"),
        F.col("p_brand").alias("equipment_brand"),
    )
    vendor = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("vendor_name")
    )
    orders = with_fiscal(table(spark, sf, "orders"), "o_orderdate").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_orderstatus").alias("order_status"),
        "fiscal_year", "fiscal_month", "fiscal_week",
    )
    out = M.enrich(lines, [(part, ["l_partkey"]), (vendor, ["l_suppkey"]), (orders, ["l_orderkey"])])
    return out.drop("l_suppkey")


@query(
    "representative_value",
    f"""SELECT cost_center, fiscal_year, fiscal_month, o_orderpriority AS budget_division, n_rows FROM (
      SELECT o_custkey % 25 AS cost_center, year(fm)::INTEGER AS fiscal_year, month(fm)::INTEGER AS fiscal_month,
        o_orderpriority, count(*) AS n_rows
      FROM ({FISCAL.format("SELECT *, o_orderdate::DATE AS d FROM orders")}) GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY cost_center, fiscal_year, fiscal_month
                               ORDER BY n_rows DESC, o_orderpriority) = 1""",
)
def representative_value(spark, sf):
    rows = with_fiscal(table(spark, sf, "orders"), "o_orderdate").select(
        (F.col("o_custkey") % 25).alias("cost_center"), "fiscal_year", "fiscal_month", "o_orderpriority"
    )
    return representative(rows, ["cost_center", "fiscal_year", "fiscal_month"], "o_orderpriority", "budget_division")


@query(
    "fact_daily_rollup",
    """SELECT l_shipdate::DATE::VARCHAR AS ship_date, l_returnflag, count(*) AS n_lines,
      sum(l_quantity::DECIMAL(15,2))::DOUBLE AS quantity, sum(l_extendedprice::DECIMAL(15,2))::DOUBLE AS gross_amount,
      sum(l_extendedprice::DECIMAL(15,2) * (1 - l_discount::DECIMAL(15,2)))::DOUBLE AS net_amount,
      sum(l_quantity::DECIMAL(15,2))::DOUBLE / count(*) AS avg_quantity
    FROM lineitem GROUP BY 1, 2""",
)
def fact_daily_rollup(spark, sf):
    quantity = F.sum(money("l_quantity")).cast("double")
    return M.rollup(
        table(spark, sf, "lineitem"),
        {"ship_date": F.to_date("l_shipdate").cast("string"), "l_returnflag": F.col("l_returnflag")},
        {
            "n_lines": F.count(F.lit(1)),
            "quantity": quantity,
            "gross_amount": F.sum(money("l_extendedprice")).cast("double"),
            "net_amount": F.sum(money("l_extendedprice") * (1 - money("l_discount"))).cast("double"),
            "avg_quantity": quantity / F.count(F.lit(1)),
        },
    )


@query(
    "metric_store",
    """WITH o AS (SELECT 'o_orderpriority=' || o_orderpriority || ',o_orderstatus=' || o_orderstatus AS dimensions,
        count(*)::DOUBLE AS a, sum(o_totalprice::DECIMAL(15,2))::DOUBLE AS b FROM orders GROUP BY 1),
    e AS (SELECT 'event_type=' || event_type || ',user_id=' || user_id::VARCHAR AS dimensions, count(*)::DOUBLE AS a,
        max(value) AS b FROM events WHERE event_type <> 'error' GROUP BY 1)
    SELECT *, '2024-01-31' AS part_date FROM (
    SELECT 'orders' AS source_name, dimensions, 'order_count' AS metric_name, a AS metric_value FROM o
    UNION ALL SELECT 'orders', dimensions, 'order_amount', b FROM o
    UNION ALL SELECT 'events', dimensions, 'event_count', a FROM e
    UNION ALL SELECT 'events', dimensions, 'top_value', b FROM e)""",
)
def metric_store(spark, sf):
    specs = [
        M.MetricSpec(
            "orders",
            ("o_orderstatus", "o_orderpriority"),
            {"order_count": F.count(F.lit(1)), "order_amount": F.sum(money("o_totalprice"))},
        ),
        M.MetricSpec(
            "events",
            ("event_type", "user_id"),
            {"event_count": F.count(F.lit(1)), "top_value": F.max("value")},
            where="event_type <> 'error'",
        ),
    ]
    rows = M.metric_rows({n: table(spark, sf, n) for n in ("orders", "events")}, specs)
    path = workspace(spark, "metrics")
    for _ in range(2):  # a rerun of the day replaces its partition
        write_partition(rows, path, "2024-01-31")
    stored = spark.read.schema(rows.schema.add("part_date", "date")).parquet(path)
    return stored.withColumn("part_date", F.col("part_date").cast("string"))


@query(
    "canonical_merge",
    """WITH lists AS (
      SELECT 0 AS r, 'billed' AS source_name, o_custkey AS entity_id, NULL AS label,
             sum(o_totalprice::DECIMAL(15,2))::DOUBLE AS amount, max(o_orderkey) AS ref
        FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey
      UNION ALL SELECT 1, 'registered', c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN c_acctbal END, c_nationkey FROM customer
      UNION ALL SELECT 2, 'vendor', s_suppkey, s_name, s_acctbal, s_nationkey FROM supplier
      UNION ALL SELECT 3, 'active', user_id, event_type, value, event_id FROM events),
    filled AS (SELECT entity_id, arg_min(label, (r, ref)) FILTER (label IS NOT NULL) AS label,
                      arg_min(amount, (r, ref)) FILTER (amount IS NOT NULL) AS amount FROM lists GROUP BY 1)
    SELECT l.entity_id, f.label, f.amount, l.ref, l.source_name FROM lists l JOIN filled f USING (entity_id)
    QUALIFY row_number() OVER (PARTITION BY l.entity_id ORDER BY l.r, l.ref) = 1""",
)
def canonical_merge_query(spark, sf):
    billed = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").groupBy(F.col("o_custkey").alias("entity_id"))
    lists = {
        "billed": billed.agg(
            F.lit(None).cast("string").alias("label"),
            F.sum(money("o_totalprice")).cast("double").alias("amount"),
            F.max("o_orderkey").alias("ref"),
        ),
        "registered": table(spark, sf, "customer").select(
            F.col("c_custkey").alias("entity_id"),
            F.col("c_name").alias("label"),
            F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("amount"),
            F.col("c_nationkey").cast("long").alias("ref"),
        ),
        "vendor": table(spark, sf, "supplier").select(
            F.col("s_suppkey").alias("entity_id"),
            F.col("s_name").alias("label"),
            F.col("s_acctbal").alias("amount"),
            F.col("s_nationkey").cast("long").alias("ref"),
        ),
        "active": table(spark, sf, "events").select(
            F.col("user_id").alias("entity_id"),
            F.col("event_type").alias("label"),
            F.col("value").alias("amount"),
            F.col("event_id").alias("ref"),
        ),
    }
    return canonical_merge(lists, ["entity_id"], fill=["label", "amount"], tiebreak=["ref"])


VERSIONS = """
  SELECT l_suppkey % 5 AS siteid, l_orderkey AS settlement_wono, l_linenumber::VARCHAR AS data_ver, l_shipdate AS mod_dt,
    l_partkey, l_suppkey, l_quantity, l_extendedprice, l_tax FROM lineitem"""


def settlement_versions(spark, sf):
    return table(spark, sf, "lineitem").select(
        (F.col("l_suppkey") % 5).alias("siteid"),
        F.col("l_orderkey").alias("settlement_wono"),
        F.col("l_linenumber").cast("string").alias("data_ver"),
        F.col("l_shipdate").alias("mod_dt"),
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax",
    )


@query(
    "fct_settlement",
    f"""WITH v AS (SELECT * FROM ({VERSIONS}) QUALIFY row_number() OVER (PARTITION BY siteid, settlement_wono
      ORDER BY mod_dt DESC NULLS LAST, data_ver::INTEGER DESC NULLS LAST, l_partkey DESC, l_suppkey DESC,
      l_extendedprice DESC) = 1)
    SELECT siteid, settlement_wono, data_ver, l_extendedprice AS settlement_amount, o_orderstatus AS settlement_status,
      s_name AS vendor_name, CASE WHEN o_orderstatus = 'F' THEN mod_dt END AS paid_at
    FROM v LEFT JOIN orders ON o_orderkey = settlement_wono LEFT JOIN supplier ON s_suppkey = l_suppkey""",
)
def fct_settlement(spark, sf):
    latest = latest_version(
        settlement_versions(spark, sf), ["siteid", "settlement_wono"], "mod_dt", "data_ver",
        ["l_partkey", "l_suppkey", "l_extendedprice"],
    )
    status = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("settlement_wono"), F.col("o_orderstatus").alias("settlement_status")
    )
    vendor = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("vendor_name")
    )
    out = M.enrich(latest, [(status, ["settlement_wono"]), (vendor, ["l_suppkey"])])
    return out.select(
        "siteid", "settlement_wono", "data_ver", F.col("l_extendedprice").alias("settlement_amount"),
        "settlement_status", "vendor_name", F.when(F.col("settlement_status") == "F", F.col("mod_dt")).alias("paid_at"),
    )


@query(
    "fct_settlement_detail",
    f"""WITH v AS (SELECT * FROM ({VERSIONS}) QUALIFY row_number() OVER (PARTITION BY siteid, settlement_wono, data_ver
      ORDER BY mod_dt DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1)
    SELECT siteid, settlement_wono, data_ver AS line_no, unnest(['quantity', 'amount', 'tax']) AS cost_type,
      unnest([l_quantity, l_extendedprice, l_tax]) AS cost_amount FROM v""",
)
def fct_settlement_detail(spark, sf):
    lines = latest_version(
        settlement_versions(spark, sf), ["siteid", "settlement_wono", "data_ver"], "mod_dt",
        tiebreak=["l_partkey", "l_suppkey", "l_extendedprice"],
    )
    lines = lines.select(
        "siteid", "settlement_wono", F.col("data_ver").alias("line_no"), F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("amount"), F.col("l_tax").alias("tax"),
    )
    ids = ["siteid", "settlement_wono", "line_no"]
    return melt(lines, ids, ["quantity", "amount", "tax"], "cost_type", "cost_amount")
