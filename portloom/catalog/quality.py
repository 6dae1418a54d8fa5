"""Checks over source tables and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from portloom.catalog.registry import query, table
from portloom.catalog.topology import (
    BASE, EDGES, NODES, ORG_GAPS, PM, PM_RAW, UNITS, dim_equipment, dim_pipe, org, ports, raw_ports,
)
from portloom.operators import quality as K
from portloom.plans.gated import NODE_FILLED, PIPE_ENDS, PIPE_FILLED, PORT_FILLED, build_gated, pipe_marts
from portloom.plans.ports import ORG_COLUMNS, PORT_COLUMNS, clean_ports
from portloom.plans.topology import EDGE_TYPES, NODE_TYPES
from portloom.session import shuffles_for, stored, workspace

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


@query(
    "check_not_null",
    f"WITH {PM_RAW} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_violations FROM pm_raw" for c in PORT_COLUMNS
    ),
)
def check_not_null(spark, sf):
    return K.not_null(raw_ports(spark, sf), PORT_COLUMNS)


@query("check_unique", f"WITH {PM} SELECT seqp_id, count(*) AS n_rows FROM pm GROUP BY 1 HAVING count(*) > 1")
def check_unique(spark, sf):
    return K.unique(clean_ports(raw_ports(spark, sf)), ["seqp_id"])


@query(
    "check_unique_composite",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def check_unique_composite(spark, sf):
    return K.unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "check_accepted_values",
    f"SELECT o_orderpriority, count(*) AS n_rows FROM orders WHERE o_orderpriority NOT IN {tuple(PRIORITIES)} GROUP BY 1",
)
def check_accepted_values(spark, sf):
    return K.accepted_values(table(spark, sf, "orders"), "o_orderpriority", PRIORITIES)


@query(
    "check_relationships",
    f"""{NODES}, {EDGES}, held AS (
      SELECT unnest({PIPE_ENDS}) AS column_name, unnest([{", ".join(PIPE_ENDS)}]) AS value FROM dim_pipe)
    SELECT column_name, value, count(*) AS n_rows FROM held
    WHERE value NOT IN (SELECT code FROM dim_equipment) GROUP BY ALL
    UNION ALL SELECT 'eqp_id', eqp_id, count(*) FROM pm_raw
    WHERE eqp_id NOT IN (SELECT eqp_id FROM org) GROUP BY 2""",
)
def check_relationships(spark, sf):
    raw = raw_ports(spark, sf)
    with shuffles_for(spark, raw.count()):
        pipes = K.relationships(dim_pipe(spark, sf), PIPE_ENDS, dim_equipment(spark, sf), "code")
        return stored(pipes.unionAll(K.relationships(raw, "eqp_id", org(spark, sf), "eqp_id")), "lost-values")


@query(
    "check_scrubber_owner",
    f"""{NODES}, nor AS (SELECT DISTINCT seqp_id || seqp_ch AS code, eqp_id FROM pm WHERE eqp_posn = 'NOR')
    SELECT code, main_equipment_code FROM dim_equipment d WHERE type_code = 'SCRUBBER'
      AND code IN (SELECT code FROM nor)
      AND (code, main_equipment_code) NOT IN (SELECT (code, eqp_id) FROM nor)""",
)
def check_scrubber_owner(spark, sf):
    used = ports(spark, sf)
    with shuffles_for(spark, used.count()):
        return stored(K.scrubber_owner(dim_equipment(spark, sf), used), "lost-owners")


@query(
    "check_merge_owner",
    f"""{NODES}, seen AS (SELECT code, type_code, group_code, CASE WHEN type_code = 'SCRUBBER_MERGE' AND length(code) % 2 = 0
        THEN 'X' || main_equipment_code ELSE main_equipment_code END AS main_equipment_code FROM dim_equipment)
    SELECT m.code, m.main_equipment_code FROM seen m
    JOIN (SELECT code, main_equipment_code AS owner FROM seen WHERE type_code = 'SCRUBBER') s
      ON s.code = m.group_code AND s.owner <> m.main_equipment_code WHERE m.type_code = 'SCRUBBER_MERGE'""",
)
def check_merge_owner(spark, sf):
    """On a node table in which part of the merges have lost their owner."""
    lost = (F.col("type_code") == "SCRUBBER_MERGE") & (F.length("code") % 2 == 0)
    owner = F.col("main_equipment_code")
    nodes = dim_equipment(spark, sf)
    return K.merge_owner(nodes.withColumn("main_equipment_code", F.when(lost, F.concat(F.lit("X"), owner)).otherwise(owner)))


@query(
    "dq_gate_summary",
    f"""{BASE}, {UNITS}, n AS (
      SELECT 'not_null' AS check_name, 'ports' AS table_name, 'seqp_ch' AS column_name,
        (SELECT count(*) FROM pm_raw WHERE seqp_ch IS NULL) AS n_violations
      UNION ALL SELECT 'not_null', 'ports', 'eqp_id', (SELECT count(*) FROM pm_raw WHERE eqp_id IS NULL)
      UNION ALL SELECT 'unique', 'orders', 'o_orderkey',
        (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))
      UNION ALL SELECT 'unique', 'lineitem', 'l_orderkey,l_linenumber',
        (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
      UNION ALL SELECT 'accepted_values', 'orders', 'o_orderpriority',
        (SELECT count(*) FROM orders WHERE o_orderpriority NOT IN {tuple(PRIORITIES)})
      UNION ALL SELECT 'relationships', 'ports', 'eqp_id',
        (SELECT count(DISTINCT eqp_id) FROM pm WHERE eqp_id NOT IN (SELECT eqp_id FROM org)))
    SELECT *, CASE WHEN n_violations > 0 THEN 'fail' ELSE 'pass' END AS status FROM n""",
)
def dq_gate_summary(spark, sf):
    raw, orders, lines = raw_ports(spark, sf), table(spark, sf, "orders"), table(spark, sf, "lineitem")
    nulls = lambda c: K.not_null(raw, [c])
    return K.run_suite(
        [
            K.Check("not_null", "ports", "seqp_ch", nulls("seqp_ch"), "n_violations"),
            K.Check("not_null", "ports", "eqp_id", nulls("eqp_id"), "n_violations"),
            K.Check("unique", "orders", "o_orderkey", K.unique(orders, ["o_orderkey"])),
            K.Check("unique", "lineitem", "l_orderkey,l_linenumber", K.unique(lines, ["l_orderkey", "l_linenumber"])),
            K.Check(
                "accepted_values", "orders", "o_orderpriority",
                K.accepted_values(orders, "o_orderpriority", PRIORITIES), "n_rows",
            ),
            K.Check(
                "relationships", "ports", "eqp_id",
                K.relationships(ports(spark, sf), "eqp_id", org(spark, sf), "eqp_id"),
            ),
        ]
    )


@query(
    "freshness_status",
    """SELECT user_id, max(ts) AS last_loaded_at,
      CASE WHEN max(ts) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOUR THEN 'error'
           WHEN max(ts) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 6 HOUR THEN 'warn' ELSE 'pass' END AS status
    FROM events GROUP BY user_id""",
)
def freshness_status(spark, sf):
    now = F.to_timestamp_ntz(F.lit("2024-01-31 00:00:00"))
    return K.freshness(table(spark, sf, "events"), "ts", now, "6 HOURS", "24 HOURS", ["user_id"])


@query(
    "reconcile_diff",
    """WITH old AS (SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE o_orderkey % 53 <> 0),
    renewed AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
              CASE WHEN o_orderkey % 11 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey
            FROM orders WHERE o_orderkey % 59 <> 0),
    twice AS (SELECT * FROM renewed UNION ALL SELECT * FROM renewed WHERE o_orderkey % 101 = 0),
    c AS (SELECT coalesce(o.o_orderkey, k.o_orderkey) AS o_orderkey, coalesce(n_old, 0) AS n_old, coalesce(n_new, 0) AS n_new
      FROM (SELECT o_orderkey, count(*) AS n_old FROM old GROUP BY 1) o
      FULL JOIN (SELECT o_orderkey, count(*) AS n_new FROM twice GROUP BY 1) k USING (o_orderkey))
    SELECT c.*, 'missing' AS difference, NULL AS column_name, NULL AS old_value, NULL AS new_value FROM c WHERE n_new = 0
    UNION ALL SELECT c.*, 'extra', NULL, NULL, NULL FROM c WHERE n_old = 0
    UNION ALL SELECT c.*, 'duplicate', NULL, NULL, NULL FROM c WHERE n_old > 1 OR n_new > 1
    UNION ALL SELECT c.*, 'changed', 'o_orderstatus', o.o_orderstatus, w.o_orderstatus
      FROM old o JOIN renewed w USING (o_orderkey) JOIN c USING (o_orderkey)
      WHERE o.o_orderstatus IS DISTINCT FROM w.o_orderstatus
    UNION ALL SELECT c.*, 'changed', 'o_custkey', o.o_custkey::VARCHAR, w.o_custkey::VARCHAR
      FROM old o JOIN renewed w USING (o_orderkey) JOIN c USING (o_orderkey)
      WHERE o.o_custkey <> w.o_custkey""",
)
def reconcile_diff(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    key = F.col("o_orderkey")
    renewed = orders.where(key % 59 != 0).select(
        "o_orderkey",
        F.when(key % 7 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 11 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("o_custkey"),
    )
    twice = renewed.unionAll(renewed.where(key % 101 == 0))
    return K.reconcile(orders.where(key % 53 != 0), twice, ["o_orderkey"], ["o_orderstatus", "o_custkey"])


def gated_sql(nodes: str, pipes: bool) -> str:
    """Violations of every check of the gated build, counted table by table."""
    nulls = lambda t, cols: f"(SELECT {' + '.join(f'count(*) - count({c})' for c in cols)} FROM {t})"
    repeated = lambda t, c: f"(SELECT count(*) FROM (SELECT 1 FROM {t} GROUP BY {c} HAVING count(*) > 1))"
    outside = lambda t, c, some: f"(SELECT count(*) FROM {t} WHERE {c} NOT IN ({some}))"
    listed = lambda kinds: ", ".join(f"'{k}'" for k in kinds)
    org_filled = ["eqp_id", *ORG_COLUMNS]
    vendor_filled = ["code", "name", "type_code"]
    checks = [
        ("not_null", "slv_ports", ",".join(PORT_FILLED), nulls("used_ports", PORT_FILLED)),
        ("accepted_values", "slv_ports", "seqp_type", outside("used_ports", "seqp_type", "'PUMP', 'SCRUBBER'")),
        ("unique", "slv_org", "eqp_id", repeated("org", "eqp_id")),
        ("not_null", "slv_org", ",".join(org_filled), nulls("org", org_filled)),
        ("unique", "dim_vendor", "code", repeated("dim_vendor", "code")),
        ("not_null", "dim_vendor", ",".join(vendor_filled), nulls("dim_vendor", vendor_filled)),
        ("unique", "dim_equipment", "code", repeated("dim_equipment", "code")),
        ("not_null", "dim_equipment", ",".join(NODE_FILLED), nulls("dim_equipment", NODE_FILLED)),
        ("accepted_values", "dim_equipment", "type_code", outside("dim_equipment", "type_code", listed(NODE_TYPES))),
        ("relationships", "dim_equipment", "main_equipment_code",
         outside("dim_equipment", "main_equipment_code", "SELECT code FROM dim_equipment")),
        ("relationships", "dim_equipment", "vendor_code", outside("dim_equipment", "vendor_code", "SELECT code FROM dim_vendor")),
        ("merge_owner", "dim_equipment", "main_equipment_code",
         """(SELECT count(*) FROM dim_equipment m JOIN dim_equipment s ON s.code = m.group_code
             AND s.type_code = 'SCRUBBER' AND m.type_code = 'SCRUBBER_MERGE'
             AND s.main_equipment_code <> m.main_equipment_code)"""),
        ("scrubber_owner", "dim_equipment", "main_equipment_code",
         """(SELECT count(*) FROM dim_equipment WHERE type_code = 'SCRUBBER' AND code IN (SELECT code FROM nor)
             AND (code, main_equipment_code) NOT IN (SELECT (code, eqp_id) FROM nor))"""),
    ]
    if pipes:
        checks += [
            ("unique", "dim_pipe", "code", repeated("dim_pipe", "code")),
            ("not_null", "dim_pipe", ",".join(PIPE_FILLED), nulls("dim_pipe", PIPE_FILLED)),
            ("accepted_values", "dim_pipe", "type_code", outside("dim_pipe", "type_code", listed(EDGE_TYPES))),
            ("relationships", "dim_pipe", ",".join(PIPE_ENDS), outside("held", "value", "SELECT code FROM dim_equipment")),
        ]
    counted = " UNION ALL ".join(
        f"SELECT '{check}' AS check_name, '{t}' AS table_name, '{c}' AS column_name, {n}::BIGINT AS n_violations"
        for check, t, c, n in checks
    )
    held = f"held AS (SELECT unnest([{', '.join(PIPE_ENDS)}]) AS value FROM dim_pipe)," if pipes else ""
    return f"""{nodes}, {EDGES + "," if pipes else ""} {held}
    nor AS (SELECT DISTINCT seqp_id || seqp_ch AS code, eqp_id FROM pm WHERE eqp_posn = 'NOR'),
    used_ports AS (SELECT * FROM pm_raw
      WHERE seqp_maker <> '' AND seqp_id <> '' AND NOT (seqp_type = 'SCRUBBER' AND seqp_ch IS NULL)),
    dim_vendor AS (SELECT DISTINCT seqp_maker AS code, seqp_maker AS name, 'EQUIPMENT' AS type_code FROM pm),
    n AS ({counted})
    SELECT *, CASE WHEN n_violations > 0 THEN 'fail' ELSE 'pass' END AS status,
      sum(n_violations) OVER (PARTITION BY table_name) = 0 AS published FROM n"""


@query("gated_build", gated_sql(NODES, pipes=False))
def gated_build(spark, sf):
    """Here a scrubber whose only NOR user has no organisation fails the node table, so pipes wait."""
    marts = pipe_marts(ports(spark, sf), org(spark, sf))
    return build_gated(marts, workspace(spark, "marts"), must_pass=False)


@query("gated_pipes", gated_sql(NODES.replace(ORG_GAPS, "").replace("(l_orderkey // 40)", "(l_orderkey // 4000)"), pipes=True))
def gated_pipes(spark, sf):
    """Every organisation is known and scrubbers are shared widely: the node table passes, pipes fail
    on ducts that no node is, where an equipment uses scrubbers that all belong to others."""
    place = F.regexp_extract("seqp_id", "^S[0-9]+G([0-9]+)$", 1).cast("long")
    shared = F.concat(F.regexp_extract("seqp_id", "^(S[0-9]+G)", 1), F.floor(place / 100).cast("string"))
    seen = ports(spark, sf).withColumn("seqp_id", F.when(F.col("seqp_type") == "SCRUBBER", shared).otherwise(F.col("seqp_id")))
    marts = pipe_marts(seen, org(spark, sf, gaps=False))
    return build_gated(marts, workspace(spark, "marts"), must_pass=False)
