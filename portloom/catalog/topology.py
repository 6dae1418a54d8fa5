"""Cleaning of port rows, equipment nodes, pipe edges and their building blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from portloom.catalog.registry import query, table
from portloom.operators.pick import precedence_dedup
from portloom.plans import ports as P
from portloom.plans import topology as G
from portloom.session import shuffles_for
from portloom.sources.layers import materialize

PM_RAW = """
pm_raw AS (
  SELECT 'E' || (l_orderkey // 10)::VARCHAR AS eqp_id,
         (l_linenumber % 4)::VARCHAR AS eqp_chamber_id,
         CASE WHEN l_linenumber % 4 = 0 THEN CASE WHEN l_partkey % 2 = 0 THEN 'TM' ELSE 'LL1' END
              WHEN l_orderkey % 2 = 0 THEN 'PRO' ELSE 'PED' END AS eqp_chamber_posn,
         CASE WHEN l_linenumber % 4 = 0 OR l_partkey % 3 = 0 THEN '0'
              WHEN l_partkey % 3 = 1 THEN 'NOR' ELSE 'BYP' END AS eqp_posn,
         CASE WHEN l_linenumber % 4 = 0 OR l_partkey % 3 = 0 THEN 'PUMP' ELSE 'SCRUBBER' END AS seqp_type,
         CASE WHEN l_suppkey % 50 = 49 THEN '' ELSE 'M' || (l_suppkey % 25)::VARCHAR END AS seqp_maker,
         CAST(NULL AS VARCHAR) AS seqp_model_code,
         CASE WHEN l_linenumber % 4 = 0 OR l_partkey % 3 = 0
              THEN 'E' || (l_orderkey // 10)::VARCHAR || '_PP' || l_linenumber::VARCHAR || l_suppkey::VARCHAR
              ELSE 'S' || l_suppkey::VARCHAR || 'G' || (l_orderkey // 40)::VARCHAR END AS seqp_id,
         CASE WHEN l_linenumber % 4 = 0 OR l_partkey % 3 = 0 THEN '0'
              WHEN l_partkey % 97 = 0 THEN NULL ELSE (l_suppkey % 2)::VARCHAR END AS seqp_ch,
         l_linenumber::VARCHAR AS seqp_port
  FROM lineitem)"""
PM = PM_RAW + """,
pm AS (
  SELECT DISTINCT * FROM pm_raw
  WHERE seqp_maker <> '' AND seqp_id <> '' AND NOT (seqp_type = 'SCRUBBER' AND seqp_ch IS NULL))"""
ORG_GAPS = " WHERE n % 20 <> 0"  # equipments without an organisation
ORG = f"""
org AS (
  SELECT 'E' || n::VARCHAR AS eqp_id, 'T' || (n % 7)::VARCHAR AS team_code, 'D' || (n % 3)::VARCHAR AS division_code,
         'P' || (n % 4)::VARCHAR AS site_code, 'L' || (n % 11)::VARCHAR AS line_code,
         'A' || (n % 5)::VARCHAR AS area_code
  FROM (SELECT DISTINCT o_orderkey // 10 AS n FROM orders){ORG_GAPS})"""
UNITS = """
units AS (
  SELECT pm.*, eqp_id || '_' || eqp_chamber_id AS chamber,
         eqp_id || '_' || eqp_chamber_id || '_' || eqp_chamber_posn AS cell,
         seqp_id || seqp_ch AS unit,
         seqp_id || seqp_ch || '_' || eqp_posn || '_' || eqp_chamber_id || '_' || eqp_chamber_posn AS valve,
         bool_or(seqp_type = 'SCRUBBER') OVER (PARTITION BY eqp_id, eqp_chamber_id) AS has_scrubber,
         org.* EXCLUDE (eqp_id)
  FROM pm JOIN org USING (eqp_id))"""
BASE = f"WITH {PM}, {ORG}"
NODES = f"""{BASE}, {UNITS},
owners AS (
  SELECT unit, eqp_id, seqp_maker FROM units WHERE seqp_type = 'SCRUBBER'
  QUALIFY row_number() OVER (PARTITION BY unit ORDER BY (eqp_posn <> 'NOR')::INT, eqp_id, seqp_maker) = 1),
found AS (
  SELECT v.* FROM units, LATERAL (VALUES
    (1, 'MAIN', eqp_id, eqp_id, 1, NULL),
    (2, 'CHAMBER', CASE WHEN has_scrubber THEN cell ELSE chamber END, eqp_id, 1, NULL),
    (3, 'PUMP', CASE WHEN seqp_type = 'PUMP' THEN seqp_id END, seqp_id, 2, seqp_maker),
    (5, 'SCRUBBER_NOR_VALVE', CASE WHEN eqp_posn = 'NOR' THEN valve END, unit, 3, seqp_maker),
    (6, 'SCRUBBER_BYP_VALVE', CASE WHEN eqp_posn = 'BYP' THEN valve END, unit, 3, seqp_maker)
  ) t(priority, type_code, code, group_code, layer_order, vendor_code), LATERAL (SELECT t.*, units.eqp_id) v
  UNION ALL
  SELECT v.* FROM owners, LATERAL (VALUES
    (4, 'SCRUBBER', unit, unit, 3, seqp_maker),
    (7, 'SCRUBBER_MERGE', unit || '_MERGE', unit, 4, seqp_maker),
    (8, 'LATERAL_DUCT', eqp_id || '_DUCT', eqp_id || '_DUCT', 5, seqp_maker)
  ) t(priority, type_code, code, group_code, layer_order, vendor_code), LATERAL (SELECT t.*, owners.eqp_id) v),
dim_equipment AS (
  SELECT code, type_code, CASE WHEN type_code <> 'MAIN' THEN eqp_id END AS main_equipment_code,
         team_code, division_code, site_code, line_code, area_code, group_code, layer_order, vendor_code
  FROM (SELECT * FROM found WHERE code IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY code ORDER BY priority, eqp_id, vendor_code, group_code) = 1)
  JOIN org USING (eqp_id))"""
TRIOS = """
path_pump AS (SELECT DISTINCT eqp_id, cell, seqp_id AS pump FROM units WHERE seqp_type = 'PUMP' AND eqp_posn = '0'),
path_nor AS (SELECT DISTINCT cell, unit, valve, seqp_maker FROM units WHERE seqp_type = 'SCRUBBER' AND eqp_posn = 'NOR'),
path_byp AS (SELECT DISTINCT cell, unit, valve FROM units WHERE seqp_type = 'SCRUBBER' AND eqp_posn = 'BYP'),
trios AS (
  SELECT DISTINCT p.eqp_id, p.cell AS chamber_code, p.pump AS pump_code, n.unit AS nor_scrubber_code,
         n.seqp_maker AS nor_scrubber_maker, n.valve AS nor_valve_code, n.unit || '_MERGE' AS nor_merge_code,
         b.unit AS byp_scrubber_code, b.valve AS byp_valve_code, b.unit || '_MERGE' AS byp_merge_code
  FROM path_pump p JOIN path_nor n USING (cell) LEFT JOIN path_byp b USING (cell))"""
EDGES = f"""{TRIOS},
links AS (
  SELECT DISTINCT eqp_id, chamber_code, t.* FROM trios, LATERAL (VALUES
    ('FORELINE', chamber_code, pump_code, NULL, 5.0), ('PS', pump_code, nor_valve_code, NULL, 3.0),
    ('SS', nor_valve_code, byp_valve_code, nor_scrubber_maker, 1.0),
    ('ALLBYPASS', byp_valve_code, byp_merge_code, NULL, 3.0), ('SD1', nor_scrubber_code, nor_merge_code, NULL, 3.0),
    ('SD2', nor_merge_code, eqp_id || '_DUCT', NULL, 6.0)
  ) t(type_code, a, z, vendor_code, length_m) WHERE a IS NOT NULL AND z IS NOT NULL
  UNION ALL
  SELECT DISTINCT eqp_id, chamber, 'FORELINE', chamber, seqp_id, NULL, 5.0
  FROM units WHERE seqp_type = 'PUMP' AND eqp_posn = '0' AND NOT has_scrubber),
dim_pipe AS (
  SELECT a || '_' || z || '_' || chamber_code AS code, type_code, eqp_id AS main_equipment_code, chamber_code,
         a AS from_equipment_code, z AS to_equipment_code, vendor_code,
         length_m::DECIMAL(2,1) AS length_m, 150 AS mtbf_days
  FROM links)"""


def raw_ports(spark, sf):
    return P.port_master(table(spark, sf, "lineitem"))


def ports(spark, sf):
    return P.valid_ports(raw_ports(spark, sf))


def most_ports(spark, sf):
    """The lines that ports are made of, which the files' footers tell."""
    return table(spark, sf, "lineitem").count()


def org(spark, sf, gaps=True):
    return P.org_interface(P.org_mapping(table(spark, sf, "orders"), gaps))


@query("slv_clean_rows", f"WITH {PM} SELECT * FROM pm")
def slv_clean_rows(spark, sf):
    return P.clean_ports(raw_ports(spark, sf))


@query(
    "select_distinct_rows",
    f"WITH {PM_RAW} SELECT DISTINCT eqp_id, eqp_chamber_id, eqp_chamber_posn, seqp_type, seqp_maker FROM pm_raw",
)
def select_distinct_rows(spark, sf):
    return raw_ports(spark, sf).select(
        "eqp_id", "eqp_chamber_id", "eqp_chamber_posn", "seqp_type", "seqp_maker"
    ).distinct()


@query("org_interface", f"WITH {ORG} SELECT * FROM org")
def org_interface(spark, sf):
    return org(spark, sf)


@query(
    "valve_role_filter",
    f"""{BASE}, {UNITS}
    SELECT DISTINCT valve AS code, unit AS group_code, eqp_id, eqp_posn, seqp_maker FROM units
    WHERE seqp_type = 'SCRUBBER' AND eqp_posn IN ('NOR', 'BYP') AND seqp_ch IS NOT NULL""",
)
def valve_role_filter(spark, sf):
    return G.valves(ports(spark, sf), org(spark, sf))


@query(
    "composite_code",
    f"""WITH {PM_RAW} SELECT eqp_id || '_' || eqp_chamber_id || '_' || eqp_chamber_posn AS chamber_code,
    seqp_id || seqp_ch AS unit_code, seqp_id || seqp_ch || '_MERGE' AS merge_code,
    seqp_id || '_' || seqp_model_code AS model_code, count(*) AS n_rows FROM pm_raw GROUP BY ALL""",
)
def composite_code(spark, sf):
    coded = raw_ports(spark, sf).select(
        G.path_code().alias("chamber_code"),
        G.scrubber_code().alias("unit_code"),
        G.code_of(G.scrubber_code(), "_MERGE").alias("merge_code"),
        G.code_of(F.col("seqp_id"), "_", F.col("seqp_model_code")).alias("model_code"),
    )
    return coded.groupBy(*coded.columns).agg(F.count(F.lit(1)).alias("n_rows"))


@query("org_enrich_inner", f"{BASE} SELECT * FROM pm JOIN org USING (eqp_id)")
def org_enrich_inner(spark, sf):
    return G.org_enrich(P.clean_ports(raw_ports(spark, sf)), org(spark, sf))


@query(
    "chambers_with_scrubber",
    f"WITH {PM} SELECT DISTINCT eqp_id, eqp_chamber_id FROM pm WHERE seqp_type = 'SCRUBBER'",
)
def chambers_with_scrubber(spark, sf):
    return G.chambers_with_scrubber(ports(spark, sf))


@query(
    "chambers",
    f"""{BASE}, {UNITS} SELECT DISTINCT CASE WHEN has_scrubber THEN cell ELSE chamber END AS code,
    eqp_id AS group_code, eqp_id, team_code, division_code, site_code, line_code, area_code FROM units""",
)
def chambers(spark, sf):
    return G.chambers(ports(spark, sf), org(spark, sf))


@query(
    "tmll_pumps_without_scrubber",
    f"""{BASE}, {UNITS} SELECT DISTINCT eqp_id, chamber AS chamber_code, seqp_id AS pump_code
    FROM units WHERE seqp_type = 'PUMP' AND eqp_posn = '0' AND NOT has_scrubber""",
)
def tmll_pumps_without_scrubber(spark, sf):
    return G.tmll_pumps(ports(spark, sf), org(spark, sf))


@query(
    "path_pairing",
    f"""{BASE}, {UNITS}, {TRIOS}
    SELECT DISTINCT eqp_id, chamber_code, nor_scrubber_code, nor_scrubber_maker, nor_valve_code, nor_merge_code,
      'PUMP' AS partner_type, pump_code AS partner_code, NULL::VARCHAR AS partner_valve_code,
      NULL::VARCHAR AS partner_merge_code FROM trios
    UNION ALL
    SELECT DISTINCT eqp_id, chamber_code, nor_scrubber_code, nor_scrubber_maker, nor_valve_code, nor_merge_code,
      'BYP', byp_scrubber_code, byp_valve_code, byp_merge_code FROM trios WHERE byp_scrubber_code IS NOT NULL""",
)
def path_pairing(spark, sf):
    return G.pair_paths(ports(spark, sf), org(spark, sf))


@query(
    "scrubber_owner_pick",
    f"""{BASE}, {UNITS} SELECT unit AS code, eqp_id, seqp_maker FROM units WHERE seqp_type = 'SCRUBBER'
    QUALIFY row_number() OVER (PARTITION BY unit ORDER BY CASE eqp_posn WHEN 'NOR' THEN 0 ELSE 1 END, eqp_id, seqp_maker) = 1""",
)
def scrubber_owner_pick(spark, sf):
    return G.scrubber_owners(ports(spark, sf), org(spark, sf))


@query(
    "duct_vendor_pick",
    f"{NODES} SELECT main_equipment_code AS eqp_id, vendor_code FROM dim_equipment WHERE type_code = 'LATERAL_DUCT'",
)
def duct_vendor_pick(spark, sf):
    return G.duct_vendors(ports(spark, sf), org(spark, sf))


@query(
    "precedence_dedup",
    f"""{BASE}, {UNITS} SELECT code, type_code, eqp_id, seqp_maker FROM (
      SELECT seqp_id AS code, 1 AS p, 'PUMP' AS type_code, eqp_id, seqp_maker FROM units WHERE seqp_type = 'PUMP'
      UNION ALL SELECT unit, 2, eqp_posn, eqp_id, seqp_maker FROM units WHERE seqp_type = 'SCRUBBER')
    QUALIFY row_number() OVER (PARTITION BY code ORDER BY p, eqp_id, seqp_maker, type_code) = 1""",
)
def precedence_dedup_query(spark, sf):
    rows = G.mapped(ports(spark, sf), org(spark, sf)).select(
        F.when(G.is_pump(), F.col("seqp_id")).otherwise(G.scrubber_code()).alias("code"),
        F.when(G.is_pump(), 1).otherwise(2).alias("p"),
        F.when(G.is_pump(), "PUMP").otherwise(F.col("eqp_posn")).alias("type_code"),
        "eqp_id",
        "seqp_maker",
    )
    return precedence_dedup(rows, "code", "p", ["eqp_id", "seqp_maker", "type_code"]).drop("p")


@query("dim_equipment", f"{NODES} SELECT * FROM dim_equipment")
def dim_equipment(spark, sf):
    return G.nodes(ports(spark, sf), org(spark, sf), most_rows=most_ports(spark, sf))


@query("dim_pipe", f"{BASE}, {UNITS}, {EDGES} SELECT * FROM dim_pipe")
def dim_pipe(spark, sf):
    return G.edges(ports(spark, sf), org(spark, sf), most_rows=most_ports(spark, sf))


@query(
    "dim_vendor",
    f"""WITH {PM} SELECT DISTINCT seqp_maker AS code, seqp_maker AS name, 'EQUIPMENT' AS type_code,
    '{G.VENDOR_NOTE}' AS description FROM pm WHERE seqp_type IN ('PUMP', 'SCRUBBER')""",
)
def dim_vendor(spark, sf):
    return G.vendors(ports(spark, sf))


@query(
    "pipe_reachability",
    f"""{NODES.replace("WITH", "WITH RECURSIVE", 1)}, {EDGES},
    hops AS (SELECT from_equipment_code AS a, to_equipment_code AS b FROM dim_pipe
             UNION SELECT code, group_code FROM dim_equipment
             WHERE type_code IN ('SCRUBBER_NOR_VALVE', 'SCRUBBER_BYP_VALVE')),
    walk AS (SELECT code AS root, code AS node, 0 AS depth FROM dim_equipment WHERE type_code = 'CHAMBER'
             UNION SELECT root, b, depth + 1 FROM walk JOIN hops ON a = node)
    SELECT root, node, min(depth) AS depth FROM walk GROUP BY ALL""",
)
def pipe_reachability(spark, sf):
    with shuffles_for(spark, most_ports(spark, sf)):
        nodes = materialize(dim_equipment(spark, sf), "dim_equipment", "gld")
        return G.pipe_reachability(nodes, dim_pipe(spark, sf))
