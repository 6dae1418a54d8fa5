"""Marts staged, checked and only then published; a failing check stops everything after it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portloom.operators import quality as K
from portloom.plans import topology as G
from portloom.plans.ports import ORG_COLUMNS, PUMP, SCRUBBER
from portloom.session import shuffles_for
from portloom.sources.layers import materialize
from portloom.sources.tables import publish_version, stage_version

Marts = dict[str, DataFrame]

NODE_FILLED = [
    "code", "type_code", "team_code", "division_code", "site_code", "line_code", "area_code", "group_code", "layer_order",
]
PORT_FILLED = ["eqp_id", "eqp_chamber_id", "eqp_chamber_posn", "eqp_posn", "seqp_type", "seqp_maker", "seqp_id"]
PIPE_ENDS = ["main_equipment_code", "chamber_code", "from_equipment_code", "to_equipment_code"]
PIPE_FILLED = ["code", "type_code", *PIPE_ENDS, "length_m", "mtbf_days"]


@dataclass(frozen=True)
class Mart:
    """A mart, how it is built from the marts before it, and the checks it must pass."""

    name: str
    build: Callable[[Marts], DataFrame]
    checks: Callable[[Marts], Sequence[K.Check]]


def pipe_marts(ports: DataFrame, org: DataFrame) -> list[Mart]:
    """The cleaned tables and the marts made from them, each with its checks; a broken cleaned table
    stops everything, and the marts read the cleaned tables as written."""

    def port_checks(m: Marts):
        t, name = m["slv_ports"], "slv_ports"
        return [
            K.Check("not_null", name, ",".join(PORT_FILLED), K.not_null(t, PORT_FILLED), "n_violations"),
            K.Check("accepted_values", name, "seqp_type", K.accepted_values(t, "seqp_type", [PUMP, SCRUBBER]), "n_rows"),
        ]

    def org_checks(m: Marts):
        t, filled = m["slv_org"], ["eqp_id", *ORG_COLUMNS]
        return [
            K.Check("unique", "slv_org", "eqp_id", K.unique(t, ["eqp_id"])),
            K.Check("not_null", "slv_org", ",".join(filled), K.not_null(t, filled), "n_violations"),
        ]

    def vendor_checks(m: Marts):
        t = m["dim_vendor"]
        return [
            K.Check("unique", "dim_vendor", "code", K.unique(t, ["code"])),
            K.Check("not_null", "dim_vendor", "code,name,type_code", K.not_null(t, ["code", "name", "type_code"]), "n_violations"),
        ]

    def node_checks(m: Marts):
        t, name = m["dim_equipment"], "dim_equipment"
        return [
            K.Check("unique", name, "code", K.unique(t, ["code"])),
            K.Check("not_null", name, ",".join(NODE_FILLED), K.not_null(t, NODE_FILLED), "n_violations"),
            K.Check("accepted_values", name, "type_code", K.accepted_values(t, "type_code", list(G.NODE_TYPES)), "n_rows"),
            K.Check("relationships", name, "main_equipment_code", K.relationships(t, "main_equipment_code", t, "code"), "n_rows"),
            K.Check("relationships", name, "vendor_code", K.relationships(t, "vendor_code", m["dim_vendor"], "code"), "n_rows"),
            K.Check("merge_owner", name, "main_equipment_code", K.merge_owner(t, written=True)),
            K.Check("scrubber_owner", name, "main_equipment_code", K.scrubber_owner(t, m["slv_ports"])),
        ]

    def pipe_checks(m: Marts):
        t, name = m["dim_pipe"], "dim_pipe"
        ends = K.relationships(t, PIPE_ENDS, m["dim_equipment"], "code")
        return [
            K.Check("unique", name, "code", K.unique(t, ["code"])),
            K.Check("not_null", name, ",".join(PIPE_FILLED), K.not_null(t, PIPE_FILLED), "n_violations"),
            K.Check("accepted_values", name, "type_code", K.accepted_values(t, "type_code", list(G.EDGE_TYPES)), "n_rows"),
            K.Check("relationships", name, ",".join(PIPE_ENDS), ends, "n_rows"),
        ]

    return [
        Mart("slv_ports", lambda m: ports, port_checks),
        Mart("slv_org", lambda m: org, org_checks),
        Mart("dim_vendor", lambda m: G.vendors(m["slv_ports"]), vendor_checks),
        Mart("dim_equipment", lambda m: G.nodes(m["slv_ports"], m["slv_org"]), node_checks),
        Mart("dim_pipe", lambda m: G.edges(m["slv_ports"], m["slv_org"]), pipe_checks),
    ]


def build_gated(marts: Sequence[Mart], root: str, must_pass: bool = True) -> DataFrame:
    """Builds the marts in order: each is written once as a version that no reader sees, what was
    written is checked, and a log line publishes it.

    Returns the check results with ``published`` per table. The first failing table stays unpublished,
    its last good version stays the newest, and later marts are not built; with ``must_pass`` this
    raises, otherwise the results up to there are returned. Each step shuffles into as many partitions as
    the largest mart before it needs.
    """
    built: Marts = {}
    results = []
    most = 0
    for mart in marts:
        df = mart.build(built)
        spark = df.sparkSession
        with shuffles_for(spark, most):
            staged = stage_version(df, f"{root}/gld/{mart.name}")
        built[mart.name] = staged.read(spark)
        most = max(most, staged.row_count)
        with shuffles_for(spark, most):
            suite = K.run_suite(mart.checks(built))
            suite = materialize(suite, f"{mart.name}_checks", "sbx", root)
        try:
            K.gate(suite)
        except K.GateFailed:
            if must_pass:
                raise
            results.append(suite.withColumn("published", F.lit(False)))
            break
        publish_version(spark, staged)
        results.append(suite.withColumn("published", F.lit(True)))
    return reduce(DataFrame.unionAll, results)
