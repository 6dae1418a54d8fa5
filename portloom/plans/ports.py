"""Port master and organisation mapping derived from the order tables, and the cleaned port rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portloom.operators.shape import valid_rows

# fixed values
PORT_COLUMNS = (
    "eqp_id", "eqp_chamber_id", "eqp_chamber_posn", "eqp_posn", "seqp_type",
    "seqp_maker", "seqp_model_code", "seqp_id", "seqp_ch", "seqp_port",
)
ORG_COLUMNS = ("team_code", "division_code", "site_code", "line_code", "area_code")
PUMP, SCRUBBER = "PUMP", "SCRUBBER"
PUMP_POSN, NOR, BYP = "0", "NOR", "BYP"


def port_master(lineitem: DataFrame) -> DataFrame:
    """Port-level records projected from order lines: one line is one port of an equipment."""
    text = lambda c: c.cast("string")
    order, line, part, supp = (F.col(f"l_{c}") for c in ("orderkey", "linenumber", "partkey", "suppkey"))
    transfer = line % 4 == 0
    pump = transfer | (part % 3 == 0)
    eqp = F.concat(F.lit("E"), text(F.floor(order / 10)))
    channel = F.when(part % 97 != 0, text(supp % 2))
    return lineitem.select(
        eqp.alias("eqp_id"),
        text(line % 4).alias("eqp_chamber_id"),
        F.when(transfer, F.when(part % 2 == 0, "TM").otherwise("LL1"))
        .otherwise(F.when(order % 2 == 0, "PRO").otherwise("PED"))
        .alias("eqp_chamber_posn"),
        F.when(pump, PUMP_POSN).when(part % 3 == 1, NOR).otherwise(BYP).alias("eqp_posn"),
        F.when(pump, PUMP).otherwise(SCRUBBER).alias("seqp_type"),
        F.when(supp % 50 == 49, "").otherwise(F.concat(F.lit("M"), text(supp % 25))).alias("seqp_maker"),
        F.lit(None).cast("string").alias("seqp_model_code"),
        F.when(pump, F.concat(eqp, F.lit("_PP"), text(line), text(supp)))
        .otherwise(F.concat(F.lit("S"), text(supp), F.lit("G"), text(F.floor(order / 40))))
        .alias("seqp_id"),
        F.when(pump, "0").otherwise(channel).alias("seqp_ch"),
        text(line).alias("seqp_port"),
    )


def org_mapping(orders: DataFrame, gaps: bool = True) -> DataFrame:
    """Equipment to organisation, one row per equipment; with ``gaps`` every twentieth is unmapped."""
    n = F.col("n")
    code = lambda letter, k: F.concat(F.lit(letter), (n % k).cast("string"))
    numbers = orders.select(F.floor(F.col("o_orderkey") / 10).alias("n")).distinct()
    return (numbers.where(n % 20 != 0) if gaps else numbers).select(
        F.concat(F.lit("E"), n.cast("string")).alias("eqp_id"),
        code("T", 7).alias("team_code"),
        code("D", 3).alias("division_code"),
        code("P", 4).alias("site_code"),
        code("L", 11).alias("line_code"),
        code("A", 5).alias("area_code"),
    )


def valid_ports(ports: DataFrame) -> DataFrame:
    """Usable port rows; copies stay, for marts that remove them at their own grain."""
    return valid_rows(
        ports,
        not_null=("eqp_id", "eqp_chamber_id", "eqp_chamber_posn", "eqp_posn", "seqp_type", "seqp_maker", "seqp_id"),
        not_empty=("seqp_maker", "seqp_id"),
        implications=[(F.col("seqp_type") == SCRUBBER, F.col("seqp_ch").isNotNull())],
    )


def clean_ports(ports: DataFrame) -> DataFrame:
    """Cleaned port rows without copies."""
    return valid_ports(ports.select(*PORT_COLUMNS)).distinct()


def org_interface(mapping: DataFrame) -> DataFrame:
    """The mapping as its consumers see it, whatever source is behind it."""
    return mapping.select("eqp_id", *ORG_COLUMNS)
