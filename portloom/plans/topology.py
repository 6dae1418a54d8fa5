"""Equipment nodes, pipe edges and vendors built from cleaned port rows.

Every mart removes copies at its own, narrower grain, so all functions accept port rows with or
without copies. The organisation map is joined without a hint: Spark broadcasts it below its size
threshold and shuffles it otherwise.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portloom.functions.text import code_of
from portloom.operators.closure import reachability
from portloom.operators.pick import pick_first
from portloom.operators.shape import encode
from portloom.operators.skew import ROWS_PER_SLICE, ROWS_PER_TASK, dealt, skew_join
from portloom.plans.ports import BYP, NOR, ORG_COLUMNS, PUMP, PUMP_POSN, SCRUBBER
from portloom.session import shuffles_for, stored

# fixed values: type -> (precedence, layer)
NODE_TYPES = {
    "MAIN": (1, 1),
    "CHAMBER": (2, 1),
    "PUMP": (3, 2),
    "SCRUBBER": (4, 3),
    "SCRUBBER_NOR_VALVE": (5, 3),
    "SCRUBBER_BYP_VALVE": (6, 3),
    "SCRUBBER_MERGE": (7, 4),
    "LATERAL_DUCT": (8, 5),
}
# fixed values: type -> length in metres
EDGE_TYPES = {
    "FORELINE": Decimal("5.0"),
    "PS": Decimal("3.0"),
    "SS": Decimal("1.0"),
    "ALLBYPASS": Decimal("3.0"),
    "SD1": Decimal("3.0"),
    "SD2": Decimal("6.0"),
}
MTBF_DAYS = 150
VENDOR_TYPE = "EQUIPMENT"
VENDOR_NOTE = "PortMaster2 seqp_maker 기준 자동 생성"

PATH = ["eqp_id", "eqp_chamber_id", "eqp_chamber_posn"]
CHAMBER = ["eqp_id", "eqp_chamber_id"]
UNITS_PER_ROW = 1000
NODE_COLUMNS = [
    "code", "type_code", "main_equipment_code", *ORG_COLUMNS, "group_code", "layer_order", "vendor_code",
]

def is_pump() -> Column:
    return F.col("seqp_type") == PUMP


def is_scrubber() -> Column:
    return F.col("seqp_type") == SCRUBBER


def scrubber_code() -> Column:
    return code_of(F.col("seqp_id"), F.col("seqp_ch"))


def path_code() -> Column:
    return code_of(F.col("eqp_id"), "_", F.col("eqp_chamber_id"), "_", F.col("eqp_chamber_posn"))


def chamber_code() -> Column:
    return code_of(F.col("eqp_id"), "_", F.col("eqp_chamber_id"))


def valve_code(scrubber: Column, role: Column | str) -> Column:
    return code_of(scrubber, "_", role, "_", F.col("eqp_chamber_id"), "_", F.col("eqp_chamber_posn"))


def mapped(ports: DataFrame, org: DataFrame) -> DataFrame:
    """Ports of equipments that have an organisation."""
    return ports.join(org.select("eqp_id"), "eqp_id", "left_semi")


def org_enrich(ports: DataFrame, org: DataFrame) -> DataFrame:
    return ports.join(org.select("eqp_id", *ORG_COLUMNS), "eqp_id")


def org_numbers(org: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(eqp_id, _org) and (_org, organisation columns): equipments with a number for their organisation
    rows, and the rows of each number; equipments of equal organisation share one."""
    rows = org.select("eqp_id", F.struct(*ORG_COLUMNS).alias("_row")).where(F.col("eqp_id").isNotNull())
    held = stored(rows.groupBy("eqp_id").agg(F.sort_array(F.collect_list("_row")).alias("_rows")), "org-rows")
    numbers = held.select("_rows").distinct().withColumn("_org", F.monotonically_increasing_id())
    numbers = stored(numbers, "org-numbers")
    return held.join(numbers, "_rows").select("eqp_id", "_org"), numbers.select("_org", F.inline("_rows"))


def chambers_with_scrubber(ports: DataFrame) -> DataFrame:
    return ports.where(is_scrubber()).select(*CHAMBER).distinct()


def chamber_cells(ports: DataFrame, org: DataFrame) -> DataFrame:
    """(code, eqp_id): one cell per path where the chamber holds a scrubber, else one per chamber.

    Rows shrink to paths first; only those are matched with the scrubber chambers.
    """
    return _cells(mapped(ports, org))


def _cells(known: DataFrame, *also: str) -> DataFrame:
    """``also`` are columns that belong to the equipment."""
    known = known.where(F.col("eqp_chamber_id").isNotNull())
    paths = known.groupBy(*PATH, *also).agg(F.max(is_scrubber()).alias("_s")).repartition("eqp_id")
    held = F.max("_s").over(Window.partitionBy(*CHAMBER))
    coded = paths.withColumn("_held", held).select(
        F.when(F.col("_held"), path_code()).otherwise(chamber_code()).alias("code"), "eqp_id", *also
    )
    return coded.distinct()


def chambers(ports: DataFrame, org: DataFrame) -> DataFrame:
    """Chamber nodes with their organisation."""
    cells = chamber_cells(ports, org).select("code", F.col("eqp_id").alias("group_code"), "eqp_id")
    return org_enrich(cells, org)


def scrubber_owners(ports: DataFrame, org: DataFrame) -> DataFrame:
    """One row per scrubber code: the equipment using it in NOR position first, then by id."""
    return _owners(mapped(ports, org))


def _owners(known: DataFrame, *also: str) -> DataFrame:
    rows = known.where(is_scrubber() & F.col("seqp_ch").isNotNull())
    rows = rows.select(
        scrubber_code().alias("code"),
        "eqp_id",
        "seqp_maker",
        *also,
        F.when(F.col("eqp_posn") == NOR, 0).otherwise(1).alias("_rank"),
    )
    order = [F.col("_rank"), F.col("eqp_id").asc_nulls_last(), F.col("seqp_maker").asc_nulls_last()]
    return pick_first(rows, ["code"], order).drop("_rank")


def duct_vendors(ports: DataFrame, org: DataFrame) -> DataFrame:
    """First maker, in name order, among the scrubbers an equipment owns."""
    return scrubber_owners(ports, org).groupBy("eqp_id").agg(F.min("seqp_maker").alias("vendor_code"))


def valves(ports: DataFrame, org: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Copies of a valve are copies in one equipment, so one shuffle serves the match and the distinct rows."""
    rows = ports.where(is_scrubber() & F.col("eqp_posn").isin(NOR, BYP) & F.col("seqp_ch").isNotNull())
    rows = dealt(rows.select(*PATH, "eqp_posn", "seqp_maker", "seqp_id", "seqp_ch"), ["eqp_id"], rows_per_task)
    return mapped(rows, org).select(
        valve_code(scrubber_code(), F.col("eqp_posn")).alias("code"),
        scrubber_code().alias("group_code"),
        "eqp_id",
        "eqp_posn",
        "seqp_maker",
    ).distinct()


def _node(kind: str, code: Column, group: Column | None = None, vendor: Column | None = None) -> Column:
    """A node candidate of the equipment ``eqp_id``; without ``group`` the code, or of the equipment's
    own nodes the equipment, is the group."""
    none = F.lit(None).cast("string")
    return F.struct(
        code.alias("code"),
        F.lit(NODE_TYPES[kind][0]).alias("type_priority"),
        F.col("eqp_id").alias("eqp_id"),
        F.col("_org").alias("_org"),
        (none if group is None else group).alias("group_code"),
        (none if vendor is None else vendor).alias("vendor_code"),
    )


def node_candidates(ports: DataFrame, numbers: DataFrame) -> DataFrame:
    """Nodes of all types before precedence, only with what their type does not say. ``numbers`` has the
    equipments that have an organisation, with its number in ``_org``.

    A chamber unfolds to MAIN and CHAMBER, a port row to its pump or valve, an owned scrubber to
    SCRUBBER, MERGE and DUCT. A duct then exists only where a scrubber is owned, and the vendor
    order of the later dedup picks its first maker. Copies are left to that dedup, which keeps one
    row per code and task before its shuffle. The ports that have an organisation are matched and
    written once; all three parts read them from there.
    """
    maker, group = F.col("seqp_maker"), F.col("_scrubber")
    used = ["eqp_id", "eqp_chamber_id", "eqp_chamber_posn", "eqp_posn", "seqp_type", "seqp_maker", "seqp_id", "seqp_ch"]
    known = ports.select(*used).join(numbers, "eqp_id")
    known = stored(known.sortWithinPartitions("eqp_id"), "mapped-ports")  # like codes together compress well
    usable = is_scrubber() & F.col("seqp_ch").isNotNull()
    role = F.when(usable & F.col("eqp_posn").isin(NOR, BYP), F.col("eqp_posn"))
    units = known.select(
        "eqp_id",
        "_org",
        "seqp_maker",
        F.when(is_pump(), F.col("seqp_id")).alias("_pump"),
        F.when(role.isNotNull(), scrubber_code()).alias("_scrubber"),
        role.alias("_role"),
        F.when(role.isNotNull(), valve_code(scrubber_code(), role)).alias("_valve"),
    )
    unit_nodes = F.array(
        F.when(F.col("_pump").isNotNull(), _node("PUMP", F.col("_pump"), vendor=maker)),
        F.when(F.col("_role") == NOR, _node("SCRUBBER_NOR_VALVE", F.col("_valve"), group, maker)),
        F.when(F.col("_role") == BYP, _node("SCRUBBER_BYP_VALVE", F.col("_valve"), group, maker)),
    )
    from_units = units.select(F.inline(F.array_compact(unit_nodes)))

    held = F.array(_node("MAIN", F.col("eqp_id")), _node("CHAMBER", F.col("code")))
    from_chambers = _cells(known, "_org").select(F.inline(held))

    owned = F.array(
        _node("SCRUBBER", F.col("code"), vendor=maker),
        _node("SCRUBBER_MERGE", code_of(F.col("code"), "_MERGE"), F.col("code"), maker),
        _node("LATERAL_DUCT", code_of(F.col("eqp_id"), "_DUCT"), vendor=maker),
    )
    from_scrubbers = _owners(known, "_org").select(F.inline(owned))
    return from_chambers.unionAll(from_units).unionAll(from_scrubbers)


def nodes(ports: DataFrame, org: DataFrame, most_rows: int | None = None) -> DataFrame:
    """Equipment nodes of eight types; of nodes sharing a code the first type stays. ``most_rows`` is the number of
    ports or one above it; if it is not given they are counted, which computes them once more."""
    order = [
        F.col("type_priority"),
        F.col("eqp_id"),
        F.col("vendor_code").asc_nulls_last(),
        F.col("group_code"),
    ]
    with shuffles_for(ports.sparkSession, ports.count() if most_rows is None else most_rows):
        numbers, rows = org_numbers(org)
        candidates = node_candidates(ports, numbers)
    found = pick_first(candidates, ["code"], order).join(rows, "_org")
    kinds = {priority: kind for kind, (priority, _) in NODE_TYPES.items()}
    kind, main = F.col("type_priority"), NODE_TYPES["MAIN"][0]
    own = F.when(kind.isin(main, NODE_TYPES["CHAMBER"][0]), F.col("eqp_id")).otherwise(F.col("code"))
    grouped = kind.isin(*(NODE_TYPES[k][0] for k in ("SCRUBBER_NOR_VALVE", "SCRUBBER_BYP_VALVE", "SCRUBBER_MERGE")))
    said = {
        "type_code": encode("type_priority", kinds),
        "main_equipment_code": F.when(kind != main, F.col("eqp_id")),
        "group_code": F.when(grouped, F.col("group_code")).otherwise(own),
        "layer_order": encode("type_priority", dict(NODE_TYPES.values())),
    }
    return found.withColumns(said).select(*NODE_COLUMNS)


def tmll_pumps(ports: DataFrame, org: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Pumps of chambers that hold no scrubber."""
    pumps = ports.where(is_pump() & (F.col("eqp_posn") == PUMP_POSN))
    pumps = mapped(pumps, org).select(*CHAMBER, F.col("seqp_id").alias("pump_code")).distinct()
    free = skew_join(pumps, chambers_with_scrubber(ports), CHAMBER, "left_anti", rows_per_slice)
    return free.select("eqp_id", chamber_code().alias("chamber_code"), "pump_code")


def path_units(
    ports: DataFrame, org: DataFrame, units_per_row: int = UNITS_PER_ROW, most_rows: int | None = None
) -> DataFrame:
    """(path columns, free, parts, nors, others): the NOR scrubbers, and the pumps and BYP scrubbers, of paths that
    have both a pump and a NOR scrubber, once each; a path of more than ``units_per_row`` has ``parts`` rows. The
    pumps of chambers that hold no scrubber are the others of ``free`` rows, without a position.

    The ports are dealt once, by equipment, which paths and chambers are parts of. The result is written, so
    that all edges start from one pass over the ports. ``most_rows`` is as in ``nodes``.
    """
    pump, usable = is_pump() & (F.col("eqp_posn") == PUMP_POSN), is_scrubber() & F.col("seqp_ch").isNotNull()
    role = F.when(pump, "PUMP").when(usable & F.col("eqp_posn").isin(NOR, BYP), F.col("eqp_posn"))
    rows = ports.where(pump | is_scrubber()).select(
        *PATH,
        role.alias("role"),
        F.when(role == "PUMP", F.col("seqp_id")).when(role.isNotNull(), scrubber_code()).alias("unit"),
        F.when(role == NOR, F.col("seqp_maker")).alias("maker"),
        is_scrubber().alias("_s"),
    )
    posn, free = F.col("eqp_chamber_posn"), F.col("free")
    held = F.max("_s").over(Window.partitionBy(*CHAMBER))
    in_order = Window.partitionBy(*PATH, "free").orderBy("role", "unit")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    is_nor = F.col("role") == NOR
    with shuffles_for(ports.sparkSession, ports.count() if most_rows is None else most_rows):
        known = mapped(rows.repartition("eqp_id"), org).distinct()
        known = known.withColumn("free", F.col("eqp_chamber_id").isNull() | ~held)
        known = known.where((free & (F.col("role") == "PUMP")) | (~free & F.col("role").isNotNull() & posn.isNotNull()))
        units = known.withColumn("eqp_chamber_posn", F.when(~free, posn)).groupBy(*PATH, "free", "role", "unit").agg(
            F.sort_array(F.collect_set(F.struct("maker"))).alias("makers")
        )
        placed = units.select(
            "*",
            (free | (F.max(F.col("role") == "PUMP").over(whole) & F.max(is_nor).over(whole))).alias("_kept"),
            F.ceil(F.count(F.lit(1)).over(whole) / F.lit(units_per_row)).alias("parts"),
            F.floor((F.row_number().over(in_order) - 1) / F.lit(units_per_row)).alias("_part"),
        )
        paths = placed.where("_kept").groupBy(*PATH, "free", "parts", "_part").agg(
            F.collect_list(F.when(is_nor, F.struct("unit", "makers"))).alias("nors"),
            F.collect_list(F.when(~is_nor, F.struct("role", "unit"))).alias("others"),
        )
        return stored(paths.drop("_part"), "path-units")


def _path_pairs(paths: DataFrame, rows_per_slice: int) -> DataFrame:
    """Every NOR scrubber with every pump and every BYP scrubber of its path; never all three. Paths of one row
    hold their pairs, only the parts of larger ones are joined."""

    def unfolded(met: DataFrame) -> DataFrame:
        one = met.select(*PATH, F.explode("nors").alias("_n"), "others")
        return one.select(*PATH, F.col("_n.unit").alias("nor"), F.col("_n.makers").alias("makers"), F.inline("others")).withColumnRenamed(
            "unit", "other"
        )

    complete = paths.where(~F.col("free"))
    pairs, large = unfolded(complete.where("parts = 1")), complete.where("parts > 1")
    if large.isEmpty():
        return pairs
    nors, others = (large.select(*PATH, c).where(F.size(c) > 0) for c in ("nors", "others"))
    return pairs.unionAll(unfolded(skew_join(nors, others, PATH, "inner", max(1, rows_per_slice // UNITS_PER_ROW))))


def pair_paths(ports: DataFrame, org: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """NOR scrubbers of each path with its pumps (``partner_type`` PUMP) and, where there are any, with
    its BYP scrubbers (BYP); a scrubber of several makers comes once for each."""
    pairs = _path_pairs(path_units(ports, org, min(UNITS_PER_ROW, rows_per_slice)), rows_per_slice)
    nor, other, byp = F.col("nor"), F.col("other"), F.col("role") == BYP
    return pairs.select("*", F.explode("makers").alias("_m")).select(
        "eqp_id",
        path_code().alias("chamber_code"),
        nor.alias("nor_scrubber_code"),
        F.col("_m.maker").alias("nor_scrubber_maker"),
        valve_code(nor, NOR).alias("nor_valve_code"),
        code_of(nor, "_MERGE").alias("nor_merge_code"),
        F.col("role").alias("partner_type"),
        other.alias("partner_code"),
        F.when(byp, valve_code(other, BYP)).alias("partner_valve_code"),
        F.when(byp, code_of(other, "_MERGE")).alias("partner_merge_code"),
    )


def _edge(kind: str, chamber: Column, start: Column, end: Column, vendor: Column | None = None) -> Column:
    return F.struct(
        code_of(start, "_", end, "_", chamber).alias("code"),
        F.lit(kind).alias("type_code"),
        F.col("eqp_id").alias("main_equipment_code"),
        chamber.alias("chamber_code"),
        start.alias("from_equipment_code"),
        end.alias("to_equipment_code"),
        (F.lit(None).cast("string") if vendor is None else vendor).alias("vendor_code"),
        F.lit(EDGE_TYPES[kind]).cast("decimal(2,1)").alias("length_m"),
        F.lit(MTBF_DAYS).alias("mtbf_days"),
    )


def edges(
    ports: DataFrame, org: DataFrame, rows_per_slice: int = ROWS_PER_SLICE, most_rows: int | None = None
) -> DataFrame:
    """Pipe edges of six types between equipment nodes. ``most_rows`` is as in ``nodes``.

    Four types belong to one unit of a complete path and come straight from its row; only PS and SS
    link two units, a NOR scrubber with a pump or a BYP scrubber of its path. SS differs by maker.
    """
    paths = path_units(ports, org, min(UNITS_PER_ROW, rows_per_slice), most_rows)
    complete, free = paths.where(~F.col("free")), paths.where("free")
    cell, unit = path_code(), F.col("unit")
    merge = code_of(unit, "_MERGE")
    of_nor = F.array(_edge("SD1", cell, unit, merge), _edge("SD2", cell, merge, code_of(F.col("eqp_id"), "_DUCT")))
    of_other = F.when(F.col("role") == "PUMP", F.array(_edge("FORELINE", cell, cell, unit))).otherwise(
        F.array(_edge("ALLBYPASS", cell, valve_code(unit, BYP), merge))
    )
    valve, other = valve_code(F.col("nor"), NOR), F.col("other")
    by_maker = F.transform(
        "makers", lambda m: _edge("SS", cell, valve, valve_code(other, BYP), m["maker"])
    )
    of_pair = F.when(F.col("role") == BYP, by_maker).otherwise(F.array(_edge("PS", cell, other, valve)))
    of_free = F.array(_edge("FORELINE", chamber_code(), chamber_code(), unit))
    return (
        complete.select(*PATH, F.inline("nors")).select(F.inline(of_nor))
        .unionAll(complete.select(*PATH, F.inline("others")).select(F.inline(of_other)))
        .unionAll(_path_pairs(paths, rows_per_slice).select(F.inline(of_pair)))
        .unionAll(free.select(*CHAMBER, F.inline("others")).select(F.inline(of_free)))
    )


def vendors(ports: DataFrame, note: str = VENDOR_NOTE) -> DataFrame:
    """Makers seen on pumps and scrubbers; ``note`` says where they come from."""
    makers = ports.where(F.col("seqp_type").isin(PUMP, SCRUBBER)).select("seqp_maker").distinct()
    return makers.select(
        F.col("seqp_maker").alias("code"),
        F.col("seqp_maker").alias("name"),
        F.lit(VENDOR_TYPE).alias("type_code"),
        F.lit(note).alias("description"),
    )


def pipe_links(node_table: DataFrame, edge_table: DataFrame) -> DataFrame:
    """Directed links of the pipe graph; a valve leads on to the scrubber it belongs to."""
    valve = F.col("type_code").isin("SCRUBBER_NOR_VALVE", "SCRUBBER_BYP_VALVE")
    bridge = node_table.where(valve).select(F.col("code").alias("src"), F.col("group_code").alias("dst"))
    pipes = edge_table.select(F.col("from_equipment_code").alias("src"), F.col("to_equipment_code").alias("dst"))
    return pipes.unionAll(bridge)


def pipe_reachability(node_table: DataFrame, edge_table: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(root, node, depth): everything downstream of each chamber. Give written marts, the node
    table is read for the seeds and for the links."""
    seeds = node_table.where(F.col("type_code") == "CHAMBER").select(F.col("code").alias("node"))
    return reachability(pipe_links(node_table, edge_table), seeds, max_depth=max_depth)
