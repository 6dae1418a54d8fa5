from collections import Counter

import pytest
from conftest import rows
from fixture_ports import ORG_SCHEMA, PORT_SCHEMA, golden, org, pump, scrub
from pyspark.sql import functions as F

from portloom import session
from portloom.catalog import quality as checks
from portloom.operators import quality as K
from portloom.operators.skew import dealt
from portloom.plans import gated
from portloom.plans import ports as P
from portloom.plans import topology as G
from portloom.plans.gated import build_gated, pipe_marts
from portloom.sources.tables import read_table, table_exists


@pytest.fixture(scope="module")
def built(spark):
    ports = P.clean_ports(spark.createDataFrame(golden(), PORT_SCHEMA))
    orgs = spark.createDataFrame(org("AX10", "BX20", "CX30"), ORG_SCHEMA)
    return ports, orgs, G.nodes(ports, orgs).cache(), G.edges(ports, orgs).cache()


def by_type(df):
    return dict(Counter(r.type_code for r in df.collect()))


def make(spark, port_rows, *eqps):
    ports = P.valid_ports(spark.createDataFrame(port_rows, PORT_SCHEMA))
    return ports, spark.createDataFrame(org(*eqps), ORG_SCHEMA)


def test_golden_counts(built):
    ports, orgs, nodes, edges = built
    assert ports.count() == 47
    assert G.vendors(ports).count() == 6
    assert by_type(nodes) == {
        "MAIN": 3, "CHAMBER": 19, "PUMP": 21, "SCRUBBER": 11, "SCRUBBER_NOR_VALVE": 16,
        "SCRUBBER_BYP_VALVE": 10, "SCRUBBER_MERGE": 11, "LATERAL_DUCT": 3,
    }
    assert by_type(edges) == {"FORELINE": 21, "PS": 16, "SS": 10, "ALLBYPASS": 10, "SD1": 16, "SD2": 16}


def test_golden_passes_all_checks(built):
    ports, _, nodes, edges = built
    ends = ["main_equipment_code", "chamber_code", "from_equipment_code", "to_equipment_code"]
    suite = K.run_suite(
        [
            K.Check("unique", "nodes", "code", K.unique(nodes, ["code"])),
            K.Check("unique", "edges", "code", K.unique(edges, ["code"])),
            K.Check("not_null", "edges", "all", K.not_null(edges, [*ends, "code", "length_m"]), "n_violations"),
            K.Check("relationships", "edges", "ends", K.relationships(edges, ends, nodes, "code")),
            K.Check("relationships", "nodes", "main", K.relationships(nodes, "main_equipment_code", nodes, "code")),
            K.Check("relationships", "nodes", "vendor", K.relationships(nodes, "vendor_code", G.vendors(ports), "code")),
            K.Check("accepted_values", "nodes", "type_code", K.accepted_values(nodes, "type_code", list(G.NODE_TYPES))),
            K.Check("owner", "nodes", "scrubber", K.scrubber_owner(nodes, ports)),
            K.Check("owner", "nodes", "merge", K.merge_owner(nodes)),
        ]
    )
    assert {r.status for r in suite.collect()} == {"pass"}
    K.gate(suite)


def test_pair_scrubbers_share_merge_and_layers(built):
    _, _, nodes, edges = built
    got = {r.code: r for r in nodes.collect()}
    assert got["AX10_SC011_MERGE"].group_code == "AX10_SC011"
    assert got["AX10_SC011_MERGE"].layer_order == 4
    assert got["AX10"].main_equipment_code is None and got["AX10"].vendor_code is None
    assert got["AX10_0"].type_code == "CHAMBER" and "AX10_A" not in got and "AX10_A_PRO" in got
    assert got["AX10_DUCT"].vendor_code == "MK3" and got["AX10_DUCT"].layer_order == 5
    ss = [r for r in edges.collect() if r.type_code == "SS" and r.chamber_code == "AX10_A_PRO"]
    assert [(r.code, r.vendor_code, str(r.length_m), r.mtbf_days) for r in ss] == [
        ("AX10_SC011_NOR_A_PRO_AX10_SC021_BYP_A_PRO_AX10_A_PRO", "MK3", "1.0", 150)
    ]


def test_pairing_without_triples(built):
    ports, orgs, _, edges = built
    pairs = G.pair_paths(ports, orgs).collect()
    kinds, made = [r.partner_type for r in pairs], by_type(edges)
    assert kinds.count("PUMP") == made["PS"] and kinds.count("BYP") == made["SS"]
    assert {r.partner_type for r in pairs if r.eqp_id == "CX30"} == {"PUMP"}
    assert all((r.partner_valve_code is None) == (r.partner_type == "PUMP") for r in pairs)


def test_vendor_note(built):
    ports, _, _, _ = built
    assert {r.description for r in G.vendors(ports).collect()} == {G.VENDOR_NOTE}
    assert {r.description for r in G.vendors(ports, "by hand").collect()} == {"by hand"}


def test_copies_do_not_matter(spark, built):
    _, orgs, nodes, edges = built
    ports = P.valid_ports(spark.createDataFrame(golden() * 3, PORT_SCHEMA))
    assert rows(G.nodes(ports, orgs)) == rows(nodes)
    assert rows(G.edges(ports, orgs)) == rows(edges)


@pytest.mark.parametrize("slice_rows", [1, 2])
def test_hot_paths_are_cut_without_changing_edges(spark, slice_rows):
    crowd = [pump("H1", "A", "PRO", n, "MK1") for n in range(9)]
    crowd += [scrub("H1", "A", "PRO", "NOR", n, "MK2") for n in range(4)]
    crowd += [scrub("H1", "A", "PRO", "BYP", n, "MK2") for n in range(10, 13)]
    crowd += [pump("H1", "0", "TM", 30, "MK1"), pump("H2", "A", "PRO", 31, "MK1")]
    ports, orgs = make(spark, crowd, "H1", "H2")
    cut, whole = G.edges(ports, orgs, slice_rows), G.edges(ports, orgs)
    assert rows(cut) == rows(whole)
    assert by_type(cut) == {"FORELINE": 11, "PS": 36, "SS": 12, "ALLBYPASS": 3, "SD1": 4, "SD2": 4}
    assert rows(G.pair_paths(ports, orgs, slice_rows)) == rows(G.pair_paths(ports, orgs))
    assert G.pair_paths(ports, orgs).count() == 9 * 4 + 4 * 3


def test_invalid_rows_go(spark):
    bad = [
        pump("E1", "0", "TM", 1, ""),
        pump("E1", "0", "TM", 2, None),
        scrub("E1", "A", "PRO", "NOR", 1, "MK1", ch=None),
        pump("E1", "0", "TM", 3, "MK1"),
        pump("E1", "0", "TM", 3, "MK1"),
    ]
    assert P.clean_ports(spark.createDataFrame(bad, PORT_SCHEMA)).count() == 1


def test_unmapped_equipment_vanishes(spark):
    ports, orgs = make(spark, [pump("E1", "0", "TM", 1, "M"), pump("E2", "0", "TM", 2, "M")], "E1")
    assert {r.code for r in G.nodes(ports, orgs).collect()} == {"E1", "E1_0", "E1_PP01"}
    assert [r.main_equipment_code for r in G.edges(ports, orgs).collect()] == ["E1"]


def test_shared_scrubber_goes_to_nor_user_and_leaves_dangling_duct(spark):
    shared = ("SCRUBBER", "MK1", None, "SH1", "1", "1")
    ports, orgs = make(
        spark,
        [
            pump("E1", "A", "PRO", 1, "MK2"),
            ("E1", "A", "PRO", "BYP", *shared),
            ("E1", "A", "PRO", "NOR", "SCRUBBER", "MK1", None, "SH2", "1", "1"),
            pump("E2", "A", "PRO", 1, "MK2"),
            ("E2", "A", "PRO", "NOR", *shared),
            ("E0", "A", "PRO", "NOR", "SCRUBBER", "MK1", None, "SH2", "1", "1"),
        ],
        "E0", "E1", "E2",
    )
    nodes, edges = G.nodes(ports, orgs), G.edges(ports, orgs)
    owner = {r.code: r.main_equipment_code for r in nodes.collect() if r.type_code == "SCRUBBER"}
    assert owner == {"SH11": "E2", "SH21": "E0"}
    # E1 owns none of its scrubbers, so its duct is missing although the edge to it is there
    dangling = K.relationships(edges, "to_equipment_code", nodes, "code").collect()
    assert [(r.value, r.n_rows) for r in dangling] == [("E1_DUCT", 1)]


def test_scrubber_with_two_makers_breaks_uniqueness_only(spark):
    ports, orgs = make(
        spark,
        [
            pump("E1", "A", "PRO", 1, "MK2"),
            scrub("E1", "A", "PRO", "NOR", 1, "MK1"),
            scrub("E1", "A", "PRO", "NOR", 1, "MK9"),
            scrub("E1", "A", "PRO", "BYP", 2, "MK1"),
        ],
        "E1",
    )
    edges = G.edges(ports, orgs)
    assert by_type(edges) == {"FORELINE": 1, "PS": 1, "SS": 2, "ALLBYPASS": 1, "SD1": 1, "SD2": 1}
    assert [r.n_rows for r in K.unique(edges, ["code"]).collect()] == [2]


def test_path_without_pump_or_nor_has_no_process_edges(spark):
    ports, orgs = make(
        spark,
        [
            scrub("E1", "A", "PRO", "NOR", 1, "MK1"),
            scrub("E1", "A", "PRO", "BYP", 2, "MK1"),
            pump("E1", "B", "PRO", 1, "MK1"),
            scrub("E1", "B", "PRO", "BYP", 3, "MK1"),
        ],
        "E1",
    )
    assert G.edges(ports, orgs).count() == 0


def test_code_collision_keeps_first_type_and_smallest_owner(spark):
    ports, orgs = make(
        spark,
        [
            pump("E1", "0", "TM", 1, "MK1"),
            ("E2", "0", "TM", "0", "PUMP", "MK0", None, "E1", "0", "0"),
            ("E4", "A", "PRO", "NOR", "SCRUBBER", "MK1", None, "SX", "1", "1"),
            ("E3", "A", "PRO", "NOR", "SCRUBBER", "MK1", None, "SX", "1", "1"),
        ],
        "E1", "E2", "E3", "E4",
    )
    got = {r.code: r for r in G.nodes(ports, orgs).collect()}
    assert got["E1"].type_code == "MAIN"
    assert got["SX1_NOR_A_PRO"].main_equipment_code == "E3"


def test_a_known_number_of_ports_is_not_counted(built, monkeypatch):
    ports, orgs, nodes, edges = built
    asked = []
    monkeypatch.setattr(G, "shuffles_for", lambda spark, n, f=G.shuffles_for: asked.append(n) or f(spark, n))
    assert rows(G.nodes(ports, orgs, most_rows=10**6)) == rows(nodes)
    assert rows(G.edges(ports, orgs, most_rows=10**6 + 1)) == rows(edges)
    assert asked == [10**6, 10**6 + 1]


def test_reachability_from_chamber_to_duct(built):
    _, _, nodes, edges = built
    reached = G.pipe_reachability(nodes, edges).where("root = 'AX10_A_PRO'").collect()
    depth = {r.node: r.depth for r in reached}
    assert depth["AX10_DUCT"] == 5
    assert depth["AX10_PP04"] == 1 and depth["AX10_SC011_NOR_A_PRO"] == 2


def test_gate_publishes_good_marts_and_blocks_bad_ones(built, spark, folder):
    ports, orgs, _, edges = built
    root = folder("wh")
    results = build_gated(pipe_marts(ports, orgs), root).collect()
    assert {(r.table_name, r.published, r.status) for r in results} == {
        (t, True, "pass") for t in ("slv_ports", "slv_org", "dim_vendor", "dim_equipment", "dim_pipe")
    }
    assert rows(read_table(spark, f"{root}/gld/dim_pipe")) == rows(edges)

    # the scrubber is owned by a BYP user because its only NOR user has no organisation
    bad = [scrub("E1", "A", "PRO", "BYP", 1, "MK1"), ("E2", "A", "PRO", "NOR", "SCRUBBER", "MK1", None, "E1_SC01", "1", "1")]
    bad_ports, bad_org = make(spark, bad, "E1")
    with pytest.raises(K.GateFailed, match="scrubber_owner"):
        build_gated(pipe_marts(bad_ports, bad_org), root)
    assert rows(read_table(spark, f"{root}/gld/dim_pipe")) == rows(edges)
    other = folder("other")
    stopped = build_gated(pipe_marts(bad_ports, bad_org), other, must_pass=False).collect()
    good = {(t, True) for t in ("slv_ports", "slv_org", "dim_vendor")}
    assert {(r.table_name, r.published) for r in stopped} == {*good, ("dim_equipment", False)}
    with pytest.raises(K.GateFailed, match="unique slv_org.eqp_id"):
        build_gated(pipe_marts(bad_ports, bad_org.unionAll(bad_org)), folder("twice"))
    assert not table_exists(spark, f"{other}/gld/dim_equipment")


def tables_of(df):
    """The names of the stored tables that a frame reads, without their random parts."""
    return {f.split("/")[-2].rsplit("-", 1)[0] for f in df.inputFiles()}


def test_nodes_match_the_ports_once(spark, folder):
    spark.createDataFrame(golden(), PORT_SCHEMA).write.parquet(folder("ports"))
    ports = P.valid_ports(spark.read.parquet(folder("ports")))
    orgs = spark.createDataFrame(org("AX10", "BX20", "CX30"), ORG_SCHEMA)
    assert tables_of(G.nodes(ports, orgs)) == {"mapped-ports", "org-numbers"}


def test_nodes_come_once_for_each_organisation_row(spark, built):
    ports, orgs, nodes, _ = built
    other = orgs.where("eqp_id = 'AX10'").withColumn("team_code", F.lit(None).cast("string"))
    twice = G.nodes(ports, orgs.unionAll(other))
    moved = nodes.join(other.select("eqp_id"), F.coalesce("main_equipment_code", "code") == F.col("eqp_id"), "left_semi")
    expected = nodes.unionAll(moved.withColumn("team_code", F.lit(None).cast("string")))
    assert Counter(map(tuple, twice.collect())) == Counter(map(tuple, expected.collect()))


def test_merge_owner_reads_written_nodes(built):
    assert tables_of(K.merge_owner(built[2])) == {"owned-nodes"}


def test_valves_are_dealt_by_their_rows(spark):
    """More rows than a task should get make more tasks, and the copies still meet; a hot key stays with Spark."""
    held = [
        (f"E{i % 50}", "1", "PRO", "NOR" if i % 3 else "BYP", "SCRUBBER", "M1", None, f"S{i % 70}", "0", str(i))
        for i in range(400)
    ]
    ports = spark.createDataFrame(held + held, PORT_SCHEMA)
    orgs = spark.createDataFrame(org(*(f"E{i}" for i in range(40))), ORG_SCHEMA)
    want = sorted({(f"{r[7]}0_{r[3]}_1_PRO", f"{r[7]}0", r[0], r[3], "M1") for r in held if int(r[0][1:]) < 40})
    for per_task in (20, 10, 500_000):  # dealt, a key larger than a task, few rows
        assert sorted(tuple(r) for r in G.valves(ports, orgs, per_task).collect()) == want
    many = dealt(ports, ["eqp_id"], 20)
    assert many.rdd.getNumPartitions() == 40
    assert dealt(ports, ["eqp_id"], 10) is ports and dealt(ports, ["eqp_id"]) is ports


def test_edges_start_from_one_written_pass(spark, built):
    """The ports are dealt once; paths of many units take several rows, and those are still all paired."""
    ports, orgs, _, edges = built
    assert tables_of(G.edges(ports, orgs)) == {"path-units"}
    assert {r.parts for r in G.path_units(ports, orgs).collect()} == {1}
    cut = G.path_units(ports, orgs, 2).where("not free").collect()
    assert max(r.parts for r in cut) > 1 and max(len(r.nors) + len(r.others) for r in cut) == 2
    assert rows(G.edges(ports, orgs, 2)) == rows(edges)


def test_free_pumps_count_without_their_position(spark):
    twice = [pump("E1", "A", "PRO", 1, "M1"), pump("E1", "A", "PED", 1, "M1"), pump("E1", "B", "PRO", 2, "M1")]
    ports, orgs = make(spark, [*twice, scrub("E1", "B", "PED", "BYP", 1, "M1")], "E1")
    assert [r.code for r in G.edges(ports, orgs).collect()] == ["E1_A_E1_PP01_E1_A"]


def test_shuffles_follow_the_rows(spark, built, folder, monkeypatch):
    """Builds and checks shuffle into more partitions than the session has where their rows need them."""
    ports, orgs, *_ = built
    before, seen = spark.conf.get(session.PARTITIONS_CONF), []
    monkeypatch.setattr(session, "ROWS_PER_TASK", 2)

    def noting(plain):
        def noted(df, *args):
            seen.append(int(spark.conf.get(session.PARTITIONS_CONF)))
            return plain(df, *args)

        return noted

    for module, name in ((G, "stored"), (gated, "stage_version"), (gated, "materialize"), (checks, "stored")):
        monkeypatch.setattr(module, name, noting(getattr(module, name)))
    build_gated(pipe_marts(ports, orgs), folder("sized"))
    assert seen[0] == int(before) and min(seen[1:]) >= ports.count() / 2  # nothing is known before the first mart
    for query in ("check_scrubber_owner", "check_relationships"):
        monkeypatch.setattr(checks, "dim_equipment", lambda spark, sf: G.nodes(ports, orgs))
        monkeypatch.setattr(checks, "dim_pipe", lambda spark, sf: G.edges(ports, orgs))
        for source in ("ports", "raw_ports"):
            monkeypatch.setattr(checks, source, lambda spark, sf: ports)
        monkeypatch.setattr(checks, "org", lambda spark, sf: orgs)
        seen.clear()
        assert getattr(checks, query)(spark, "none").count() == 0
        assert min(seen) >= ports.count() / 2
    assert spark.conf.get(session.PARTITIONS_CONF) == before and spark.conf.get(session.ADVISORY_CONF) != session.BYTES_PER_TASK
