from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from portloom.functions.calendar import local_time, to_local, with_fiscal
from portloom.functions.text import code_of, parse_json, surrogate_key, to_messages
from portloom.operators import marts as M
from portloom.operators import quality as K
from portloom.operators import shape as S
from portloom.operators.closure import hierarchy, reachability
from portloom.plans.lineage import downstream_freshness, stale_partitions, upstream_status
from portloom.session import CLEANUP_CONF, stored


def test_code_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    assert rows(df.select(code_of(F.col("x"), "_", F.col("y")).alias("c"))) == [(None,), ("a_b",)]


def test_surrogate_key_keeps_null_positions_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "")], "x string, y string")
    assert df.select(surrogate_key("x", "y").alias("k")).distinct().count() == 3


def test_fiscal_calendar_edges(spark):
    days = [date(2024, 1, 15), date(2024, 1, 16), date(2024, 12, 16), date(2024, 12, 15), date(2024, 2, 29), date(2024, 1, 22), date(2024, 1, 23)]
    got = rows(with_fiscal(spark.createDataFrame([(d,) for d in days], "d date"), "d"))
    assert got == sorted(
        [
            (date(2024, 1, 15), 2024, 1, 5), (date(2024, 1, 16), 2024, 2, 1), (date(2024, 12, 16), 2025, 1, 1),
            (date(2024, 12, 15), 2024, 12, 5), (date(2024, 2, 29), 2024, 3, 2), (date(2024, 1, 22), 2024, 2, 1),
            (date(2024, 1, 23), 2024, 2, 2),
        ]
    )


def test_local_time_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 10, 20, 30),)], "t timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert rows(to_local(df, ["t"])) == [(datetime(2024, 3, 11, 5, 30), datetime(2024, 3, 10, 20, 30))]
        assert rows(df.select(local_time(df, "t").alias("t"))) == [(datetime(2024, 3, 11, 5, 30),)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_json_and_messages(spark):
    df = spark.createDataFrame([(1, '{"k": 5, "s": "x"}'), (2, "not json")], "id int, p string")
    assert rows(parse_json(df, "p", {"k": ("$.k", "int"), "s": ("$.s", "int")}), "id", "k", "s") == [(1, 5, None), (2, None, None)]
    assert rows(to_messages(df.select("id"), ["id"])) == [("1", '{"id":1}'), ("2", '{"id":2}')]


def test_valid_rows_and_implication(spark):
    df = spark.createDataFrame([("a", "S", None), ("b", "S", "1"), ("", "P", None), (None, "P", "1"), ("c", "P", None)], "m string, t string, ch string")
    kept = S.valid_rows(df, ["m", "t"], ["m"], [(F.col("t") == "S", F.col("ch").isNotNull())])
    assert rows(kept, "m") == [("b",), ("c",)]


def test_melt_keeps_zero_and_sums(spark):
    df = spark.createDataFrame([(1, 0.0, None), (2, 3.0, 4.0)], "id int, a double, b double")
    out = S.melt(df, ["id"], ["a", "b"], "what", "amount")
    assert rows(out) == [(1, "a", 0.0), (2, "a", 3.0), (2, "b", 4.0)]
    assert S.melt(df, ["id"], ["a", "b"], "what", "amount", drop_null=False).count() == 4


def test_conform_and_versions(spark):
    df = spark.createDataFrame([(1, "A", "5")], "i int, k string, n string")
    out = S.conform(df, {"i": "id", "k": "kind_type", "n": "count"}, {"count": "int"}, {"kind_type": {"A": 1}}, {"is_a": F.col("kind_type") == "A"})
    assert rows(out) == [(1, 1, 5, True)]
    old = spark.createDataFrame([(1, "x")], "id int, name string")
    new = spark.createDataFrame([(2, "y", "n")], "key int, title string, note string")
    both = S.unify_versions({"v1": old, "v3": new}, {"v1": {"id": "id", "label": "name"}, "v3": {"id": "key", "label": "title", "note": "note"}})
    assert rows(both, "id", "label", "note", "schema_version") == [(1, "x", None, "v1"), (2, "y", "n", "v3")]


def test_canonical_merge_prefers_earlier_source(spark):
    a = spark.createDataFrame([(1, "a1", None)], "k int, name string, amount int")
    b = spark.createDataFrame([(1, "b1", 5), (2, "b2", 6)], "k int, name string, amount int")
    assert rows(S.canonical_merge({"a": a, "b": b}, ["k"]), "k", "name", "amount", "source_name") == [(1, "a1", None, "a"), (2, "b2", 6, "b")]
    filled = S.canonical_merge({"a": a, "b": b}, ["k"], fill=["amount"])
    assert rows(filled, "k", "name", "amount", "source_name") == [(1, "a1", 5, "a"), (2, "b2", 6, "b")]


def test_details_preagg_and_metrics(spark):
    base = spark.createDataFrame([(1,), (2,)], "id int")
    d1 = spark.createDataFrame([(1, "p")], "id int, a string")
    d2 = spark.createDataFrame([(1, "q"), (2, "r")], "id int, b string")
    assert rows(M.join_details(base, [(d1, ["id"]), (d2, ["id"])], {"name": ["a", "b"]})) == [(1, "p"), (2, "r")]
    fact = spark.createDataFrame([(1, "x"), (1, "y")], "fid int, v string")
    agg = M.with_preagg(base, fact, {"id": "fid"}, [F.count(F.lit(1)).alias("n")], zero=["n"])
    assert rows(agg) == [(1, 2), (2, 0)]
    spec = M.MetricSpec("f", ("fid",), {"n": F.count(F.lit(1)), "top": F.max(F.lit(3))})
    assert rows(M.metric_rows({"f": fact}, [spec])) == [("f", "fid=1", "n", 2.0), ("f", "fid=1", "top", 3.0)]


def test_checks_ignore_null_and_gate_blocks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4), ("z", 5)], "c string, n int")
    assert rows(K.unique(df, ["c"])) == [("a", 2)]
    assert rows(K.accepted_values(df, "c", ["a"])) == [("z", 1)]
    assert rows(K.not_null(df, ["c", "n"])) == [("c", 2), ("n", 0)]
    parent = spark.createDataFrame([("a",)], "p string")
    assert rows(K.relationships(df, "c", parent, "p")) == [("c", "z", 1)]
    suite = K.run_suite([K.Check("unique", "t", "c", K.unique(df, ["c"])), K.Check("not_null", "t", "n", K.not_null(df, ["n"]), "n_violations")])
    assert rows(suite) == [("not_null", "t", "n", 0, "pass"), ("unique", "t", "c", 1, "fail")]
    with pytest.raises(K.GateFailed, match="unique t.c: 1"):
        K.gate(suite)


def test_freshness(spark):
    now = datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, now), (2, now - timedelta(hours=7)), (3, now - timedelta(days=3)), (4, None)], "s int, t timestamp_ntz")
    got = K.freshness(df, "t", F.lit(now).cast("timestamp_ntz"), "6 HOURS", "1 DAY", ["s"])
    assert rows(got, "s", "status") == [(1, "pass"), (2, "warn"), (3, "error"), (4, "never")]


def test_reconcile(spark):
    schema = "k int, x string, y int"
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, None, 3), (5, "e", 5), (6, "f", 6), (6, "f", 6)], schema)
    new = spark.createDataFrame([(1, "a", 1), (2, "B", 9), (3, None, 3), (4, "d", 4), (5, "e", 7), (5, "e", 6)], schema)
    assert rows(K.reconcile(old, new, ["k"], ["x", "y"])) == sorted(
        [
            (2, 1, 1, "changed", "x", "b", "B"), (2, 1, 1, "changed", "y", "2", "9"), (4, 0, 1, "extra", None, None, None),
            (5, 1, 2, "changed", "y", "5", "7"), (5, 1, 2, "duplicate", None, None, None),
            (6, 2, 0, "duplicate", None, None, None), (6, 2, 0, "missing", None, None, None),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_reachability_stops_on_cycles_and_keeps_shortest(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("x", "y")], "src string, dst string")
    seeds = spark.createDataFrame([("a",), ("q",)], "node string")
    assert rows(reachability(edges, seeds)) == [("a", "a", 0), ("a", "b", 1), ("a", "c", 1), ("q", "q", 0)]
    assert rows(reachability(edges, seeds, max_depth=0)) == [("a", "a", 0), ("q", "q", 0)]
    hub = spark.createDataFrame([("h", f"n{i}") for i in range(50)] + [(f"n{i}", "t") for i in range(50)], "src string, dst string")
    got = reachability(hub, spark.createDataFrame([("h",)], "node string"))
    assert got.count() == 52


def test_hierarchy_levels(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 2), (9, 8), (5, 6), (6, 5)], "id int, up int")
    got = rows(hierarchy(df, "id", "up"), "node", "root", "level", "all_parent_list")
    on_cycle = [(5, None, None, None), (6, None, None, None)]
    assert got == [(1, 1, 1, []), (2, 1, 2, [1]), (3, 1, 3, [1, 2]), *on_cycle, (9, 9, 1, [])]


def test_deep_chains_end(spark):
    n = 70
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "src long, dst long")
    got = reachability(edges, spark.createDataFrame([(0,)], "node long"))
    assert got.count() == n + 1 and got.agg({"depth": "max"}).first()[0] == n
    tree = hierarchy(edges.selectExpr("dst AS id", "src AS up"), "id", "up")
    assert tree.agg({"level": "max"}).first()[0] == n


def test_stale_partitions_and_upstream(spark):
    t = lambda d: datetime(2024, 1, d)
    up = spark.createDataFrame([("p1", t(1)), ("p2", t(5)), ("p3", t(1))], "part string, at timestamp_ntz")
    down = spark.createDataFrame([("p1", t(2)), ("p2", t(3))], "part string, at timestamp_ntz")
    assert rows(stale_partitions(up, down, "part", "at"), "part", "reason") == [("p2", "outdated"), ("p3", "missing")]
    edges = spark.createDataFrame([("raw", "slv"), ("slv", "gld"), ("ok", "gld")], "upstream string, downstream string")
    status = spark.createDataFrame([("raw", "error"), ("ok", "pass"), ("slv", "pass"), ("gld", "pass")], "relation string, status string")
    assert rows(upstream_status(edges, status), "consumer", "waiting_for", "depth", "status") == [
        ("gld", "raw", 2, "error"), ("slv", "raw", 1, "error"),
    ]
    unseen = upstream_status(edges, status.where("relation <> 'ok'"))
    assert ("gld", "ok", 1, "never") in rows(unseen, "consumer", "waiting_for", "depth", "status")


def test_a_deep_chain_takes_few_rounds(spark, monkeypatch):
    from portloom.operators import closure

    rounds, cut = [], closure.cut_lineage
    monkeypatch.setattr(closure, "cut_lineage", lambda df: rounds.append(1) or cut(df))
    edges = [(i, i - 1 if i else None) for i in range(1000)]
    got = hierarchy(spark.createDataFrame(edges, "id int, up int"), "id", "up")
    assert len(rounds) - 2 <= 12
    deepest = got.where("node = 999").first()
    assert (deepest.root, deepest.level, deepest.all_parent_list) == (0, 1000, list(range(999)))
    assert got.agg(F.sum("level")).first()[0] == 1000 * 1001 // 2


def test_hierarchy_of_repeated_rows_several_parents_and_cycles(spark):
    rows_ = [("a", None), ("b", "a"), ("b", "a"), ("c", "b"), ("c", "a"), ("d", "c"), ("o", "gone"), (None, "a")]
    rows_ += [("x", "y"), ("y", "z"), ("z", "x"), ("u", "x"), ("v", "u"), ("s", "s"), ("m", "x"), ("m", "a")]
    got = hierarchy(spark.createDataFrame(rows_, "id string, up string"), "id", "up")
    found = sorted(((r.node, r.root, r.level, r.all_parent_list) for r in got.collect()), key=str)
    ways = [
        ("a", "a", 1, []), ("b", "a", 2, ["a"]), ("c", "a", 3, ["a", "b"]), ("c", "a", 2, ["a"]), ("o", "o", 1, []),
        ("d", "a", 4, ["a", "b", "c"]), ("d", "a", 3, ["a", "c"]), (None, "a", 2, ["a"]), ("m", "a", 2, ["a"]),
    ]
    lost = [(n, None, None, None) for n in "xyzuvs"]
    assert found == sorted(ways + lost, key=str)


def test_equal_buckets_are_not_compared_row_by_row(spark, folder):
    cols = ["x", "y", "z"]
    spark.range(2000).selectExpr("id AS k", "id % 7 AS x", "if(id % 3 = 0, null, 'v') AS y", "if(id % 3 = 0, 'v', null) AS z").write.parquet(
        folder("old")
    )
    old = spark.read.parquet(folder("old"))
    # nulls that change places, a changed value, a missing and an extra key, a repeated one
    swapped = old.where("k = 3").selectExpr("k", "x", "z AS y", "y AS z")
    new = old.where("k not in (3, 5, 9)").unionAll(swapped).unionAll(old.where("k in (11)"))
    new = new.unionAll(old.where("k = 5").selectExpr("k", "x + 1", "y", "z")).unionAll(old.where("k = 1").selectExpr("5000L", "x", "y", "z"))
    want = rows(K._compared(old.select("k", *cols), new, ["k"], cols))
    assert rows(K.reconcile(old, new, ["k"], cols)) == want and len(want) == 6
    found = K.reconcile(old, new, ["k"], cols, buckets=50)
    assert rows(found) == want
    execution = found._jdf.queryExecution()
    execution.toRdd().count()
    plan = execution.executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.index("Exchange hashpartitioning(k") < plan.index("LeftSemi")  # listed from the top down
    assert K.reconcile(old, old, ["k"], cols).isEmpty()


def test_specs_of_a_source_share_one_scan(spark, folder):
    spark.range(100).selectExpr("id % 4 AS a", "if(id % 5 = 0, null, id % 5) AS b", "id AS v").write.parquet(folder("f"))
    fact = spark.read.parquet(folder("f"))
    specs = [
        M.MetricSpec("f", ("a",), {"n": F.count(F.lit(1)), "s": F.sum("v")}),
        M.MetricSpec("f", ("b", "a"), {"n": F.count(F.lit(1))}, where="v >= 50"),
        M.MetricSpec("f", ("b",), {"top": F.max("v"), "kinds": F.count_distinct("a")}, where="a = 1"),
        M.MetricSpec("f", (), {"n": F.count(F.lit(1))}, where="v < 0"),
    ]

    def alone(spec):
        parts = [F.concat(F.lit(f"{d}="), F.coalesce(F.col(d).cast("string"), F.lit("null"))) for d in sorted(spec.dims)]
        return rows(M.evaluate({"f": fact}, spec).select("source_name", F.concat_ws(",", *parts), "metric_name", "metric_value"))

    want = sorted((r for s in specs for r in alone(s)), key=str)
    found = M.metric_rows({"f": fact}, specs)
    assert sorted(rows(found), key=str) == want
    plan = M.metric_rows({"f": fact}, specs[:3])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_the_worst_state_and_its_nearest_cause(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "d"), ("x", "c"), ("d", "b"), ("y", "d"), ("d", "e"), ("a", "a"), ("k", "e")]
    edges = spark.createDataFrame(edges, "upstream string, downstream string")
    status = [("a", "warn"), ("b", "pass"), ("c", "error"), ("d", "pass"), ("e", "pass"), ("x", "pass"), ("y", "error"), ("k", "odd")]
    status = spark.createDataFrame(status, "relation string, status string")
    found = downstream_freshness(edges, status)
    assert rows(found) == [
        ("a", "warn", "a", 1), ("b", "error", "c", 2), ("c", "error", "c", 3), ("d", "error", "c", 1), ("e", "never", "k", 1),
    ]


def test_unique_is_exact_when_digests_meet(spark):
    pairs = [(f"k{i % 40}", i // 2) for i in range(80)] + [("k1", 0), ("k1", 0), (None, 1), (None, 1), ("x", None)]
    df = spark.createDataFrame(pairs, "a string, b int")
    want = rows(df.dropna().groupBy("a", "b").count().where("count > 1"))
    for digest in (None, lambda cols: F.pmod(F.xxhash64(*cols), F.lit(3)), lambda cols: F.lit(1).cast("long")):
        found = K.unique(df, ["a", "b"], **({"digest": digest} if digest else {}))
        assert found.columns == ["a", "b", "n_rows"] and rows(found) == want == [("k1", 0, 3)]
    assert rows(K.unique(df, ["b"])) == rows(df.dropna(subset=["b"]).groupBy("b").count().where("count > 1"))


def test_reachability_keeps_its_rounds_as_tables(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c")], "src string, dst string")
    found = reachability(edges, spark.createDataFrame([("a",)], "node string"))
    assert {f.split("/")[-2].rsplit("-", 1)[0] for f in found.inputFiles()} == {"reached", "names"}
    assert rows(found) == [("a", "a", 0), ("a", "b", 1), ("a", "c", 2)]


def test_names_get_their_numbers_without_a_join(spark, monkeypatch):
    from portloom.operators import closure

    edges = spark.createDataFrame([("a", "bb"), ("bb", "cc"), ("cc", "d"), ("d", "bb"), ("a", None), ("x", "y")], "src string, dst string")
    seeds = spark.createDataFrame([("a",), ("q",), (None,)], "node string")
    want = [("a", "a", 0), ("a", "bb", 1), ("a", "cc", 2), ("a", "d", 3), ("q", "q", 0)]
    joined = []
    monkeypatch.setattr(closure, "_numbered", lambda df, *rest, f=closure._numbered: joined.append(1) or f(df, *rest))
    assert rows(reachability(edges, seeds)) == want and not joined
    monkeypatch.setattr(closure, "_digest", F.length)  # names that share a digest are told apart all the same
    assert rows(reachability(edges, seeds)) == want and len(joined) == 3


def test_stored_leaves_the_session_as_it_was(spark):
    before = spark.conf.get(CLEANUP_CONF, None)
    df = spark.range(5).selectExpr("id % 2 AS k", "id").groupBy("k").count()
    assert sorted(map(tuple, stored(df, "small").collect())) == [(0, 3), (1, 2)]
    assert sorted(map(tuple, df.collect())) == [(0, 3), (1, 2)]
    assert spark.conf.get(CLEANUP_CONF, None) == before
