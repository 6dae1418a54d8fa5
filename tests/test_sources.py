from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from portloom import session
from portloom.sources import control, jdbc, landing, loader, tables
from portloom.sources.layers import materialize
from portloom.sources.merge import KeyIndex, RepeatedKeys, merge_partitions
from portloom.sources.spec import SourceSpec, Split

CONF = session.CHECKPOINT_CONF
NOW = datetime(2024, 5, 1, 1, 0)
LATER = datetime(2024, 5, 1, 2, 0)


def spec(**kw):
    return SourceSpec(**{"name": "ports", "location": "src.ports", "expected_columns": ("a", "b"), **kw})


def test_spec_refuses_unknown_mode_and_bad_names():
    assert spec().columns == ("a", "b") and spec(select_columns=("a",)).columns == ("a",)
    for bad in ({"mode": "stream"}, {"name": "Ports"}, {"expected_columns": ("a; drop",)}, {"expected_columns": ()}):
        with pytest.raises(ValueError):
            spec(**bad)


def test_scan_pushes_filter_and_columns(spark, folder):
    spark.range(100).selectExpr("id as a", "id % 3 as b", "id as c").write.parquet(folder("src"))
    scan = landing.snapshot_scan(
        spark, spec(location=folder("src"), select_columns=("a",), filter="b = 1 AND a > 90")
    )
    assert rows(scan) == [(91,), (94,), (97,)]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(a,90)" in plan and "ReadSchema: struct<a:bigint,b:bigint>" in plan


def test_contract(spark, folder):
    df = spark.createDataFrame([(1, None), (2, "x")], "A int, extra string")
    assert rows(landing.check_contract(df, ["a", "b"])) == [
        ("a", "present", 2, 0), ("b", "missing", 2, None), ("extra", "unexpected", 2, 1),
    ]
    assert landing.enforce_contract(df, ["a"]) is df
    with pytest.raises(landing.ContractViolation, match="'b'"):
        landing.enforce_contract(df, ["a", "b"])


def test_bronze_is_text(spark):
    df = spark.createDataFrame([(1, 2.5, None)], "a int, b double, c date")
    out = landing.to_bronze(df, ["a", "b", "c"], F.lit(NOW))
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "string", "string", "timestamp"]
    assert rows(out, "a", "b", "c") == [("1", "2.5", None)]


def test_replace_is_idempotent_and_may_read_itself(spark, folder):
    path = folder("t")
    df = spark.range(10)
    assert tables.replace_table(df, path) == tables.Load(1, 10)
    assert tables.replace_table(df, path) == tables.Load(2, 10)
    assert tables.replace_table(tables.read_table(spark, path).where("id < 4"), path) == tables.Load(3, 4)
    assert tables.read_table(spark, path).count() == 4
    assert tables.read_table(spark, path, version=1).count() == 10
    with pytest.raises(LookupError):
        tables.read_table(spark, path, version=9)


def test_failed_or_empty_replace_keeps_the_table(spark, folder):
    path = folder("t")
    tables.replace_table(spark.range(3), path)
    with pytest.raises(tables.EmptySnapshot):
        tables.replace_table(spark.range(0), path)
    with pytest.raises(Exception, match="boom"):
        tables.replace_table(spark.range(5).select(F.raise_error(F.lit("boom")).cast("long").alias("id")), path)
    assert tables.read_table(spark, path).count() == 3
    assert tables.replace_table(spark.range(0), path, allow_empty=True).row_count == 0


def test_partition_and_window_publish(spark, folder):
    path = folder("p")
    df = spark.createDataFrame([(1, 2020), (2, 2021), (3, 2022)], "id int, y int")
    tables.publish(df, path, "y")
    tables.publish(df.where("y = 2021").withColumn("id", F.lit(9)), path, "y", F.col("y") == 2021)
    assert rows(spark.read.parquet(path), "id", "y") == [(1, 2020), (3, 2022), (9, 2021)]
    with pytest.raises(Exception, match="outside the publish window"):
        tables.publish(df, path, "y", F.col("y") == 2021)
    assert rows(spark.read.parquet(path), "id", "y") == [(1, 2020), (3, 2022), (9, 2021)]


def test_publish_leaves_no_stale_partition(spark, folder):
    path = folder("p")
    df = spark.createDataFrame([(1, 2020), (2, 2021), (3, 2022), (4, None)], "id int, y int")
    window = F.col("y").between(2021, 2022)
    tables.publish(df, path, "y")
    tables.publish(df.where("y = 2021"), path, "y", window)
    schema = "id int, y int"
    assert rows(spark.read.schema(schema).parquet(path)) == [(1, 2020), (2, 2021), (4, None)]
    for part in (None, window):
        with pytest.raises(tables.EmptySnapshot):
            tables.publish(df.limit(0), path, "y", part)
    assert spark.read.schema(schema).parquet(path).count() == 3
    assert tables.publish(df.limit(0), path, "y", window, allow_empty=True) == 0
    assert rows(spark.read.schema(schema).parquet(path)) == [(1, 2020), (4, None)]
    tables.publish(df.where("id = 3"), path, "y")
    assert rows(spark.read.schema(schema).parquet(path)) == [(3, 2022)]


def test_seed_types_are_declared(spark, folder):
    spark.createDataFrame([("007", "x")], "code string, name string").write.csv(folder("s"), header=True)
    assert rows(landing.load_seed(spark, folder("s"), "code string, name string")) == [("007", "x")]
    with pytest.raises(Exception):
        landing.load_seed(spark, folder("s"), "code string, label string").collect()


def test_upsert_sets_only_given_columns(spark):
    base = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "k int, x string, y string")
    delta = spark.createDataFrame([(2, None, 1), (2, "old", 0), (3, "n", 1)], "k int, x string, seq int")
    got = control.upsert(base, delta, ["k"], order_by=[F.col("seq").desc()])
    assert rows(got) == [(1, "a", "b"), (2, None, "d"), (3, "n", None)]
    again = control.upsert(got, delta, ["k"], order_by=[F.col("seq").desc()])
    assert rows(again) == rows(got)
    assert rows(control.upsert(base, delta.where("seq = 1"), ["k"], set_cols=[], insert=False)) == rows(base)


def test_watermark_and_audit(spark):
    marks = control.advance_watermark(spark.createDataFrame([], control.WATERMARK_SCHEMA), "s", "t", NOW, NOW)
    marks = control.advance_watermark(marks, "s", "t", now=LATER)
    assert rows(marks) == [("s", "t", NOW, LATER)]

    audit = spark.createDataFrame([], control.AUDIT_SCHEMA)
    audit = control.audit_start(audit, "d", NOW, "r1", NOW)
    audit = control.audit_finish(audit, "d", NOW, "success", 7, now=LATER)
    assert rows(audit) == [("d", NOW, "r1", "success", 7, NOW, LATER, None)]
    audit = control.audit_start(audit, "d", NOW, "r2", LATER)
    assert rows(audit) == [("d", NOW, "r2", "running", 7, LATER, None, None)]
    audit = control.audit_finish(audit, "d", NOW, "failed", detail="x" * 3000, now=LATER)
    assert rows(audit) == [("d", NOW, "r2", "failed", None, LATER, LATER, "x" * 2000)]
    assert control.audit_finish(audit, "unknown", NOW, "success", 1).count() == 1


def test_folded_audit_equals_one_by_one(spark):
    said = [
        ("d", "finish", "-", "success", 1, None), ("d", "start", "r1", "-", None, None),
        ("d", "finish", "-", "failed", None, "y" * 2500), ("d", "start", "r2", "-", None, None),
        ("e", "start", "q1", "-", None, None), ("e", "finish", "-", "success", 5, None),
        ("e", "start", "q2", "-", None, None), ("f", "finish", "-", "success", 5, None),
    ]
    audit = spark.createDataFrame([], control.AUDIT_SCHEMA)
    log = []
    for n, (dag, kind, run, status, count, detail) in enumerate(said):
        at = datetime(2024, 5, 1, n)
        log.append((dag, NOW, kind, run, status, count, at, detail))
        if kind == "start":
            audit = control.audit_start(audit, dag, NOW, run, at)
        else:
            audit = control.audit_finish(audit, dag, NOW, status, count, detail, at)
    messages = spark.createDataFrame(
        log, "dag_id string, logical_date timestamp, kind string, run_id string, status string, row_count long, at timestamp, detail string"
    )
    assert rows(control.fold_audit(messages, ["at"])) == rows(audit)


def test_incremental_load_is_idempotent(spark):
    schema = "id int, ts timestamp_ntz, v string"
    day = lambda n: datetime(2024, 1, n)
    target = spark.createDataFrame([(1, day(1), "a"), (2, day(10), "b")], schema)
    source = spark.createDataFrame(
        [(1, day(1), "ignored"), (2, day(10), "B"), (3, day(9), "late"), (4, day(2), "too late"), (5, day(12), "new")], schema
    )
    got = control.incremental_load(source, target, "ts", ["id"], "3 DAYS")
    assert rows(got, "id", "v") == [(1, "a"), (2, "B"), (3, "late"), (5, "new")]
    assert rows(control.incremental_load(source, got, "ts", ["id"], "3 DAYS")) == rows(got)
    assert control.incremental_load(source, target.limit(0), "ts", ["id"], "3 DAYS").count() == 5


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_incremental_bound_reaches_the_scan(spark, folder, zone, kind):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        hours = F.expr("timestamp_ntz'2024-01-01 00:30:00' + make_dt_interval(0, int(id))").cast(kind)
        path = folder("src")
        spark.range(100).select("id", hours.alias("ts")).write.parquet(path)
        source = spark.read.parquet(path)
        got = control.incremental_load(source, source.where("id <= 50 AND id % 2 = 0"), "ts", ["id"], "10 HOURS")
        want = sorted({i for i in range(0, 51, 2)} | set(range(41, 100)))
        assert [r[0] for r in rows(got.orderBy("id"), "id")] == sorted(want, key=str)
        assert "GreaterThan(ts," in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_jdbc_options():
    s = spec(format="jdbc", filter="b = 'x'", options={"url": "jdbc:x", "user": "u"})
    plain = jdbc.extract_options(s)
    assert plain == {"fetchsize": "10000", "url": "jdbc:x", "user": "u", "dbtable": "(SELECT a, b FROM src.ports WHERE b = 'x') src"}
    split = jdbc.extract_options(s, "a", 0, 1000, 16)
    assert split["partitionColumn"] == "a" and split["numPartitions"] == "16" and split["upperBound"] == "1000"
    for bad in (("a",), ("a", 0, 1), ("zz", 0, 1, 2)):
        with pytest.raises(ValueError):
            jdbc.extract_options(s, *bad)


def test_loader_reads_a_database_in_ranges(monkeypatch):
    s = spec(format="jdbc", location="src.ports", split=Split("a", 0, 1000, 16), options={"url": "jdbc:x"})
    seen = {}

    class Reader:
        def format(self, kind):
            seen["format"] = kind
            return self

        def options(self, **given):
            seen.update(given)
            return self

        def load(self):
            return "frame"

    class Session:
        read = Reader()

    assert landing.read_source(Session(), s) == "frame"
    assert seen == {
        "format": "jdbc", "fetchsize": "10000", "dbtable": "src.ports", "url": "jdbc:x",
        "partitionColumn": "a", "lowerBound": "0", "upperBound": "1000", "numPartitions": "16",
    }
    for bad in ({"split": Split("a", 0, 1, 2)}, {"format": "jdbc", "split": Split("zz", 0, 1, 2)}, {"target": "../x"}):
        with pytest.raises(ValueError):
            spec(**bad)


class FakeSession:
    def __init__(self, named, master):
        self.conf, self.sparkContext, self.master, self.dir = {CONF: named} if named else {}, self, master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, folder):
        self.dir = folder


def test_shared_folder_follows_the_session():
    assert session.workspace(FakeSession("s3a://shared/x/", "yarn"), "t").startswith("s3a://shared/x/t-")
    with pytest.raises(RuntimeError, match="shared folder"):
        session.shared_folder(FakeSession(None, "yarn"))
    alone = FakeSession(None, "local[2]")
    assert session.shared_folder(alone) == session.shared_folder(alone)


def test_load_snapshot_end_to_end(spark, folder):
    root, src = folder("wh"), folder("src")
    spark.range(5).selectExpr("id as a", "id as b").write.parquet(src)
    s = spec(location=src, target="brz.ports", filter="b > 1")
    assert loader.load_snapshot(spark, s, root, "d", NOW, "r1").row_count == 3
    empty = spec(location=src, target="brz.ports", filter="b > 100")
    with pytest.raises(tables.EmptySnapshot):
        loader.load_snapshot(spark, empty, root, "d", LATER, "r2")
    broken = spec(location=src, target="brz.ports", expected_columns=("a", "zz"))
    with pytest.raises(landing.ContractViolation):
        loader.load_snapshot(spark, broken, root, "d", LATER, "r3")
    assert tables.read_table(spark, f"{root}/brz/ports").count() == 3
    audit = tables.read_table(spark, f"{root}/ctl/job_audit")
    assert rows(audit, "logical_date", "run_id", "status", "row_count") == [
        (NOW, "r1", "success", 3), (LATER, "r3", "failed", None),
    ]
    assert "zz" in audit.where("status = 'failed'").first().detail
    assert rows(tables.read_table(spark, f"{root}/ctl/watermark"), "source_name", "table_name") == [("ports", "brz.ports")]


def test_layers(spark, folder):
    view = materialize(spark.range(3), "cleaned", "slv")
    assert view.count() == 3 and spark.catalog.tableExists("slv_cleaned")
    assert materialize(spark.range(4), "mart", "gld", folder("wh")).count() == 4
    with pytest.raises(ValueError):
        materialize(spark.range(1), "x", "platinum")


def test_messages_are_written_by_the_configured_format(spark, folder):
    from portloom.functions.text import send_messages

    send_messages(spark.range(2).selectExpr("id", "'x' as v"), ["id", "v"], {"path": folder("bus")}, fmt="parquet")
    assert rows(spark.read.parquet(folder("bus"))) == [("0|x", '{"id":0,"v":"x"}'), ("1|x", '{"id":1,"v":"x"}')]


def part_files(folder):
    from pathlib import Path

    return {p.parent.name: p.name for p in Path(folder).rglob("*.parquet")}


def test_merge_rewrites_only_touched_partitions(spark, folder):
    path = folder("m")
    schema = "id int, v string, p string"
    merge_partitions(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], schema).coalesce(1), path, ["id"], "p")
    before = part_files(path)
    delta = spark.createDataFrame([(2, "B", "y"), (2, "old", "y"), (3, "c", "y"), (4, "d", "z")], schema)
    merge_partitions(delta, path, ["id"], "p", order_by=[F.col("v")])
    assert rows(spark.read.parquet(path), "id", "v", "p") == [(1, "a", "x"), (2, "B", "y"), (3, "c", "y"), (4, "d", "z")]
    after = part_files(path)
    assert after["p=x"] == before["p=x"] and after["p=y"] != before["p=y"]
    assert merge_partitions(delta.limit(0), path, ["id"], "p") == 0


def test_merge_keeps_null_partitions_and_refuses_repeated_keys(spark, folder):
    path, schema = folder("m"), "id int, v string, p string"
    merge_partitions(spark.createDataFrame([(1, "a", None), (2, "b", "y")], schema), path, ["id"], "p")
    assert merge_partitions(spark.createDataFrame([(3, "c", None)], schema), path, ["id"], "p") == 1
    assert rows(spark.read.schema(schema).parquet(path)) == [(1, "a", None), (2, "b", "y"), (3, "c", None)]
    with pytest.raises(RepeatedKeys):
        merge_partitions(spark.createDataFrame([(2, "x", "y"), (2, "z", "y")], schema), path, ["id"], "p")
    moved = spark.createDataFrame([(2, "B", "x"), (1, "A", "y")], schema)
    assert merge_partitions(moved, path, ["id"], "p", moving=True) == 2
    assert rows(spark.read.schema(schema).parquet(path)) == [(1, "A", "y"), (2, "B", "x"), (3, "c", None)]
    merge_partitions(spark.createDataFrame([(2, "again", "w")], schema), path, ["id"], "p", moving=True)
    assert rows(spark.read.schema(schema).parquet(path)) == [(1, "A", "y"), (2, "again", "w"), (3, "c", None)]


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def test_load_incremental_end_to_end(spark, folder, zone):
    root, src = folder("wh"), folder("src")
    s = SourceSpec("log", src, ("id", "at", "v"), target="brz.log", mode="watermark")
    day = lambda n: datetime(2024, 1, n)

    def load(run, data):
        spark.createDataFrame(data, "id int, at timestamp_ntz, v string").write.mode("overwrite").parquet(src)
        return loader.load_incremental(spark, s, root, "at", ["id"], "3 DAYS", "d", day(run), f"r{run}")

    first = [(1, day(1), "a"), (2, day(9), "b"), (3, day(10), "c")]
    later = [(1, day(1), "ignored"), (2, day(9), "B"), (3, day(10), "c"), (4, day(8), "late"), (5, day(2), "too late"), (6, day(12), "new")]
    load(10, first)
    assert load(12, later).row_count == 4
    want = [("1", "a"), ("2", "B"), ("3", "c"), ("4", "late"), ("6", "new")]
    assert rows(spark.read.parquet(f"{root}/brz/log"), "id", "v") == want
    load(12, later)
    assert rows(spark.read.parquet(f"{root}/brz/log"), "id", "v") == want
    assert load(12, [(2, day(11), "moved"), (7, None, "no time")]).row_count == 1
    moved = [("1", "a"), ("2", "moved"), ("3", "c"), ("4", "late"), ("6", "new")]
    assert rows(spark.read.parquet(f"{root}/brz/log"), "id", "v") == moved
    marks = tables.read_table(spark, f"{root}/ctl/watermark")
    assert rows(marks.select("source_name", "table_name", F.col("watermark_ts").cast("timestamp_ntz"))) == [
        ("log", "brz.log", day(12))
    ]
    with pytest.raises(ValueError):
        loader.load_snapshot(spark, s, root, "d", day(1), "r")


@pytest.mark.parametrize("moving", [False, True])
def test_a_repeated_batch_with_null_keys_changes_nothing(spark, folder, moving):
    path, schema = folder("m"), "id int, v string, p string"
    merge_partitions(spark.createDataFrame([(1, "a", "x"), (None, "n", "x")], schema), path, ["id"], "p", moving=moving)
    delta = spark.createDataFrame([(None, "N", "x"), (2, "b", None)], schema)
    for _ in range(2):
        merge_partitions(delta, path, ["id"], "p", moving=moving)
        assert rows(spark.read.schema(schema).parquet(path)) == [(None, "N", "x"), (1, "a", "x"), (2, "b", None)]
    with pytest.raises(RepeatedKeys):
        merge_partitions(spark.createDataFrame([(None, "y", "x"), (None, "z", "x")], schema), path, ["id"], "p", moving=moving)


def test_a_moving_key_is_found_in_its_bucket_of_the_index(spark, folder):
    path, schema = folder("m"), "id int, v string, p string"
    first = spark.range(400).selectExpr("cast(id as int) id", "'a' v", "concat('p', id % 20) p")
    merge_partitions(first, path, ["id"], "p", moving=True)
    index = KeyIndex(path, first.schema, ["id"], "p")
    before, table_before = part_files(index.path), part_files(path)
    moved = spark.createDataFrame([(7, "b", "p3"), (1000, "c", "p3")], schema)
    mine = index.entries(moved)
    plan = index.of_same_keys(mine)._jdf.queryExecution().executedPlan().toString()
    buckets = [r[0] for r in mine.select("_bucket").distinct().collect()]
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [_bucket" in plan
    for _ in range(2):
        merge_partitions(moved, path, ["id"], "p", moving=True)
        found = spark.read.schema(schema).parquet(path)
        assert found.count() == 401 and rows(found.where("id in (7, 1000)")) == [(1000, "c", "p3"), (7, "b", "p3")]
        assert rows(spark.read.parquet(index.path).where("id in (7, 1000)"), "id", "p") == [(1000, "p3"), (7, "p3")]
    after, table_after = part_files(index.path), part_files(path)
    changed = {b for b in after if after[b] != before.get(b)}
    assert changed <= {f"_bucket={b}" for b in buckets}
    assert {p for p in table_after if p[0] == "p" and table_after[p] != table_before[p]} == {"p=p3", "p=p7"}


def test_a_table_without_index_gets_one_and_plain_merges_keep_it(spark, folder):
    path, schema = folder("m"), "id int, v string, p string"
    merge_partitions(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], schema), path, ["id"], "p")
    merge_partitions(spark.createDataFrame([(1, "A", "y")], schema), path, ["id"], "p", moving=True)
    merge_partitions(spark.createDataFrame([(3, "c", "z")], schema), path, ["id"], "p")
    merge_partitions(spark.createDataFrame([(3, "C", "y")], schema), path, ["id"], "p", moving=True)
    assert rows(spark.read.schema(schema).parquet(path)) == [(1, "A", "y"), (2, "b", "y"), (3, "C", "y")]


def test_balanced_ranges_hold_every_row_once(spark):
    values = [None] * 7 + [5] * 400 + list(range(600)) + [10**12 + i for i in range(300)]
    df = spark.createDataFrame([(v, date(2024, 1, 1) + timedelta(days=i % 90)) for i, v in enumerate(values)], "k long, d date")
    for column, most in (("k", 520), ("d", 2 * 1307 / 8)):
        conditions = jdbc.range_predicates(column, jdbc.balanced_bounds(df, column, 8))
        met = [df.where(c).count() for c in conditions]
        assert sum(met) == 1307 and max(met) <= most and len(conditions) <= 8
    assert jdbc.range_predicates("k", []) == ["1 = 1"] and jdbc.balanced_bounds(df, "k", 1) == []
    assert jdbc.balanced_bounds(df.limit(0), "k", 8) == []
    assert jdbc.range_predicates("t", [date(2024, 1, 2), date(2024, 1, 5)]) == [
        "t < DATE '2024-01-02' OR t IS NULL", "t >= DATE '2024-01-02' AND t < DATE '2024-01-05'", "t >= DATE '2024-01-05'",
    ]
    with pytest.raises(ValueError, match="bound"):
        jdbc.range_predicates("k", ["x'; DROP"])
