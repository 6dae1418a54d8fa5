"""Histories against plain versions: numbering, intersections and incremental upkeep."""

import random
from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from portloom.operators.history import scd2
from portloom.operators.intervals import intersect_histories
from portloom.operators.ordered import numbered
from portloom.sources.histories import RepeatedRows, apply_snapshots, read_history


def test_rows_are_numbered_over_all_tasks(spark):
    df = spark.createDataFrame([(i * 7919 % 1000, "x") for i in range(1000)], "a long, b string").repartition(9)
    found = numbered(df, [F.col("b"), F.col("a").desc()], "n").collect()
    assert {(r.a, r.n) for r in found} == {(a, 999 - a) for a in range(1000)}
    assert numbered(df.limit(0), [F.col("a")], "n").count() == 0


def naive_intersection(left, right):
    out = []
    for k, a, s, e in left:
        for j, b, t, u in right:
            if k != j or (s is not None and s == e) or (t is not None and t == u):
                continue
            start = max((x for x in (s, t) if x is not None), default=None)
            end = min((x for x in (e, u) if x is not None), default=None)
            if start is None or end is None or start < end:
                out.append((k, a, b, start, end, end is None))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_intervals_that_overlap_each_other(spark, seed):
    draw = random.Random(seed)

    def side(n):
        out = []
        for i in range(n):
            start = draw.choice([None, *range(20)]) if i % 5 == 0 else draw.randrange(20)
            end = draw.choice([None, 0 if start is None else start, 25]) if i % 4 == 0 else (start or 0) + draw.randrange(6)
            if start is not None and end is not None and end < start:
                end = start
            out.append((draw.choice([None, 1, 2]), i // 2, start, end))
        return out

    left, right = side(30), side(40)
    schema = "k long, {} long, valid_from int, valid_to int"
    found = intersect_histories(
        spark.createDataFrame(left, schema.format("a")), spark.createDataFrame(right, schema.format("b")), ["k"], ["a"], ["b"]
    )
    assert sorted((tuple(r) for r in found.collect()), key=str) == naive_intersection(left, right)


def test_intersection_of_plain_histories_has_no_more_rows_than_bounds(spark):
    left = [(1, i, i, i + 1) for i in range(300)]
    right = [(1, i, 3 * i, 3 * i + 3) for i in range(100)]
    schema = "k long, {} long, valid_from int, valid_to int"
    sides = spark.createDataFrame(left, schema.format("a")), spark.createDataFrame(right, schema.format("b"))
    found = intersect_histories(*sides, ["k"], ["a"], ["b"])
    assert found.count() == 300
    with pytest.raises(ValueError, match="both sides"):
        intersect_histories(sides[0], sides[0], ["k"], ["a"], ["a"])


DAY = date(2024, 1, 1)


def at(n):
    return DAY + timedelta(days=n)


def history_of(spark, facts):
    df = spark.createDataFrame([(k, at(d), *v) for (k, d), v in facts.items()], "k long, day date, a string, b double")
    return rows(scd2(df, ["k"], ["day"], ["a", "b"]))


@pytest.mark.parametrize("seed", range(2))
def test_days_in_any_order_give_the_history_of_all(spark, folder, seed):
    draw, path, facts = random.Random(seed), folder("history"), {}
    order = [[0, 1, 2], [4], [7], [3], [9], [5, 6], [8], [4]]  # late days, one of them between, one given again
    for days in order:
        batch = {}
        for d in days:
            for k in (None, 1, 2, 3, 4):
                if draw.random() < 0.75 or (k, d) in facts:
                    batch[k, d] = (draw.choice([None, "x", "y"]), draw.choice([None, 1.5]))
        facts |= batch
        schema = "k long, day date, a string, b double"
        frames = [spark.createDataFrame([(k, at(d), *v) for (k, d), v in f.items()], schema) for f in (batch, facts)]
        apply_snapshots(path, frames[0], ["k"], "day", ["a", "b"], observed=frames[1])
        assert rows(read_history(spark, path, ["k"], ["a", "b"])) == history_of(spark, facts)
    again = apply_snapshots(path, frames[0], ["k"], "day", ["a", "b"], observed=frames[1])
    assert (again.added, again.removed) == (0, 0)


def files(spark, path, part):
    found = spark.read.parquet(f"{path}/rows").where(F.col("_part").startswith(part))
    return {r[0] for r in found.select(F.col("_metadata.file_path")).distinct().collect()}


def test_a_new_day_leaves_closed_partitions_alone(spark, folder):
    path, schema = folder("history"), "k long, day date, a string"

    def day(n, values):
        return spark.createDataFrame([(k, at(n), v) for k, v in values.items()], schema)

    for n in range(3):
        apply_snapshots(path, day(n, {k: f"{k % 3 == 0 and n}" for k in range(30)}), ["k"], "day", ["a"])
    closed, opened = files(spark, path, "closed"), files(spark, path, "open")
    done = apply_snapshots(path, day(3, {k: "0" if k == 5 else f"{k % 3 == 0 and 2}" for k in range(30)}), ["k"], "day", ["a"])
    assert (done.added, done.removed) == (2, 1)
    assert closed < files(spark, path, "closed")
    assert len(opened - files(spark, path, "open")) <= 1  # the bucket of the key that changed
    with pytest.raises(ValueError, match="late"):
        apply_snapshots(path, day(1, {1: "z"}), ["k"], "day", ["a"])
    with pytest.raises(RepeatedRows):
        apply_snapshots(path, day(9, {1: "z"}).unionAll(day(9, {1: "y"})), ["k"], "day", ["a"])


def test_a_run_that_failed_between_its_writes_is_repeated(spark, folder, monkeypatch):
    from portloom.sources import histories

    path, schema = folder("history"), "k long, day date, a string"
    first, second = (spark.createDataFrame([(k, at(n), str(n)) for k in range(9)], schema) for n in (0, 1))
    apply_snapshots(path, first, ["k"], "day", ["a"])
    with monkeypatch.context() as broken:
        broken.setattr(histories, "replace_partitions", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            apply_snapshots(path, second, ["k"], "day", ["a"])
    apply_snapshots(path, second, ["k"], "day", ["a"])
    want = scd2(first.unionAll(second), ["k"], ["day"], ["a"])
    assert rows(read_history(spark, path, ["k"], ["a"])) == rows(want)


def test_intersection_reads_written_tables(spark):
    sides = [spark.createDataFrame([("k", n, 1, 5)], f"k string, {n} string, valid_from int, valid_to int") for n in "ab"]
    found = intersect_histories(*sides, ["k"], ["a"], ["b"])
    assert {f.split("/")[-2].rsplit("-", 1)[0] for f in found.inputFiles()} == {"placed"}
    assert [tuple(r) for r in found.collect()] == [("k", "a", "b", 1, 5, False)]
