from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from portloom.operators import history as H
from portloom.operators.pick import latest_version, precedence_dedup, representative
from portloom.operators.skew import Sliced, skew_join

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def log(spark):
    """One user holds most rows, at uneven times; ties in the second occur."""
    data = [(1, START + timedelta(minutes=(i * i) % 977, microseconds=i), "abc"[(i * 7 // 5) % 3], float(i % 4)) for i in range(300)]
    data += [(u, START + timedelta(hours=u + i), "ab"[i % 2 if u % 2 else 0], 1.0) for u in range(2, 12) for i in range(4)]
    return spark.createDataFrame(data, "u long, ts timestamp_ntz, kind string, v double").cache()


def python_groups(log):
    out = {}
    for r in sorted(log.collect(), key=lambda r: (r.u, r.ts)):
        out.setdefault(r.u, []).append(r)
    return out


@pytest.mark.parametrize("slice_rows", [3, 20, 1_000_000])
def test_change_flags_match_brute_force(log, slice_rows):
    got = rows(
        H.change_flags(log, ["u"], ["ts"], ["kind"], ["v"], rows_per_slice=slice_rows),
        "u", "ts", "prev_kind", "is_kind_changed", "v_delta",
    )
    want = []
    for u, group in python_groups(log).items():
        for i, r in enumerate(group):
            p = group[i - 1] if i else None
            want.append((u, r.ts, p and p.kind, p is not None and p.kind != r.kind, p and r.v - p.v))
    assert got == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("slice_rows", [3, 20, 1_000_000])
def test_scd2_neither_gaps_nor_overlaps(log, slice_rows):
    got = {}
    for r in H.scd2(log, ["u"], ["ts"], ["kind"], slice_rows).orderBy("u", "valid_from").collect():
        got.setdefault(r.u, []).append(r)
    for u, group in python_groups(log).items():
        spans = got[u]
        assert spans[0].valid_from == group[0].ts
        assert [s.is_current for s in spans] == [False] * (len(spans) - 1) + [True]
        for a, b in zip(spans, spans[1:]):
            assert a.valid_to == b.valid_from and a.kind != b.kind
        for r in group:
            inside = [s for s in spans if s.valid_from <= r.ts and (s.valid_to is None or r.ts < s.valid_to)]
            assert [s.kind for s in inside] == [r.kind]


@pytest.mark.parametrize("slice_rows", [3, 1_000_000])
def test_transitions_keep_only_changes(log, slice_rows):
    got = H.transitions(log, ["u"], ["ts"], ["kind"], rows_per_slice=slice_rows)
    want = sum(a.kind != b.kind for g in python_groups(log).values() for a, b in zip(g, g[1:]))
    assert got.count() == want
    first = H.transitions(log, ["u"], ["ts"], ["kind"], keep_first=True, rows_per_slice=slice_rows)
    assert first.count() == want + len(python_groups(log))


@pytest.mark.parametrize("slice_rows", [2, 25, 1_000_000])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_point_in_time_join(spark, slice_rows, how):
    hist = [(k, START + timedelta(hours=10 * i), START + timedelta(hours=10 * i + (10 if i % 3 else 6)), f"{k}-{i}")
            for k in (1, 2) for i in range(20)]
    fact = [(k, i, START + timedelta(hours=i - 5)) for k in (1, 2, 3) for i in range(0, 230, 1 if k == 1 else 29)]
    got = H.point_in_time_join(
        spark.createDataFrame(fact, "k int, n int, at timestamp_ntz"),
        spark.createDataFrame(hist, "k int, valid_from timestamp_ntz, valid_to timestamp_ntz, label string"),
        ["k"], "at", ["label"], how=how, rows_per_slice=slice_rows,
    )
    want = []
    for k, n, at in fact:
        hit = [h[3] for h in hist if h[0] == k and h[1] <= at < h[2]]
        if hit or how == "left":
            want.append((k, n, at, hit[0] if hit else None))
    assert rows(got) == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("slice_rows", [1, 4, 1_000_000])
def test_skew_join_equals_plain_join(spark, how, slice_rows):
    left = [(1, i) for i in range(30)] + [(k, k) for k in range(2, 9)] + [(None, 5), (None, 6)]
    right = ([(1, -i) for i in range(12)] if how == "inner" else [(1, -1)]) + [(k, -k) for k in range(5, 12)] + [(None, 7)]
    a, b = spark.createDataFrame(left, "k int, x int"), spark.createDataFrame(right, "k int, y int")
    assert rows(skew_join(a, b, ["k"], how, slice_rows)) == rows(a.join(b, ["k"], how))


def test_latest_version_orders_text_versions_as_numbers(spark):
    data = [("a", "2024-01-01", "9", 1), ("a", "2024-01-01", "10", 2), ("a", None, "99", 3), ("b", "2024-01-01", "x", 4), ("b", "2024-01-01", "1", 5)]
    df = spark.createDataFrame(data, "k string, m string, v string, id int")
    assert rows(latest_version(df, ["k"], "m", "v"), "k", "id") == [("a", 2), ("b", 5)]
    assert rows(latest_version(df, ["k"], "m", "v", null_modified_wins=True), "k", "id") == [("a", 3), ("b", 5)]


def test_precedence_and_representative(spark):
    df = spark.createDataFrame([("c", 2, "x"), ("c", 1, "z"), ("c", 1, "y"), ("d", None, "q")], "code string, p int, o string")
    assert rows(precedence_dedup(df, "code", "p", ["o"]), "code", "o") == [("c", "y"), ("d", "q")]
    votes = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (1, None), (1, None), (2, "z")], "k int, v string")
    assert rows(representative(votes, ["k"], "v"), "k", "v", "n_rows") == [(1, "a", 1), (2, "z", 1)]


def test_accumulating_snapshot(spark):
    df = spark.createDataFrame(
        [(1, "a", START), (1, "a", START - timedelta(days=1)), (1, "b", START), (2, "b", START)],
        "id int, stage string, ts timestamp_ntz",
    )
    got = rows(H.accumulating_snapshot(df, ["id"], "stage", "ts", ["a", "b"]))
    assert got == [(1, START - timedelta(days=1), START), (2, None, START)]


def test_hot_key_with_timestamps_of_a_zone(log):
    zoned = log.withColumn("ts", F.col("ts").cast("timestamp"))
    cut = H.scd2(zoned, ["u"], ["ts"], ["kind"], 10)
    assert rows(cut) == rows(H.scd2(zoned, ["u"], ["ts"], ["kind"]))


def test_slices_are_cut_by_count(spark):
    """Outlier dates, one-second bursts, text order and a null key: no slice above twice its size."""
    per = 100
    minute = "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, {})"
    even = spark.range(3000).selectExpr("cast(id % 2 as string) AS k", f"{minute.format('id')} AS at", "id")
    ends = spark.sql("SELECT '0' AS k, timestamp_ntz'1900-01-01 00:00:00' AS at, -1L AS id UNION ALL SELECT '0', timestamp_ntz'9999-01-01 00:00:00', -2L")
    burst = spark.range(1000).selectExpr("'b' AS k", f"{minute.format('7')} AS at", "id")
    lost = spark.range(1000).selectExpr("CAST(NULL AS string) AS k", f"{minute.format('id')} AS at", "id")
    df = even.unionAll(ends).unionAll(burst).unionAll(lost)
    for order in (["at", "id"], ["text", "id"]):
        cut = Sliced(df.withColumn("text", F.concat(F.lit("x"), F.col("at").cast("string"))), ["k"], order, per)
        sizes = cut.rows.groupBy("k", "_slice").count()
        assert sizes.agg(F.max("count")).first()[0] <= 2 * per
        assert sizes.where("k IS NULL").count() >= 5 and sizes.where("k = 'b'").count() >= 5
        apart = cut.rows.withColumn("before", F.lag("_slice").over(Window.partitionBy("k").orderBy(*order)))
        assert apart.where("_slice < before").count() == 0


def test_null_keys_carry_over_cuts(spark):
    df = spark.range(50).selectExpr("CAST(NULL AS string) AS k", "id AS t", "id div 20 AS v")
    want = [(None, 0, 0, 20, False), (None, 1, 20, 40, False), (None, 2, 40, None, True)]
    assert rows(H.scd2(df, ["k"], ["t"], ["v"], 4)) == rows(H.scd2(df, ["k"], ["t"], ["v"])) == want


def test_point_in_time_does_not_depend_on_input_order(spark):
    log = [(1, 10, 1, "a"), (1, 20, 2, "b"), (1, 20, 3, "c"), (1, 20, 4, "a"), (1, 30, 5, "d"), (1, 30, 6, "e")]
    facts = spark.createDataFrame([(1, t) for t in (5, 10, 15, 20, 25, 30, 35)], "u int, at int")
    want = [(1, 10, "a"), (1, 15, "a"), (1, 20, "a"), (1, 25, "a"), (1, 30, "e"), (1, 35, "e"), (1, 5, None)]
    for given in (log, log[::-1]):
        for size in (2, 1_000_000):
            hist = H.scd2(spark.createDataFrame(given, "u int, ts int, n int, v string"), ["u"], ["ts", "n"], ["v"], size)
            assert rows(hist, "v", "valid_from", "valid_to") == [("a", 10, 30), ("e", 30, None)]
            assert rows(H.point_in_time_join(facts, hist, ["u"], "at", ["v"], rows_per_slice=size)) == want
    # intervals of no length that came from elsewhere are ignored in any order
    spans = [(1, "a", 0, 9), (1, "b", 9, 9), (1, "c", 9, None)]
    for given in (spans, spans[::-1]):
        hist = spark.createDataFrame(given, "u int, v string, valid_from int, valid_to int")
        assert rows(H.point_in_time_join(facts.where("at = 10"), hist, ["u"], "at", ["v"])) == [(1, 10, "c")]
