from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from portloom.streaming.arrivals import Arrivals
from portloom.streaming.partials import Measure, PartialMart, land_partitions
from portloom.streaming.tumbling import current_rows, drain, tumbling

START = datetime(2024, 1, 1)
SCHEMA = "ts timestamp_ntz, k string, v int"


def measures():
    return {"n": F.count(F.lit(1)), "s": F.sum("v")}


def samples(spark, start, stop):
    return spark.createDataFrame([(START + timedelta(seconds=17 * i), "ab"[i % 2], i) for i in range(start, stop)], SCHEMA)


def test_drained_stream_equals_batch_and_corrects_late_rows(spark, folder):
    landing, out, progress = folder("in"), folder("out"), folder("progress")

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(landing)
        drain(tumbling(stream, "ts", ["k"], measures(), watermark="20 minutes"), out, progress, ["window_start", "k"])

    samples(spark, 0, 100).where("v <> 60").write.mode("append").parquet(landing)
    run()
    samples(spark, 100, 200).write.mode("append").parquet(landing)
    samples(spark, 60, 61).write.mode("append").parquet(landing)
    run()
    run()
    batch = tumbling(samples(spark, 0, 200), "ts", ["k"], measures())
    assert rows(current_rows(spark, out, batch.schema)) == rows(batch)


def test_rows_later_than_the_lookback_are_dropped(spark, folder):
    landing, out, progress = folder("in"), folder("out"), folder("progress")
    for part in (samples(spark, 0, 200), samples(spark, 500, 600), samples(spark, 0, 1)):
        part.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(SCHEMA).parquet(landing)
        windows = tumbling(stream, "ts", ["k"], measures(), watermark="5 minutes")
        drain(windows, out, progress, ["window_start", "k"])
    first = current_rows(spark, out, windows.schema).where(F.col("window_start") == F.lit(START).cast("timestamp_ntz"))
    assert rows(first.where("k = 'a'"), "n") == [(9,)]


def test_refresh_waits_for_every_source(spark, folder):
    a, b = folder("a"), folder("b")
    spark.range(3).write.parquet(a)
    spark.range(0).write.parquet(b)
    schema = spark.range(1).schema
    state = Arrivals(spark, folder("root"), {"a": (a, schema), "b": (b, schema)})
    build = lambda bronze: bronze["a"].join(bronze["b"], "id")
    state.drain()
    assert state.waiting_for() == ["b"] and state.refresh(build, folder("mart")) is None
    spark.range(2).write.mode("append").parquet(b)
    state.drain()
    assert state.refresh(build, folder("mart")).row_count == 2
    assert state.waiting_for() == ["a", "b"]
    spark.range(5, 6).write.mode("append").parquet(a)
    state.drain()
    assert state.waiting_for() == ["b"]


def test_partials_read_stale_partitions_only(spark, folder):
    source, path = folder("source"), folder("partials")
    schema = "k string, v int, day int"

    def days(*rows_):
        return spark.createDataFrame(list(rows_), schema)

    land_partitions(days(("a", 1, 1), ("b", 5, 1), ("a", 2, 2), ("a", 9, 3), ("c", 7, 4)), source, "day")
    measures = {
        "n": Measure("count", F.lit(1)), "s": Measure("sum", F.col("v")),
        "low": Measure("min", F.col("v")), "top": Measure("max", F.col("v")),
    }
    mart = PartialMart(spark, path, source, days().schema, "day", {"k": F.col("k")}, measures)
    assert sorted(mart.refresh()) == [1, 2, 3, 4] and mart.refresh() == []
    assert rows(mart.read()) == [("a", 3, 12, 1, 9), ("b", 1, 5, 5, 5), ("c", 1, 7, 7, 7)]
    for file in Path(source).glob("day=1/*.parquet"):
        file.write_bytes(b"not parquet")  # whoever reads this partition again fails
    land_partitions(days(("a", 3, 3), ("b", 4, 3), ("c", 1, 5)), source, "day", withdrawn=[4])
    assert sorted(mart.refresh()) == [3, 4, 5]
    assert rows(mart.read()) == [("a", 3, 6, 1, 3), ("b", 2, 9, 4, 5), ("c", 1, 1, 1, 1)]
    with pytest.raises(ValueError, match="measures"):
        Measure("median", F.col("v"))
