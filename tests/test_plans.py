"""The physical plans that the scale of a job rests on."""

from conftest import rows
from fixture_ports import ORG_SCHEMA, PORT_SCHEMA, golden, org
from pyspark.sql import functions as F

from portloom.operators import history as H
from portloom.operators import quality as K
from portloom.operators.pick import latest_version
from portloom.plans import ports as P
from portloom.plans import topology as G


def final_plan(df):
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def log(spark, folder):
    spark.range(5000).selectExpr(
        "id % 50 AS u", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts",
        "id", "cast(id % 7 AS string) AS kind", "'unused' AS pad",
    ).write.parquet(folder("log"))
    return spark.read.parquet(folder("log"))


def test_intervals_of_calm_keys_cost_one_scan_and_one_shuffle(spark, folder):
    plan = final_plan(H.scd2(log(spark, folder), ["u"], ["ts", "id"], ["kind"]))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "pad" not in plan


def test_first_per_key_is_cut_down_before_the_shuffle(spark, folder):
    plan = final_plan(latest_version(log(spark, folder), ["u"], "ts", "kind", ["id"]))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")
    assert plan.count("WindowGroupLimit") == 2


def test_port_filters_reach_the_scan(spark, folder):
    spark.createDataFrame(golden(), PORT_SCHEMA).write.parquet(folder("ports"))
    cleaned = P.valid_ports(spark.read.parquet(folder("ports"))).where(F.col("seqp_type") == "PUMP").select("seqp_id")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = final_plan(cleaned)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(seqp_type,PUMP)" in plan and "seqp_port" not in plan and "seqp_model_code" not in plan


def test_organisation_is_shuffled_when_it_is_too_big_to_broadcast(spark):
    ports = P.valid_ports(spark.createDataFrame(golden(), PORT_SCHEMA))
    orgs = spark.createDataFrame(org("AX10", "BX20", "CX30"), ORG_SCHEMA)
    want = rows(G.edges(ports, orgs))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        assert "SortMergeJoin" in final_plan(G.org_enrich(ports, orgs))
        assert rows(G.edges(ports, orgs, 2)) == want
        assert len(rows(G.nodes(ports, orgs))) == 94
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_checks_shuffle_each_value_once(spark, folder):
    """Keys are not shuffled where no digests meet; counted values are matched with the parent where they are."""
    spark.range(900).selectExpr("concat('c', id) AS code", "concat('c', id % 7) AS a", "concat('x', id % 5) AS b").write.parquet(
        folder("codes")
    )
    codes = spark.read.parquet(folder("codes"))
    plan = final_plan(K.unique(codes, ["code"]))
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning(_digest" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        lost = K.relationships(codes, ["a", "b"], codes, "code")
        assert final_plan(lost).count("Exchange hashpartitioning") == 2
        assert sorted(map(tuple, lost.collect())) == [("b", f"x{i}", 180) for i in range(5)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
