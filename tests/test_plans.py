"""Plan guards: what every registered query must (not) compile to."""

import pytest
from pyspark.sql import functions as F

from eventlake.operators import models as M
from eventlake.operators import parse as P
from eventlake.plans import queries as QQ
from eventlake.plans import stored

SF = "/root/testdata/sf0.001"
WRITES = set(stored.QUERIES) | {"dq_suite", "layer_counts"}  # these write when called
LAZY = sorted(set(QQ.QUERIES) - (WRITES - {"binary_messages"}))
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "BroadcastExchange", "FlatMapGroupsInPandas", "MapInPandas")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_no_broadcast(spark, name):
    plan = physical(QQ.QUERIES[name](spark, SF))
    for op in FORBIDDEN:
        assert op not in plan, (name, op)


def test_parse_has_no_shuffle_and_filter_stays_on_top(spark):
    msgs = spark.read.parquet(f"{SF}/events.parquet").select(F.col("props").alias("value"), "ts")
    plan = physical(P.valid_rows(P.parse(msgs, stamp=F.col("ts"))))
    # no exchange by default, whatever the number of splits; only a caller asks for one
    for parts in (1, 3, 64):
        df = spark.range(0, 100, 1, parts).select(F.lit("{}").alias("value"))
        assert "Exchange" not in physical(P.valid_rows(P.parse(df)))
        assert physical(P.parse(df, min_partitions=5)).count("RoundRobinPartitioning(5)") == 1
    assert "Exchange" not in plan
    # the routing filter reads the computed reason; it was not pushed into the scan side
    assert "Filter isnull(error" in plan
    assert plan.count("parseJson") == 2  # the element parse and the guarded member parse, once each
    # the counter that cuts the generated code in two sits between two fused stages
    assert plan.count("CollectMetrics decoded_") == 1


def test_gold_combines_before_the_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        b = QQ.bronze(spark, SF)
        agg = physical(M.dedup(M.silver(b), "aggregate"))
        win = physical(M.dedup(M.silver(b), "window"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "partial_min" in agg and agg.count("Exchange hashpartitioning(event_id") == 1
    assert win.count("WindowGroupLimit") == 2 and win.count("Exchange hashpartitioning(event_id") == 1


def test_scan_reads_only_needed_columns(spark):
    plan = physical(QQ.QUERIES["batch_rotation"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan
