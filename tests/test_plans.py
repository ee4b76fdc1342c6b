"""What the plans look like: shuffles, pushed filters, skew splitting, no slow operators."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tillstream.operators import sessions as S
from tillstream.plans import insights as I
from tillstream.plans import marts as M
from tillstream.plans import serving as V
from tillstream.plans import staging as G
from tillstream.sources import testbed as T
from verification.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
SLOW = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "PythonUDF")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan_of(df))


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_sessions_shuffle_cells_only(spark):
    events = G.stage_events(T.raw_events(spark, FOLDER))
    plan = S.summarize(events, S.SessionRule.elapsed(30), times_present=True)
    keys = exchanges(plan)
    assert len(keys) == 2
    assert "cell" in keys[0] or "cell" in keys[1]
    # The events are reduced before the first shuffle.
    text = plan_of(plan)
    assert text.rindex("partial_min(tick") > text.rindex("Exchange hashpartitioning")
    assert text.count("Window [") == 2


def test_hot_visitor_reaches_the_window_as_few_rows(spark):
    hot = spark.range(200_000).select(
        F.concat(F.lit("e"), "id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 1000)).alias("visitor_id"),
        F.lit("view").alias("event_type"),
        F.lit(None).cast("string").alias("item_id"),
        F.timestamp_seconds(F.col("id") % 7200).cast("timestamp_ntz").alias("event_ts"),
    )
    cells = S._cells(hot, S.SessionRule.elapsed(30))
    assert cells.where("visitor_id = 'hot'").count() <= 4
    assert S.summarize(hot, S.SessionRule.elapsed(30)).where("visitor_id = 'hot'").first().event_count == 66_667


def test_order_scan_reads_needed_columns_and_pushes_filters(spark):
    staging = T.staged(spark, FOLDER)
    orders = M.commerce_orders(M.orders_with_context(staging))
    trend = orders.groupBy("order_date").agg(F.sum("payment_value_brl"))
    text = trend._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "o_totalprice" not in text and "l_shipdate" not in text and "c_name" not in text
    assert "EqualTo(l_linestatus,F)" in text


def test_mart_filters_reach_the_files(spark, settings, tmp_path):
    settings(spark__sql__maxMetadataStringLength="1000")
    orders = M.commerce_orders(M.orders_with_context(T.staged(spark, FOLDER)))
    orders.write.parquet(str(tmp_path / "mart"))
    page = V.list_orders(spark.read.parquet(str(tmp_path / "mart")), status="delivered", start=date(1996, 1, 1))
    text = plan_of(page)
    assert "EqualTo(order_status,delivered)" in text and "GreaterThanOrEqual(order_date" in text
    assert "TakeOrderedAndProject" in text


@pytest.mark.parametrize("hot", ["customer_id", "order_id"])
def test_hot_keys_are_split(spark, settings, tmp_path, hot):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    staging = T.staged(spark, FOLDER)
    number = F.xxhash64("order_id")
    skewed = spark.range(40).crossJoin(staging.orders).withColumns(
        {
            "order_id": F.concat_ws("-", "order_id", "id") if hot != "order_id" else F.col("order_id"),
            hot: F.when(F.pmod(number, F.lit(2)) == 0, "7").otherwise(F.concat_ws("-", hot, "id")),
        }
    ).drop("id")
    skewed.repartition(8).write.parquet(str(tmp_path / "orders"))
    many = spark.read.parquet(str(tmp_path / "orders"))
    context = M.orders_with_context(G.Staging(**{**staging.__dict__, "orders": many}))
    assert len(context.collect()) == many.count()
    assert "skew=true" in plan_of(context)


def test_building_the_order_mart_starts_no_job(spark):
    spark.sparkContext.setJobGroup("build-orders", "")
    try:
        I.category_state_matrix(M.commerce_orders(M.orders_with_context(T.staged(spark, FOLDER))), ["ASIA", "EUROPE"])
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build-orders")
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description"):
            spark.sparkContext.setLocalProperty(name, None)


def test_join_strategy_follows_the_size_check(spark, settings):
    staging = T.staged(spark, FOLDER)
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(M.orders_with_context(staging).select("order_id", "avg_temperature_c", "brl_to_usd_fx_rate"))
    assert "avg_temperature_c" in plan
    assert not [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "order_date" in line]
    assert [line for line in plan.splitlines() if "SortMergeJoin" in line and "order_date" in line]


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_slow_operators(spark, name):
    if name.startswith("streaming"):
        pytest.skip("runs a stream to build its frame")
    text = plan_of(all_queries()[name](spark, FOLDER))
    assert not [word for word in SLOW if word in text]
