"""Plans keep the shape that makes them scale."""

import re

import pytest

import __spark_entry__ as entry
from flowgauge.operators.sampling import with_test_flag
from flowgauge.plans.rollup import observed_flow, station_flow
from flowgauge.sources.events import event_swipes

FITTING = {"slot_leaderboard", "daily_leaderboard", "best_models", "forecast_slots", "forecast_recursive"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The adaptive plan after a run, subqueries included."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", sorted(set(entry.flow_queries()) - FITTING))
def test_no_cross_product_and_no_row_python(name, spark, small):
    plan = plan_of(entry.flow_queries()[name](spark, small))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_flow_reads_the_events_once_with_three_columns(spark, small):
    text = final_plan(station_flow(event_swipes(spark, small)))
    final = text.split("Initial Plan")[0]
    assert final.count("Scan parquet") == 1
    assert "ReusedExchange" in text
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", text)) == {"ts:timestamp_ntz,user_id:bigint,event_type:string"}


def test_limited_stations_are_filled_alone(spark, small):
    """Other stations are left out before their empty slots are made, by a list or by a table."""
    swipes = event_swipes(spark, small)
    table = spark.createDataFrame([(10,), (12,)], "stationID long")
    whole = station_flow(swipes).where("stationID in (10, 12)")
    for stations in ([10, 12], table):
        some = station_flow(swipes, stations=stations)
        assert some.exceptAll(whole).isEmpty() and whole.exceptAll(some).isEmpty()
        plan = plan_of(some)
        assert not any(word in plan[: plan.index("Generate")] for word in ("Join", "Filter"))


def test_scaled_features_make_the_dense_table_once(spark, small):
    plan = plan_of(entry.flow_queries()["scaled_features"](spark, small))
    assert "Generate" not in plan


def test_scaled_features_has_a_row_for_every_slot(spark, small):
    scaled = entry.flow_queries()["scaled_features"](spark, small)
    flow = station_flow(event_swipes(spark, small)).select("stationID", "startTime")
    slots = scaled.select("stationID", "startTime")
    assert slots.exceptAll(flow).isEmpty() and flow.exceptAll(slots).isEmpty()
    assert {kind for name, kind in scaled.dtypes if name.endswith("_z")} == {"double"}


def test_dense_rows_are_made_after_the_last_shuffle(spark, small):
    plan = plan_of(station_flow(event_swipes(spark, small)))
    assert plan.index("Generate") < plan.index("Exchange")
    assert "Join" not in plan


def test_counts_are_combined_before_the_shuffle(spark, small):
    plan = plan_of(observed_flow(event_swipes(spark, small)))
    assert plan.count("HashAggregate") >= 2 and plan.count("Exchange") == 1


def test_split_does_not_shuffle_the_table(spark):
    plan = plan_of(with_test_flag(spark.range(1000), ["id"]))
    top = plan.split("Subquery")[0]
    assert "Exchange" not in top and "Window" not in top


def test_split_makes_digests_once(spark):
    """Rows are written with their side; what is read again is a comparison for the few rows without one."""
    flagged = with_test_flag(spark.range(100_000), ["id"])
    text = final_plan(flagged)
    assert "Range (" not in text and "sides-" in text
    sided = spark.read.parquet(*flagged.inputFiles())
    assert 0 < sided.where("_test is null").count() < 5_000
