"""Every query against its SQL counterpart on the small test tables."""

import pytest
from check_queries import differences, duck

import __spark_entry__ as entry

FITTED = {"slot_leaderboard", "daily_leaderboard", "best_models", "forecast_slots", "forecast_recursive", "support_vector_days"}
ORACLES = entry.flow_oracles()
QUERIES = entry.flow_queries()


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLES) == FITTED


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, small, con):
    ours = QUERIES[name](spark, small).toPandas()
    assert differences(ours, con.execute(ORACLES[name]).df()) == ""


def test_entry_is_dense(spark):
    df = entry.entry(spark)
    assert df.columns == ["stationID", "startTime", "endTime", "inNums", "outNums"]
    assert df.count() == 15 * 30 * 144


def test_every_forecast_slot_is_there_once(spark, small):
    rows = QUERIES["forecast_slots"](spark, small)
    assert rows.count() == rows.select("stationID", "startTime").distinct().count()
    stations = rows.select("stationID").distinct().count()
    assert stations > 0 and rows.count() == stations * 5 * 144
    assert rows.where("inNums < 0 or outNums < 0 or inNums is null or outNums is null").isEmpty()
