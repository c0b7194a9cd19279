"""Row numbers, windows over one long order, and the split near its due place."""

import math
import random

import pytest
from conftest import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowgauge.operators import sampling
from flowgauge.operators.features import daily_features
from flowgauge.operators.order import over_long_order, with_row_number
from flowgauge.operators.sampling import with_test_flag
from flowgauge.operators.series import rolling_mean


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_row_numbers_follow_the_order(spark, n):
    rng = random.Random(n)
    rows = [(rng.randrange(50) if i % 9 else None, i, rng.choice("ab")) for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "a int, b int, row_number string").repartition(6) if rows else spark.createDataFrame([], "a int, b int, row_number string")
    got = [(r["place"], r["a"], r["b"]) for r in with_row_number(df, ["a", F.col("b").desc()], "place").orderBy("place").collect()]
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, -r[1]))
    assert got == [(i + 1, a, b) for i, (a, b, _) in enumerate(want)]


@pytest.mark.parametrize("block", [1, 3, 8, 100])
@pytest.mark.parametrize("halo", [1, 2, 7])
def test_blocks_see_what_one_window_sees(spark, block, halo):
    df = spark.range(53).select((F.col("id") * 31 % 53).alias("o"), (F.col("id") % 11).alias("v")).repartition(5)

    def columns(w):
        return {"m": F.avg("v").over(w.rowsBetween(-halo, 0)), "l": F.lag("v", halo).over(w)}

    ours = over_long_order(df, ["o"], halo, columns, block)
    assert ours.columns == ["o", "v", "m", "l"]
    assert rows_of(ours) == rows_of(df.withColumns(columns(Window.orderBy("o"))))


def test_no_window_takes_all_rows_into_one_task(spark):
    daily = spark.range(40).select(F.expr("date_add(DATE'2024-01-01', CAST(id AS INT))").alias("date"), F.col("id").alias("inNums"), F.lit(1).cast("long").alias("outNums"))
    for df in (daily_features(daily), rolling_mean(daily, [], "date", "inNums", 3, "m")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        # The one keyless window runs over a total per range.
        assert plan.count("Window [") == plan.count("SinglePartition") + 1 <= 2 or "SinglePartition" not in plan.split("BroadcastExchange")[0]
    assert daily_features(daily.where("inNums < 0")).isEmpty()


@pytest.mark.parametrize("n, share", [(1, 0.2), (10, 0.0), (37, 1.0), (3000, 0.2), (3000, 0.731)])
def test_split_is_the_same_by_either_way(spark, n, share, monkeypatch):
    df = spark.range(n)
    near = rows_of(with_test_flag(df, ["id"], share))
    assert sum(flag for _, flag in near) == math.ceil(n * share)
    monkeypatch.setattr(sampling, "SPREADS", -1)  # nothing is near: digits are counted
    assert rows_of(with_test_flag(df, ["id"], share)) == near


def test_split_with_keys_that_repeat(spark):
    """Rows of one key are on one side; the rows up to the wanted one are test rows."""
    df = spark.range(1000).select((F.col("id") % 7).alias("k"))
    flagged = with_test_flag(df, ["k"], 0.2)
    sides = {(r["k"], r["is_test"]) for r in flagged.collect()}
    assert len(sides) == 7 and 200 <= flagged.where("is_test").count() <= 200 + 143
