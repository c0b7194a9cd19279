"""Forecasts from fitted models."""

from collections.abc import Callable, Hashable

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.numfns import clamp_zero, half_even
from flowgauge.functions.timefns import is_weekend, monday_weekday, week_number
from flowgauge.models.competition import DAY_TYPES, TARGETS, predict
from flowgauge.operators.features import calendar_features, slot_features
from flowgauge.operators.flow import union_all
from flowgauge.operators.rows import last_rows
from flowgauge.operators.series import slot_grid

Predictor = Callable[[DataFrame], DataFrame]


def forecast_slots(
    models: dict[Hashable, Transformer],
    stations: DataFrame,
    base: Column,
    days: int,
    station_columns: list[int],
    step: str = "10 minutes",
    day_types: list[str] | None = None,
    onehot: list[str] | None = None,
) -> DataFrame:
    """Entries and exits for every station and slot of ``days`` days from ``base`` on.

    All slots of a day type are scored together, by its entry model and then its exit model.
    Counts are rounded half to even and never negative. Both models of every day type must be
    there; ``day_types`` limits the forecast to some.
    """
    wanted = list(DAY_TYPES) if day_types is None else day_types
    missing = [(day_type, target) for day_type in wanted for target in TARGETS if (day_type, target) not in models]
    if missing:
        raise ValueError(f"no model for {missing}")
    grid = slot_features(slot_grid(stations, base, days, step), station_columns, onehot=onehot)
    parts = []
    for day_type, flag in ((name, DAY_TYPES[name]) for name in wanted):
        scored = grid.where(F.col("isWeekend") == flag)
        for target in TARGETS:
            scored = predict(scored, models[(day_type, target)], f"_{target}")
        parts.append(
            scored.select(
                "stationID",
                "startTime",
                "endTime",
                *[clamp_zero(half_even(f"_{target}")).alias(target) for target in TARGETS],
            )
        )
    return union_all(parts)


def model_predictor(models: dict[Hashable, Transformer]) -> Predictor:
    """Predictor for :func:`forecast_recursive` from a model of ``inNums`` and one of ``outNums``."""

    def apply(df: DataFrame) -> DataFrame:
        return predict(predict(df, models["inNums"], "_in"), models["outNums"], "_out")

    return apply


class LinearPredictor:
    """Lines of entries and exits from coefficients by feature name; the name ``""`` holds the intercept."""

    def __init__(self, entries: dict[str, float], exits: dict[str, float]):
        self.entries, self.exits = entries, exits

    @staticmethod
    def line(coefficients: dict[str, float], feature: Callable[[str], Column]) -> Column:
        total = F.lit(float(coefficients.get("", 0.0)))
        for name, value in coefficients.items():
            if name:
                total = total + F.lit(float(value)) * feature(name)
        return total

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.withColumns({"_in": self.line(self.entries, F.col), "_out": self.line(self.exits, F.col)})


def linear_predictor(entries: dict[str, float], exits: dict[str, float]) -> LinearPredictor:
    """Predictor from given coefficients by feature name; the name ``""`` holds the intercept."""
    return LinearPredictor(entries, exits)


def _mean(tail: Column | str) -> Column:
    total = F.aggregate(tail, F.lit(0).cast("bigint"), lambda a, v: a + v)
    return total.cast("double") / F.size(tail)


def _last_seven(tail: Column, value: Column) -> Column:
    return F.slice(F.concat(tail, F.array(value)), F.greatest(F.size(tail) - 5, F.lit(1)), 7)


def _folded_days(predictor: LinearPredictor, horizon: int, update: bool, clamp: bool) -> Column:
    """All forecast days of a series as an array, folded over the horizon from the columns of its state."""
    calendar = {
        "dayOfWeek": monday_weekday,
        "dayOfMonth": F.dayofmonth,
        "isWeekend": is_weekend,
        "week_number": week_number,
    }
    none = F.array().cast("array<struct<date:date,dayOfWeek:int,inNums:bigint,outNums:bigint>>")
    start = {"in": F.col("_now_in").cast("bigint"), "out": F.col("_now_out").cast("bigint"), "days": none}
    if update:
        start |= {"tail_in": F.col("_tail_in"), "tail_out": F.col("_tail_out")}

    def step(state: Column, number: Column) -> Column:
        date = F.date_add(F.col("_last"), number)

        def feature(name: str) -> Column:
            if name in calendar:
                return calendar[name](date)
            for side in ("in", "out"):
                if name == f"prev_day_{side}":
                    return state[side]
                if name == f"rolling_mean_{side}_7d":
                    return _mean(state[f"tail_{side}"]) if update else F.col(f"_mean_{side}")
            return F.col(name)

        def counted(coefficients: dict[str, float]) -> Column:
            value = half_even(predictor.line(coefficients, feature))
            return clamp_zero(value) if clamp else value

        def moved(now: Column) -> Column:
            day = F.struct(
                date.alias("date"), monday_weekday(date).cast("int").alias("dayOfWeek"), now["in"].alias("inNums"), now["out"].alias("outNums")
            )
            out = {"in": now["in"], "out": now["out"], "days": F.concat(state["days"], F.array(day))}
            if update:
                out |= {f"tail_{side}": _last_seven(state[f"tail_{side}"], now[side]) for side in ("in", "out")}
            return F.struct(*[c.alias(n) for n, c in out.items()])

        # The day's two numbers are computed once, as the one element of an array.
        both = F.struct(counted(predictor.entries).alias("in"), counted(predictor.exits).alias("out"))
        return F.transform(F.array(both), moved)[0]

    steps = F.sequence(F.lit(1), F.lit(horizon)) if horizon > 0 else F.array().cast("array<int>")
    return F.aggregate(steps, F.struct(*[c.alias(n) for n, c in start.items()]), step)["days"]


def forecast_recursive(
    daily: DataFrame,
    predictor: Predictor,
    horizon: int,
    keys: list[str] | None = None,
    roll: str = "frozen",
    clamp: bool = False,
) -> DataFrame:
    """Forecast ``horizon`` days after each series' last day, each from the day before it.

    A predicted day is the next day's lag. The seven-day means stay those of the last seven
    actual days with ``roll="frozen"``; ``roll="update"`` lets predictions enter them.

    Each series is reduced to one row that holds its last seven days. With a linear predictor a
    series' days are folded over the horizon within that row: the plan is the same for any horizon.
    With other predictors every step adds columns to that row, for all series at once. No step
    shuffles, collects or needs a checkpoint.
    """
    if roll not in ("frozen", "update"):
        raise ValueError("roll must be 'frozen' or 'update'")
    keys = keys or []
    days = F.sort_array(F.collect_list(F.struct("date", "inNums", "outNums")))
    state = (
        last_rows(daily.select(*keys, "date", "inNums", "outNums"), "date", 7, keys)
        .groupBy(*keys)
        .agg(F.max("date").alias("_last"), days.alias("_tail"))
        .where(F.col("_last").isNotNull())
        .select(
            *keys,
            "_last",
            F.element_at("_tail", -1)["inNums"].alias("_now_in"),
            F.element_at("_tail", -1)["outNums"].alias("_now_out"),
            F.col("_tail.inNums").alias("_tail_in"),
            F.col("_tail.outNums").alias("_tail_out"),
        )
    )

    state = state.withColumns({"_mean_in": _mean("_tail_in"), "_mean_out": _mean("_tail_out")})
    if isinstance(predictor, LinearPredictor):
        days = _folded_days(predictor, horizon, roll == "update", clamp)
        rows = state.select(*keys, F.explode(days).alias("_day"))
        return rows.select(*keys, "_day.*", F.lit(True).alias("isPrediction"))
    kept = state.columns
    steps = []
    for step in range(1, horizon + 1):
        features = calendar_features(state.withColumn("date", F.date_add("_last", step))).withColumns(
            {
                "prev_day_in": F.col("_now_in"),
                "prev_day_out": F.col("_now_out"),
                "rolling_mean_in_7d": F.col("_mean_in"),
                "rolling_mean_out_7d": F.col("_mean_out"),
            }
        )
        predicted = predictor(features).withColumns({"_in": half_even("_in"), "_out": half_even("_out")})
        if clamp:
            predicted = predicted.withColumns(
                {"_in": clamp_zero(F.col("_in")), "_out": clamp_zero(F.col("_out"))}
            )
        one_day = F.struct("date", "dayOfWeek", F.col("_in").alias("inNums"), F.col("_out").alias("outNums"))
        moved = {"_now_in": F.col("_in"), "_now_out": F.col("_out")}
        if roll == "update":
            for side in ("in", "out"):
                moved[f"_tail_{side}"] = _last_seven(F.col(f"_tail_{side}"), F.col(f"_{side}"))
        state = predicted.withColumn(f"_day_{step}", one_day).withColumns(moved)
        if roll == "update":
            state = state.withColumns({"_mean_in": _mean("_tail_in"), "_mean_out": _mean("_tail_out")})
        steps.append(f"_day_{step}")
        state = state.select(*kept, *steps)
    rows = state.select(*keys, F.explode(F.array(*steps)).alias("_day"))
    return rows.select(*keys, "_day.*", F.lit(True).alias("isPrediction"))
