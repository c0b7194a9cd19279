"""From swipes to dense flow tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.operators.rows import for_stations, valid_swipes, with_direction_flags
from flowgauge.operators.series import flow_by_slot, gap_fill, with_slot_end


def observed_flow(
    swipes: DataFrame,
    step: str = "10 minutes",
    keys: list[str] | None = None,
    time: str = "time",
    status: str = "status",
) -> DataFrame:
    """Entries and exits of the slots that have any."""
    return flow_by_slot(with_direction_flags(valid_swipes(swipes, status), status), step, keys, time)


def station_flow(
    swipes: DataFrame,
    step: str = "10 minutes",
    station: str = "stationID",
    time: str = "time",
    status: str = "status",
    bounds: str = "global",
    stations: list[int] | DataFrame | None = None,
) -> DataFrame:
    """Entries and exits per station and slot, with zero rows for empty slots.

    Swipes are taken as they are; cleaning is a step of its own. ``stations`` limits the result
    to some of them before empty slots are filled; the days are still those of all swipes.
    """
    observed = observed_flow(swipes, step, [station], time, status)
    only = None if stations is None else lambda df: for_stations(df, stations, station)
    dense = gap_fill(observed, [station], "startTime", step, ["inNums", "outNums"], bounds, only=only)
    return with_slot_end(dense, step).select(station, "startTime", "endTime", "inNums", "outNums")


def daily_flow(
    swipes: DataFrame, keys: list[str] | None = None, time: str = "time", status: str = "status"
) -> DataFrame:
    """Entries and exits per day straight from swipes; days without any count 0.

    Gives what ``daily_totals(station_flow(...))`` gives without making the dense slots.
    """
    keys = keys or []
    observed = observed_flow(swipes, "1 day", keys, time, status)
    dense = gap_fill(observed, keys, "startTime", "1 day", ["inNums", "outNums"])
    return dense.select(*keys, F.to_date("startTime").alias("date"), "inNums", "outNums")
