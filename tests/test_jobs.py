"""The whole jobs on a small folder of day files."""

import datetime
import glob
import random

import pytest
from conftest import day, rows_of
from pyspark.sql import functions as F

from flowgauge.models.estimators import linear
from flowgauge.plans.incremental import kept_flow, update_days
from flowgauge.plans.jobs import run_daily_forecast, run_profiles, run_rollup, run_slot_forecast
from flowgauge.sources.readers import read_flow, read_report

START, END = day("2019-01-01"), day("2019-01-15")
ABSENT = day("2019-01-09")


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    draw = random.Random(9)
    counts = {}
    for i in range((END - START).days + 1):
        date = START + datetime.timedelta(days=i)
        if date == ABSENT:
            continue
        lines = ["time,lineID,stationID,deviceID,status,userID,payType"]
        for n in range(300):
            station, status = draw.choice([10, 10, 10, 12, 90]), draw.choice([0, 1])
            time = f"{date} {draw.randrange(6, 22):02d}:{draw.randrange(60):02d}:{draw.randrange(60):02d}"
            lines.append(f"{time},{draw.choice('ABCD')},{station},{n},{status},u{n},1")
            counts[date, status] = counts.get((date, status), 0) + 1
        (folder / f"record_{date}.csv").write_text("\n".join(lines) + "\n")
    return str(folder), counts


@pytest.fixture(scope="module")
def flow(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("flow") / "table")
    missing = run_rollup(spark, raw[0], out, START, END)
    assert rows_of(missing) == [(ABSENT,)]
    return out


def test_rollup_job(spark, raw, flow):
    table = read_flow(spark, flow)
    assert table.count() == 3 * 15 * 144
    sums = table.groupBy("date").agg(F.sum("inNums").alias("i"), F.sum("outNums").alias("o")).collect()
    assert {(r["date"], s): n for r in sums for s, n in ((1, r["i"]), (0, r["o"])) if n} == raw[1]


def test_rollup_job_says_what_it_left_out(spark, raw, flow):
    audit = spark.read.parquet(f"{flow}/_audit").first()
    assert audit["rows"] == audit["counted"] == 14 * 300 and audit["other_status"] == 0
    assert spark.read.parquet(f"{flow}/_skipped").isEmpty()
    with pytest.raises(ValueError):
        run_rollup(spark, raw[0], flow, day("2018-01-01"), day("2018-01-02"))


def test_csv_from_rollup_to_report(spark, raw, flow, tmp_path):
    table, out = str(tmp_path / "flow"), str(tmp_path / "out")
    run_rollup(spark, raw[0], table, START, END, fmt="csv")
    run_daily_forecast(spark, table, out, START, END, horizon=4, candidates={"linear": linear}, fmt="csv")
    run_daily_forecast(spark, flow, f"{out}-parquet", START, END, horizon=4, candidates={"linear": linear})
    assert rows_of(read_report(spark, f"{out}/report")) == rows_of(read_report(spark, f"{out}-parquet/report"))
    run_slot_forecast(spark, table, f"{out}-slots", START, END, day("2019-01-26"), 5, candidates={"linear": linear}, fmt="csv", split="time")
    assert spark.read.parquet(f"{out}-slots/leaderboard").count() == 4


def test_profiles_job(spark, raw, tmp_path):
    out = str(tmp_path)
    run_profiles(spark, f"{raw[0]}/record_2019-01-02.csv", out)
    assert spark.read.parquet(f"{out}/audit").first()["rows"] == 300
    assert rows_of(spark.read.parquet(f"{out}/title")) == [("2019-01-02 (Wednesday)",)]
    assert rows_of(spark.read.parquet(f"{out}/unmapped_stations")) == [(90,)]
    assert rows_of(spark.read.parquet(f"{out}/unmapped_lines")) == [("D",)]
    assert len(glob.glob(f"{out}/stations/lineName=*")) == 3
    assert {r["n"] for r in spark.read.parquet(f"{out}/curves").groupBy("lineName").agg(F.count("*").alias("n")).collect()} == {300}


def test_slot_forecast_job(spark, flow, tmp_path):
    out = str(tmp_path)
    run_slot_forecast(spark, flow, out, START, END, day("2019-01-26"), 5, candidates={"linear": linear})
    files = glob.glob(f"{out}/forecast/*.csv")
    lines = [line for f in sorted(files) for line in open(f).read().splitlines()[1:]]
    # All five asked-for stations; two of them have a history.
    assert len(lines) == 5 * 5 * 144
    assert spark.read.parquet(f"{out}/without_history").count() == 3
    assert lines[0].startswith("10,2019-01-26 00:00:00,2019-01-26 00:10:00,")
    assert len(glob.glob(f"{out}/charts/stationID=*/date=*")) == 25
    assert spark.read.parquet(f"{out}/description").count() == 2
    assert spark.read.parquet(f"{out}/leaderboard").count() == 4


def test_daily_forecast_job(spark, flow, tmp_path):
    out = str(tmp_path)
    run_daily_forecast(spark, flow, out, START, END, horizon=4, candidates={"linear": linear})
    report = read_report(spark, f"{out}/report")
    assert report.count() == 15 + 4
    assert report.where("`数据类型` = '预测值'").count() == 4
    assert len(glob.glob(f"{out}/charts/isPrediction=*")) == 2


def test_a_day_with_only_skipped_files_is_missing(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "flow")
    raw.mkdir()
    (raw / "record_2019-01-01.csv").write_text("time,stationID,status\n2019-01-01 08:00:00,1,1\n")
    (raw / "record_2019-01-02.csv").write_text("to do\nbuy milk\n")
    (raw / "record_2019-01-03.csv.gz").write_bytes(b"this is no gzip")
    missing = run_rollup(spark, str(raw), out, day("2019-01-01"), day("2019-01-04"))
    assert rows_of(missing) == [(day("2019-01-02"),), (day("2019-01-03"),), (day("2019-01-04"),)]
    skipped = dict(rows_of(spark.read.parquet(f"{out}/_skipped")))
    assert set(skipped) == {"record_2019-01-02.csv", "record_2019-01-03.csv.gz"}


def files_of(folder):
    return {f: (glob.os.path.getmtime(f), glob.os.path.getsize(f)) for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)}


def test_days_one_by_one_give_what_all_at_once_give(spark, raw, flow, tmp_path):
    """A late day writes its own partition; a day run twice, a new station and a gap change no other."""
    out = str(tmp_path)
    late = day("2019-01-06")
    assert rows_of(update_days(spark, raw[0], out, START, late - datetime.timedelta(days=1))) == []
    assert rows_of(update_days(spark, raw[0], out, late + datetime.timedelta(days=1), END)) == [(ABSENT,)]
    before = files_of(out)
    update_days(spark, raw[0], out, late, late)
    after = files_of(out)
    assert {f.split("date=")[1][:10] for f in set(after) - set(before)} == {str(late)} and before.items() <= after.items()
    whole = read_flow(spark, flow).drop("date")
    assert rows_of(kept_flow(spark, out)) == rows_of(whole)
    update_days(spark, raw[0], out, late, late)
    update_days(spark, raw[0], out, START, END)
    assert rows_of(kept_flow(spark, out)) == rows_of(whole)


def test_a_replaced_day_and_swipes_past_midnight(spark, tmp_path):
    raw, out, head = tmp_path / "raw", str(tmp_path / "out"), "time,stationID,status\n"
    raw.mkdir()
    (raw / "record_2019-01-01.csv").write_text(f"{head}2019-01-01 23:59:00,1,1\n2019-01-02 00:05:00,1,1\n")
    (raw / "record_2019-01-02.csv").write_text(f"{head}2019-01-02 00:01:00,1,1\n2019-01-02 08:00:00,2,0\n")
    span = (day("2019-01-01"), day("2019-01-02"))
    update_days(spark, str(raw), out, *span)
    some = {(r["stationID"], str(r["startTime"])): (r["inNums"], r["outNums"]) for r in kept_flow(spark, out).where("inNums + outNums > 0").collect()}
    assert some == {(1, "2019-01-01 23:50:00"): (1, 0), (1, "2019-01-02 00:00:00"): (2, 0), (2, "2019-01-02 08:00:00"): (0, 1)}
    assert kept_flow(spark, out).count() == 2 * 2 * 144
    # The second day's file is replaced by one without a valid swipe; the first one breaks, so what is kept of it stays.
    (raw / "record_2019-01-02.csv").write_text(f"{head}2019-01-02 00:01:00,1,7\n")
    (raw / "record_2019-01-01.csv").write_text("nothing\n")
    assert rows_of(update_days(spark, str(raw), out, *span)) == [(day("2019-01-01"),)]
    left = kept_flow(spark, out).where("inNums + outNums > 0")
    assert [(str(r["startTime"]), r["inNums"]) for r in left.orderBy("startTime").collect()] == [("2019-01-01 23:50:00", 1), ("2019-01-02 00:00:00", 1)]
