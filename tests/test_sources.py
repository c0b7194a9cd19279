import bz2
import datetime
import functools
import glob
import gzip
import random
import zlib

import pytest
import zstandard
from conftest import at, day, rows_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from flowgauge.plans.profiles import line_station_profile
from flowgauge.plans.rollup import station_flow
from flowgauge.session import scratch_path
from flowgauge.sources.events import event_swipes
from flowgauge.sources.ledger import file_ledger
from flowgauge.sources.readers import read_days, read_flow, read_report, read_swipes, skipped_files
from flowgauge.sources.sinks import write_chart_feed, write_flow, write_forecast, write_report
from flowgauge.streaming.flow_stream import flow_stream, late_swipes, run_available, with_open_slots

REPORT = "`日期` string, `星期` string, `进站人数` string, `出站人数` string, `数据类型` string"


def write(path, name, text):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(text, encoding="utf-8")


def test_columns_are_found_by_name_and_bad_lines_kept(spark, tmp_path):
    write(
        tmp_path,
        "record_2019-01-02.csv",
        "time,userID,status,stationID,lineID\n"
        "2019-01-02 05:06:07,u1,1,10,A\n"
        "not a time,u2,0,11,B\n"
        "2019-01-02 05:06:08,u3,,x,C\n",
    )
    df = read_swipes(spark, str(tmp_path), keep_bad=True).cache()
    assert dict(df.dtypes)["time"] == "timestamp_ntz" and dict(df.dtypes)["userID"] == "string"
    got = {r["userID"]: r for r in df.collect()}
    assert got["u1"]["time"] == at("2019-01-02 05:06:07") and got["u1"]["_bad"] is None
    assert got["u2"]["time"] is None and got["u2"]["stationID"] == 11 and "not a time" in got["u2"]["_bad"]
    assert got["u3"]["stationID"] is None and got["u3"]["status"] is None
    df.unpersist()
    assert "_bad" not in read_swipes(spark, str(tmp_path)).columns


def test_days_come_from_file_names_and_only_those_files_are_read(spark, tmp_path):
    for d in (1, 2, 4):
        write(tmp_path, f"record_2019-01-{d:02d}.csv", f"time,stationID,status\n2019-01-{d:02d} 08:00:00,{d},1\n")
    df = read_days(spark, str(tmp_path), day("2019-01-02"), day("2019-01-31")).select("date", "stationID")
    assert rows_of(df) == [(day("2019-01-02"), 2), (day("2019-01-04"), 4)]
    # Read after the one run above: another run would reset the counter without listing files again.
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().get("numFiles").get().value() == 2


def test_a_folder_as_it_comes(spark, tmp_path):
    """Stray files, other column orders, files that can't be read: the good days are read, the others are listed."""
    write(tmp_path, "record_2019-01-01.csv", "time,stationID,status\n2019-01-01 08:00:00,1,1\n")
    write(tmp_path, "record_2019-01-02.csv", "status,lineID,stationID,time\n0,B,2,2019-01-02 08:00:00\n")
    write(tmp_path, "record_extra.csv", "time,stationID,status\n2019-01-01 08:00:00,9,1\n")
    write(tmp_path, "notes_2019-01-03.csv", "to do\nbuy milk\n")
    (tmp_path / "record_2019-01-04.csv.gz").write_bytes(b"this is no gzip")
    write(tmp_path, "record_2019-02-30.csv", "time,stationID,status\n2019-01-01 08:00:00,9,1\n")
    write(tmp_path, "record_2018-01-01.csv", "nothing\n")
    span = (day("2019-01-01"), day("2019-01-31"))
    got = read_days(spark, str(tmp_path), *span).select("date", "time", "lineID", "stationID", "status")
    assert rows_of(got) == sorted(
        [(day("2019-01-01"), at("2019-01-01 08:00:00"), None, 1, 1), (day("2019-01-02"), at("2019-01-02 08:00:00"), "B", 2, 0)], key=str
    )
    skipped = dict(rows_of(skipped_files(file_ledger(spark, str(tmp_path), *span))))
    assert set(skipped) == {"record_extra.csv", "notes_2019-01-03.csv", "record_2019-01-04.csv.gz", "record_2019-02-30.csv"}
    assert skipped["record_extra.csv"] == "no date in its path" and skipped["notes_2019-01-03.csv"].startswith("no column")
    assert skipped["record_2019-01-04.csv.gz"].startswith(("unreadable", "no column"))
    none = read_days(spark, str(tmp_path), day("2020-01-01"), day("2020-01-31"))
    assert none.isEmpty() and "date" in none.columns


def test_written_rows_are_in_order(spark):
    """Sorted sinks: files in the order of their numbers, and rows in the files."""
    flow = spark.range(500).selectExpr(
        "pmod(id * 7919, 10) AS stationID", "TIMESTAMP_NTZ'2019-01-26 00:00:00' + make_dt_interval(0, 0, pmod(id * 31, 500)) AS startTime",
        "TIMESTAMP_NTZ'2019-01-26 00:00:00' AS endTime", "1L AS inNums", "2L AS outNums",
    ).repartition(7)
    path = scratch_path(spark, "ordered")
    write_forecast(flow, path)
    lines = [line.split(",")[:2] for f in sorted(glob.glob(f"{path}/*.csv")) for line in open(f).read().splitlines()[1:]]
    assert len(lines) == 500 and lines == sorted(lines, key=lambda x: (int(x[0]), x[1]))


def test_profiles_are_in_order(spark, small):
    by_name = [(r["lineName"], r["station_order"]) for r in line_station_profile(event_swipes(spark, small)).collect()]
    by_id = [(r["lineName"], r["station_order"]) for r in line_station_profile(event_swipes(spark, small), order="by_id").collect()]
    assert by_name == sorted(by_name) and by_id == sorted(by_id) and len(by_name) > 5


def test_flow_from_csv(spark, small):
    flow = station_flow(event_swipes(spark, small))
    path = scratch_path(spark, "flow")
    write_flow(flow, path, "csv")
    again = read_flow(spark, path, day("2024-01-05"), day("2024-01-06"), fmt="csv")
    assert dict(again.dtypes)["startTime"] == "timestamp_ntz" and again.count() == 15 * 2 * 144
    assert read_flow(spark, path, fmt="csv").drop("date").exceptAll(flow).isEmpty()


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def __init__(self, **values):
            self.values = {k.replace("_", "."): v for k, v in values.items()}

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**values)

    with pytest.raises(RuntimeError):
        scratch_path(Session(spark_master="spark://host:7077"), "x")
    with pytest.raises(RuntimeError):
        scratch_path(Session(spark_master="local-cluster[2,1,1024]"), "x")
    shared = Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/"})
    assert scratch_path(shared, "x").startswith("hdfs:///shared/flowgauge/x-")


def test_flow_table_round_trip_prunes_days(spark, small):
    flow = station_flow(event_swipes(spark, small))
    path = scratch_path(spark, "flow")
    write_flow(flow, path)
    one = read_flow(spark, path, day("2024-01-05"), day("2024-01-06"))
    assert one.count() == 15 * 2 * 144
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert read_flow(spark, path).drop("date").exceptAll(flow).isEmpty()


def test_csv_export_has_text_times(spark):
    flow = spark.sql(
        "SELECT 1L AS stationID, TIMESTAMP_NTZ'2019-01-26 00:00:00' AS startTime,"
        " TIMESTAMP_NTZ'2019-01-26 00:10:00' AS endTime, 3L AS inNums, 4L AS outNums"
    )
    for name, writer in (("forecast", write_forecast), ("flow", lambda df, p: write_flow(df, p, "csv"))):
        path = scratch_path(spark, name)
        writer(flow, path)
        lines = [line for f in glob.glob(f"{path}/**/*.csv", recursive=True) for line in open(f)]
        assert lines == [
            "stationID,startTime,endTime,inNums,outNums\n",
            "1,2019-01-26 00:00:00,2019-01-26 00:10:00,3,4\n",
        ]


def test_report_file_is_one_csv_with_mark_and_quoted_counts(spark):
    rows = [("2019-01-02", "周三", "1,187,799", "1,188,663", "实际值"), ("2019-01-01", "周二", "1,270,547", "999", "实际值")]
    path = scratch_path(spark, "report")
    write_report(spark.createDataFrame(rows, REPORT).repartition(2), path)
    files = glob.glob(f"{path}/*.csv")
    assert len(files) == 1
    raw = open(files[0], "rb").read()
    assert raw.startswith(b"\xef\xbb\xbf")
    assert raw.decode("utf-8-sig").split("\n")[:2] == ["日期,星期,进站人数,出站人数,数据类型", '2019-01-01,周二,"1,270,547",999,实际值']
    back = read_report(spark, path)
    assert rows_of(back.select("日期", "inNums", "outNums")) == [("2019-01-01", 1270547, 999), ("2019-01-02", 1187799, 1188663)]


def test_chart_feed_has_one_folder_per_chart(spark):
    df = spark.createDataFrame([("a", day("2024-01-01"), 1), ("b", day("2024-01-02"), 2)], "k string, date date, v int")
    path = scratch_path(spark, "feed")
    write_chart_feed(df, path, ["k", "date"])
    assert len(glob.glob(f"{path}/k=*/date=*")) == 2


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert scratch_path(spark, "x").startswith(shared)


def test_stream_closes_slots_as_batch_counts_them_and_resumes(spark, tmp_path):
    base = datetime.datetime(2024, 1, 1)
    folder = tmp_path / "in"
    schema = "time timestamp_ntz, stationID long, lineID string, status int"

    def arrive(name, rows):
        data = [(base + datetime.timedelta(minutes=m), s, "A", st) for m, s, st in rows]
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(folder / name))

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(folder))
        run_available(flow_stream(stream), str(tmp_path / "out"), str(tmp_path / "progress"))
        return rows_of(spark.read.parquet(str(tmp_path / "out")))

    def slot(minute, *rest):
        start = base + datetime.timedelta(minutes=minute)
        return (rest[0], start, start + datetime.timedelta(minutes=10), *rest[1:])

    arrive("one", [(1, 1, 1), (2, 1, 0), (3, 1, 1), (4, 2, 2), (31, 1, 1)])
    assert run() == [slot(0, 1, 2, 1)]
    arrive("two", [(33, 1, 1), (70, 2, 1)])
    assert run() == sorted([slot(0, 1, 2, 1), slot(30, 1, 2, 0)], key=str)
    # The end of the stream: a swipe of the first slot comes too late; open slots come from the batch roll-up.
    arrive("three", [(4, 1, 1), (95, 1, 0)])
    closed = run()
    assert slot(0, 1, 2, 1) in closed and slot(90, 1, 0, 1) not in closed
    swipes = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(str(folder))
    written = spark.read.parquet(str(tmp_path / "out"))
    done = rows_of(with_open_slots(written, swipes))
    assert done == sorted([slot(0, 1, 2, 1), slot(30, 1, 2, 0), slot(70, 2, 1, 0), slot(90, 1, 0, 1)], key=str)
    assert rows_of(late_swipes(written, swipes)) == [(1, base, 1)]


def packed(kind, data):
    if kind == "gz":
        return gzip.compress(data)
    if kind == "bz2":
        return bz2.compress(data)
    if kind == "zst":
        return zstandard.ZstdCompressor().compress(data)
    return zlib.compress(data)


SPAN = (day("2019-01-01"), day("2019-01-31"))


def some_lines(n, d=1):
    rng = random.Random(n)
    return "".join(f"2019-01-{d:02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}:00,{rng.randrange(81)},{rng.randrange(2)}\n" for _ in range(n))


@pytest.mark.parametrize("kind", ["gz", "bz2", "zst", "deflate"])
def test_a_file_damaged_behind_its_first_lines_is_left_out_as_a_whole(spark, tmp_path, kind):
    """Cut off or broken in the middle: listed and passed over; other days are read, whole and streamed files too."""
    good = f"time,stationID,status\n{some_lines(5000)}".encode()
    data = packed(kind, good)
    write(tmp_path, "record_2019-01-01.csv", good.decode())
    for d, content in {2: data, 3: data[: len(data) // 2], 4: data[: len(data) // 2] + bytes(40) + data[len(data) // 2 + 40 :], 5: data[:-3]}.items():
        (tmp_path / f"record_2019-01-{d:02d}.csv.{kind}").write_bytes(content)
    if kind in ("gz", "bz2"):  # several streams in a row are one file
        (tmp_path / f"record_2019-01-06.csv.{kind}").write_bytes(packed(kind, good[:70_000]) + packed(kind, good[70_000:]))
    ledger = file_ledger(spark, str(tmp_path), *SPAN)
    found = {r["path"].rsplit("/", 1)[-1]: r for r in ledger.collect()}
    whole = {f for f, r in found.items() if not r["fault"]}
    broken = {f"record_2019-01-{d:02d}.csv.{kind}" for d in (3, 5)} | ({f"record_2019-01-04.csv.{kind}"} if kind != "zst" else set())
    assert set(found) - whole >= broken and {"record_2019-01-01.csv", f"record_2019-01-02.csv.{kind}"} <= whole
    assert all(found[f]["rows"] == 5000 and found[f]["header"] == ["time", "stationID", "status"] for f in whole if f[-3:] != "zst" or "-02" in f)
    assert found[f"record_2019-01-03.csv.{kind}"]["fault"].startswith("unreadable: ")
    if kind == "zst":
        return  # Spark reads it only where its Hadoop has the library
    counts = {r["date"].day: r["count"] for r in read_days(spark, str(tmp_path), *SPAN, ledger=ledger).groupBy("date").count().collect()}
    assert counts == dict.fromkeys([1, 2, 6] if kind in ("gz", "bz2") else [1, 2], 5000)
    assert {r["file"] for r in skipped_files(ledger).collect()} == broken


def test_the_number_of_jobs_does_not_grow_with_the_files(spark, tmp_path):
    context, jobs = spark.sparkContext, []
    for n in (80, 240):
        for i in range(n):
            write(tmp_path / str(n), f"a{i}_2019-01-{i % 28 + 1:02d}.csv", f"time,stationID,status\n{some_lines(3, i % 28 + 1)}")
            if i % 2:
                (tmp_path / str(n) / f"b{i}_2019-01-{i % 28 + 1:02d}.csv.gz").write_bytes(gzip.compress(b"time,status,stationID\n" + b"2019-01-01 00:00:00,1,2\n" * (i % 5)))
        context.setJobGroup(f"files-{n}", "")
        assert read_days(spark, str(tmp_path / str(n)), *SPAN).count() == 3 * n + sum(i % 5 for i in range(n) if i % 2)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"files-{n}")))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] < 15


def test_lines_of_a_large_file_are_counted_by_many_tasks(spark, tmp_path):
    """The header is the first line of the file, whatever task reads it; blank lines and marks before it don't count."""
    write(tmp_path, "record_2019-01-02.csv", f"\ufeff\n\ntime,stationID,status\n{some_lines(30_000, 2)}\n\n")
    write(tmp_path, "record_2019-01-03.csv", "")
    write(tmp_path, "record_2019-01-04.csv", 'time,"station,ID",,Time,stationID,status\r\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        found = {r["date"].day: r for r in file_ledger(spark, str(tmp_path), *SPAN).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found[2]["rows"] == 30_000 and found[2]["header"][1:] == ["stationID", "status"]
    assert found[3]["rows"] == 0 and found[3]["fault"] == "no column time, stationID, status"
    assert found[4]["rows"] == 0 and found[4]["header"] == ["time", "station,ID", "_c2", "Time3", "stationID", "status"] and not found[4]["fault"]


def test_errors_that_are_no_fault_of_a_file_end_the_read(spark, tmp_path):
    """A file that is gone by the time it is read."""
    write(tmp_path, "record_2019-01-01.csv", "time,stationID,status\n2019-01-01 08:00:00,1,1\n")
    ledger = file_ledger(spark, str(tmp_path), *SPAN)
    (tmp_path / "record_2019-01-01.csv").unlink()
    with pytest.raises(PySparkException):
        read_days(spark, str(tmp_path), *SPAN, ledger=ledger).collect()


def test_csv_tables_are_compressed_and_dealt_in_parts_that_fit_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("flowgauge.sources.sinks.ROWS_AT_ONCE", 1_000)
    start = F.timestamp_seconds(F.lit(1546300800) + F.col("id") % 288 * 600).cast("timestamp_ntz")
    flow = spark.range(28_800).select((F.col("id") / 288).cast("bigint").alias("stationID"), start.alias("startTime"))
    flow = flow.withColumn("endTime", F.col("startTime") + F.expr("INTERVAL '10' MINUTE"))
    flow = flow.withColumns({"inNums": F.lit(1).cast("bigint"), "outNums": F.lit(0).cast("bigint")})
    for name, writer in (("flow", functools.partial(write_flow, fmt="csv")), ("forecast", write_forecast)):
        path = str(tmp_path / name)
        writer(flow, path, compression="gzip")
        files = list((tmp_path / name).rglob("part-*"))
        assert len(files) >= 20 and sum(f.stat().st_size for f in files) < 20 * 28_800
        read = spark.read.option("header", True).csv(path)
        assert read.groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).first()[0] < 4_000
        back = read.select([F.col(c).cast(kind) for c, kind in flow.dtypes])
        assert back.exceptAll(flow).isEmpty() and flow.exceptAll(back).isEmpty()
