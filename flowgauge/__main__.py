"""``python -m flowgauge <job> ...`` or the same under ``spark-submit``."""

import argparse
import datetime

from pyspark.sql import SparkSession

from flowgauge.plans.incremental import update_days
from flowgauge.plans.jobs import run_daily_forecast, run_profiles, run_rollup, run_slot_forecast


def main() -> None:
    parser = argparse.ArgumentParser(prog="flowgauge")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, dated: bool = True) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.add_argument("source")
        sub.add_argument("out")
        if dated:
            sub.add_argument("start", type=datetime.date.fromisoformat)
            sub.add_argument("end", type=datetime.date.fromisoformat)
        return sub

    rollup = job("rollup")
    rollup.add_argument("--step", default="10 minutes")
    rollup.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    update = job("update")
    update.add_argument("--step", default="10 minutes")
    job("profiles", dated=False)
    slots = job("slot-forecast")
    slots.add_argument("base", type=datetime.date.fromisoformat)
    slots.add_argument("--days", type=int, default=5)
    slots.add_argument("--stations", type=int, nargs="*")
    slots.add_argument("--split", default="random", choices=["random", "time"])
    slots.add_argument("--onehot", nargs="*", choices=["hour", "minute", "weekday"])
    daily = job("daily-forecast")
    daily.add_argument("--horizon", type=int, default=6)
    daily.add_argument("--roll", default="frozen", choices=["frozen", "update"])
    for sub in (slots, daily):
        sub.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    args = parser.parse_args()

    spark = SparkSession.builder.appName(f"flowgauge {args.job}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.job == "rollup":
        run_rollup(spark, args.source, args.out, args.start, args.end, args.step, args.format).show(truncate=False)
    elif args.job == "update":
        update_days(spark, args.source, args.out, args.start, args.end, args.step).show(truncate=False)
    elif args.job == "profiles":
        run_profiles(spark, args.source, args.out)
    elif args.job == "slot-forecast":
        fitted = run_slot_forecast(
            spark, args.source, args.out, args.start, args.end, args.base, args.days, args.stations,
            fmt=args.format, split=args.split, onehot=args.onehot,
        )
        fitted.winners.show()
    else:
        fitted = run_daily_forecast(spark, args.source, args.out, args.start, args.end, args.horizon, args.roll, fmt=args.format)
        fitted.winners.show()


if __name__ == "__main__":
    main()
