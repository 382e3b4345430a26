"""``spark-submit martloom/cli.py geo --events-path … --cities-path … --output-path … --date-from … --date-to …``"""

from __future__ import annotations

import argparse
import datetime as dt

from martloom.plans.pipelines import GeoRun, run_geo_marts, run_warehouse
from martloom.session import build_session

STAGED = ("users", "restaurants", "orders", "couriers", "deliveries", "bonus_events")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="martloom")
    jobs = top.add_subparsers(dest="job", required=True)
    geo = jobs.add_parser("geo", help="profiles, zone activity, friend recommendations")
    for name in ("events-path", "cities-path", "output-path", "date-from", "date-to"):
        geo.add_argument(f"--{name}", required=True)
    geo.add_argument("--only", choices=["profiles", "zones", "recommendations"], action="append")
    geo.add_argument("--margin-days", type=int, help="read for the zones only the day folders of the period and so many days on either side; without it, every folder")
    house = jobs.add_parser("warehouse", help="staging to dimensions, facts and marts")
    house.add_argument("--staging-path", required=True)
    house.add_argument("--output-path", required=True)
    house.add_argument("--today", type=dt.date.fromisoformat)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"martloom-{args.job}")
    if args.job == "geo":
        run = GeoRun(args.events_path, args.cities_path, args.output_path, args.date_from, args.date_to, args.margin_days)
        run_geo_marts(spark, run, tuple(args.only or ("profiles", "zones", "recommendations")))
    else:
        staging = {name: spark.read.parquet(f"{args.staging_path}/{name}") for name in STAGED}
        run_warehouse(spark, staging, args.output_path, args.today)


if __name__ == "__main__":
    main()
