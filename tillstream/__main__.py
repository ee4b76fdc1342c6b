"""Jobs from the command line: ``spark-submit`` this file or ``python -m tillstream JOB ...``."""

from __future__ import annotations

import argparse

from tillstream.plans import checks, jobs
from tillstream.session import build_session
from tillstream.settings import ReplayPlan
from tillstream.sinks.tables import create_layers
from tillstream.sources import payloads
from tillstream.streaming.replay import run_replay, start_replay


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tillstream", description=__doc__)
    job = parser.add_subparsers(dest="job", required=True)
    commerce = job.add_parser("commerce", help="load the commerce CSV files of a folder")
    commerce.add_argument("folder")
    commerce.add_argument("--only", nargs="*", help="names of the files to load")
    products = job.add_parser("products", help="load product answers")
    products.add_argument("path")
    products.add_argument("--bronze", required=True)
    weather = job.add_parser("weather", help="load daily weather from a folder with one file per city")
    weather.add_argument("folder")
    weather.add_argument("--bronze", required=True)
    fx = job.add_parser("fx", help="load exchange rates")
    fx.add_argument("path")
    fx.add_argument("--bronze", required=True)
    replay = job.add_parser("replay", help="replay click events")
    replay.add_argument("source")
    replay.add_argument("output")
    replay.add_argument("--mode", choices=["replay", "continuous"], default="replay")
    replay.add_argument("--interval", default="30 seconds")
    replay.add_argument("--kafka-servers")
    job.add_parser("warehouse", help="build views and marts")
    sessions = job.add_parser("sessions", help="cut click events of JSON lines into sessions")
    sessions.add_argument("--input-path", required=True)
    sessions.add_argument("--output-path", required=True)
    sessions.add_argument("--gap-minutes", type=int, default=30)
    quality = job.add_parser("quality", help="check the tables and write reports")
    quality.add_argument("report")
    quality.add_argument("--non-strict", action="store_true")
    return parser.parse_args(arguments)


def run(spark, chosen: argparse.Namespace) -> object:
    if chosen.job == "sessions":
        return jobs.session_job(spark, chosen.input_path, chosen.output_path, chosen.gap_minutes)
    create_layers(spark)
    if chosen.job == "commerce":
        return jobs.load_commerce(spark, chosen.folder, chosen.only)
    if chosen.job == "products":
        return jobs.load_products(payloads.read_product_payloads(spark, chosen.path), chosen.bronze)
    if chosen.job == "weather":
        return jobs.load_weather(payloads.read_weather_folder(spark, chosen.folder), chosen.bronze)
    if chosen.job == "fx":
        return jobs.load_fx(payloads.read_fx_payloads(spark, chosen.path), chosen.bronze)
    if chosen.job == "replay":
        plan = ReplayPlan(chosen.source, chosen.output, kafka_servers=chosen.kafka_servers)
        if chosen.mode == "continuous":
            query = start_replay(spark, plan, continuous=chosen.interval, table="raw.retailrocket_events")
            return query.awaitTermination()
        return run_replay(spark, plan)
    if chosen.job == "warehouse":
        return jobs.build_warehouse(spark)
    return checks.run_quality(spark, chosen.report, strict=not chosen.non_strict)


if __name__ == "__main__":
    session = build_session()
    try:
        print(run(session, parse()))
    finally:
        session.stop()
