"""Session and arguments shared by the jobs.

The master, memory and packages come from ``spark-submit``; only what the library relies on is set here.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def session(name: str) -> SparkSession:
    return (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def arguments(description: str) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=description)
    parser.add_argument("--base", required=True, help="folder of landing, bronze, silver, gold, audit")
    parser.add_argument("--run-id", default="latest", help="folder of this run in the quarantine")
    parser.add_argument("--format", default="parquet", help="format of silver and gold tables")
    parser.add_argument(
        "--partition-facts", action="store_true", help="store sales in a folder per order date"
    )
    parser.add_argument(
        "--build-anyway", action="store_true", help="build gold also from tables that fail the gate"
    )
    return parser.parse_args()


def say(step: str, **what) -> None:
    print(json.dumps({"step": step, **what}), flush=True)
