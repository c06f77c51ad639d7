"""Options that both jobs take."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidemark.workspace import use_utc


def add_common(args: argparse.ArgumentParser) -> None:
    args.add_argument(
        "--option",
        action="append",
        default=[],
        metavar="KEY=VALUE",
        help="option of the reader, such as startingOffsets=earliest or maxOffsetsPerTrigger=1000000; may be repeated",
    )
    args.add_argument("--ids", action="store_true", help="send each record with an id as its key, the same when a batch is sent again")
    args.add_argument("--once-within", metavar="SPAN", help="leave out records that were sent again within a span such as '1 hour', by key")
    args.add_argument("--zone", help="time zone of time texts; the session's if not given")


def reader_options(given: argparse.Namespace) -> dict[str, str]:
    pairs = [text.partition("=") for text in given.option]
    if wrong := [key for key, sign, _ in pairs if not sign]:
        raise SystemExit(f"not KEY=VALUE: {', '.join(wrong)}")
    return {key: value for key, _, value in pairs}


def session(name: str, given: argparse.Namespace) -> SparkSession:
    spark = SparkSession.builder.appName(name).getOrCreate()
    return use_utc(spark, given.zone) if given.zone else spark
