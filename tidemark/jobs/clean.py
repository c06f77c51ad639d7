"""spark-submit job: envelopes to flat records.

    spark-submit tidemark/jobs/clean.py --servers host:9092 --areas /path/areas --folder /shared/clean
"""

from __future__ import annotations

import argparse

from tidemark import settings
from tidemark.jobs.options import add_common, reader_options, session
from tidemark.sinks.delivery import with_ids_sink
from tidemark.sinks.writers import folder_sink, kafka_sink
from tidemark.sources.areas import AreaSnapshots
from tidemark.sources.messages import read_messages
from tidemark.streaming.clean import run_clean


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description="Flatten event envelopes and add their area.")
    args.add_argument("--servers", help="Kafka brokers; without them, read and write folders")
    args.add_argument("--input", default=settings.ENVELOPE_TOPIC, help="topic, or folder of text files")
    args.add_argument("--output", default=settings.CLEAN_TOPIC, help="topic, or folder")
    args.add_argument("--areas", required=True, help="parquet table with columns area, codes")
    args.add_argument("--folder", required=True, help="shared folder for the checkpoint and bad rows")
    args.add_argument("--default-area", help=f"area of unmapped countries, such as '{settings.OTHER_AREA}'; null if not given")
    add_common(args)
    args.add_argument("--once", action="store_true", help="stop when all present input is done")
    given = args.parse_args(argv)

    spark = session("clean", given)
    if given.servers:
        options = {"kafka.bootstrap.servers": given.servers, "subscribe": given.input, **reader_options(given)}
        messages = read_messages(spark, "kafka", streaming=True, once=given.once_within, **options)
        sink = kafka_sink(given.output, given.servers)
        sink = with_ids_sink(sink) if given.ids else sink
    else:
        messages = read_messages(spark, "text", streaming=True, path=given.input, **reader_options(given))
        sink = folder_sink(given.output, "text")
    query = run_clean(
        messages,
        AreaSnapshots(lambda: spark.read.schema("area string, codes string").parquet(given.areas)),
        sink,
        f"{given.folder}/checkpoint",
        folder_sink(f"{given.folder}/bad", few_files=True),
        default_area=given.default_area,
        trigger={"availableNow": True} if given.once else None,
    )
    query.awaitTermination()


if __name__ == "__main__":
    main()
