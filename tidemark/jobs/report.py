"""spark-submit job: audit texts to counts per minute, type and area.

    spark-submit tidemark/jobs/report.py --servers host:9092 --folder /shared/report
"""

from __future__ import annotations

import argparse

from tidemark import settings
from tidemark.jobs.options import add_common, reader_options, session
from tidemark.operators.windows import LABELS
from tidemark.sinks.delivery import with_ids_sink
from tidemark.sinks.writers import all_of, console_sink, folder_sink, kafka_sink, upsert_sink
from tidemark.sources.messages import read_messages
from tidemark.streaming.report import ReportStep, run_report_builtin, run_report_exact


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description="Count audit events per window, type and area.")
    args.add_argument("--servers", help="Kafka brokers; without them, read and write folders")
    args.add_argument("--input", default=settings.AUDIT_TOPIC, help="topic, or folder of text files")
    args.add_argument("--late", default=settings.LATE_TOPIC, help="topic, or folder, for rows that come too late")
    args.add_argument("--folder", required=True, help="shared folder for documents, state, checkpoint and bad rows")
    args.add_argument("--label", choices=LABELS, default="window_end", help="the time printed on a count")
    args.add_argument("--builtin", action="store_true", help="use Spark's watermark; late rows are only counted")
    args.add_argument("--documents", choices=("append", "upsert"), default="append", help="every emission, or the last of each id")
    args.add_argument("--each-refire", action="store_true", help="a document for each correction, not one per batch and window")
    args.add_argument("--times", choices=("positive", "nonzero"), default="positive", help="moments to count: after the epoch, or any but it")
    args.add_argument("--lenient", action="store_true", help="times need no leading zeros, roll over, and may be followed by text")
    for name, what in (("window", "width of a window"), ("delay", "how far the watermark trails"), ("lateness", "how long corrections are taken")):
        args.add_argument(f"--{name}", type=float, default=getattr(settings.Timing(), f"{name}_ms") / 1000, help=f"{what}, in seconds")
    add_common(args)
    args.add_argument("--print", action="store_true", dest="show", help="print the documents too")
    args.add_argument("--once", action="store_true", help="stop when all present input is done")
    given = args.parse_args(argv)

    spark = session("report", given)
    timing = settings.Timing(*(round(seconds * 1000) for seconds in (given.window, given.delay, given.lateness)))
    if given.servers:
        options = {"kafka.bootstrap.servers": given.servers, "subscribe": given.input, **reader_options(given)}
        messages = read_messages(spark, "kafka", streaming=True, once=given.once_within, **options)
        late = kafka_sink(given.late, given.servers)
        late = with_ids_sink(late) if given.ids else late
    else:
        messages = read_messages(spark, "text", streaming=True, path=given.input, **reader_options(given))
        late = folder_sink(given.late, "text", few_files=True)
    place = f"{given.folder}/{settings.REPORT_INDEX}"
    docs = upsert_sink(place) if given.documents == "upsert" else folder_sink(place)
    bad = folder_sink(f"{given.folder}/bad", few_files=True)
    if given.show:
        docs = all_of(docs, console_sink())
    checkpoint = f"{given.folder}/checkpoint"
    trigger = {"availableNow": True} if given.once else None
    if given.builtin:
        queries = run_report_builtin(messages, docs, bad, checkpoint, timing, given.label, given.times, trigger=trigger, lenient=given.lenient)
    else:
        arrival = "arrival" if "arrival" in messages.columns else None
        options = {"each_refire": given.each_refire, "lenient": given.lenient}
        step = ReportStep(f"{given.folder}/state", docs, late, bad, timing, arrival, given.times, given.label, **options)
        queries = (run_report_exact(messages, step, checkpoint, trigger),)
    if given.once:
        for query in queries:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
