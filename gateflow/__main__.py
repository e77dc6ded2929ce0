"""Command line: ``python -m gateflow <job> [options]``.

    clean     --raw DIR --out DIR [--month 2019-01 --first 1 --last 25] [--new-files]
    analyses  --out DIR (reads DIR/clean, writes the five result tables)
    stream    --source DIR --out DIR [--mode update|append] [--rocksdb] [--console]
    inout     --source DIR --out DIR [--rocksdb]

``clean --new-files`` takes the daily files that earlier such runs have not seen
and cleans their days.  Streams read text files, at most --files-per-batch of them a micro-batch, or,
with --kafka SERVERS --topic NAME, a topic.  --checkpoint names the folder that
all executors share, where the session has none (spark.checkpoint.dir).
"""

from __future__ import annotations

import argparse

from .plans import jobs
from .schemas import Period
from .session import get_session, size_for_input
from .sinks.kafka import read_kafka_lines
from .sources.streams import text_line_stream
from .streaming.minute_flow import await_all, configure_state


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="gateflow")
    ap.add_argument("job", choices=["clean", "analyses", "stream", "inout"])
    ap.add_argument("--raw")
    ap.add_argument("--source")
    ap.add_argument("--out", required=True)
    ap.add_argument("--month", default="2019-01")
    ap.add_argument("--first", type=int, default=1)
    ap.add_argument("--last", type=int, default=25)
    ap.add_argument("--mode", default="update", choices=["update", "append"])
    ap.add_argument("--new-files", action="store_true")
    ap.add_argument("--rocksdb", action="store_true")
    ap.add_argument("--console", action="store_true", help="also print per-line totals")
    ap.add_argument("--checkpoint", help="shared folder, if the session names none")
    ap.add_argument("--files-per-batch", type=int, default=100)
    ap.add_argument("--kafka", help="bootstrap servers, instead of --source")
    ap.add_argument("--topic")
    args = ap.parse_args(argv)

    extra = {"spark.checkpoint.dir": args.checkpoint} if args.checkpoint else None
    spark = get_session(extra_conf=extra)
    period = Period(args.month, args.first, args.last)
    out = args.out.rstrip("/")
    if args.job == "clean":
        size_for_input(spark, args.raw)
        if args.new_files:
            await_all(spark, [jobs.start_clean_job(spark, args.raw, out, period)])
        else:
            jobs.clean_job(spark, args.raw, out, period)
    elif args.job == "analyses":
        clean = f"{out}/clean"
        size_for_input(spark, clean)
        jobs.halfhour_job(spark, clean, out, period)
        jobs.line_halfhour_job(spark, clean, out, period)
        jobs.station_job(spark, clean, out, period)
        jobs.daily_line_job(spark, clean, out, period)
        jobs.paytype_job(spark, clean, out, period)
    else:
        configure_state(spark, rocksdb=args.rocksdb)
        if args.kafka:
            lines = read_kafka_lines(spark, args.kafka, args.topic)
        else:
            size_for_input(spark, args.source)
            lines = text_line_stream(spark, args.source, args.files_per_batch)
        if args.job == "inout":
            await_all(spark, jobs.start_inout_jobs(lines, out))
        else:
            await_all(spark, jobs.start_stream_jobs(lines, out, args.mode, console=args.console))


if __name__ == "__main__":
    main()
