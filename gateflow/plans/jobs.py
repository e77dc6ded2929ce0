"""The studied programs as Spark jobs over whole folders.

=========================  ==================================================
studied program            job here
=========================  ==================================================
data preprocessing         ``clean_job``: daily CSV -> clean layer (by day),
                           rejects table, report table and report text
analysis one               ``halfhour_job``: half-hour flow + week comparison
analysis two               ``line_halfhour_job``: per line and direction
analysis three             ``station_job``: station flow with top-10 flag
analysis four              ``daily_line_job``: per line + day total, pivot
analysis five              ``paytype_job``: pay-type counts and shares
stream consumer            ``start_stream_jobs``: per-minute line + station
                           flow (update or append) and a rejects sink
=========================  ==================================================

Result tables are keyed and written by the upsert sink, so re-running a job
replaces its keys (``REPLACE INTO`` semantics) and keeps the others.  The
analyses read the day-partitioned clean layer, so a day list prunes whole
partitions at planning time and only the needed columns are decoded.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import flows, quality
from ..operators.records import typed
from ..schemas import LINE_ANALYSIS_DAYS, WEEK_BASE_DAY, WEEK_GROUPS, Period
from ..sinks.files import write_by_day, write_table
from ..sinks.upsert import upsert
from ..sources.daily_files import daily_file_stream, read_clean_layer, read_daily_records
from ..streaming import minute_flow as stream


def _version() -> int:
    return time.time_ns() // 1000


def clean_job(spark: SparkSession, raw_folder: str, out_folder: str, period: Period,
              days: Iterable[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """Clean the daily files; returns the report (read back from its table).

    One scan, one shuffle (the grouping, written once), three writes.  Rows
    with another field count are rejects with their text as detail."""
    raw = read_daily_records(spark, raw_folder, days)
    res = quality.clean_all(raw, period)
    schema = res.report.schema
    try:
        write_table(res.report, f"{out_folder}/report", partition_by=["service_date"])
        # One row a day: the days of this run that have no clean row, or no reject.
        days = res.report.select("service_date", (F.col("final") == 0).alias("no_clean"),
                                 (F.col("final") == F.col("total")).alias("no_reject")).collect()
        write_by_day(res.clean, f"{out_folder}/clean", fmt=fmt,
                     empty_days=[r.service_date for r in days if r.no_clean])
        write_table(res.rejects, f"{out_folder}/rejects", partition_by=["service_date"],
                    empty_days=[r.service_date for r in days if r.no_reject])
    finally:
        res.release()
    report = spark.read.schema(schema).parquet(f"{out_folder}/report")
    write_table(quality.report_text(report).coalesce(1), f"{out_folder}/report_text", fmt="json")
    return report


def start_clean_job(spark: SparkSession, raw_folder: str, out_folder: str, period: Period,
                    trigger: dict | None = None, checkpoint: str | None = None,
                    max_files_per_trigger: int | None = None) -> StreamingQuery:
    """``clean_job`` for the days of new daily files only.

    The folder is a file stream, so a file that was there at an earlier run is
    neither read nor cleaned again.  The files of a micro-batch name its days;
    these are cleaned from all their files, so that a late part of a day joins
    the parts that came before, and only their folders are written.  A replay
    cleans the same days again."""
    days = daily_file_stream(spark, raw_folder, max_files_per_trigger).select("service_date")

    def write(batch: DataFrame, batch_id: int) -> None:
        came = [r[0] for r in batch.distinct().collect()]           # at most one a file
        if came:
            clean_job(spark, raw_folder, out_folder, period, came)

    name = "clean_new_days"
    return (days.writeStream.queryName(name)
                .option("checkpointLocation", checkpoint or stream.checkpoint_location(spark, name, target=out_folder))
                .foreachBatch(write).trigger(**(trigger or {"availableNow": True})).start())


def _clean_typed(spark: SparkSession, clean_path: str, days=None, fmt: str = "parquet") -> DataFrame:
    return typed(read_clean_layer(spark, clean_path, days, fmt))


def halfhour_job(spark: SparkSession, clean_path: str, out_folder: str, period: Period,
                 day_numbers: Sequence[int] | None = None) -> None:
    """Half-hour flow of the base day and the week-group days (or the
    given days), and the week comparison series."""
    if day_numbers is None:
        day_numbers = sorted({WEEK_BASE_DAY} | {d for a, b in WEEK_GROUPS for d in range(a, b + 1)})
    t = _clean_typed(spark, clean_path, period.days(day_numbers))
    upsert(flows.halfhour_flow(t), f"{out_folder}/passenger_flow",
           ["service_date", "time_slot"], _version(), partition_by=["service_date"])
    upsert(flows.week_comparison(t, period), f"{out_folder}/week_comparison",
           ["group_id", "service_date", "time_slot"], _version(), partition_by=["group_id"])


def line_halfhour_job(spark: SparkSession, clean_path: str, out_folder: str, period: Period,
                      day_numbers: Sequence[int] = LINE_ANALYSIS_DAYS) -> None:
    t = _clean_typed(spark, clean_path, period.days(day_numbers))
    upsert(flows.halfhour_flow_by_line(t), f"{out_folder}/passenger_flow_by_line",
           ["service_date", "time_slot", "lineID", "status"], _version(),
           partition_by=["service_date"])


def station_job(spark: SparkSession, clean_path: str, out_folder: str, period: Period,
                day_numbers: Sequence[int] = LINE_ANALYSIS_DAYS) -> None:
    t = _clean_typed(spark, clean_path, period.days(day_numbers))
    upsert(flows.station_flow_daily(t), f"{out_folder}/passenger_flow_by_station",
           ["service_date", "lineID", "stationID", "status"], _version(),
           partition_by=["service_date"])


def daily_line_job(spark: SparkSession, clean_path: str, out_folder: str, period: Period) -> None:
    t = _clean_typed(spark, clean_path, period.days())
    upsert(flows.line_flow_daily_with_total(t), f"{out_folder}/daily_line_flow",
           ["service_date", "lineID"], _version(), partition_by=["service_date"])


def paytype_job(spark: SparkSession, clean_path: str, out_folder: str, period: Period) -> None:
    t = _clean_typed(spark, clean_path, period.days())
    upsert(flows.paytype_distribution(t), f"{out_folder}/paytype", ["pay_type"], _version())


def start_stream_jobs(lines: DataFrame, out_folder: str, output_mode: str = "update",
                      trigger: dict | None = None, console: bool = False):
    """Station and line tables from one windowed query (the source is
    read and parsed once for both), plus the rejects sink; wait with
    ``streaming.minute_flow.await_all``.  ``console`` adds a query printing
    the per-line totals of each micro-batch in key order (K9)."""
    # Hour folders: a long-running stream's readers open the last hours only.
    extra = []
    if console:
        flow = stream.windowed_minute_flow(stream.parsed_records(lines), stream.LINE_KEYS)
        extra.append(flow.writeStream.queryName("line_console").outputMode("update")
                     .option("checkpointLocation", stream.checkpoint_location(
                         lines.sparkSession, "line_console", str(_version())))
                     .foreachBatch(stream.console_batch_writer(["minute", "lineID"]))
                     .trigger(**(trigger or {"processingTime": "0 seconds"})).start())
    return extra + [
        stream.start_station_and_line_flow(lines, f"{out_folder}/station_statistics",
                                           f"{out_folder}/line_statistics", output_mode,
                                           "station_and_line_statistics", trigger=trigger,
                                           partition_by=stream.HOURLY_PARTITIONS),
        stream.start_rejects(lines, f"{out_folder}/stream_rejects", "stream_rejects",
                             trigger=trigger),
    ]


def start_inout_jobs(lines: DataFrame, out_folder: str, trigger: dict | None = None):
    """The hand-written consumer: in/out tables by station and line,
    a minute saved when the next one arrives, and its rejects."""
    return [
        stream.start_inout_flow(lines, f"{out_folder}/inout_station", f"{out_folder}/inout_line",
                                query_name="inout_statistics", trigger=trigger,
                                partition_by=stream.HOURLY_PARTITIONS),
        stream.start_inout_rejects(lines, f"{out_folder}/inout_rejects", trigger=trigger),
    ]
