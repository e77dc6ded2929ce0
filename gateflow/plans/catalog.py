"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the supplied tables (the swipe records are a projection
of ``events``, FIXTURES §4) over their whole extent.  Times leave as text
("yyyy-MM-dd HH:mm:ss") and counts as BIGINT, so results compare as values.
IDs in comments refer to SURVEY §2.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import ts_text
from ..operators import flows, minute, quality, series
from ..operators.records import typed, with_labels
from ..schemas import RAW_COLUMNS, WEEK_GROUPS
from ..session import apply_session_defaults, scratch_path
from ..sinks import cells
from ..sinks.files import write_by_day, write_daily_files
from ..sinks.upsert import read_table, upsert
from ..sources.daily_files import read_clean_layer, read_daily_csv, read_daily_records
from ..sources.fixture import FIXTURE_PERIOD, raw_swipes_from_dir
from ..sources.lines import lax_records, parse_lax, parse_strict, strict_records, to_line
from ..sources.streams import events_line_stream, text_line_stream
from ..streaming import minute_flow as stream
from . import jobs

Query = Callable[[SparkSession, str], DataFrame]
PERIOD = FIXTURE_PERIOD


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_session_defaults(spark)
    return raw_swipes_from_dir(spark, sf_dir, faults=True)


def _clean(spark, sf_dir) -> DataFrame:
    return quality.clean(_raw(spark, sf_dir), PERIOD)


def _typed(spark, sf_dir) -> DataFrame:
    return typed(_clean(spark, sf_dir))


def _lines(spark, sf_dir) -> DataFrame:
    return to_line(_raw(spark, sf_dir))


def _strict_valid(spark, sf_dir) -> DataFrame:
    return strict_records(_lines(spark, sf_dir))


def _lax_valid(spark, sf_dir) -> DataFrame:
    return lax_records(_lines(spark, sf_dir))


def _minute_text(df: DataFrame) -> DataFrame:
    return df.withColumn("minute", ts_text("minute"))


# --- scans and cleaning ------------------------------------------------------

def swipe_scan(spark, sf_dir):
    """Raw swipe records (service day + seven text columns)."""
    return _raw(spark, sf_dir)


def raw_csv_roundtrip(spark, sf_dir):
    """Raw swipes written as day-partitioned CSV with a header
    line, read back by position with the fixed all-text schema."""
    path = scratch_path(spark, "raw-csv")
    write_by_day(_raw(spark, sf_dir), path, fmt="csv")
    return read_clean_layer(spark, path, fmt="csv")


def quality_null_counts(spark, sf_dir):
    """G1/G2."""
    return quality.null_counts(_raw(spark, sf_dir))


def quality_report(spark, sf_dir):
    """One row per day."""
    return quality.report(_raw(spark, sf_dir), PERIOD)


def quality_report_text(spark, sf_dir):
    """K3: the text block per day."""
    return quality.report_text(quality.report(_raw(spark, sf_dir), PERIOD))


def clean_records(spark, sf_dir):
    """F1-F8, G4."""
    return _clean(spark, sf_dir)


def rejected_records(spark, sf_dir):
    """Rejects with reason and dropped-copy count."""
    return quality.rejects(_raw(spark, sf_dir), PERIOD)


def clean_roundtrip(spark, sf_dir):
    """K1/K2: write the clean layer partitioned by day into the shared
    folder, read it back."""
    path = scratch_path(spark, "clean-layer")
    write_by_day(_clean(spark, sf_dir), path)
    return read_clean_layer(spark, path)


#: The day that ``clean_rerun`` finds without a clean row the second time.
RERUN_DAY = "2024-01-05"
#: The day list of ``daily_files_scan``'s second read.
LISTED_DAYS = ("2024-01-02", "2024-01-09", "2024-01-31")


def clean_rerun(spark, sf_dir):
    """K1: clean all days twice; the second time one day's rows are all
    rejected, so its old clean rows must go."""
    path = scratch_path(spark, "clean-rerun")
    raw = _raw(spark, sf_dir)
    write_by_day(quality.clean(raw, PERIOD), path)
    line = F.when(F.col("service_date") == RERUN_DAY, F.lit("Z")).otherwise(F.col("lineID"))
    again = raw.withColumn("lineID", line)
    empty = quality.report(again, PERIOD).where("final = 0").select("service_date").collect()
    write_by_day(quality.clean(again, PERIOD), path, empty_days=[r[0] for r in empty])
    return read_clean_layer(spark, path)


def daily_files_scan(spark, sf_dir):
    """The rows as ``record_<day>.csv`` files, read by folder
    and by day list; the day comes from the file name."""
    path = scratch_path(spark, "daily-files")
    write_daily_files(_raw(spark, sf_dir), path)
    return read_daily_csv(spark, path).select(F.lit("folder").alias("scan"), "*").unionByName(
        read_daily_csv(spark, path, LISTED_DAYS).select(F.lit("days").alias("scan"), "*"))


def _short_or_long(device: str = "deviceID") -> tuple:
    """Fault of ``daily_files_malformed``: which rows lack a field or have one
    too many (all rows pass)."""
    n = F.pmod(F.col(device).cast("int"), F.lit(50))
    return n == 7, n == 9


def daily_files_malformed(spark, sf_dir):
    """Daily files in which some rows have six fields and some
    eight; they are rejects with their text, beside the other rejects."""
    raw = _raw(spark, sf_dir)
    short, long_ = _short_or_long()
    fields = [F.coalesce(F.col(c), F.lit("")) for c in RAW_COLUMNS]
    line = (F.when(short, F.concat_ws(",", *fields[:-1])).when(long_, F.concat_ws(",", *fields, F.lit("extra")))
            .otherwise(F.concat_ws(",", *fields)))
    path = scratch_path(spark, "daily-malformed")
    write_daily_files(raw.select("service_date", line.alias(",".join(RAW_COLUMNS))), path,
                      options={"sep": "\u0001", "quote": ""})
    return quality.rejects(read_daily_records(spark, path), PERIOD)


def quality_observed(spark, sf_dir):
    """The report's counts over all days, observed while the
    grouping is written; nothing reads the grouping for them."""
    path = scratch_path(spark, "quality-observed")
    totals = quality.write_groups(_raw(spark, sf_dir), PERIOD, path)
    return spark.createDataFrame([tuple(totals.values())], ", ".join(f"{c} long" for c in totals))


#: ``clean_incremental``: the days up to this one arrive first, and of the day itself a part only.
FIRST_DAYS = "2024-01-14"


def clean_incremental(spark, sf_dir):
    """Daily files arrive twice, one day's in two parts; each run
    cleans the days of the new files.  The clean layer that results."""
    raw = _raw(spark, sf_dir)
    folder, out = scratch_path(spark, "daily-arrivals"), scratch_path(spark, "daily-clean")
    even = F.pmod(F.col("deviceID").cast("int"), F.lit(2)) == 0
    first = (F.col("service_date") < FIRST_DAYS) | ((F.col("service_date") == FIRST_DAYS) & even)
    for tag, rows in (("a", raw.where(first)), ("b", raw.where(~first))):
        write_daily_files(rows, folder, mode="append", tag=tag)
        q = jobs.start_clean_job(spark, folder, out, PERIOD)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return read_clean_layer(spark, f"{out}/clean")


# --- batch analyses ----------------------------------------------------------

def halfhour_flow(spark, sf_dir):
    """G7/P9/P10."""
    return flows.halfhour_flow(_typed(spark, sf_dir))


def halfhour_flow_in_order(spark, sf_dir):
    """O1: slots ascending within a day."""
    return flows.in_slot_order(flows.halfhour_flow(_typed(spark, sf_dir)))


def station_flow_in_order(spark, sf_dir):
    """O2: stations ascending within a day."""
    return flows.in_station_order(flows.station_flow_daily(_typed(spark, sf_dir)))


def halfhour_flow_by_line(spark, sf_dir):
    """G8/P15/F9."""
    return flows.halfhour_flow_by_line(_typed(spark, sf_dir))


def line_direction_series(spark, sf_dir):
    """C2/P12/P20."""
    return flows.line_direction_series(_typed(spark, sf_dir))


def week_comparison(spark, sf_dir):
    """J1/C1/P12."""
    return flows.week_comparison(_typed(spark, sf_dir), PERIOD)


def week_comparison_pruned(spark, sf_dir):
    """The week groups as a table, whose days prune the scan of the
    clean layer while the query runs."""
    layer, table = scratch_path(spark, "clean-layer"), scratch_path(spark, "week-groups")
    write_by_day(_clean(spark, sf_dir), layer)
    flows.week_groups_frame(spark, PERIOD).coalesce(1).write.parquet(table)
    groups = [f"{a:02d}_to_{b:02d}" for a, b in WEEK_GROUPS]
    return flows.week_comparison_by_table(typed(read_clean_layer(spark, layer)), spark.read.parquet(table), groups)


def station_flow_daily(spark, sf_dir):
    """G9/P16/W1/C3."""
    return flows.station_flow_daily(_typed(spark, sf_dir))


def station_top10(spark, sf_dir):
    """W1/O3/J3/U3/P14."""
    return flows.station_top10(_typed(spark, sf_dir))


def line_flow_daily_with_total(spark, sf_dir):
    """G10/G11."""
    return flows.line_flow_daily_with_total(_typed(spark, sf_dir))


def line_flow_pivot(spark, sf_dir):
    """C4."""
    return flows.line_flow_pivot(_typed(spark, sf_dir))


def paytype_distribution(spark, sf_dir):
    """G12/G16/W2/J2/C5."""
    return flows.paytype_distribution(_typed(spark, sf_dir))


def decoded_records(spark, sf_dir):
    """Clean records with status and pay-type labels."""
    return with_labels(_typed(spark, sf_dir)).withColumn("event_ts", ts_text("event_ts"))


def service_day_span(spark, sf_dir):
    """O5."""
    return flows.day_span(_typed(spark, sf_dir))


# --- message parsing and per-minute flows ------------------------------------

def parse_lines_strict(spark, sf_dir):
    """P4/P5/F10/K10."""
    return (parse_strict(_lines(spark, sf_dir))
            .withColumn("event_ts", ts_text("event_ts")))


def parse_lines_lax(spark, sf_dir):
    """P6/P8."""
    return parse_lax(_lines(spark, sf_dir))


def minute_flow_line(spark, sf_dir):
    """G13/P7 per line."""
    return _minute_text(minute.minute_flow_line(_strict_valid(spark, sf_dir)))


def minute_flow_station(spark, sf_dir):
    """G13/P7 per station."""
    return _minute_text(minute.minute_flow_station(_strict_valid(spark, sf_dir)))


def inout_minute_line(spark, sf_dir):
    """G14/F15."""
    return minute.inout_minute_line(_lax_valid(spark, sf_dir))


def inout_minute_station(spark, sf_dir):
    """G15/P14."""
    return minute.inout_minute_station(_lax_valid(spark, sf_dir))


def ingest_profile(spark, sf_dir):
    """G17/W3/W4."""
    return minute.ingest_profile(_raw(spark, sf_dir))


def live_series_line(spark, sf_dir):
    """C6/F13."""
    return series.live_series_line(minute.minute_flow_line(_strict_valid(spark, sf_dir)))


def live_series_station(spark, sf_dir):
    """C7/F14."""
    return series.live_series_station(minute.inout_minute_station(_lax_valid(spark, sf_dir)))


def live_series_station_selected(spark, sf_dir):
    """the in and out series of three stations of line A."""
    return series.live_series_station(minute.inout_minute_station(_lax_valid(spark, sf_dir)), line="A",
                                      stations=("A-1", "A-7", "A-40", "B-2"), types=("in", "out"))


def rowkey_cells_line(spark, sf_dir):
    """K6/K7, line table."""
    return cells.line_cells(minute.minute_flow_line(_strict_valid(spark, sf_dir)))


def rowkey_cells_station(spark, sf_dir):
    """K6/K7, station table."""
    return cells.station_cells(minute.minute_flow_station(_strict_valid(spark, sf_dir)))


def inout_cells_line(spark, sf_dir):
    """K6/K7/K8, in/out line table."""
    return cells.inout_line_cells(minute.inout_minute_line(_lax_valid(spark, sf_dir)))


def inout_cells_station(spark, sf_dir):
    """K6/K7/K8, in/out station table."""
    return cells.inout_station_cells(minute.inout_minute_station(_lax_valid(spark, sf_dir)))


def cells_in_key_order(spark, sf_dir):
    """O1/O2/K6/K7: the station cells as sorted files with key ranges of
    their own, read back."""
    path = scratch_path(spark, "cell-files")
    cells.write_in_key_order(cells.station_cells(minute.minute_flow_station(_strict_valid(spark, sf_dir))), path, 8)
    return spark.read.parquet(path)


# --- sinks -------------------------------------------------------------------

def upsert_latest_wins(spark, sf_dir):
    """Load half-hour counts of the uncleaned rows (version 1), then
    upsert the cleaned counts (version 2) twice; keys only in version 1
    keep their values, the replay changes nothing."""
    raw_counts = flows.halfhour_flow(typed(_raw(spark, sf_dir)))
    clean_counts = flows.halfhour_flow(_typed(spark, sf_dir))
    target = scratch_path(spark, "tables", "passenger_flow")
    keys = ["service_date", "time_slot"]
    upsert(raw_counts, target, keys, 1, partition_by=["service_date"])
    upsert(clean_counts, target, keys, 2, partition_by=["service_date"])
    upsert(clean_counts, target, keys, 2, partition_by=["service_date"])
    return read_table(spark, target).select("service_date", "time_slot", "traffic_count")


def upsert_new_writer(spark, sf_dir):
    """A first writer loads the counts of the uncleaned rows as
    version 7; a later one, whose versions begin at 0 again, loads the cleaned
    counts and outranks it."""
    target = scratch_path(spark, "tables", "passenger_flow_writers")
    keys = ["service_date", "time_slot"]
    upsert(flows.halfhour_flow(typed(_raw(spark, sf_dir))), target, keys, 7,
           partition_by=["service_date"], writer="1-first")
    upsert(flows.halfhour_flow(_typed(spark, sf_dir)), target, keys, 0,
           partition_by=["service_date"], writer="2-second")
    return read_table(spark, target).select("service_date", "time_slot", "traffic_count")


# --- streaming ---------------------------------------------------------------

def _stream_run(spark, sf_dir, keys, mode, name):
    lines = events_line_stream(spark, sf_dir)
    target = scratch_path(spark, "tables", name)
    run_id = target.rsplit("/", 1)[-1]
    out = stream.run_to_completion(lines, target, keys, mode, name, run_id=run_id)
    return _minute_text(out.select("minute", *keys, "total_flow", "exit_count", "entry_count"))


def stream_minute_line_update(spark, sf_dir):
    """T1/T2/T4/T5/T6/K5 (update mode, upsert sink)."""
    return _stream_run(spark, sf_dir, stream.LINE_KEYS, "update", "stream_minute_line_update")


def stream_minute_station_update(spark, sf_dir):
    """T1/T3/T4/T5/K5."""
    return _stream_run(spark, sf_dir, stream.STATION_KEYS, "update", "stream_minute_station_update")


def stream_minute_line_append(spark, sf_dir):
    """A minute is written once the watermark closes it."""
    return _stream_run(spark, sf_dir, stream.LINE_KEYS, "append", "stream_minute_line_append")


def stream_chained_rollup(spark, sf_dir):
    """Line windows chained onto station windows in one query."""
    target = scratch_path(spark, "tables", "chained_lines")
    name = "stream_chained_rollup"
    q = stream.start_chained_line_flow(
        events_line_stream(spark, sf_dir), target, name,
        checkpoint=stream.checkpoint_location(spark, name, target.rsplit("/", 1)[-1]), trigger={"availableNow": True})
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return _minute_text(read_table(spark, target).select("minute", "lineID", "total_flow", "exit_count", "entry_count"))


def stream_shared_parse(spark, sf_dir):
    """Messages are read and parsed once, into a table that the
    line flow and the rejects read as streams.  Both results as
    (kind, minute, lineID, reason, n)."""
    parsed, flow, rejects = (scratch_path(spark, "tables", f"shared_{k}") for k in ("parsed", "flow", "rejects"))
    now = {"availableNow": True}
    stream.await_all(spark, [stream.start_parse(events_line_stream(spark, sf_dir), parsed, trigger=now)])
    stream.await_all(spark, [
        stream.start_record_flow(stream.parsed_stream(spark, parsed, True), flow, query_name="shared_flow", trigger=now),
        stream.start_parsed_rejects(spark, parsed, rejects, trigger=now)])
    none = F.lit(None).cast("string")
    lines = read_table(spark, flow).select(F.lit("flow").alias("kind"), ts_text("minute").alias("minute"), "lineID",
                                           none.alias("reason"), F.col("total_flow").alias("n"))
    return lines.unionByName(spark.read.parquet(rejects).groupBy("reject_reason").agg(F.count("*").alias("n")).select(
        F.lit("reject").alias("kind"), none.alias("minute"), none.alias("lineID"),
        F.col("reject_reason").alias("reason"), "n"))


def stream_state_left(spark, sf_dir):
    """What an append-mode query on the RocksDB provider keeps in
    its state when all messages are in: the open windows."""
    keys = [*stream.STATE_CONF, "spark.sql.streaming.stateStore.providerClass"]
    before = {k: spark.conf.get(k, None) for k in keys}
    target = scratch_path(spark, "tables", "state_left")
    name, run_id = "stream_state_left", target.rsplit("/", 1)[-1]
    stream.configure_state(spark, rocksdb=True)
    try:
        stream.run_to_completion(events_line_stream(spark, sf_dir), target, stream.LINE_KEYS, "append", name, run_id)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return _minute_text(stream.open_windows(spark, stream.checkpoint_location(spark, name, run_id)))


def stream_line_rollup(spark, sf_dir):
    """T8 with one query: station windows, line rows rolled up per batch."""
    lines = events_line_stream(spark, sf_dir)
    station_target = scratch_path(spark, "tables", "station_statistics")
    line_target = scratch_path(spark, "tables", "line_statistics")
    run_id = line_target.rsplit("/", 1)[-1]
    q = stream.start_station_and_line_flow(
        lines, station_target, line_target, "update", "stream_line_rollup",
        checkpoint=stream.checkpoint_location(spark, "stream_line_rollup", run_id),
        trigger={"availableNow": True})
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    out = read_table(spark, line_target)
    return _minute_text(out.select("minute", "lineID", "total_flow", "exit_count", "entry_count"))


def _inout_stream_run(spark, sf_dir, name):
    lines = events_line_stream(spark, sf_dir)
    station_target = scratch_path(spark, "tables", "inout_station_stats")
    line_target = scratch_path(spark, "tables", "inout_line_stats")
    run_id = line_target.rsplit("/", 1)[-1]
    q = stream.start_inout_flow(lines, station_target, line_target, "append", name,
                                checkpoint=stream.checkpoint_location(spark, name, run_id),
                                trigger={"availableNow": True})
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return station_target, line_target


def stream_inout_line_append(spark, sf_dir):
    """The hand-written consumer's line table, a minute saved
    once complete."""
    _, line_target = _inout_stream_run(spark, sf_dir, "stream_inout_line_append")
    return read_table(spark, line_target).select("minute", "lineID", "in_count", "out_count",
                                                 "total_count")


def stream_inout_rejects(spark, sf_dir):
    """T13 for the hand-written consumer: its skipped messages and those
    whose minute is no time."""
    target = scratch_path(spark, "tables", "inout_rejects")
    q = stream.start_inout_rejects(events_line_stream(spark, sf_dir), target, "stream_inout_rejects",
                                   trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(target)


def _sliced_stream(spark, sf_dir, name, slice_of, again, watermark, **options):
    """The messages of all ``events`` in four slices that arrive one after
    the other, each as micro-batches of their own; ``again``: the first slice
    arrives once more at the end.  T7's state settings are on."""
    raw = _raw(spark, sf_dir).withColumn("_slice", slice_of)
    folder = scratch_path(spark, "stream-slices")
    target = scratch_path(spark, "tables", name)
    before = {k: spark.conf.get(k, None) for k in stream.STATE_CONF}
    stream.configure_state(spark)
    try:
        for k in (0, 1, 2, 3, *((0,) if again else ())):
            to_line(raw.where(F.col("_slice") == k)).write.mode("append").text(folder)
            q = stream.start_minute_flow(text_line_stream(spark, folder), target, stream.LINE_KEYS, "update",
                                         name, trigger={"availableNow": True}, watermark=watermark, **options)
            q.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    out = read_table(spark, target)
    return _minute_text(out.select("minute", *stream.LINE_KEYS, "total_flow", "exit_count", "entry_count"))


def stream_multi_batch_update(spark, sf_dir):
    """Every minute comes in several micro-batches and is emitted
    anew with each."""
    any_slice = F.pmod(F.xxhash64("time", "userID", "deviceID"), F.lit(4))
    return _sliced_stream(spark, sf_dir, "stream_multi_batch_update", any_slice, False, "60 days")


def stream_late_rows(spark, sf_dir):
    """The first week's messages come a second time, weeks behind the
    watermark, and change nothing."""
    week = F.least(F.lit(3), F.floor((F.dayofmonth(F.to_date("service_date")) - 1) / 8))
    return _sliced_stream(spark, sf_dir, "stream_late_rows", week, True, stream.WATERMARK_DELAY)


def upsert_compacted_live(spark, sf_dir):
    """Day folders that the stream folds behind its watermark while
    it goes on writing, and whose updates it deletes at once."""
    # Each half month in two arrivals, so that a day gets two updates at least before it closes.
    half = F.when(F.dayofmonth(F.to_date("service_date")) <= 15, 0).otherwise(2)
    part = half + F.pmod(F.xxhash64("time", "userID", "deviceID"), F.lit(2))
    return _sliced_stream(spark, sf_dir, "upsert_compacted_live", part, False, "16 days",
                          grace=0.0)


def stream_rejects(spark, sf_dir):
    """Rejected messages of the stream, written by a file sink."""
    lines = events_line_stream(spark, sf_dir)
    target = scratch_path(spark, "tables", "stream_rejects")
    run_id = target.rsplit("/", 1)[-1]
    q = stream.start_rejects(lines, target, "stream_rejects",
                             checkpoint=stream.checkpoint_location(spark, "stream_rejects", run_id),
                             trigger={"availableNow": True})
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(target)


QUERIES: dict[str, Query] = {
    "swipe_scan": swipe_scan,
    "raw_csv_roundtrip": raw_csv_roundtrip,
    "quality_null_counts": quality_null_counts,
    "quality_report": quality_report,
    "quality_report_text": quality_report_text,
    "clean_records": clean_records,
    "rejected_records": rejected_records,
    "clean_roundtrip": clean_roundtrip,
    "halfhour_flow": halfhour_flow,
    "halfhour_flow_by_line": halfhour_flow_by_line,
    "line_direction_series": line_direction_series,
    "week_comparison": week_comparison,
    "station_flow_daily": station_flow_daily,
    "station_top10": station_top10,
    "line_flow_daily_with_total": line_flow_daily_with_total,
    "line_flow_pivot": line_flow_pivot,
    "paytype_distribution": paytype_distribution,
    "service_day_span": service_day_span,
    "decoded_records": decoded_records,
    "parse_lines_strict": parse_lines_strict,
    "parse_lines_lax": parse_lines_lax,
    "minute_flow_line": minute_flow_line,
    "minute_flow_station": minute_flow_station,
    "inout_minute_line": inout_minute_line,
    "inout_minute_station": inout_minute_station,
    "ingest_profile": ingest_profile,
    "live_series_line": live_series_line,
    "live_series_station": live_series_station,
    "rowkey_cells_line": rowkey_cells_line,
    "rowkey_cells_station": rowkey_cells_station,
    "inout_cells_line": inout_cells_line,
    "inout_cells_station": inout_cells_station,
    "upsert_latest_wins": upsert_latest_wins,
    "stream_minute_line_update": stream_minute_line_update,
    "stream_minute_station_update": stream_minute_station_update,
    "stream_minute_line_append": stream_minute_line_append,
    "stream_line_rollup": stream_line_rollup,
    "stream_inout_line_append": stream_inout_line_append,
    "stream_rejects": stream_rejects,
    "clean_rerun": clean_rerun,
    "daily_files_scan": daily_files_scan,
    "halfhour_flow_in_order": halfhour_flow_in_order,
    "station_flow_in_order": station_flow_in_order,
    "live_series_station_selected": live_series_station_selected,
    "upsert_new_writer": upsert_new_writer,
    "stream_inout_rejects": stream_inout_rejects,
    "stream_multi_batch_update": stream_multi_batch_update,
    "stream_late_rows": stream_late_rows,
    "stream_chained_rollup": stream_chained_rollup,
    "upsert_compacted_live": upsert_compacted_live,
    "daily_files_malformed": daily_files_malformed,
    "stream_shared_parse": stream_shared_parse,
    "clean_incremental": clean_incremental,
    "quality_observed": quality_observed,
    "cells_in_key_order": cells_in_key_order,
    "week_comparison_pruned": week_comparison_pruned,
    "stream_state_left": stream_state_left,
}
