"""Per-minute line and station flow on a stream.

Message text -> strict native parse -> minute -> watermark -> 1-minute
tumbling window per key -> ``foreachBatch`` keyed upsert.  Each query has a
name and its own checkpoint folder under the shared folder, so a restart
resumes instead of re-reading (the studied consumer gets a fresh random
folder on every start).  State is bounded by the watermark: a minute's
groups leave the state store once the watermark passes the window end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import shared_dir
from ..sinks.upsert import FOLD_GRACE, LiveFolding, batch_facts, read_table, upsert, upsert_batch_writer, writer_id
from ..functions.labels import station_key
from ..functions.time import parse_time
from ..sources.lines import (
    STRICT_RECORD_COLUMNS, minute_records, minute_rejects, parse_strict, strict_records, strict_rejects)

# --- fixed values: stream settings of the studied consumer ------------------
WATERMARK_DELAY = "1 minute"
WINDOW_LENGTH = "1 minute"
# spark.sql.streaming.* values it sets.
STATE_CONF = {
    "spark.sql.streaming.minBatchesToRetain": "100",
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "10",
}
# -----------------------------------------------------------------------------

# For many keys per minute at cluster scale the state belongs in RocksDB
# (off-heap, incremental checkpoints) rather than the JVM heap.
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

LINE_KEYS = ("lineID",)
# Sink tables are partitioned by the day of the window start.  A long-running
# stream whose micro-batches cover minutes takes HOURLY_PARTITIONS, so that a
# reader of the last hours opens those only; a back-fill of many days in
# one batch is faster with day partitions (fewer, larger files).
SINK_PARTITIONS = ["day"]
HOURLY_PARTITIONS = ["day", "hour"]
STATION_KEYS = ("lineID", "stationID")


def configure_state(spark: SparkSession, rocksdb: bool = False) -> None:
    """Retention and snapshot settings (state store provider must be
    chosen before the first start of a query)."""
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    if rocksdb:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def parsed_records(lines: DataFrame) -> DataFrame:
    """valid strictly parsed rows."""
    return strict_records(lines)


def rejected_records(lines: DataFrame) -> DataFrame:
    """Messages that fail the strict parse, with the reason."""
    return strict_rejects(lines)


def windowed_minute_flow(records: DataFrame, keys: Sequence[str] = LINE_KEYS,
                         watermark: str = WATERMARK_DELAY) -> DataFrame:
    """1-minute tumbling counts per key with a watermark.
    ``day`` and ``hour`` are carried for partitioning the sink."""
    minute = F.date_trunc("minute", F.col("event_ts"))
    df = records.withColumn("minute", minute).withWatermark("minute", watermark)
    agg = (df.groupBy(F.window("minute", WINDOW_LENGTH), *keys)
             .agg(F.count(F.lit(1)).alias("total_flow"),
                  F.count_if(F.col("status") == 0).alias("exit_count"),
                  F.count_if(F.col("status") == 1).alias("entry_count")))
    return agg.select(F.col("window.start").alias("minute"), *keys,
                      "total_flow", "exit_count", "entry_count",
                      F.date_format(F.col("window.start"), "yyyy-MM-dd").alias("day"),
                      F.date_format(F.col("window.start"), "HH").alias("hour"))


def passed_partitions(minute: Column, delay: str, partition_by: Sequence[str]) -> list[Column]:
    """The partition values that ``delay`` before a row's minute falls in:
    partitions below the greatest of them are behind the watermark."""
    behind = minute - F.expr(f"interval {delay}")
    known = {"day": F.date_format(behind, "yyyy-MM-dd"), "hour": F.date_format(behind, "HH")}
    return [known[c] for c in partition_by]


def checkpoint_location(spark: SparkSession, query_name: str, run_id: str | None = None,
                        target: str | None = None) -> str:
    """A query's checkpoint folder under the shared folder.  ``target`` keeps
    queries of one name that write to different tables apart."""
    tag = hashlib.sha1(target.encode()).hexdigest()[:16] if target else run_id
    base = f"{shared_dir(spark)}/streams/{query_name}"
    return base if tag is None else f"{base}/{tag}"


def start_minute_flow(lines: DataFrame, target: str, keys: Sequence[str] = LINE_KEYS,
                      output_mode: str = "update", query_name: str = "minute_flow_line",
                      checkpoint: str | None = None, trigger: dict | None = None,
                      watermark: str = WATERMARK_DELAY,
                      partition_by=SINK_PARTITIONS, grace: float = FOLD_GRACE) -> StreamingQuery:
    """Start one minute-flow query writing into the keyed
    table at ``target`` (partitioned by day).  ``update`` re-emits every
    changed window (T4/T12); ``append`` emits a window once the watermark
    has closed it (T11).  Partitions behind the watermark are folded as the
    stream goes on; what that replaced is deleted ``grace`` seconds later."""
    return start_record_flow(parsed_records(lines), target, keys, output_mode, query_name, checkpoint, trigger,
                             watermark, partition_by, grace)


def start_record_flow(records: DataFrame, target: str, keys: Sequence[str] = LINE_KEYS,
                      output_mode: str = "update", query_name: str = "minute_flow_line",
                      checkpoint: str | None = None, trigger: dict | None = None,
                      watermark: str = WATERMARK_DELAY,
                      partition_by=SINK_PARTITIONS, grace: float = FOLD_GRACE) -> StreamingQuery:
    """``start_minute_flow`` for a stream of parsed records."""
    return _start_keyed(windowed_minute_flow(records, keys, watermark), target, ["minute", *keys], output_mode,
                        query_name, checkpoint, trigger, watermark, partition_by, grace)


def _start_keyed(flow: DataFrame, target: str, keys: Sequence[str], output_mode: str, query_name: str,
                 checkpoint: str | None, trigger: dict | None, watermark: str, partition_by, grace: float
                 ) -> StreamingQuery:
    spark = flow.sparkSession
    checkpoint = checkpoint or checkpoint_location(spark, query_name, target=target)
    writer = upsert_batch_writer(target, keys, partition_by=partition_by, writer=writer_id(spark, checkpoint),
                                 passed=passed_partitions(F.col("minute"), watermark, partition_by), grace=grace)
    trig = trigger or {"processingTime": "0 seconds"}
    return (flow.writeStream
                .queryName(query_name)
                .outputMode(output_mode)
                .option("checkpointLocation", checkpoint)
                .foreachBatch(writer)
                .trigger(**trig)
                .start())


def chained_line_flow(records: DataFrame, watermark: str = WATERMARK_DELAY) -> DataFrame:
    """Line windows chained onto station windows.  Two stateful
    aggregates in one query, for append mode: a station window that the
    watermark closes goes on, by its ``window_time``, into the window of its
    line, so that neither a table nor a micro-batch is read back."""
    df = records.withColumn("minute", F.date_trunc("minute", F.col("event_ts"))).withWatermark("minute", watermark)
    stations = (df.groupBy(F.window("minute", WINDOW_LENGTH), *STATION_KEYS)
                  .agg(F.count(F.lit(1)).alias("total_flow"),
                       F.count_if(F.col("status") == 0).alias("exit_count"),
                       F.count_if(F.col("status") == 1).alias("entry_count")))
    lines = (stations.groupBy(F.window(F.window_time("window"), WINDOW_LENGTH), *LINE_KEYS)
                     .agg(*(F.sum(c).alias(c) for c in ("total_flow", "exit_count", "entry_count"))))
    start = F.col("window.start")
    return lines.select(start.alias("minute"), *LINE_KEYS, "total_flow", "exit_count", "entry_count",
                        F.date_format(start, "yyyy-MM-dd").alias("day"), F.date_format(start, "HH").alias("hour"))


def start_chained_line_flow(lines: DataFrame, target: str, query_name: str = "chained_line_flow",
                            checkpoint: str | None = None, trigger: dict | None = None,
                            watermark: str = WATERMARK_DELAY, partition_by=SINK_PARTITIONS,
                            grace: float = FOLD_GRACE) -> StreamingQuery:
    """The line table of ``chained_line_flow``."""
    return _start_keyed(chained_line_flow(parsed_records(lines), watermark), target, ["minute", *LINE_KEYS], "append",
                        query_name, checkpoint, trigger, watermark, partition_by, grace)


def line_rollup(stations: DataFrame) -> DataFrame:
    """Line totals of a minute = sums over its stations (counts add up)."""
    return (stations.groupBy("minute", "lineID", "day", "hour")
            .agg(F.sum("total_flow").alias("total_flow"),
                 F.sum("exit_count").alias("exit_count"),
                 F.sum("entry_count").alias("entry_count"))
            .select("minute", "lineID", "total_flow", "exit_count", "entry_count", "day", "hour"))


def rollup_writer(station_target: str, line_target: str, station_keys, line_keys, rollup,
                  from_batch: bool = False, partition_by=SINK_PARTITIONS, writer: str = "0",
                  passed: Sequence[Column] | None = None, grace: float = FOLD_GRACE):
    """``foreachBatch`` for T8 with one source read: upsert the changed
    station windows, then rebuild the line rows of the touched minutes from
    the station table (all stations of those minutes, also ones unchanged in
    this batch) and upsert them.  Only the touched partitions of the station
    table are listed and read.  A replay writes the same rows again.

    ``from_batch``: in append mode a closed minute leaves the state store
    with all its keys in one micro-batch, so its line rows come from the
    batch itself and the station table is not read back."""
    folding = [LiveFolding(t, partition_by, writer, grace) for t in (station_target, line_target)] if passed else []

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        batch_df.persist()
        try:
            n, touched, bound = batch_facts(batch_df, partition_by, passed)
            if not n:
                return
            upsert(batch_df, station_target, list(station_keys), batch_id, partition_by,
                   unique_keys=True, writer=writer)
            if from_batch:
                stations = batch_df
            else:
                parts = [dict(zip(partition_by, v)) for v in touched]
                stations = (read_table(spark, station_target, partitions=parts)
                            .join(batch_df.select("minute").distinct(), "minute", "left_semi"))
            upsert(rollup(stations), line_target, list(line_keys), batch_id, partition_by,
                   unique_keys=True, writer=writer)
            for f in folding:
                f.after_batch(spark, touched, bound, batch_id)
        finally:
            batch_df.unpersist()

    return write


def station_and_line_writer(station_target: str, line_target: str, from_batch: bool = False,
                            partition_by=SINK_PARTITIONS, writer: str = "0", **folding):
    return rollup_writer(station_target, line_target, ["minute", *STATION_KEYS],
                         ["minute", *LINE_KEYS], line_rollup, from_batch, partition_by, writer, **folding)


def start_station_and_line_flow(lines: DataFrame, station_target: str, line_target: str,
                                output_mode: str = "update",
                                query_name: str = "station_and_line_flow",
                                checkpoint: str | None = None, trigger: dict | None = None,
                                watermark: str = WATERMARK_DELAY,
                                partition_by=SINK_PARTITIONS, grace: float = FOLD_GRACE) -> StreamingQuery:
    """T8 as one query: the source is read and parsed once and one state
    store holds the station windows; line totals are derived per batch."""
    spark = lines.sparkSession
    flow = windowed_minute_flow(parsed_records(lines), STATION_KEYS, watermark)
    trig = trigger or {"processingTime": "0 seconds"}
    checkpoint = checkpoint or checkpoint_location(spark, query_name, target=station_target)
    return (flow.writeStream
                .queryName(query_name)
                .outputMode(output_mode)
                .option("checkpointLocation", checkpoint)
                .foreachBatch(station_and_line_writer(station_target, line_target,
                                                      from_batch=output_mode == "append",
                                                      partition_by=partition_by,
                                                      writer=writer_id(spark, checkpoint),
                                                      passed=passed_partitions(F.col("minute"), watermark, partition_by),
                                                      grace=grace))
                .trigger(**trig)
                .start())


# The hand-written consumer saves a minute when the next one arrives.
INOUT_WATERMARK = "0 seconds"


def windowed_inout_flow(records: DataFrame, watermark: str = INOUT_WATERMARK) -> DataFrame:
    """K8/T11 with the hand-written consumer's counting rule (G15): per
    minute key and station, in = status "1", out = status "0", total =
    in + out.  ``records``: from ``minute_records``; messages whose minute is
    no time are in ``minute_rejects`` (``start_inout_rejects``)."""
    df = records.withWatermark("minute_ts", watermark)
    s = F.col("status")
    agg = (df.groupBy(F.window("minute_ts", WINDOW_LENGTH), "lineID", "stationID")
             .agg(F.count_if(s == "1").alias("in_count"), F.count_if(s == "0").alias("out_count")))
    start = F.col("window.start")
    return agg.select(F.date_format(start, "yyyy-MM-dd HH:mm").alias("minute"), "lineID", "stationID",
                      station_key("lineID", "stationID").alias("station_key"),
                      "in_count", "out_count",
                      (F.col("in_count") + F.col("out_count")).alias("total_count"),
                      F.date_format(start, "yyyy-MM-dd").alias("day"),
                      F.date_format(start, "HH").alias("hour"))


def inout_line_rollup(stations: DataFrame) -> DataFrame:
    return (stations.groupBy("minute", "lineID", "day", "hour")
            .agg(F.sum("in_count").alias("in_count"), F.sum("out_count").alias("out_count"),
                 F.sum("total_count").alias("total_count"))
            .select("minute", "lineID", "in_count", "out_count", "total_count", "day", "hour"))


def start_inout_flow(lines: DataFrame, station_target: str, line_target: str,
                     output_mode: str = "append", query_name: str = "inout_flow",
                     checkpoint: str | None = None, trigger: dict | None = None,
                     watermark: str = INOUT_WATERMARK,
                     partition_by=SINK_PARTITIONS, grace: float = FOLD_GRACE) -> StreamingQuery:
    """The hand-written consumer as one query: lax parse, a minute is saved
    with all its keys once the next one arrives (append), line rows rolled up
    from the station rows of the same minutes."""
    spark = lines.sparkSession
    flow = windowed_inout_flow(minute_records(lines), watermark)
    trig = trigger or {"processingTime": "0 seconds"}
    checkpoint = checkpoint or checkpoint_location(spark, query_name, target=station_target)
    return (flow.writeStream
                .queryName(query_name)
                .outputMode(output_mode)
                .option("checkpointLocation", checkpoint)
                .foreachBatch(rollup_writer(station_target, line_target,
                                            ["minute", "lineID", "stationID"], ["minute", "lineID"],
                                            inout_line_rollup,
                                            from_batch=output_mode == "append",
                                            partition_by=partition_by,
                                            writer=writer_id(spark, checkpoint),
                                            passed=passed_partitions(F.to_timestamp("minute", "yyyy-MM-dd HH:mm"),
                                                                     watermark, partition_by), grace=grace))
                .trigger(**trig)
                .start())


def start_rejects(lines: DataFrame, target: str, query_name: str = "stream_rejects",
                  checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Rejected messages to their own append-only file table (the
    file sink's log makes replays exactly-once)."""
    return _append(rejected_records(lines), target, query_name, checkpoint, trigger)


def start_inout_rejects(lines: DataFrame, target: str, query_name: str = "inout_rejects",
                        checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """T13 for the hand-written consumer: messages that its lax parse skips
    and those whose minute is no time, so that saved rows, rejects and the
    open minute together are all messages."""
    return _append(minute_rejects(lines), target, query_name, checkpoint, trigger)


# Messages are read and parsed once, into a streaming table that
# the flow and the rejects read, each its own partition of it.
PARSED_SCHEMA = "raw string, time string, lineID string, stationID int, deviceID int, status int, userID string, " \
                "payType int, event_ts timestamp, reject_reason string, is_valid boolean"


def start_parse(lines: DataFrame, target: str, query_name: str = "parsed_messages",
                checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Every message, parsed, into a file table partitioned by ``is_valid``."""
    parsed = parse_strict(lines).withColumn("raw", F.when(~F.col("is_valid"), F.col("raw")))
    spark = lines.sparkSession
    return (parsed.writeStream
                .queryName(query_name)
                .outputMode("append")
                .format("parquet")
                .partitionBy("is_valid")
                .option("path", target)
                .option("checkpointLocation", checkpoint or checkpoint_location(spark, query_name, target=target))
                .trigger(**(trigger or {"processingTime": "0 seconds"}))
                .start())


def parsed_stream(spark: SparkSession, target: str, valid: bool) -> DataFrame:
    """The valid records, or the rejects, of the table of ``start_parse`` as a
    stream.  The table's own log says which files count, so a message arrives
    once even if the parse was stopped inside a write."""
    rows = spark.readStream.schema(PARSED_SCHEMA).parquet(target).where(F.col("is_valid") == valid)
    return rows.select(*STRICT_RECORD_COLUMNS) if valid else rows.select("raw", "reject_reason")


def start_parsed_rejects(spark: SparkSession, parsed: str, target: str, query_name: str = "parsed_rejects",
                         checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """T13 from the parsed table."""
    return _append(parsed_stream(spark, parsed, False), target, query_name, checkpoint, trigger)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows that a minute-flow query of line keys keeps in
    its state: those that the watermark has not closed.  Read with the state
    data source from the query's checkpoint."""
    state = spark.read.format("statestore").load(checkpoint)
    # Aggregation buffers are in the order of the aggregates, under names that repeat; a cast goes by place.
    counts = F.col("value").cast("struct<total_flow: bigint, exit_count: bigint, entry_count: bigint>")
    return state.select(F.col("key.window.start").alias("minute"), F.col("key.lineID").alias("lineID"),
                        counts.alias("counts")).select("minute", "lineID", "counts.*")


def _append(rows: DataFrame, target: str, query_name: str, checkpoint: str | None,
            trigger: dict | None) -> StreamingQuery:
    return (rows.writeStream
                .queryName(query_name)
                .outputMode("append")
                .format("parquet")
                .option("path", target)
                .option("checkpointLocation",
                        checkpoint or checkpoint_location(rows.sparkSession, query_name, target=target))
                .trigger(**(trigger or {"processingTime": "0 seconds"}))
                .start())


def await_all(spark: SparkSession, queries: Sequence[StreamingQuery],
              poll_seconds: int = 5) -> None:
    """Wait for every query; the first failure stops the others and is
    raised (waiting on one query after another would hide a failure of the
    second while the first runs)."""
    pending = list(queries)
    try:
        while pending:
            for q in list(pending):
                q.awaitTermination(poll_seconds)        # raises if the query has failed
                if not q.isActive:
                    pending.remove(q)
    finally:
        for other in pending:
            other.stop()


def console_batch_writer(keys: Sequence[str]):
    """Print every row of each micro-batch's per-key totals in key
    order, one partition of them at a time."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        print("|".join(batch_df.columns))
        for row in batch_df.orderBy(*keys).toLocalIterator():
            print("|".join(map(str, row)))

    return write


def run_to_completion(lines: DataFrame, target: str, keys: Sequence[str] = LINE_KEYS,
                      output_mode: str = "update", query_name: str = "minute_flow_line",
                      run_id: str | None = None, **options) -> DataFrame:
    """Process everything available now (T6 for tests and back-fills) and
    return the keyed table as a batch DataFrame."""
    spark = lines.sparkSession
    q = start_minute_flow(lines, target, keys, output_mode, query_name,
                          checkpoint=checkpoint_location(spark, query_name, run_id),
                          trigger={"availableNow": True}, **options)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return read_table(spark, target)
