"""Per-minute flows (G13-G15, P7, P8, P13) and the ingest profile of a
day's messages (G17, W3, W4).

Two counting rules exist in the studied code and both are kept:

* ``minute_flow_*`` (the Structured Streaming consumer): ``total_flow``
  counts every parsed row, ``exit_count`` / ``entry_count`` status 0 / 1;
* ``inout_minute_*`` (the hand-written consumer): only status "0"/"1" are
  counted, total = in + out, but an unknown status still creates the key
  with zeros.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.labels import station_key
from ..functions.time import minute_key, minute_start, parse_time


def _flow_aggs():
    return (F.count(F.lit(1)).alias("total_flow"),
            F.count_if(F.col("status") == 0).alias("exit_count"),
            F.count_if(F.col("status") == 1).alias("entry_count"))


def minute_flow(records: DataFrame, keys=("lineID",)) -> DataFrame:
    """Per minute and ``keys``: total, exit and entry counts.
    ``records`` are strictly parsed rows (``event_ts``, int ``status``)."""
    df = records.filter(F.col("event_ts").isNotNull())
    return (df.groupBy(minute_start("event_ts").alias("minute"), *keys)
              .agg(*_flow_aggs()))


def minute_flow_line(records: DataFrame) -> DataFrame:
    return minute_flow(records, ("lineID",))


def minute_flow_station(records: DataFrame) -> DataFrame:
    return minute_flow(records, ("lineID", "stationID"))


def _inout_aggs():
    s = F.col("status")
    inc = F.count_if(s == "1")
    outc = F.count_if(s == "0")
    return (inc.alias("in_count"), outc.alias("out_count"), (inc + outc).alias("total_count"))


def inout_minute_line(lax: DataFrame) -> DataFrame:
    """Per minute key ("yyyy-MM-dd HH:mm") and line; ``lax`` is the
    output of ``sources.lines.parse_lax`` (valid rows)."""
    return lax.groupBy("minute", "lineID").agg(*_inout_aggs())


def inout_minute_station(lax: DataFrame) -> DataFrame:
    """Per minute key and station key "line-station"."""
    agg = lax.groupBy("minute", "lineID", "stationID").agg(*_inout_aggs())
    return agg.select("minute", "lineID", "stationID",
                      station_key("lineID", "stationID").alias("station_key"),
                      "in_count", "out_count", "total_count")


def ingest_profile(raw: DataFrame, time_col: str = "time", day_col: str = "service_date") -> DataFrame:
    """Records per minute key of each day's file, the running
    number of records sent and the gap to the previous minute.

    Only minute keys that parse as a time take part (the studied producer
    fails on any other), so a day's window partition holds one row per
    valid minute key of that day's file (1,440 when its rows are from its
    own day), never the records, whatever the input size."""
    minute = minute_key(F.trim(F.col(time_col)))
    minute_ts = parse_time(F.concat(minute, F.lit(":00")))
    agg = (raw.filter(minute_ts.isNotNull())
              .groupBy(F.col(day_col).alias("service_date"), minute.alias("minute"))
              .agg(F.count(F.lit(1)).alias("records")))
    w = W.partitionBy("service_date").orderBy("minute")
    ts = parse_time(F.concat(F.col("minute"), F.lit(":00")))
    prev = F.lag(ts).over(w)
    gap_ms = F.coalesce((F.unix_micros(ts) - F.unix_micros(prev)) / 1000, F.lit(0)).cast("bigint")
    return agg.select(
        "service_date", "minute", "records",
        F.sum("records").over(w.rowsBetween(W.unboundedPreceding, 0)).cast("bigint").alias("sent_total"),
        gap_ms.alias("gap_ms"),
    )
