"""The five batch analyses as single grouped plans (G7-G12, G16, W1, W2,
O1-O3, O5, J1-J3, C1-C5).

The studied programs loop over days, lines and directions and start one job
per combination (22 scans in the week comparison, 48 jobs for the line
table).  Here each analysis is one scan and one aggregation with more
grouping keys.  All inputs are the typed clean records of
``operators.records.typed``.  Every aggregate is a partial + final hash
aggregate: the shuffle carries at most one row per group per map task, so
the shuffle volume does not grow with the row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.time import day_label, half_hour_start
from ..schemas import (DIRECTION_IN_OUT, LINES, PAY_TYPE_LABELS, TOTAL_LABEL, WEEK_BASE_DAY,
                       WEEK_GROUPS, Period)
from .records import for_days

_DIRECTION_CODES = [code for _, code in DIRECTION_IN_OUT]


def _slot_minutes(ts: str = "event_ts"):
    """Minutes since midnight of the 30-minute window start."""
    start = half_hour_start(ts)
    return F.hour(start) * 60 + F.minute(start)


def _hhmm(minutes):
    return F.format_string("%02d:%02d", F.floor(minutes / 60).cast("int"),
                           (minutes % 60).cast("int"))


def slot_label(minutes: str = "slot_minutes"):
    """P10: "HH:mm" of the slot start."""
    return _hhmm(F.col(minutes))


def midpoint_label(minutes: str = "slot_minutes"):
    """The plotted point, 15 minutes into the slot."""
    return _hhmm(F.col(minutes) + 15)


def halfhour_counts(typed: DataFrame, days=None, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Count per (service_date, slot, *extra_keys).  Labels are built after
    the aggregation, so the per-row work is integer arithmetic only."""
    df = for_days(typed, days).filter(F.col("event_ts").isNotNull())
    return (df.groupBy("service_date", _slot_minutes().alias("slot_minutes"), *extra_keys)
              .agg(F.count(F.lit(1)).alias("traffic_count")))


def halfhour_flow(typed: DataFrame, days=None) -> DataFrame:
    """Passengers per day and half-hour slot."""
    return (halfhour_counts(typed, days)
            .select("service_date", slot_label().alias("time_slot"), "traffic_count"))


def halfhour_flow_by_line(typed: DataFrame, days=None) -> DataFrame:
    """Per day, slot, line and direction ("In"/"Out").  A status
    that is neither 1 nor 0 belongs to no series and is left out."""
    df = typed.filter(F.col("status").isin(*_DIRECTION_CODES))
    return (halfhour_counts(df, days, ["lineID", "status"])
            .select("service_date", slot_label().alias("time_slot"), "lineID",
                    labels.in_out_label("status").alias("status"), "traffic_count"))


def line_direction_series(typed: DataFrame, days=None) -> DataFrame:
    """The six line x direction series per day, long form
    (series, x = slot midpoint, y = count)."""
    df = typed.filter(F.col("status").isin(*_DIRECTION_CODES))
    agg = halfhour_counts(df, days, ["lineID", "status"])
    return agg.select(
        "service_date",
        labels.line_direction_series("lineID", labels.in_out_label("status")).alias("series"),
        slot_label().alias("time_slot"),
        midpoint_label().alias("x"),
        F.col("traffic_count").alias("y"),
    )


def week_groups_frame(spark: SparkSession, period: Period,
                      groups: Sequence[tuple[int, int]] = WEEK_GROUPS,
                      base_day: int = WEEK_BASE_DAY) -> DataFrame:
    """(group_id, service_date); the base day belongs to every group.
    Its size is the parameter list (days x groups), never the data."""
    rows = []
    for first, last in groups:
        gid = f"{first:02d}_to_{last:02d}"
        rows.append((gid, period.day(base_day)))
        rows.extend((gid, period.day(d)) for d in range(first, last + 1) if d != base_day)
    return spark.createDataFrame(rows, "group_id string, service_date string")


def week_comparison(typed: DataFrame, period: Period,
                    groups: Sequence[tuple[int, int]] = WEEK_GROUPS,
                    base_day: int = WEEK_BASE_DAY) -> DataFrame:
    """For each week group, one half-hour series per day plus the base
    day; x = slot midpoint, y = count.  The day list prunes the scan; the
    parameter table is broadcast (bounded by the parameter list)."""
    spark = typed.sparkSession
    dim = week_groups_frame(spark, period, groups, base_day)
    days = sorted({period.day(base_day)}
                  | {period.day(d) for a, b in groups for d in range(a, b + 1)})
    agg = halfhour_counts(typed, days)
    return (agg.join(F.broadcast(dim), "service_date")
               .select("group_id",
                       "service_date",
                       day_label("service_date").alias("series"),
                       slot_label().alias("time_slot"),
                       midpoint_label().alias("x"),
                       F.col("traffic_count").alias("y")))


def week_comparison_by_table(typed: DataFrame, week_groups: DataFrame, groups: Sequence[str]) -> DataFrame:
    """``week_comparison`` with the groups from a dimension table
    (group_id, service_date).  The days of the named groups are found while
    the query runs and prune the scan of a layer that is partitioned by
    ``service_date``; no day list is written into the query.  The table has a
    row a day and group; the planner broadcasts it by its size."""
    dim = week_groups.where(F.col("group_id").isin(*groups))
    agg = halfhour_counts(typed.join(dim.select("service_date"), "service_date", "left_semi"))
    return agg.join(dim, "service_date").select("group_id", "service_date", day_label("service_date").alias("series"),
                      slot_label().alias("time_slot"), midpoint_label().alias("x"), F.col("traffic_count").alias("y"))


def station_counts(typed: DataFrame, days=None) -> DataFrame:
    """Passengers per day, line, station and status code."""
    return (for_days(typed, days)
            .groupBy("service_date", "lineID", "stationID", "status")
            .agg(F.count(F.lit(1)).alias("traffic_count")))


def _rank_window():
    # O3/W1 tie rule: higher count first, then lower station, then line.
    return (W.partitionBy("service_date", "status")
             .orderBy(F.desc("traffic_count"), F.asc("stationID"), F.asc("lineID")))


def station_flow_daily(typed: DataFrame, days=None, top_k: int = 10) -> DataFrame:
    """Station bars per day with the top-10 flag of their
    direction.  Ranking runs on the aggregate (at most days x lines x
    stations x 2 rows), never on the records."""
    agg = station_counts(typed, days)
    rank = F.when(F.col("status").isin(*_DIRECTION_CODES), F.row_number().over(_rank_window()))
    return agg.select(
        "service_date", "lineID", "stationID",
        labels.inflow_outflow_label("status").alias("status"),
        "traffic_count",
        F.coalesce(rank <= top_k, F.lit(False)).alias("is_top10"),
    )


def station_top10(typed: DataFrame, days=None, top_k: int = 10) -> DataFrame:
    """The top-k stations per day and direction.  The
    ``row_number() <= k`` filter becomes a WindowGroupLimit, which keeps
    only k rows per group before the window's own sort."""
    agg = (station_counts(typed, days)
           .filter(F.col("status").isin(*_DIRECTION_CODES)))
    ranked = agg.withColumn("rank", F.row_number().over(_rank_window()))
    return ranked.filter(F.col("rank") <= top_k).select(
        "service_date",
        labels.inflow_outflow_label("status").alias("status"),
        F.col("rank").cast("bigint").alias("rank"),
        "lineID", "stationID", "traffic_count",
        labels.station_key().alias("station_key"))


def line_day_counts(typed: DataFrame, days=None) -> DataFrame:
    """Passengers per day and line."""
    return (for_days(typed, days).groupBy("service_date", "lineID")
            .agg(F.count(F.lit(1)).alias("n")))


def line_flow_daily_with_total(typed: DataFrame, days=None) -> DataFrame:
    """G10 + G11: per-line rows and a "total" row per day.

    Grouping sets run on the per-line aggregate (a few rows per day), so the
    Expand operator never touches the records.  The label comes from
    ``grouping(lineID)``: a NULL line stays NULL, it does not become "total"."""
    per_line = line_day_counts(typed, days)
    sets = per_line.groupingSets([["service_date", "lineID"], ["service_date"]],
                                 "service_date", "lineID")
    out = sets.agg(F.sum("n").cast("bigint").alias("passenger_flow"),
                   F.grouping("lineID").alias("_g"))
    return out.select(
        "service_date",
        F.when(F.col("_g") == 1, F.lit(TOTAL_LABEL)).otherwise(F.col("lineID")).alias("lineID"),
        "passenger_flow")


def line_flow_pivot(typed: DataFrame, days=None, lines: Sequence[str] = LINES) -> DataFrame:
    """C4: one row per day, one column per line plus the day total (a pivot
    with the line list given, so no extra job discovers the values)."""
    per_line = line_day_counts(typed, days)
    cols = [F.coalesce(F.sum(F.when(F.col("lineID") == ln, F.col("n"))), F.lit(0))
            .cast("bigint").alias(ln) for ln in lines]
    return (per_line.groupBy("service_date")
            .agg(*cols, F.sum("n").cast("bigint").alias(TOTAL_LABEL)))


def paytype_distribution(typed: DataFrame, days=None) -> DataFrame:
    """Count and share per pay type over all days.

    The share window has no partition key; it runs on the aggregate, whose
    size is the number of distinct pay types (4 after cleaning).  The code
    dictionary is a fixed 4-row table, broadcast."""
    spark = typed.sparkSession
    agg = (for_days(typed, days)
           .groupBy(F.col("payType").cast("string").alias("pay_type"))
           .agg(F.count(F.lit(1)).alias("total_count")))
    share = F.col("total_count") / F.sum("total_count").over(W.partitionBy())
    dim = spark.createDataFrame(list(PAY_TYPE_LABELS), "pay_type string, pay_label string")
    return (agg.select("pay_type", "total_count", share.alias("share"))
               .join(F.broadcast(dim), "pay_type", "left")
               .select("pay_type", "pay_label", "total_count", "share"))


def day_span(typed: DataFrame) -> DataFrame:
    """First and last service day (``days.head`` / ``days.last``)."""
    return typed.agg(F.min("service_date").alias("first_day"),
                     F.max("service_date").alias("last_day"),
                     F.countDistinct("service_date").alias("days"))


def in_slot_order(df: DataFrame) -> DataFrame:
    """O1: slots ascending within a day (then line and direction when
    present).  Only for display: a global sort is one range-partitioned
    stage over the small result table."""
    extra = [c for c in ("lineID", "status", "series") if c in df.columns]
    return df.orderBy("service_date", "time_slot", *extra)


def in_station_order(df: DataFrame) -> DataFrame:
    """O2: stations ascending with a total order (the studied sort left
    ties between lines open)."""
    return df.orderBy("service_date", "stationID", "lineID", "status")
