"""Typed swipe records (P1, P3): the clean string layer with a parsed
timestamp and integer codes.  Casts are ``try_cast`` so ANSI mode never
aborts a job on a stray value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import PAY_TYPE_LABELS, STATUS_LABELS



def typed(clean: DataFrame) -> DataFrame:
    """Clean rows already match the fixed time layout (rule F2), so the
    cheap string -> timestamp cast replaces a pattern parse per row."""
    return clean.select(
        "service_date",
        F.col("time").try_cast("timestamp").alias("event_ts"),
        "lineID",
        F.col("stationID").try_cast("int").alias("stationID"),
        F.col("deviceID").try_cast("int").alias("deviceID"),
        F.col("status").try_cast("int").alias("status"),
        "userID",
        F.col("payType").try_cast("int").alias("payType"),
    )


def for_days(df: DataFrame, days=None) -> DataFrame:
    """Restrict to a list of ``service_date`` values (pruned at the scan
    when the input is the day-partitioned clean layer)."""
    return df if days is None else df.filter(F.col("service_date").isin(list(days)))


def with_labels(typed_df: DataFrame) -> DataFrame:
    """Decode status and pay type with the two code dictionaries.
    Both are fixed tables of 2 and 4 rows, so broadcasting them is bounded."""
    spark = typed_df.sparkSession
    status_dim = spark.createDataFrame(list(STATUS_LABELS), "_status_code string, status_label string")
    pay_dim = spark.createDataFrame(list(PAY_TYPE_LABELS), "_pay_code string, pay_label string")
    df = (typed_df
          .join(F.broadcast(status_dim), F.col("status").cast("string") == F.col("_status_code"), "left")
          .join(F.broadcast(pay_dim), F.col("payType").cast("string") == F.col("_pay_code"), "left"))
    return df.drop("_status_code", "_pay_code")
