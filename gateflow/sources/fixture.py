"""Swipe records derived from the supplied ``events`` table (FIXTURES §4).

``events(event_id, ts, user_id, ...)`` is projected onto the seven swipe
columns.  The faulty variant injects every kind of defect the cleaning job
handles (bad time, line, station, status, missing pay type, duplicates); the
rules below are the fixture's definition and are mirrored in the DuckDB
oracle.  Every row of ``events`` is used; the modulo tests only choose which
rows get a defect or a duplicate copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_COLUMNS, Period

# The events table covers January 2024; the fixture's period is days 1..25.
FIXTURE_PERIOD = Period(month="2024-01", first_day=1, last_day=25)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _base(events: DataFrame, faults: bool) -> DataFrame:
    eid, uid, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    time_text = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    line = F.element_at(F.array(*[F.lit(c) for c in "ABC"]), (eid % 3 + 1).cast("int"))
    station = (uid % 81).cast("string")
    status = (eid % 2).cast("string")
    pay = (F.floor(eid / 2) % 4).cast("string")
    if faults:
        time_text = F.when(eid % 71 == 0, F.lit("2024-01-32 00:00:00")).otherwise(time_text)
        line = F.when(eid % 89 == 0, F.lit("D")).otherwise(line)
        station = (F.when(eid % 83 == 0, F.lit("99"))
                   .when(eid % 79 == 0, F.lit("x")).otherwise(station))
        status = F.when(eid % 73 == 0, F.lit("7")).otherwise(status)
        pay = F.when(eid % 97 == 0, F.lit(None).cast("string")).otherwise(pay)
    return events.select(
        eid.alias("event_id"),
        F.date_format(ts, "yyyy-MM-dd").alias("service_date"),
        time_text.alias("time"),
        line.alias("lineID"),
        station.alias("stationID"),
        (eid % 500).cast("string").alias("deviceID"),
        status.alias("status"),
        F.concat(F.lit("U"), uid.cast("string")).alias("userID"),
        pay.alias("payType"),
    )


def raw_swipes(events: DataFrame, faults: bool = True) -> DataFrame:
    """Raw layer: ``service_date`` + seven string columns.  With ``faults``
    every 50th event is sent twice (an exact duplicate in the same day)."""
    base = _base(events, faults)
    cols = ["service_date", *RAW_COLUMNS]
    if not faults:
        return base.select(*cols)
    # Fault injection, not a subset: all rows pass, some twice.
    copies = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return base.select(*cols, F.explode(copies).alias("_copy")).select(*cols)


def raw_swipes_from_dir(spark: SparkSession, sf_dir: str, faults: bool = True) -> DataFrame:
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return raw_swipes(events, faults)
