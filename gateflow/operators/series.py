"""Long series tables behind the live charts.

Drawing is out of scope; what a chart plots is a (series, x, y) table.
The explode of a fixed 3-element array is a per-row generator, no join.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import ts_text
from ..schemas import LINES

# --- fixed values: series of the live line chart ----------------------------
# total flow -> "Line A", entries -> "Line A Entry", exits -> "Line A Exit";
# station chart types in / out / total -> "A-3 (in)" etc.
LINE_SERIES_SUFFIX = (("total_flow", ""), ("entry_count", " Entry"), ("exit_count", " Exit"))
STATION_TYPES = (("in", "in_count"), ("out", "out_count"), ("total", "total_count"))
# -----------------------------------------------------------------------------


def live_series_line(minute_line: DataFrame, lines: Iterable[str] = LINES) -> DataFrame:
    """(series, x = minute, y) for the known lines only."""
    df = minute_line.filter(F.col("lineID").isin(*lines))
    points = F.array(*[
        F.struct(F.concat(F.lit("Line "), F.col("lineID"), F.lit(sfx)).alias("series"),
                 F.col(measure).cast("bigint").alias("y"))
        for measure, sfx in LINE_SERIES_SUFFIX])
    return (df.select(ts_text("minute").alias("x"), F.inline(points))
              .select("series", "x", "y"))


def live_series_station(minute_station: DataFrame, line: str | None = None,
                        stations: Iterable[str] | None = None,
                        types: Iterable[str] | None = None) -> DataFrame:
    """(station_key, type, series, x = minute key, y); optional
    selection by line prefix, station keys and flow types."""
    df = minute_station
    if line is not None:
        df = df.filter(F.col("station_key").startswith(f"{line}-"))
    if stations is not None:
        df = df.filter(F.col("station_key").isin(*list(stations)))
    wanted = [t for t in STATION_TYPES if types is None or t[0] in set(types)]
    points = F.array(*[
        F.struct(F.lit(name).alias("type"), F.col(measure).cast("bigint").alias("y"))
        for name, measure in wanted])
    out = df.select("station_key", F.col("minute").alias("x"), F.inline(points))
    return out.select("station_key", "type",
                      F.format_string("%s (%s)", F.col("station_key"), F.col("type")).alias("series"),
                      "x", "y")
