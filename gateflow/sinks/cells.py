"""Wide-column cells: row key + qualifier + text value (K6, K7).

A keyed wide-column store receives (row_key, qualifier, value) triples;
this module builds them as a long DataFrame so any connector (or a file
table) can take them.  All values are text, as in the studied puts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import jvm_timestamp_text

# --- fixed values: row-key layouts and qualifiers of the studied tables -----
# lines:           "<Timestamp.toString>_<line>", family cf
# stations:        "<Timestamp.toString>_<line>_<station>", family cf
# in/out lines:    "<yyyy-MM-dd HH:mm>-<line>", family stats
# in/out stations: "<yyyy-MM-dd HH:mm>-<line>-<station>", family stats
LINE_QUALIFIERS = ("time", "line_id", "total_flow", "exit_count", "entry_count")
STATION_QUALIFIERS = ("time", "line_id", "station_id", "total_flow", "exit_count", "entry_count")
INOUT_QUALIFIERS = ("in_count", "out_count", "total_count")
# -----------------------------------------------------------------------------


def write_in_key_order(cells: DataFrame, path: str, files: int) -> None:
    """O1/O2: cells as files that a keyed store can load: sorted by row key and
    qualifier (byte order, as such stores sort), about ``files`` files whose key
    ranges follow one another.  The rows are range-partitioned, so no task
    holds more than its range, and a row key's cells stay in one file."""
    (cells.repartitionByRange(files, "row_key").sortWithinPartitions("row_key", "qualifier")
          .write.mode("overwrite").parquet(path))


def _cells(df: DataFrame, row_key, values: dict) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(q).alias("qualifier"), v.cast("string").alias("value"))
                      for q, v in values.items()])
    return df.select(row_key.alias("row_key"), F.inline(pairs))


def line_cells(minute_line: DataFrame) -> DataFrame:
    ts = jvm_timestamp_text("minute")
    values = dict(zip(LINE_QUALIFIERS, [ts, F.col("lineID"), F.col("total_flow"),
                                        F.col("exit_count"), F.col("entry_count")]))
    return _cells(minute_line, F.concat_ws("_", ts, F.col("lineID")), values)


def station_cells(minute_station: DataFrame) -> DataFrame:
    ts = jvm_timestamp_text("minute")
    values = dict(zip(STATION_QUALIFIERS, [ts, F.col("lineID"), F.col("stationID"),
                                           F.col("total_flow"), F.col("exit_count"),
                                           F.col("entry_count")]))
    key = F.concat_ws("_", ts, F.col("lineID"), F.col("stationID").cast("string"))
    return _cells(minute_station, key, values)


def inout_line_cells(inout_line: DataFrame) -> DataFrame:
    values = {q: F.col(q) for q in INOUT_QUALIFIERS}
    return _cells(inout_line, F.concat_ws("-", F.col("minute"), F.col("lineID")), values)


def inout_station_cells(inout_station: DataFrame) -> DataFrame:
    values = {q: F.col(q) for q in INOUT_QUALIFIERS}
    return _cells(inout_station, F.concat_ws("-", F.col("minute"), F.col("station_key")), values)
