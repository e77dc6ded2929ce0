"""Record layouts, domains and dimension rows.

Raw layer: seven string columns, positional, never inferred.  Typed layer:
the same swipe with a parsed timestamp and integer codes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: these must equal the studied programs' values -------------
# Column names of a swipe record, in file order.
RAW_COLUMNS = ("time", "lineID", "stationID", "deviceID", "status", "userID", "payType")
# Timestamp text layout of the `time` column.
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
# Valid line codes.
LINES = ("A", "B", "C")
# Valid station numbers, inclusive.
STATION_MIN, STATION_MAX = 0, 80
# Status codes as they appear in the text: 0 = exit, 1 = entry.
STATUS_CODES = ("0", "1")
STATUS_LABELS = (("0", "exit"), ("1", "entry"))
# Pay-type codes and their meaning.
PAY_TYPE_CODES = ("0", "1", "2", "3")
PAY_TYPE_LABELS = (("0", "ordinary"), ("1", "student"), ("2", "senior"), ("3", "other"))
# Direction labels of the half-hour line table and of the station table.
DIRECTION_IN_OUT = (("In", 1), ("Out", 0))
DIRECTION_INFLOW, DIRECTION_OUTFLOW = "Inflow", "Outflow"
# Day-key label of the daily-total row next to the per-line rows.
TOTAL_LABEL = "total"
# Studied period: January 2019, days 1..25; week groups 05-11, 12-18, 19-25
# compared against day 01; line and station analyses use day 01 and 05-11.
STUDY_MONTH = "2019-01"
STUDY_FIRST_DAY, STUDY_LAST_DAY = 1, 25
WEEK_GROUPS = ((5, 11), (12, 18), (19, 25))
WEEK_BASE_DAY = 1
LINE_ANALYSIS_DAYS = (1, 5, 6, 7, 8, 9, 10, 11)
# Daily file name layout.
DAILY_FILE_REGEX = r"record_(\d{4}-\d{2}-\d{2})"
# -----------------------------------------------------------------------------

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

RAW_WITH_DAY_SCHEMA = T.StructType(
    [T.StructField("service_date", T.StringType(), True), *RAW_SCHEMA.fields])


@dataclass(frozen=True)
class Period:
    """The month and day range a data set covers; drives the time rules."""

    month: str = STUDY_MONTH          # "yyyy-MM"
    first_day: int = STUDY_FIRST_DAY
    last_day: int = STUDY_LAST_DAY

    @property
    def time_regex(self) -> str:
        # Fixed value: the studied time pattern.  Day 00..99 is accepted here on purpose; the range rule removes
        # impossible days afterwards.
        return r"^(" + self.month + r"-\d{2} (?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d)$"

    @property
    def lower_bound(self) -> str:
        return f"{self.month}-{self.first_day:02d} 00:00:00"

    @property
    def upper_bound(self) -> str:
        return f"{self.month}-{self.last_day:02d} 23:59:59"

    def day(self, d: int) -> str:
        return f"{self.month}-{d:02d}"

    def days(self, numbers=None) -> list[str]:
        nums = numbers if numbers is not None else range(self.first_day, self.last_day + 1)
        return [self.day(d) for d in nums]


STUDY_PERIOD = Period()
