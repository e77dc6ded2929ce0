"""Quality rules as named boolean columns (F2-F8).

Every rule reads the raw string columns and yields TRUE/FALSE, never NULL,
for a row without nulls, so ``abnormal`` and its complement together cover
every row (SURVEY §7.5 traps 1-3).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import LINES, PAY_TYPE_CODES, STATION_MAX, STATION_MIN, STATUS_CODES, Period

# Rule names in the order they are reported.
RULE_NAMES = ("bad_time", "bad_line", "bad_station", "bad_status", "bad_pay_type")


def rule_columns(period: Period) -> dict[str, Column]:
    """One boolean per rule; TRUE means the row breaks the rule."""
    station = F.col("stationID").try_cast("int")
    return {
        "bad_time": ~F.col("time").rlike(period.time_regex),
        "bad_line": ~F.col("lineID").isin(*LINES),
        # A station that is not a number breaks the rule (it is never lost).
        "bad_station": ~F.coalesce(station.between(STATION_MIN, STATION_MAX), F.lit(False)),
        # Status and pay type compare as text: "01" is not a status.
        "bad_status": ~F.col("status").isin(*STATUS_CODES),
        "bad_pay_type": ~F.col("payType").isin(*PAY_TYPE_CODES),
    }


def abnormal(period: Period) -> Column:
    """any rule broken."""
    rules = list(rule_columns(period).values())
    out = rules[0]
    for r in rules[1:]:
        out = out | r
    return out


def out_of_range(period: Period) -> Column:
    """F8: time text outside the period (string order, as the source does)."""
    return (F.col("time") < F.lit(period.lower_bound)) | (F.col("time") > F.lit(period.upper_bound))


def any_null(columns) -> Column:
    """TRUE when one of ``columns`` is NULL."""
    out = None
    for c in columns:
        e = F.col(c).isNull()
        out = e if out is None else (out | e)
    return out


def broken_rules(period: Period) -> Column:
    """Comma-separated names of the broken rules (the reject reason detail)."""
    rules = rule_columns(period)
    return F.concat_ws(",", *[F.when(rules[n], F.lit(n)) for n in RULE_NAMES])
