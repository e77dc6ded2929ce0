"""Time expressions (P1, P2, P7-P9, P18, P20, P21; slot labels P10-P12 are
built from integer minutes in ``operators.flows``).

All are native Catalyst expressions, so they stay inside whole-stage codegen
and never throw under ANSI mode: unparsable text becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import TIME_PATTERN

MINUTE_KEY_PATTERN = "yyyy-MM-dd HH:mm"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(c, pattern: str = TIME_PATTERN) -> Column:
    """Text -> TIMESTAMP (session zone); NULL when it does not parse."""
    return F.try_to_timestamp(_col(c), F.lit(pattern))


def minute_start(ts) -> Column:
    """Truncate a timestamp to its minute."""
    return F.date_trunc("minute", _col(ts))


def minute_key(text) -> Column:
    """The minute as the first 16 characters of the time text
    ("yyyy-MM-dd HH:mm").  Shorter text gives NULL (a reject)."""
    c = _col(text)
    return F.when(F.length(c) >= 16, F.substring(c, 1, 16))


def half_hour_start(ts) -> Column:
    """Start of the 30-minute tumbling window holding ``ts``."""
    return F.window(_col(ts), "30 minutes").start


def day_label(service_date) -> Column:
    """P20: "MM-dd" series name of a day ("01-05")."""
    return F.substring(_col(service_date), 6, 5)


def ts_text(ts, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(_col(ts), pattern)


def jvm_timestamp_text(ts) -> Column:
    """K6: ``java.sql.Timestamp.toString`` of a whole-second value
    ("2019-01-01 06:00:00.0")."""
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss.S")
