"""Comma-separated stream messages.

A message is the seven swipe fields joined by commas.  Both parsers are
plain Catalyst expressions (split / trim / try_cast), so a stream keeps
whole-stage codegen and filter pushdown instead of leaving Tungsten for a
typed lambda.  Java's ``String.split(",")`` drops trailing empty fields; the
trailing commas are removed first to get the same field count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import minute_key, parse_time
from ..schemas import RAW_COLUMNS

INT_FIELDS = ("stationID", "deviceID", "status", "payType")


# Java String.trim() strips every char <= U+0020 at both ends; a char-set
# trim does the same without a regular expression.
_JAVA_WHITESPACE = "".join(chr(i) for i in range(0x21))


def _jtrim(c: Column) -> Column:
    return F.trim(c, F.lit(_JAVA_WHITESPACE))


def to_line(df: DataFrame, columns=RAW_COLUMNS) -> DataFrame:
    """Encode rows as one ``value`` string (NULL field -> empty)."""
    return df.select(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                        for c in columns]).alias("value"))


def _fields(value: Column) -> Column:
    return F.split(F.rtrim(value, F.lit(",")), ",")


def parse_strict(lines: DataFrame, value_col: str = "value", keep=(),
                 time_pattern: str | None = None) -> DataFrame:
    """P5: exactly 7 fields, each trimmed, the four integer fields must
    parse, and ``time`` must be a timestamp (P2: the default cast, as the
    studied consumer's ``to_timestamp(col)``; give ``time_pattern`` to
    demand one layout).  Adds ``event_ts``, ``is_valid`` and
    ``reject_reason``; ``filter("is_valid")`` is F10 and its complement the
    reject branch (T13)."""
    v = F.col(value_col).cast("string")  # P4: Kafka bytes -> text
    parts = _fields(v)
    n = F.size(parts)
    cols = {c: _jtrim(F.get(parts, i)) for i, c in enumerate(RAW_COLUMNS)}
    typed = {c: (cols[c].try_cast("int") if c in INT_FIELDS else cols[c]) for c in RAW_COLUMNS}
    ts = (cols["time"].try_cast("timestamp") if time_pattern is None
          else parse_time(cols["time"], time_pattern))
    int_ok = None
    for c in INT_FIELDS:
        e = typed[c].isNotNull()
        int_ok = e if int_ok is None else (int_ok & e)
    reason = (F.when(v.isNull(), F.lit("null_message"))
              .when(n != len(RAW_COLUMNS), F.lit("field_count"))
              .when(~int_ok, F.lit("not_an_int"))
              .when(ts.isNull(), F.lit("bad_time")))
    return lines.select(
        *keep,
        v.alias("raw"),
        *[typed[c].alias(c) for c in RAW_COLUMNS],
        ts.alias("event_ts"),
        reason.isNull().alias("is_valid"),
        reason.alias("reject_reason"),
    )


def parse_lax(lines: DataFrame, value_col: str = "value", keep=()) -> DataFrame:
    """At least 7 fields, no integer conversion; four fields trimmed,
    minute = first 16 characters of ``time``.  Rows the hand-written
    consumer would skip get ``is_valid = false``."""
    v = F.col(value_col).cast("string")
    parts = _fields(v)
    n = F.size(parts)
    time_text = _jtrim(F.get(parts, 0))
    minute = minute_key(time_text)
    reason = (F.when(v.isNull(), F.lit("null_message"))
              .when(n < len(RAW_COLUMNS), F.lit("field_count"))
              .when(minute.isNull(), F.lit("short_time")))
    return lines.select(
        *keep,
        v.alias("raw"),
        time_text.alias("time"),
        minute.alias("minute"),
        _jtrim(F.get(parts, 1)).alias("lineID"),
        _jtrim(F.get(parts, 2)).alias("stationID"),
        _jtrim(F.get(parts, 4)).alias("status"),
        reason.isNull().alias("is_valid"),
        reason.alias("reject_reason"),
    )


def _flatten(parsed: DataFrame, keep_valid: bool, columns) -> DataFrame:
    """Keep the rows whose ``is_valid`` equals ``keep_valid``.

    A plain ``filter("is_valid")`` would be pushed below the parse with the
    whole parse inlined into the Filter, which has no common-subexpression
    elimination, so every field check would split the message again.  As a
    generator (the DataFrame form of ``map -> Option -> flatten``) the parse
    is computed once, in a projection, and nothing is pushed through it."""
    ok = F.col("is_valid") if keep_valid else ~F.col("is_valid")
    rec = F.struct(*[F.col(c) for c in columns])
    return (parsed.select(ok.alias("_keep"), rec.alias("_rec"))
                  .select(F.inline(F.when(F.col("_keep"), F.array(F.col("_rec"))))))


STRICT_RECORD_COLUMNS = (*RAW_COLUMNS, "event_ts")
LAX_RECORD_COLUMNS = ("time", "minute", "lineID", "stationID", "status")


def strict_records(lines: DataFrame, value_col: str = "value", keep=(),
                   time_pattern: str | None = None) -> DataFrame:
    """the valid strictly parsed records (seven typed fields + event_ts)."""
    cols = [*keep, *STRICT_RECORD_COLUMNS]
    return _flatten(parse_strict(lines, value_col, keep, time_pattern), True, cols)


def strict_rejects(lines: DataFrame, value_col: str = "value", keep=(),
                   time_pattern: str | None = None) -> DataFrame:
    """Messages failing the strict parse, with the reason."""
    cols = [*keep, "raw", "reject_reason"]
    return _flatten(parse_strict(lines, value_col, keep, time_pattern), False, cols)


def _with_minute(lines: DataFrame, value_col: str, keep) -> DataFrame:
    """The lax parse plus ``minute_ts``; a minute that is no time is a reject."""
    parsed = parse_lax(lines, value_col, keep)
    ts = parse_time(F.concat(F.col("minute"), F.lit(":00")))
    reason = F.coalesce(F.col("reject_reason"), F.when(ts.isNull(), F.lit("bad_minute")))
    return parsed.withColumn("minute_ts", ts).withColumn("reject_reason", reason).withColumn(
        "is_valid", reason.isNull())


def minute_records(lines: DataFrame, value_col: str = "value", keep=()) -> DataFrame:
    """The lax rows whose minute is a time (``minute_ts``)."""
    return _flatten(_with_minute(lines, value_col, keep), True, [*keep, *LAX_RECORD_COLUMNS, "minute_ts"])


def minute_rejects(lines: DataFrame, value_col: str = "value", keep=()) -> DataFrame:
    """The messages that ``minute_records`` leaves out, with the reason."""
    return _flatten(_with_minute(lines, value_col, keep), False, [*keep, "raw", "reject_reason"])


def lax_records(lines: DataFrame, value_col: str = "value", keep=()) -> DataFrame:
    """The rows the hand-written consumer counts."""
    return _flatten(parse_lax(lines, value_col, keep), True, [*keep, *LAX_RECORD_COLUMNS])
