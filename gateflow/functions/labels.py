"""Label and key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DIRECTION_IN_OUT, DIRECTION_INFLOW, DIRECTION_OUTFLOW


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def station_key(line="lineID", station="stationID", sep: str = "-") -> Column:
    """P14: "A-3"."""
    return F.concat_ws(sep, _col(line), _col(station).cast("string"))


def in_out_label(status="status") -> Column:
    """1 -> "In", 0 -> "Out", anything else -> NULL."""
    s = _col(status)
    expr = None
    for label, code in DIRECTION_IN_OUT:
        expr = (F.when(s == code, F.lit(label)) if expr is None
                else expr.when(s == code, F.lit(label)))
    return expr


def inflow_outflow_label(status="status") -> Column:
    """1 -> "Inflow", every other value -> "Outflow"."""
    return F.when(_col(status) == 1, F.lit(DIRECTION_INFLOW)).otherwise(F.lit(DIRECTION_OUTFLOW))


def line_direction_series(line="lineID", direction="status") -> Column:
    """P20: "Line A - In"."""
    return F.format_string("Line %s - %s", _col(line), _col(direction))
