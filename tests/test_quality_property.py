"""G1-G6, F1-F8 against a brute-force model of the studied cleaning
sequence, per file: count, drop rows with a null, drop duplicates, drop
abnormal rows, drop rows outside the period."""

import re

from conftest import raw_frame
from hypothesis import given, settings
from hypothesis import strategies as st

from gateflow.operators import quality
from gateflow.schemas import STUDY_PERIOD as P

DAYS = ["2019-01-05", "2019-01-06"]
TIMES = ["2019-01-05 06:00:00", "2019-01-05 24:00:00", "2019-1-5 06:00:00", "2019-01-32 00:00:00",
         "2019-01-26 00:00:00", "2019-01-25 23:59:59", "2019-01-01 00:00:00", "2018-12-31 23:59:59"]
LINES = ["A", "B", "C", "D", "a"]
STATIONS = ["0", "80", "81", "-1", "x", "05", " 5"]
STATUS = ["0", "1", "2", "01"]
PAYS = ["0", "1", "2", "3", "4"]


def maybe(values):
    return st.one_of(st.none(), st.sampled_from(values)) if len(values) > 1 else st.sampled_from(values)


ROW = st.tuples(st.sampled_from(DAYS), maybe(TIMES), maybe(LINES), maybe(STATIONS),
                st.sampled_from(["7"]), maybe(STATUS), st.sampled_from(["U1", "U2"]), maybe(PAYS))
TIME_RE = re.compile(r"^(2019-01-\d{2} (?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d)$")


def model(rows):
    out = {}
    for day in sorted({r[0] for r in rows}):
        rs = [r for r in rows if r[0] == day]
        nn = [r for r in rs if all(v is not None for v in r)]
        dd = sorted(set(nn))

        def bad(r):
            _, t, ln, stn, _, stt, _, pay = r
            try:
                station_ok = 0 <= int(stn) <= 80
            except ValueError:
                station_ok = False
            return (not TIME_RE.match(t) or ln not in ("A", "B", "C") or not station_ok
                    or stt not in ("0", "1") or pay not in ("0", "1", "2", "3"))

        ab = [r for r in dd if bad(r)]
        ok = [r for r in dd if not bad(r)]
        oor = [r for r in ok if r[1] < P.lower_bound or r[1] > P.upper_bound]
        out[day] = (len(rs), len(nn) - len(dd), len(ab), len(oor), len(ok) - len(oor))
    return out


@settings(max_examples=30, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=40).flatmap(
    lambda base: st.lists(st.sampled_from(base), min_size=len(base), max_size=2 * len(base))))
def test_report_matches_model(spark, rows):
    got = {r.service_date: (r.total, r.duplicates, r.abnormal, r.out_of_range, r.final)
           for r in quality.report(raw_frame(spark, rows), P).collect()}
    assert got == model(rows)
    clean = quality.clean(raw_frame(spark, rows), P).count()
    assert clean == sum(v[4] for v in model(rows).values())
