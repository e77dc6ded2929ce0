"""The batch analyses on hand-made records."""

from conftest import raw_frame, swipe

from gateflow.operators import flows
from gateflow.operators.records import typed
from gateflow.schemas import STUDY_PERIOD as P


def _typed(spark, rows):
    return typed(raw_frame(spark, rows))


def test_halfhour_slot_edges(spark):
    rows = [swipe(time="2019-01-05 05:59:59", user="a"), swipe(time="2019-01-05 06:00:00", user="b"),
            swipe(time="2019-01-05 06:29:59", user="c")]
    got = {(r.time_slot, r.traffic_count) for r in flows.halfhour_flow(_typed(spark, rows)).collect()}
    assert got == {("05:30", 1), ("06:00", 2)}


def test_halfhour_by_line_skips_unknown_status(spark):
    rows = [swipe(user="a", status="1"), swipe(user="b", status="0"), swipe(user="c", status="7")]
    got = {(r.lineID, r.status, r.traffic_count)
           for r in flows.halfhour_flow_by_line(_typed(spark, rows)).collect()}
    assert got == {("A", "In", 1), ("A", "Out", 1)}


def test_line_direction_series_midpoint(spark):
    rows = [swipe(time="2019-01-05 06:40:00")]
    r = flows.line_direction_series(_typed(spark, rows)).collect()[0]
    assert (r.series, r.time_slot, r.x, r.y) == ("Line A - In", "06:30", "06:45", 1)


def test_top10_ties_break_on_station_then_line(spark):
    rows = []
    # 12 stations with equal counts on line B, station 0 also on line A.
    for st in range(12):
        rows.append(swipe(line="B", station=str(st), user=f"b{st}"))
    rows.append(swipe(line="A", station="0", user="a0"))
    top = flows.station_top10(_typed(spark, rows)).orderBy("rank").collect()
    assert len(top) == 10
    assert [(r.lineID, r.stationID) for r in top[:3]] == [("A", 0), ("B", 0), ("B", 1)]
    flags = flows.station_flow_daily(_typed(spark, rows)).filter("is_top10").count()
    assert flags == 10


def test_station_outflow_takes_non_entry_status(spark):
    rows = [swipe(user="a", status="0"), swipe(user="b", status="7")]
    got = sorted((r.status, r.traffic_count, r.is_top10)
                 for r in flows.station_flow_daily(_typed(spark, rows)).collect())
    assert got == [("Outflow", 1, False), ("Outflow", 1, True)]


def test_grouping_sets_total_and_null_line(spark):
    rows = [swipe(user="a", line="A"), swipe(user="b", line="B"), swipe(user="c", line=None)]
    got = {(r.lineID, r.passenger_flow)
           for r in flows.line_flow_daily_with_total(_typed(spark, rows)).collect()}
    assert got == {("A", 1), ("B", 1), (None, 1), ("total", 3)}


def test_pivot_has_total(spark):
    rows = [swipe(user="a", line="A"), swipe(user="b", line="A"), swipe(user="c", line="C")]
    r = flows.line_flow_pivot(_typed(spark, rows)).collect()[0]
    assert (r.A, r.B, r.C, r.total) == (2, 0, 1, 3)


def test_paytype_shares_sum_to_one(spark):
    rows = [swipe(user=str(i), pay=str(i % 4)) for i in range(10)]
    out = flows.paytype_distribution(_typed(spark, rows)).collect()
    assert abs(sum(r.share for r in out) - 1.0) < 1e-12
    assert {r.pay_type: r.pay_label for r in out}["2"] == "senior"
    assert sum(r.total_count for r in out) == 10


def test_week_comparison_has_base_in_every_group(spark):
    rows = [swipe(day=P.day(d), time=f"{P.day(d)} 08:00:00", user=str(d)) for d in (1, 5, 12, 19, 26)]
    out = flows.week_comparison(_typed(spark, rows), P).collect()
    groups = {}
    for r in out:
        groups.setdefault(r.group_id, set()).add(r.series)
    assert groups == {"05_to_11": {"01-01", "01-05"}, "12_to_18": {"01-01", "01-12"},
                      "19_to_25": {"01-01", "01-19"}}
    assert {r.x for r in out} == {"08:15"}


def test_display_orders(spark):
    rows = [swipe(user="a", time="2019-01-05 07:10:00", line="B", station="2"),
            swipe(user="b", time="2019-01-05 06:10:00", line="A", station="2"),
            swipe(user="c", time="2019-01-05 06:40:00", line="A", station="1")]
    t = _typed(spark, rows)
    slots = [r.time_slot for r in flows.in_slot_order(flows.halfhour_flow(t)).collect()]
    assert slots == ["06:00", "06:30", "07:00"]
    st = [(r.stationID, r.lineID) for r in flows.in_station_order(flows.station_flow_daily(t)).collect()]
    assert st == [(1, "A"), (2, "A"), (2, "B")]
