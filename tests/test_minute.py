"""Per-minute flows, profile, series, cells."""

from gateflow.operators import minute, series
from gateflow.sinks import cells
from gateflow.sources import lines as L


def _lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


MSGS = ["2019-01-05 06:10:01,A,3,10,1,U1,0",
        "2019-01-05 06:10:30,A,3,11,0,U2,0",
        "2019-01-05 06:10:59,A,4,11,7,U3,0",
        "2019-01-05 06:11:00,B,4,11,1,U4,0"]


def test_minute_flow_counts_all_rows_in_total(spark):
    recs = L.strict_records(_lines(spark, MSGS))
    got = {(r.lineID, r.total_flow, r.exit_count, r.entry_count)
           for r in minute.minute_flow_line(recs).collect()}
    # status 7: in total_flow, in neither direction
    assert got == {("A", 3, 1, 1), ("B", 1, 0, 1)}


def test_inout_total_counts_only_known_status(spark):
    recs = L.lax_records(_lines(spark, MSGS))
    st = {r.station_key: (r.in_count, r.out_count, r.total_count)
          for r in minute.inout_minute_station(recs).filter("minute = '2019-01-05 06:10'").collect()}
    # unknown status still creates the key, with zeros
    assert st == {"A-3": (1, 1, 2), "A-4": (0, 0, 0)}


def test_ingest_profile_gaps_and_running_total(spark):
    from conftest import raw_frame, swipe
    rows = [swipe(time="2019-01-05 06:10:01", user="a"), swipe(time="2019-01-05 06:10:02", user="b"),
            swipe(time="2019-01-05 06:13:00", user="c")]
    out = minute.ingest_profile(raw_frame(spark, rows)).orderBy("minute").collect()
    assert [(r.minute, r.records, r.sent_total, r.gap_ms) for r in out] == [
        ("2019-01-05 06:10", 2, 2, 0), ("2019-01-05 06:13", 1, 3, 180000)]


def test_live_series_only_known_lines(spark):
    recs = L.strict_records(_lines(spark, MSGS + ["2019-01-05 06:10:01,D,3,10,1,U1,0"]))
    names = {r.series for r in series.live_series_line(minute.minute_flow_line(recs)).collect()}
    assert names == {"Line A", "Line A Entry", "Line A Exit", "Line B", "Line B Entry", "Line B Exit"}


def test_station_series_selection(spark):
    recs = L.lax_records(_lines(spark, MSGS))
    ms = minute.inout_minute_station(recs)
    out = series.live_series_station(ms, line="A", stations=["A-3"], types=["total"]).collect()
    assert [(r.series, r.x, r.y) for r in out] == [("A-3 (total)", "2019-01-05 06:10", 2)]


def test_row_keys_and_cells(spark):
    recs = L.strict_records(_lines(spark, MSGS[:1]))
    got = {(r.row_key, r.qualifier, r.value)
           for r in cells.line_cells(minute.minute_flow_line(recs)).collect()}
    key = "2019-01-05 06:10:00.0_A"
    assert got == {(key, "time", "2019-01-05 06:10:00.0"), (key, "line_id", "A"),
                   (key, "total_flow", "1"), (key, "exit_count", "0"), (key, "entry_count", "1")}
    lax = L.lax_records(_lines(spark, MSGS[:1]))
    mk = {r.row_key for r in cells.inout_station_cells(minute.inout_minute_station(lax)).collect()}
    assert mk == {"2019-01-05 06:10-A-3"}
