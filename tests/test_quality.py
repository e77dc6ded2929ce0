"""Cleaning rules, rejects and the one-pass report."""

from conftest import raw_frame, swipe

from gateflow.operators import quality
from gateflow.schemas import STUDY_PERIOD as P


def _clean_keys(spark, rows):
    return {tuple(r) for r in quality.clean(raw_frame(spark, rows), P).collect()}


def test_null_row_dropped_and_counted(spark):
    rows = [swipe(user="U1"), swipe(user="U2", pay=None), swipe(user="U3", line=None)]
    rep = quality.report(raw_frame(spark, rows), P).collect()[0]
    assert rep.total == 3 and rep.null_payType == 1 and rep.null_lineID == 1
    assert rep.null_rows == 2 and rep.final == 1
    assert len(_clean_keys(spark, rows)) == 1


def test_duplicates_are_per_day(spark):
    same_day = [swipe(), swipe()]
    two_days = [swipe(day="2019-01-05", time="2019-01-05 06:10:00"),
                swipe(day="2019-01-06", time="2019-01-05 06:10:00")]
    assert len(_clean_keys(spark, same_day)) == 1
    assert len(_clean_keys(spark, two_days)) == 2
    rep = quality.report(raw_frame(spark, same_day), P).collect()[0]
    assert rep.duplicates == 1 and rep.final == 1


def test_time_rules(spark):
    rows = [swipe(user="a", time="2019-01-05 24:00:00"),   # abnormal
            swipe(user="b", time="2019-1-5 06:00:00"),     # abnormal
            swipe(user="c", time="2019-01-32 00:00:00"),   # out of range
            swipe(user="d", time="2019-01-26 00:00:00"),   # out of range
            swipe(user="e", time="2019-01-25 23:59:59")]   # kept
    rep = quality.report(raw_frame(spark, rows), P).collect()[0]
    assert (rep.abnormal, rep.out_of_range, rep.final) == (2, 2, 1)
    assert {r.userID for r in quality.clean(raw_frame(spark, rows), P).collect()} == {"e"}


def test_domain_rules(spark):
    bad = [swipe(user="1", line="D"), swipe(user="2", status="2"), swipe(user="3", pay="4"),
           swipe(user="4", status="01"), swipe(user="5", station="-1"),
           swipe(user="6", station="81"), swipe(user="7", station="x")]
    good = [swipe(user="8", station="0"), swipe(user="9", station="80")]
    rep = quality.report(raw_frame(spark, bad + good), P).collect()[0]
    assert rep.abnormal == len(bad) and rep.final == len(good)
    rej = quality.rejects(raw_frame(spark, bad + good), P).collect()
    detail = {r.userID: r.detail for r in rej}
    assert detail["1"] == "bad_line" and detail["7"] == "bad_station"
    assert detail["4"] == "bad_status" and detail["3"] == "bad_pay_type"


def test_report_adds_up_and_matches_rejects(spark):
    from gateflow.sources.fixture import FIXTURE_PERIOD, raw_swipes_from_dir
    from conftest import SF_CHECK
    raw = raw_swipes_from_dir(spark, SF_CHECK)
    reps = quality.report(raw, FIXTURE_PERIOD).collect()
    for r in reps:
        assert r.total == r.null_rows + r.duplicates + r.abnormal + r.out_of_range + r.final
    tot = {k: sum(getattr(r, k) for r in reps)
           for k in ("total", "null_rows", "duplicates", "abnormal", "out_of_range", "final")}
    # FIXTURES §5 at sf0.01: raw 10,200 / non-null 10,093 / dedup 9,896 /
    # abnormal 484 / out of range 1,674 / clean 7,738.
    assert tot["total"] == 10200 and tot["total"] - tot["null_rows"] == 10093
    assert tot["abnormal"] == 484 and tot["out_of_range"] == 1674 and tot["final"] == 7738
    assert tot["total"] - tot["null_rows"] - tot["duplicates"] == 9896
    rej = quality.rejects(raw, FIXTURE_PERIOD).groupBy().sum("n").collect()[0][0]
    assert rej + tot["final"] == tot["total"]
    assert quality.clean(raw, FIXTURE_PERIOD).count() == 7738


def test_clean_all_shares_one_grouping(spark):
    rows = [swipe(user="a"), swipe(user="a"), swipe(user="b", line="D")]
    res = quality.clean_all(raw_frame(spark, rows), P)
    try:
        assert res.clean.count() == 1
        assert res.report.collect()[0].duplicates == 1
        assert sorted(r.reason for r in res.rejects.collect()) == ["abnormal", "duplicate"]
    finally:
        res.release()


def test_report_text_layout(spark):
    rows = [swipe(day="2019-01-01", time="2019-01-01 06:00:00"),
            swipe(day="2019-01-01", time="2019-01-01 06:00:00")]
    text = quality.report_text(quality.report(raw_frame(spark, rows), P)).collect()[0].text
    assert text.split("\n") == [
        "File: record_2019-01-01.csv",
        "Total number of records: 2",
        "Missing value counts per column:",
        "[0,0,0,0,0,0,0]",
        "Number of duplicate records: 1",
        "Number of abnormal records: 0",
        "Number of records with time out of expected range: 0",
        "Final total number of records: 1",
    ]
