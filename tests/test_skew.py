"""Skew: a third of all rows are copies of one swipe, another third fall on
one day.  Results stay exact, and the plans keep the protections the design
relies on (map-side partial count before the full-row exchange; rebalance
of the clean-layer write by day)."""

from conftest import raw_frame, swipe

from gateflow.operators import quality
from gateflow.schemas import STUDY_PERIOD as P
from gateflow.sinks.files import write_by_day
from gateflow.sources.daily_files import read_clean_layer


def _skewed(spark, n=300):
    hot = [swipe(day="2019-01-05", user="HOT")] * (n // 3)
    hot_day = [swipe(day="2019-01-06", time="2019-01-06 07:00:00", user=f"d{i}") for i in range(n // 3)]
    spread = [swipe(day=f"2019-01-{1 + i % 25:02d}", time=f"2019-01-{1 + i % 25:02d} 08:{i % 60:02d}:00",
                    user=f"s{i}") for i in range(n // 3)]
    return raw_frame(spark, hot + hot_day + spread)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_copies_counted_exactly(spark):
    raw = _skewed(spark)
    reps = {r.service_date: r for r in quality.report(raw, P).collect()}
    assert reps["2019-01-05"].duplicates == 99          # 100 copies -> 1 kept
    assert sum(r.final for r in reps.values()) == 1 + 100 + 100
    rej = [r for r in quality.rejects(raw, P).collect() if r.reason == "duplicate"]
    assert len(rej) == 1 and rej[0].n == 99              # one row, not 99


def test_grouping_is_partial_then_full_row_exchange(spark):
    plan = _plan(quality.row_groups(_skewed(spark)))
    assert "partial_count" in plan
    exchange = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln][0]
    # all eight key columns, not the day alone
    for c in ("service_date", "time", "lineID", "stationID", "deviceID", "status", "userID", "payType"):
        assert c in exchange


def test_clean_layer_write_is_rebalanced_by_day(spark, tmp_path):
    raw = _skewed(spark)
    clean = quality.clean(raw, P)
    hinted = clean.hint("rebalance", "service_date")
    assert "REBALANCE" in _plan(hinted).upper()
    write_by_day(clean, str(tmp_path / "c"))
    assert read_clean_layer(spark, str(tmp_path / "c")).count() == 201
