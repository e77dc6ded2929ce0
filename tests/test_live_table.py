"""Upsert tables under a running stream: files a batch, folding, listings,
and what an update must share with its table."""

import os

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from gateflow.plans import catalog
from gateflow.session import scratch_path
from gateflow.sinks import upsert as U
from gateflow.sources.streams import events_line_stream
from gateflow.streaming import minute_flow as S

NOW = {"availableNow": True}


def files(target):
    return [f"{d}/{f}" for d, _, fs in os.walk(target) for f in fs if f.startswith("part-") and f.endswith(".parquet")]


def leaves(target):
    return {os.path.dirname(f) for f in files(target)}


def test_one_file_a_folder_from_a_micro_batch(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        line, station = scratch_path(spark, "t"), scratch_path(spark, "t")
        lines = events_line_stream(spark, SF_SMALL)
        S.await_all(spark, [S.start_minute_flow(lines, line, checkpoint=scratch_path(spark, "c"), trigger=NOW),
                            S.start_inout_flow(lines, station, f"{line}-2", checkpoint=scratch_path(spark, "c"), trigger=NOW)])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for target in (line, station, f"{line}-2"):
        assert len(leaves(target)) > 20 and len(files(target)) == len(leaves(target))
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


MINUTE = "minute timestamp, lineID string, total_flow long, day string, hour string"


def batch(spark, n, rows=3):
    """Minute ``n`` of 2019-01-05, and the minute before anew."""
    base = F.expr("timestamp '2019-01-05 00:00:00'")
    df = spark.range(2 * rows).select(
        (base + F.make_dt_interval(mins=F.lit(n) - (F.col("id") % 2).cast("int"))).alias("minute"),
        F.concat(F.lit("L"), (F.col("id") / 2).cast("int")).alias("lineID"), F.lit(n).cast("long").alias("total_flow"))
    return df.withColumns({"day": F.date_format("minute", "yyyy-MM-dd"), "hour": F.date_format("minute", "HH")})


def test_listing_stays_bounded_over_200_batches(spark):
    target = scratch_path(spark, "t")
    passed = S.passed_partitions(F.col("minute"), "1 minute", S.HOURLY_PARTITIONS)
    write = U.upsert_batch_writer(target, ["minute", "lineID"], S.HOURLY_PARTITIONS, passed=passed, grace=0.0, writer="9-w")
    most = 0
    for n in range(200):
        write(batch(spark, 3 * n), n)          # ten hours, twenty batches an hour
        most = max(most, len(leaves(target)))
    # The open hours, up to a batch each, and one folder a closed hour.
    assert most <= 10 + 2 * 21 and len(files(target)) <= 10 + 21
    rows = {(str(r.minute), r.lineID): r.total_flow for r in U.read_table(spark, target).collect()}
    want = {}
    for n in range(200):
        for m in (3 * n - 1, 3 * n):
            day, m_ = ("2019-01-05", m) if m >= 0 else ("2019-01-04", 1440 + m)
            for k in range(3):
                want[f"{day} {m_ // 60:02d}:{m_ % 60:02d}:00", f"L{k}"] = 3 * n
    assert rows == want
    one = U.read_table(spark, target, partitions=[{"day": "2019-01-05", "hour": "03"}, {"day": "2030-01-01"}])
    assert {r.hour for r in one.collect()} == {"03"} and len(one.inputFiles()) == 1


def test_open_partition_with_many_updates_is_folded(spark):
    target = scratch_path(spark, "t")
    folding = U.LiveFolding(target, ["day"], "w", grace=0.0, most=5)
    for v in range(20):
        U.upsert(spark.createDataFrame([("d", "k", v), ("d", f"k{v}", v)], "day string, k string, n long"), target, ["k"],
                 v, ["day"], writer="w")
        folding.after_batch(spark, [("d",)], None, v)
        assert len(leaves(target)) <= 7
    rows = {r.k: r.n for r in U.read_table(spark, target).collect()}
    assert rows == {"k": 19, **{f"k{v}": v for v in range(20)}}


def test_folded_rows_keep_their_ranks(spark):
    """An update that ranks between two folded ones, a replay of a folded one
    and a stop before the deletion change nothing that they should not."""
    target, rows = scratch_path(spark, "t"), "day string, k string, n long"
    U.upsert(spark.createDataFrame([("d", "a", 1), ("d", "b", 1)], rows), target, ["k"], 1, ["day"])
    U.upsert(spark.createDataFrame([("d", "b", 9)], rows), target, ["k"], 9, ["day"])
    replaced = U.fold(spark, target, U.partition_folders(spark, target, ["day"]), "x", 0)
    assert len(replaced) == 2 and len(leaves(target)) == 3
    table = lambda: {r.k: r.n for r in U.read_table(spark, target).collect()}
    assert table() == {"a": 1, "b": 9}
    U.delete_folders(spark, replaced)
    assert table() == {"a": 1, "b": 9} and len(leaves(target)) == 1
    U.upsert(spark.createDataFrame([("d", "a", 5), ("d", "b", 5)], rows), target, ["k"], 5, ["day"])
    assert table() == {"a": 5, "b": 9}
    U.compact(spark, target)
    assert table() == {"a": 5, "b": 9} and len(leaves(target)) == 1


def test_restarted_stream_folds_what_an_earlier_run_left(spark):
    target, rows = scratch_path(spark, "t"), "day string, k string, n long"
    for v in range(3):
        U.upsert(spark.createDataFrame([("d1", "a", v)], rows), target, ["k"], v, ["day"], writer="w")
    U.upsert(spark.createDataFrame([("d2", "b", 3)], rows), target, ["k"], 3, ["day"], writer="w")
    U.LiveFolding(target, ["day"], "w", grace=0.0).after_batch(spark, [("d2",)], ("d2",), 3)
    assert len(leaves(target)) == 2
    assert {(r.k, r.n) for r in U.read_table(spark, target).collect()} == {("a", 2), ("b", 3)}


def test_update_unlike_its_table_is_an_error(spark):
    target = scratch_path(spark, "t")
    df = spark.createDataFrame([("a", "j", 1)], "k string, j string, n long")
    U.upsert(df, target, ["k"], 0)
    with pytest.raises(ValueError, match="columns.*more"):
        U.upsert(df.withColumn("more", F.lit(9)), target, ["k"], 1)
    with pytest.raises(ValueError, match="columns.*n"):
        U.upsert(df.withColumn("n", F.col("n").cast("string")), target, ["k"], 1)
    with pytest.raises(ValueError, match="columns.*j"):
        U.upsert(df.drop("j"), target, ["k"], 1)
    with pytest.raises(ValueError, match="keys"):
        U.upsert(df, target, ["k", "j"], 1)
    with pytest.raises(ValueError, match="partition_by"):
        U.upsert(df, target, ["k"], 1, ["j"])
    with pytest.raises(ValueError, match="format"):
        U.upsert(df, target, ["k"], 1, fmt="csv")
    assert [tuple(r) for r in U.read_table(spark, target).collect()] == [("a", "j", 1)]
    U.upsert(df.select("n", "j", "k"), target, ["k"], 1)            # another order of columns is none


def test_equal_keys_of_one_call(spark):
    rows = [("a", 1, None), ("a", 2, "x"), ("a", 2, None), ("b", None, "y"), ("b", None, None)]
    for order in (rows, rows[::-1]):
        target = scratch_path(spark, "t")
        U.upsert(spark.createDataFrame(order, "k string, n long, s string").repartition(3), target, ["k"], 0)
        assert {tuple(r) for r in U.read_table(spark, target).collect()} == {("a", 2, "x"), ("b", None, "y")}


def test_partition_values_with_odd_characters(spark):
    target = scratch_path(spark, "t")
    df = spark.createDataFrame([("a/b=c", "k", 1), (None, "l", 2), ("ü %", "m", 3)], "day string, k string, n long")
    for v in range(2):
        U.upsert(df, target, ["k"], v, ["day"])
    assert {r.k for r in U.read_table(spark, target, partitions=[{"day": "a/b=c"}, {"day": None}]).collect()} == {"k", "l"}
    U.compact(spark, target)
    assert len(leaves(target)) == 3 and {(r.day, r.n) for r in U.read_table(spark, target).collect()} == {
        ("a/b=c", 1), (None, 2), ("ü %", 3)}


def test_chained_windows_keep_two_states_and_read_no_table(spark):
    flow = S.chained_line_flow(S.parsed_records(events_line_stream(spark, SF_SMALL)))
    plan = flow._jdf.queryExecution().analyzed().toString()
    assert plan.count("Aggregate [window") == 2 and "relation" not in plan.lower().replace("streamingrelation", "")


def test_chained_windows_equal_one_window(spark):
    chained = sorted(map(str, catalog.stream_chained_rollup(spark, SF_SMALL).collect()))
    assert chained and chained == sorted(map(str, catalog.stream_minute_line_append(spark, SF_SMALL).collect()))
