"""Restarts, new checkpoints, stops between writes, failing queries, folder
tables and plans of the sinks and streams."""

import os
import re
import shutil
import time

import pytest
from conftest import SF_SMALL, raw_frame, swipe

from gateflow.operators import quality
from gateflow.plans import catalog, jobs
from gateflow.schemas import Period
from gateflow.session import scratch_path
from gateflow.sinks import upsert as U
from gateflow.sinks.files import write_by_day
from gateflow.sources.daily_files import read_clean_layer
from gateflow.sources.streams import text_line_stream
from gateflow.streaming import minute_flow as S

NOW = {"availableNow": True}


def messages(folder, name, texts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(texts) + "\n")
    at = time.time() - 1000 + 10 * len(os.listdir(folder))
    os.utime(folder / name, (at, at))


def minute(n, user):
    return f"2019-01-05 06:{n:02d}:10,A,3,10,1,{user},0"


def totals(spark, target):
    return {(str(r.minute)[11:16], r.total_flow) for r in U.read_table(spark, target).collect()}


def test_new_checkpoint_with_new_data_wins(spark, tmp_path):
    """Three messages in three batches, then a new checkpoint, whose batch
    ids begin at 0 again, over five messages."""
    src, target = tmp_path / "in", scratch_path(spark, "t")
    for i in range(3):
        messages(src, f"{i}.txt", [minute(1, f"u{i}")])
    lines = text_line_stream(spark, str(src), max_files_per_trigger=1)
    S.start_minute_flow(lines, target, checkpoint=scratch_path(spark, "c"), trigger=NOW).awaitTermination()
    assert totals(spark, target) == {("06:01", 3)}
    messages(src, "3.txt", [minute(1, "u3"), minute(1, "u4")])
    lines = text_line_stream(spark, str(src))
    S.start_minute_flow(lines, target, checkpoint=scratch_path(spark, "c"), trigger=NOW).awaitTermination()
    assert totals(spark, target) == {("06:01", 5)}


def test_writer_id_belongs_to_the_checkpoint(spark):
    a, b = scratch_path(spark, "c"), scratch_path(spark, "c")
    first = U.writer_id(spark, a)
    assert U.writer_id(spark, a) == first < U.writer_id(spark, b)
    assert first > U.LOADS


def test_two_jobs_under_one_shared_folder(spark, tmp_path):
    for k in (1, 2):
        messages(tmp_path / f"in{k}", "a.txt", [minute(k, "u")] * k)
        out = scratch_path(spark, f"job{k}")
        S.await_all(spark, jobs.start_stream_jobs(text_line_stream(spark, str(tmp_path / f"in{k}")), out, trigger=NOW))
        assert totals(spark, f"{out}/line_statistics") == {(f"06:0{k}", k)}


ROWS = "day string, k string, n long"


def test_stop_between_writes_and_replay(spark):
    target = scratch_path(spark, "t")
    first = spark.createDataFrame([("d1", "a", 1), ("d2", "b", 1)], ROWS)
    second = spark.createDataFrame([("d1", "a", 2), (None, "c", 2)], ROWS)
    U.upsert(first, target, ["k"], 0, ["day"])
    U.upsert(second, target, ["k"], 1, ["day"])
    # A stop inside the second write leaves part of its folder; the replay completes it.
    shutil.rmtree(f"{target}/day=d1/_update=0.1.0")
    U.upsert(second, target, ["k"], 1, ["day"])
    U.upsert(first, target, ["k"], 0, ["day"])  # an old replay changes nothing
    want = [(None, "c", 2), ("d1", "a", 2), ("d2", "b", 1)]
    assert sorted(map(tuple, U.read_table(spark, target).collect()), key=str) == sorted(want, key=str)


def test_null_partition_value_survives(spark):
    target = scratch_path(spark, "t")
    U.upsert(spark.createDataFrame([(None, "a", 1)], ROWS), target, ["k"], 0, ["day"])
    U.upsert(spark.createDataFrame([(None, "b", 2)], ROWS), target, ["k"], 1, ["day"])
    assert {r.k for r in U.read_table(spark, target).collect()} == {"a", "b"}


def test_only_filtered_partitions_are_scanned(spark):
    target = scratch_path(spark, "t")
    for v in (0, 1):
        U.upsert(spark.createDataFrame([(f"d{i}", f"k{i}", v) for i in range(5)], ROWS), target, ["k"], v, ["day"])
    df = U.read_table(spark, target).where("day in ('d1', 'd3')")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ IN \(d1,d3\)", plan)
    assert {(r.k, r.n) for r in df.collect()} == {("k1", 1), ("k3", 1)}


def test_compact_keeps_the_latest_rows(spark):
    target = scratch_path(spark, "t")
    U.upsert(spark.createDataFrame([("d", "a", 1), ("d", "b", 1)], ROWS), target, ["k"], 3, ["day"])
    U.upsert(spark.createDataFrame([("d", "a", 2)], ROWS), target, ["k"], 0, ["day"], writer="1-later")
    want = {("a", 2), ("b", 1)}
    for _ in range(2):
        U.compact(spark, target)
        assert {(r.k, r.n) for r in U.read_table(spark, target).collect()} == want
        assert len([p for p, _, fs in os.walk(target) if any(f.endswith(".parquet") for f in fs)]) == 1
    U.upsert(spark.createDataFrame([("d", "b", 5)], ROWS), target, ["k"], 1, ["day"], writer="1-later")
    assert {(r.k, r.n) for r in U.read_table(spark, target).collect()} == {("a", 2), ("b", 5)}


def test_failing_query_stops_the_others(spark):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def fail(df, batch_id):
        raise ValueError("planted failure")

    good = rate.writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "c")).start()
    bad = rate.writeStream.foreachBatch(fail).option("checkpointLocation", scratch_path(spark, "c")).start()
    with pytest.raises(Exception, match="planted failure"):
        S.await_all(spark, [good, bad], poll_seconds=2)
    assert not good.isActive and not bad.isActive


def test_console_prints_every_key(spark, capsys):
    S.console_batch_writer(["k"])(spark.range(250).selectExpr("249 - id as k", "id as n"), 7)
    lines = capsys.readouterr().out.splitlines()
    assert lines[:2] == ["batch 7", "k|n"] and [int(x.split("|")[0]) for x in lines[2:]] == list(range(250))


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """``events`` as a folder of parts, as any large table is."""
    folder = tmp_path_factory.mktemp("parts")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(5).write.parquet(f"{folder}/events.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["stream_minute_line_update", "stream_minute_station_update", "stream_minute_line_append",
                                  "stream_line_rollup", "stream_inout_line_append", "stream_rejects"])
def test_streams_read_a_folder_of_parts(spark, parts, name):
    def rows(sf_dir):
        return sorted(map(str, catalog.QUERIES[name](spark, sf_dir).collect()))

    got = rows(parts)
    assert got and got == rows(SF_SMALL)


def test_saved_rows_rejects_and_open_minute_are_all_messages(spark):
    raw = catalog._lines(spark, SF_SMALL)
    station, _ = catalog._inout_stream_run(spark, SF_SMALL, "all_messages")
    records = catalog._lax_valid(spark, SF_SMALL)
    rejects = catalog.stream_inout_rejects(spark, SF_SMALL)
    newest = records.where("try_to_timestamp(concat(minute, ':00')) is not null").agg({"minute": "max"}).first()[0]
    saved = {r.minute for r in U.read_table(spark, station).select("minute").distinct().collect()}
    kept = sum(r["count"] for r in records.groupBy("minute").count().collect() if r.minute in saved)
    open_ = records.where(records.minute == newest).count()
    assert newest not in saved and kept + open_ + rejects.count() == raw.count()


def test_rerun_clears_days_without_rows(spark, tmp_path):
    raw, out, period = tmp_path / "raw", str(tmp_path / "out"), Period("2019-01", 1, 25)
    header = "time,lineID,stationID,deviceID,status,userID,payType\n"
    raw.mkdir()

    def day(d, line):
        (raw / f"record_{d}.csv").write_text(header + f"{d} 06:00:00,{line},1,2,1,U1,0\n")

    day("2019-01-01", "A")
    day("2019-01-02", "Z")
    jobs.clean_job(spark, str(raw), out, period)
    assert {r.service_date for r in read_clean_layer(spark, f"{out}/clean").collect()} == {"2019-01-01"}
    day("2019-01-01", "Z")
    day("2019-01-02", "B")
    report = jobs.clean_job(spark, str(raw), out, period)
    assert {r.service_date for r in read_clean_layer(spark, f"{out}/clean").collect()} == {"2019-01-02"}
    rejects = spark.read.parquet(f"{out}/rejects").selectExpr("cast(service_date as string) as d").collect()
    assert {r.d for r in rejects} == {"2019-01-01"}
    assert {(r.service_date, r.final) for r in report.collect()} == {("2019-01-01", 0), ("2019-01-02", 1)}


def test_write_by_day_clears_named_days(spark, tmp_path):
    path = str(tmp_path / "clean")
    write_by_day(raw_frame(spark, [swipe(day="2019-01-01"), swipe(day="2019-01-02")]), path)
    write_by_day(raw_frame(spark, [swipe(day="2019-01-03")]), path, empty_days=["2019-01-02"])
    assert {r.service_date for r in read_clean_layer(spark, path).collect()} == {"2019-01-01", "2019-01-03"}


def test_rejects_take_one_scan_and_one_shuffle(spark, tmp_path):
    raw_frame(spark, [swipe(), swipe(), swipe(line="Z")]).write.parquet(str(tmp_path / "raw"))
    df = quality.rejects(spark.read.parquet(str(tmp_path / "raw")), Period("2019-01", 1, 25))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert sorted((r.reason, r.n) for r in df.collect()) == [("abnormal", 1), ("duplicate", 1)]


def test_sorted_rows_are_in_order(spark):
    rows = [(r.service_date, r.time_slot) for r in catalog.halfhour_flow_in_order(spark, SF_SMALL).collect()]
    assert rows == sorted(rows)
    rows = [(r.service_date, r.stationID, r.lineID, r.status) for r in catalog.station_flow_in_order(spark, SF_SMALL).collect()]
    assert rows == sorted(rows)
