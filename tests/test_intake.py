"""Daily files in parts, malformed rows, intake of new files, counts taken
while writing, ordered cell files, pruned scans, one parse for two streams."""

import os
import re

from conftest import SF_SMALL, raw_frame, swipe
from pyspark.sql import functions as F

from gateflow.operators import quality
from gateflow.operators.records import typed
from gateflow.plans import catalog, jobs
from gateflow.schemas import RAW_COLUMNS, Period
from gateflow.session import scratch_path
from gateflow.sinks import cells
from gateflow.sinks.files import write_by_day, write_daily_files
from gateflow.sinks.upsert import read_table
from gateflow.sources.daily_files import read_clean_layer, read_daily_csv, read_daily_records
from gateflow.operators import flows
from gateflow.streaming import minute_flow as S

PERIOD = Period("2019-01", 1, 25)
HEADER = ",".join(RAW_COLUMNS) + "\n"


def test_daily_files_keep_every_row_under_a_row_limit(spark, tmp_path):
    rows = [swipe(user=f"U{i}") for i in range(1000)] + [swipe(day="2019-01-06", user=f"U{i}") for i in range(7)]
    before = spark.conf.get("spark.sql.files.maxRecordsPerFile")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "100")
    try:
        write_daily_files(raw_frame(spark, rows), str(tmp_path / "d"))
    finally:
        spark.conf.set("spark.sql.files.maxRecordsPerFile", before)
    names = [f for f in os.listdir(tmp_path / "d") if f.endswith(".csv") and not f.startswith(".")]
    assert len(names) == 11 and "record_2019-01-06.csv" in names and "record_2019-01-05_9.csv" in names
    got = read_daily_csv(spark, str(tmp_path / "d"))
    assert got.count() == 1007 and got.distinct().count() == 1007
    assert read_daily_csv(spark, str(tmp_path / "d"), ["2019-01-05"]).count() == 1000
    # Writing again replaces the parts; adding files keeps them.
    write_daily_files(raw_frame(spark, rows[:3]), str(tmp_path / "d"))
    write_daily_files(raw_frame(spark, rows[3:5]), str(tmp_path / "d"), mode="append", tag="late")
    assert read_daily_csv(spark, str(tmp_path / "d")).count() == 5


def test_malformed_rows_are_rejects_with_their_text(spark, tmp_path):
    good = "2019-01-01 06:00:00,A,1,2,1,U1,0"
    bad = ["2019-01-01 06:00:00,A,1,2,1,U1", good + ",x", "one field", "a,b,c,d,e,f,g,h,i"]
    (tmp_path / "record_2019-01-01.csv").write_text(HEADER + "\n".join([good, good, *bad, bad[0], "2019-01-01 06:00:00,A,1,2,1,U1,"]) + "\n")
    raw = read_daily_records(spark, str(tmp_path))
    res = quality.clean_all(raw, PERIOD)
    rejects = {(r.reason, r.detail, r.n) for r in res.rejects.collect()}
    assert rejects == {("malformed", bad[0], 2), *(("malformed", b, 1) for b in bad[1:]), ("duplicate", None, 1), ("null", None, 1)}
    assert all(r.time is None for r in res.rejects.collect() if r.reason == "malformed")
    assert [tuple(r)[1:] for r in res.clean.collect()] == [tuple(good.split(","))]
    row = res.report.first()
    assert (row.total, row.malformed, row.null_rows, row.null_payType, row.null_time, row.duplicates, row.final) == (8, 5, 1, 1, 0, 1, 1)
    assert sum(r.n for r in res.rejects.collect()) + row.final == row.total
    # A scan of one column still counts the fields of a row.
    assert raw.select("lineID").where("lineID is not null").count() == 3


def test_observed_counts_equal_the_report(spark):
    raw = catalog._raw(spark, SF_SMALL)
    res = quality.clean_all(raw, catalog.PERIOD)
    total = res.report.agg(*(F.sum(c).alias(c) for c in res.totals)).first().asDict()
    assert total == res.totals and total["final"] == res.clean.count()


def test_observed_counts_need_no_read_of_the_grouping(spark, monkeypatch):
    """With the grouping gone after its write, the counts are still there."""
    path = scratch_path(spark, "g")
    totals = quality.write_groups(catalog._raw(spark, SF_SMALL), catalog.PERIOD, path)
    before = spark.read.parquet(path)
    assert set(before.columns) == {*quality.KEY, "copies"}
    assert totals["total"] == before.agg(F.sum("copies")).first()[0]
    # One shuffle makes the grouping and the counts.
    g = quality._classified(quality.row_groups(catalog._raw(spark, SF_SMALL)), catalog.PERIOD)
    plan = g._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1


def test_only_the_days_that_came_are_cleaned(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()

    def add(name, *lines):
        (raw / name).write_text(HEADER + "\n".join(lines) + "\n")

    def run():
        jobs.start_clean_job(spark, str(raw), out, PERIOD).awaitTermination()
        return {(r.service_date, r.userID) for r in read_clean_layer(spark, f"{out}/clean").collect()}

    add("record_2019-01-01.csv", "2019-01-01 06:00:00,A,1,2,1,U1,0")
    add("record_2019-01-02.csv", "2019-01-02 06:00:00,A,1,2,1,U2,0")
    assert run() == {("2019-01-01", "U1"), ("2019-01-02", "U2")}
    first = {f: os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(f"{out}/clean/service_date=2019-01-01") for f in fs}
    add("record_2019-01-02_late.csv", "2019-01-02 07:00:00,A,1,2,1,U3,0", "2019-01-02 06:00:00,A,1,2,1,U2,0")
    add("record_2019-01-03.csv", "2019-01-03 06:00:00,Z,1,2,1,U4,0")
    assert run() == {("2019-01-01", "U1"), ("2019-01-02", "U2"), ("2019-01-02", "U3")}
    again = {f: os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(f"{out}/clean/service_date=2019-01-01") for f in fs}
    assert first and first == again
    report = {r.service_date: (r.total, r.duplicates, r.abnormal) for r in spark.read.parquet(f"{out}/report").selectExpr(
        "cast(service_date as string) as service_date", "total", "duplicates", "abnormal").collect()}
    assert report == {"2019-01-01": (1, 0, 0), "2019-01-02": (3, 1, 0), "2019-01-03": (1, 0, 1)}
    assert run() == {("2019-01-01", "U1"), ("2019-01-02", "U2"), ("2019-01-02", "U3")}     # nothing new


def test_cell_files_do_not_overlap(spark, tmp_path):
    df = catalog.rowkey_cells_station(spark, SF_SMALL)
    cells.write_in_key_order(df, str(tmp_path / "c"), 6)
    parts = []
    for f in sorted(os.listdir(tmp_path / "c")):
        if f.endswith(".parquet"):
            rows = [(r.row_key.encode(), r.qualifier) for r in spark.read.parquet(str(tmp_path / "c" / f)).collect()]
            assert rows == sorted(rows)
            parts.append((rows[0][0], rows[-1][0], len(rows)))
    parts.sort()
    assert len(parts) >= 4 and all(a[1] < b[0] for a, b in zip(parts, parts[1:]))
    assert sum(p[2] for p in parts) == df.count()


def test_week_table_prunes_the_scan(spark, tmp_path):
    layer, table = str(tmp_path / "clean"), str(tmp_path / "weeks")
    write_by_day(catalog._clean(spark, SF_SMALL), layer)
    flows.week_groups_frame(spark, catalog.PERIOD).coalesce(1).write.parquet(table)
    df = flows.week_comparison_by_table(typed(read_clean_layer(spark, layer)), spark.read.parquet(table), ["05_to_11"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*dynamicpruning", plan)
    assert {r.service_date for r in df.select("service_date").distinct().collect()} <= {
        "2024-01-01", *(f"2024-01-{d:02d}" for d in range(5, 12))}


def test_one_parse_feeds_flow_and_rejects(spark):
    rows = catalog.stream_shared_parse(spark, SF_SMALL).collect()
    assert sum(r.n for r in rows) == catalog._lines(spark, SF_SMALL).count()
    assert {r.kind for r in rows} == {"flow", "reject"}


def test_state_holds_the_windows_that_were_not_written(spark):
    left = {(r.minute, r.lineID) for r in catalog.stream_state_left(spark, SF_SMALL).collect()}
    saved = {(r.minute, r.lineID) for r in catalog.stream_minute_line_append(spark, SF_SMALL).collect()}
    every = {(r.minute, r.lineID) for r in catalog.minute_flow_line(spark, SF_SMALL).collect()}
    assert left and not left & saved and left | saved == every


def test_key_order_on_the_console(spark, capsys):
    """O4/K9 over a real stream: the batch's totals in key order."""
    from gateflow.sources.streams import events_line_stream
    flow = S.windowed_minute_flow(S.parsed_records(events_line_stream(spark, SF_SMALL)), S.LINE_KEYS)
    (flow.writeStream.outputMode("update").option("checkpointLocation", scratch_path(spark, "c"))
         .foreachBatch(S.console_batch_writer(["minute", "lineID"])).trigger(availableNow=True).start().awaitTermination())
    lines = [x.split("|")[:2] for x in capsys.readouterr().out.splitlines() if x.startswith("2024-")]
    assert len(lines) == catalog.minute_flow_line(spark, SF_SMALL).count() and lines == sorted(lines)
