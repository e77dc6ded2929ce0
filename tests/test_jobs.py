"""End to end: daily CSV files -> clean job -> the five analysis jobs, and
the CLI; results equal the registered queries on the same rows."""

from conftest import SF_SMALL

from gateflow.__main__ import main as cli
from gateflow.operators import flows, quality
from gateflow.operators.records import typed
from gateflow.plans import jobs
from gateflow.sinks.upsert import read_table
from gateflow.sources.fixture import FIXTURE_PERIOD as P
from gateflow.sources.fixture import raw_swipes_from_dir


def _daily_files(spark, folder):
    """Write the fixture's raw rows as one header CSV per day (test setup)."""
    pdf = raw_swipes_from_dir(spark, SF_SMALL).toPandas()
    folder.mkdir()
    for day, part in pdf.groupby("service_date"):
        part.drop(columns=["service_date"]).to_csv(folder / f"record_{day}.csv", index=False)
    return pdf


def test_clean_and_analyses(spark, tmp_path):
    _daily_files(spark, tmp_path / "raw")
    out = str(tmp_path / "out")
    report = jobs.clean_job(spark, str(tmp_path / "raw"), out, P)
    want = quality.report(raw_swipes_from_dir(spark, SF_SMALL), P)
    # CSV has no NULL/empty distinction for the missing pay types, which
    # read back as NULL as well, so the report is identical.
    assert sorted(map(tuple, report.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))

    clean_path = f"{out}/clean"
    jobs.halfhour_job(spark, clean_path, out, P)
    jobs.daily_line_job(spark, clean_path, out, P)
    jobs.paytype_job(spark, clean_path, out, P)
    jobs.station_job(spark, clean_path, out, P)
    jobs.line_halfhour_job(spark, clean_path, out, P)
    t = typed(quality.clean(raw_swipes_from_dir(spark, SF_SMALL), P))
    got = read_table(spark, f"{out}/passenger_flow").select("service_date", "time_slot", "traffic_count")
    week_days = P.days([1, *range(5, 26)])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, flows.halfhour_flow(t, week_days).collect()))
    got = read_table(spark, f"{out}/daily_line_flow").select("service_date", "lineID", "passenger_flow")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, flows.line_flow_daily_with_total(t).collect()))
    assert read_table(spark, f"{out}/paytype").count() == 4

    # Re-running an analysis replaces its keys and keeps the table size.
    before = read_table(spark, f"{out}/passenger_flow").count()
    jobs.halfhour_job(spark, clean_path, out, P)
    assert read_table(spark, f"{out}/passenger_flow").count() == before


def test_cli_clean(spark, tmp_path):
    _daily_files(spark, tmp_path / "raw")
    out = tmp_path / "out"
    cli(["clean", "--raw", str(tmp_path / "raw"), "--out", str(out), "--month", "2024-01"])
    assert spark.read.parquet(str(out / "report")).count() > 0
    texts = spark.read.json(str(out / "report_text")).collect()
    assert texts[0].text.startswith("File: record_2024-01-")
