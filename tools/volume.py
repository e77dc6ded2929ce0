"""Volume check: replicate ``events`` K times (a generator, no join), write
the swipe projection once as a raw parquet layer, then time the one-pass
report, the clean-layer write and the analyses on the clean layer.

    python tools/volume.py K OUT_DIR [SF_DIR]      # K=575 -> ~58.6 M rows

Set VOLUME_STEPS=clean_all to time only the shared-grouping cleaning
(clean layer + rejects + report written from one shuffle).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    from gateflow.operators import flows, quality
    from gateflow.operators.records import typed
    from gateflow.session import get_session
    from gateflow.sinks.files import write_by_day
    from gateflow.sources.daily_files import read_clean_layer
    from gateflow.sources.fixture import FIXTURE_PERIOD as P
    from gateflow.sources.fixture import raw_swipes

    k, out = int(sys.argv[1]), sys.argv[2].rstrip("/")
    sf_dir = sys.argv[3] if len(sys.argv) > 3 else "/root/testdata/sf0.1"
    spark = get_session(master="local[8]", shuffle_partitions=64,
                        extra_conf={"spark.ui.showConsoleProgress": "false",
                                    "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        print(f"{name:40s} {time.perf_counter() - t0:8.2f} s", flush=True)

    def noop(df):
        return lambda: df.write.format("noop").mode("overwrite").save()

    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id")
    rep = (ev.select(F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("k"), "event_id", "ts", "user_id")
             .repartition(64)
             .select((F.col("event_id") * k + F.col("k")).alias("event_id"), "ts",
                     ((F.col("user_id") * 7 + F.col("k")) % 15000).alias("user_id")))
    raw_path = f"{out}/raw"
    if not os.path.exists(raw_path):
        timed("materialise raw layer", lambda: raw_swipes(rep).write.parquet(raw_path))
    raw = spark.read.parquet(raw_path)
    print("raw rows", raw.count(), flush=True)
    if os.environ.get("VOLUME_STEPS") == "clean_all":
        from gateflow.sinks.files import write_table

        def shared():
            res = quality.clean_all(raw, P)
            try:
                write_by_day(res.clean, f"{out}/clean_all/clean")
                write_table(res.rejects, f"{out}/clean_all/rejects", partition_by=["service_date"])
                write_table(res.report, f"{out}/clean_all/report", partition_by=["service_date"])
            finally:
                res.release()
        timed("clean_all: clean + rejects + report", shared)
        spark.stop()
        return
    timed("report (one pass)", noop(quality.report(raw, P)))
    timed("clean -> day-partitioned clean layer", lambda: write_by_day(quality.clean(raw, P), f"{out}/clean"))
    t = typed(read_clean_layer(spark, f"{out}/clean"))
    for name, fn in [("halfhour_flow", flows.halfhour_flow), ("station_top10", flows.station_top10),
                     ("line_flow_daily_with_total", flows.line_flow_daily_with_total),
                     ("paytype_distribution", flows.paytype_distribution)]:
        timed(f"{name} (clean layer)", noop(fn(t)))
    timed("week_comparison (clean layer)", noop(flows.week_comparison(t, P)))
    timed("rejects (one grouping)", noop(quality.rejects(raw, P)))
    from gateflow.sinks.upsert import compact, read_table, upsert
    from gateflow.sources.lines import strict_records, to_line
    from gateflow.operators.minute import minute_flow_station

    # Upserts of the largest result table: stations by minute, in two versions.
    stations = minute_flow_station(strict_records(to_line(raw))).withColumn(
        "day", F.date_format("minute", "yyyy-MM-dd"))
    for version in (1, 2):
        timed(f"upsert station minutes, version {version}", lambda v=version: upsert(
            stations, f"{out}/stations", ["minute", "lineID", "stationID"], v, ["day"], unique_keys=True))
    timed("read one day of the table", noop(read_table(spark, f"{out}/stations").where("day = '2024-01-03'")))
    timed("compact the table", lambda: compact(spark, f"{out}/stations"))
    spark.stop()


if __name__ == "__main__":
    main()
