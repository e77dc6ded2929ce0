"""Minute flow on a file stream equals the batch result; late
rows behind the watermark are dropped; rejects go to their own sink."""

import os
import time
import uuid

from gateflow.operators import minute
from gateflow.session import scratch_path
from gateflow.sinks.upsert import read_table
from gateflow.sources import lines as L
from gateflow.sources.streams import text_line_stream
from gateflow.streaming import minute_flow as S


def _write_batches(folder, batches):
    """One file per micro-batch.  The file source orders files by
    modification time, so each gets a distinct, increasing one."""
    folder.mkdir()
    base = time.time() - 1000
    for i, msgs in enumerate(batches):
        f = folder / f"part-{i:03d}.txt"
        f.write_text("\n".join(msgs) + "\n")
        os.utime(f, (base + i * 10, base + i * 10))


def _run(spark, folder, keys, mode):
    lines = text_line_stream(spark, str(folder), max_files_per_trigger=1)
    target = scratch_path(spark, "test-tables")
    return S.run_to_completion(lines, target, keys, mode, f"t_{uuid.uuid4().hex[:8]}",
                               run_id=uuid.uuid4().hex)


B0 = ["2019-01-05 06:00:10,A,3,10,1,U1,0", "2019-01-05 06:00:20,A,4,10,0,U2,0",
      "2019-01-05 06:00:30,B,4,10,1,U2,0", "garbage"]
B1 = ["2019-01-05 06:01:10,A,3,10,1,U1,0", "2019-01-05 06:00:50,A,3,10,1,U3,0"]
B2 = ["2019-01-05 06:02:10,A,3,10,1,U1,0"]
B3 = ["2019-01-05 06:05:10,A,3,10,1,U1,0"]
B4 = ["2019-01-05 06:06:10,A,3,10,1,U1,0"]
LATE = ["2019-01-05 06:00:59,A,3,10,1,U9,0"]


def test_update_mode_equals_batch(spark, tmp_path):
    src = tmp_path / "in"
    _write_batches(src, [B0, B1, B2])
    out = _run(spark, src, S.LINE_KEYS, "update")
    got = {(str(r.minute), r.lineID, r.total_flow, r.exit_count, r.entry_count) for r in out.collect()}
    batch = minute.minute_flow_line(L.strict_records(
        spark.createDataFrame([(v,) for v in B0 + B1 + B2], "value string")))
    want = {(str(r.minute), r.lineID, r.total_flow, r.exit_count, r.entry_count) for r in batch.collect()}
    assert got == want


def test_station_keys(spark, tmp_path):
    src = tmp_path / "in"
    _write_batches(src, [B0])
    out = _run(spark, src, S.STATION_KEYS, "update")
    assert {(r.lineID, r.stationID) for r in out.collect()} == {("A", 3), ("A", 4), ("B", 4)}


def test_append_mode_emits_closed_minutes_only(spark, tmp_path):
    src = tmp_path / "in"
    _write_batches(src, [B0, B1, B2])
    out = _run(spark, src, S.LINE_KEYS, "append")
    minutes = {str(r.minute)[11:16] for r in out.collect()}
    # watermark = 06:02 - 1 min = 06:01; only windows ending <= 06:01 close
    assert minutes == {"06:00"}


def test_late_rows_behind_watermark_are_dropped(spark, tmp_path):
    src = tmp_path / "in"
    # The late row comes two batches after the watermark passed its window.
    _write_batches(src, [B0, B2, B3, B4, LATE])
    out = _run(spark, src, S.LINE_KEYS, "update")
    a0600 = [r for r in out.collect() if r.lineID == "A" and str(r.minute).endswith("06:00:00")]
    assert a0600[0].total_flow == 2


def test_rejects_stream(spark, tmp_path):
    src = tmp_path / "in"
    _write_batches(src, [B0, ["2019-01-05 06:00:10,A,x,10,1,U1,0"]])
    lines = text_line_stream(spark, str(src), max_files_per_trigger=1)
    target = scratch_path(spark, "test-rejects")
    q = S.start_rejects(lines, target, "rej_" + uuid.uuid4().hex[:8],
                        checkpoint=scratch_path(spark, "test-ckpt"), trigger={"availableNow": True})
    q.awaitTermination()
    got = sorted(r.reject_reason for r in spark.read.parquet(target).collect())
    assert got == ["field_count", "not_an_int"]


def test_restart_resumes_from_checkpoint(spark, tmp_path):
    src = tmp_path / "in"
    _write_batches(src, [B0])
    target = scratch_path(spark, "test-tables")
    ck = scratch_path(spark, "test-ckpt")
    name = "resume_" + uuid.uuid4().hex[:8]
    for _ in range(2):   # second start finds nothing new and changes nothing
        q = S.start_minute_flow(text_line_stream(spark, str(src)), target, S.LINE_KEYS, "update",
                                name, checkpoint=ck, trigger={"availableNow": True})
        q.awaitTermination()
    got = {(r.lineID, r.total_flow) for r in read_table(spark, target).collect()}
    assert got == {("A", 2), ("B", 1)}


def test_single_query_line_rollup_equals_two_queries(spark, tmp_path):
    src = tmp_path / "in"
    # Batch 1 changes only station A-3 of minute 06:00; the line row must
    # still include station A-4 from batch 0.
    _write_batches(src, [B0, ["2019-01-05 06:00:40,A,3,10,1,U7,0"], B1, B2])
    station_t = scratch_path(spark, "test-tables")
    line_t = scratch_path(spark, "test-tables")
    q = S.start_station_and_line_flow(text_line_stream(spark, str(src), max_files_per_trigger=1),
                                      station_t, line_t, "update", "roll_" + uuid.uuid4().hex[:8],
                                      checkpoint=scratch_path(spark, "test-ckpt"),
                                      trigger={"availableNow": True},
                                      partition_by=S.HOURLY_PARTITIONS)
    q.awaitTermination()
    assert q.exception() is None
    got = {(str(r.minute), r.lineID, r.total_flow, r.exit_count, r.entry_count)
           for r in read_table(spark, line_t).collect()}
    two = _run(spark, src, S.LINE_KEYS, "update")
    want = {(str(r.minute), r.lineID, r.total_flow, r.exit_count, r.entry_count) for r in two.collect()}
    assert got == want
    a0600 = [r for r in got if r[1] == "A" and r[0].endswith("06:00:00")]
    assert a0600[0][2] == 4


def test_append_rollup_from_batch_equals_table_rollup(spark, tmp_path):
    src = tmp_path / "in"
    _write_batches(src, [B0, ["2019-01-05 06:00:40,A,3,10,1,U7,0"], B1, B2, B3])
    station_t = scratch_path(spark, "test-tables")
    line_t = scratch_path(spark, "test-tables")
    q = S.start_station_and_line_flow(text_line_stream(spark, str(src), max_files_per_trigger=1),
                                      station_t, line_t, "append", "app_" + uuid.uuid4().hex[:8],
                                      checkpoint=scratch_path(spark, "test-ckpt"),
                                      trigger={"availableNow": True})
    q.awaitTermination()
    lines = {(str(r.minute), r.lineID, r.total_flow) for r in read_table(spark, line_t).collect()}
    from_stations = {(str(r.minute), r.lineID, r.total_flow)
                     for r in S.line_rollup(read_table(spark, station_t)).collect()}
    assert lines == from_stations
    assert ("2019-01-05 06:00:00", "A", 4) in lines


def test_stream_jobs_with_console(spark, tmp_path, capsys):
    from gateflow.plans import jobs
    src = tmp_path / "in"
    _write_batches(src, [B0])
    out = scratch_path(spark, "test-jobs")
    qs = jobs.start_stream_jobs(text_line_stream(spark, str(src)), out, "update",
                                trigger={"availableNow": True}, console=True)
    S.await_all(spark, qs)
    got = {(r.lineID, r.total_flow) for r in read_table(spark, f"{out}/line_statistics").collect()}
    assert got == {("A", 2), ("B", 1)}
    assert spark.read.parquet(f"{out}/stream_rejects").count() == 1
