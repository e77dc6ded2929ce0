"""Daily files, day-partitioned overwrite, upsert."""

import os

from conftest import raw_frame, swipe

from gateflow.sinks.files import write_by_day
from gateflow.sinks.upsert import read_table, upsert
from gateflow.sources.daily_files import read_clean_layer, read_daily_csv


def test_daily_csv_day_from_file_name(spark, tmp_path):
    header = "time,lineID,stationID,deviceID,status,userID,payType\n"
    for day, body in (("2019-01-01", "2019-01-01 06:00:00,A,1,2,1,U1,0\n"),
                      ("2019-01-02", "2019-01-01 07:00:00,B,1,2,0,U2,1\n")):
        (tmp_path / f"record_{day}.csv").write_text(header + body)
    df = read_daily_csv(spark, str(tmp_path))
    got = {(r.service_date, r.time) for r in df.collect()}
    # the day key is the file's, even when the row's time says otherwise
    assert got == {("2019-01-01", "2019-01-01 06:00:00"), ("2019-01-02", "2019-01-01 07:00:00")}
    assert read_daily_csv(spark, str(tmp_path), days=["2019-01-02"]).count() == 1


def test_write_by_day_overwrites_only_given_days(spark, tmp_path):
    path = str(tmp_path / "clean")
    first = raw_frame(spark, [swipe(day="2019-01-01", user="a"), swipe(day="2019-01-02", user="b")])
    write_by_day(first, path)
    again = raw_frame(spark, [swipe(day="2019-01-02", user="c")])
    write_by_day(again, path)
    got = {(r.service_date, r.userID) for r in read_clean_layer(spark, path).collect()}
    assert got == {("2019-01-01", "a"), ("2019-01-02", "c")}
    assert not os.path.exists(os.path.join(path, "_SUCCESS"))
    assert read_clean_layer(spark, path, days=["2019-01-01"]).count() == 1


def _counts(spark, rows):
    return spark.createDataFrame(rows, "day string, slot string, n long")


def test_upsert_latest_wins_and_replay(spark, tmp_path):
    target = str(tmp_path / "t")
    upsert(_counts(spark, [("d1", "06:00", 1), ("d1", "06:30", 2), ("d2", "06:00", 5)]),
           target, ["day", "slot"], 1, partition_by=["day"])
    upd = _counts(spark, [("d1", "06:00", 10), ("d1", "07:00", 3)])
    upsert(upd, target, ["day", "slot"], 2, partition_by=["day"])
    upsert(upd, target, ["day", "slot"], 2, partition_by=["day"])   # replay
    got = {(r.day, r.slot, r.n) for r in read_table(spark, target).collect()}
    assert got == {("d1", "06:00", 10), ("d1", "06:30", 2), ("d1", "07:00", 3), ("d2", "06:00", 5)}
    # an older version never overwrites a newer one
    upsert(_counts(spark, [("d1", "06:00", 99)]), target, ["day", "slot"], 1, partition_by=["day"])
    got = {(r.slot, r.n) for r in read_table(spark, target).filter("day = 'd1'").collect()}
    assert ("06:00", 10) in got


def test_upsert_unpartitioned(spark, tmp_path):
    target = str(tmp_path / "p")
    upsert(spark.createDataFrame([("0", 5), ("1", 6)], "k string, v long"), target, ["k"], 1)
    upsert(spark.createDataFrame([("1", 7)], "k string, v long"), target, ["k"], 2)
    assert {(r.k, r.v) for r in read_table(spark, target).collect()} == {("0", 5), ("1", 7)}


def test_foreach_batch_writer_replay_is_noop(spark, tmp_path):
    from gateflow.sinks.upsert import upsert_batch_writer
    target = str(tmp_path / "s")
    write = upsert_batch_writer(target, ["day", "slot"], partition_by=["day"])
    b0 = _counts(spark, [("d1", "06:00", 1), ("d1", "06:01", 2)])
    b1 = _counts(spark, [("d1", "06:01", 5)])
    write(b0, 0)
    write(b1, 1)
    state = sorted(map(tuple, read_table(spark, target, keep_version=True).collect()))
    write(b1, 1)                                   # the same micro-batch again
    assert sorted(map(tuple, read_table(spark, target, keep_version=True).collect())) == state
    write(_counts(spark, []).limit(0), 2)          # empty batch: skipped
    assert sorted(map(tuple, read_table(spark, target, keep_version=True).collect())) == state
    assert {(r.slot, r.n) for r in read_table(spark, target).collect()} == {("06:00", 1), ("06:01", 5)}


def test_positional_rename_and_kafka_options(spark, tmp_path):
    from gateflow.sinks.kafka import kafka_source_options
    from gateflow.sources.daily_files import rename_positional
    (tmp_path / "r.csv").write_text("a,b,c,d,e,f,g\n2019-01-05 06:00:00,A,1,2,1,U1,0\n")
    df = rename_positional(spark.read.option("header", True).csv(str(tmp_path / "r.csv")))
    assert df.columns == ["time", "lineID", "stationID", "deviceID", "status", "userID", "payType"]
    opts = kafka_source_options("h:9092", "swipes", min_partitions=16)
    assert opts["startingOffsets"] == "latest" and opts["failOnDataLoss"] == "false"
    assert opts["subscribe"] == "swipes" and opts["minPartitions"] == "16"
