"""Message encoding and both parsers."""

from gateflow.sources import lines as L

GOOD = "2019-01-05 06:10:00,A,3,10,1,U1,0"


def _frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def _strict(spark, value):
    return L.parse_strict(_frame(spark, [value])).collect()[0]


def test_strict_accepts_good_and_trims(spark):
    r = _strict(spark, GOOD)
    assert r.is_valid and r.stationID == 3 and r.payType == 0
    r = _strict(spark, "2019-01-05 06:10:00 , A , 5 ,10,1,U1, 0 ")
    assert r.is_valid and r.lineID == "A" and r.stationID == 5 and r.payType == 0


def test_strict_field_count(spark):
    assert _strict(spark, "2019-01-05 06:10:00,A,3,10,1,U1").reject_reason == "field_count"
    assert _strict(spark, GOOD + ",x").reject_reason == "field_count"
    # Java split drops trailing empty fields: 6 fields + "," is 6 fields.
    assert _strict(spark, "2019-01-05 06:10:00,A,3,10,1,U1,").reject_reason == "field_count"


def test_strict_int_fields(spark):
    assert _strict(spark, "2019-01-05 06:10:00,A,5.0,10,1,U1,0").reject_reason == "not_an_int"
    assert _strict(spark, "2019-01-05 06:10:00,A,,10,1,U1,0").reject_reason == "not_an_int"
    assert _strict(spark, "2019-01-05 06:10:00,A,+5,10,1,U1,0").is_valid


def test_strict_bad_time(spark):
    assert _strict(spark, "2019-01-32 06:10:00,A,3,10,1,U1,0").reject_reason == "bad_time"


def test_records_and_rejects_partition_the_input(spark):
    vals = [GOOD, "bad", "2019-01-05 06:10:00,A,x,10,1,U1,0", None]
    df = _frame(spark, vals)
    assert L.strict_records(df).count() == 1
    reasons = sorted(r.reject_reason for r in L.strict_rejects(df).collect())
    assert reasons == ["field_count", "not_an_int", "null_message"]


def test_lax_parser(spark):
    df = _frame(spark, [GOOD + ",extra", "2019-01-05 06:10:00,A,3,10,1,U1,",
                        "2019-01-05,A,3,10,1,U1,0"])
    rows = L.parse_lax(df).collect()
    assert rows[0].is_valid and rows[0].minute == "2019-01-05 06:10"
    assert rows[1].reject_reason == "field_count"
    assert rows[2].reject_reason == "short_time"
    assert L.lax_records(df).count() == 1


def test_to_line_roundtrip(spark):
    from gateflow.schemas import RAW_SCHEMA
    df = spark.createDataFrame([tuple(GOOD.split(","))], RAW_SCHEMA)
    assert L.to_line(df).collect()[0].value == GOOD
    nulls = spark.createDataFrame([("t", "A", None, "1", "1", "U", None)], RAW_SCHEMA)
    assert L.to_line(nulls).collect()[0].value == "t,A,,1,1,U,"
