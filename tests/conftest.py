import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from gateflow.session import get_session

    extra = {"spark.ui.showConsoleProgress": "false"}
    # Tests set their own shared folder only when the session has none.
    from pyspark import SparkConf
    if not SparkConf().get("spark.checkpoint.dir", None):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="gateflow-test-")
    s = get_session(master="local[4]", app_name="gateflow-tests", shuffle_partitions=4,
                    extra_conf=extra)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


RAW_COLS = ["service_date", "time", "lineID", "stationID", "deviceID", "status", "userID", "payType"]


def raw_frame(spark, rows):
    from gateflow.schemas import RAW_WITH_DAY_SCHEMA
    return spark.createDataFrame(rows, RAW_WITH_DAY_SCHEMA)


def swipe(day="2019-01-05", time=None, line="A", station="3", device="10", status="1",
          user="U1", pay="0"):
    return (day, time if time is not None else f"{day} 06:10:00", line, station, device,
            status, user, pay)
