"""K4/T15 against a model: after any sequence of versioned loads (out of
order, with replays), each key holds the value of the highest version that
contained it."""

import uuid

from hypothesis import given, settings
from hypothesis import strategies as st

from gateflow.session import scratch_path
from gateflow.sinks.upsert import read_table, upsert

KEYS = [("d1", "s1"), ("d1", "s2"), ("d2", "s1"), ("d3", "s3")]
LOAD = st.lists(st.tuples(st.sampled_from(KEYS), st.integers(0, 99)), min_size=1, max_size=4,
                unique_by=lambda kv: kv[0])


@settings(max_examples=8, deadline=None)
@given(st.lists(LOAD, min_size=1, max_size=3), st.permutations(range(3)), st.booleans())
def test_upsert_matches_model(spark, loads, order, replay):
    loads = {v + 1: rows for v, rows in enumerate(loads)}          # version -> rows
    sequence = [v + 1 for v in order if v + 1 in loads]
    if replay:
        sequence.append(sequence[0])                                 # an old batch again
    target = scratch_path(spark, "prop-upsert") + uuid.uuid4().hex[:6]
    for v in sequence:
        df = spark.createDataFrame([(d, s, n) for (d, s), n in loads[v]], "day string, slot string, n long")
        upsert(df, target, ["day", "slot"], v, partition_by=["day"])
    want = {}
    for v in sorted(loads):
        for key, n in loads[v]:
            want[key] = n
    got = {(r.day, r.slot): r.n for r in read_table(spark, target).collect()}
    assert got == want
