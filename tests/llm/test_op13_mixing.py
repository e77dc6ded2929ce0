import math
import re

from llm_rows import *  # noqa: F403
from pyspark.sql import functions as F

from gateflow.llm import mixing


def brute_targets(sizes):
    """Targets of {source: size}: shared by weight, stopped, the rest shared anew."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    stopped, left = set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in stopped]
        rest = left - sum(3 * sizes[s] for s in stopped)
        over = [s for s in free if rest / sum(weight[x] for x in free) * weight[s] > 3 * sizes[s]] if left else []
        if not over:
            return {s: 3.0 * sizes[s] if s in stopped else rest / sum(weight[x] for x in free) * weight[s] for s in names}
        stopped.update(over)


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    for c in [*CLASH, "part", "place", "tie", "rank", "size", "name", "first", "before", "step", "offset", "copies"]:
        df = df.withColumn(c, F.lit("x"))
    return df


def check(rows, out):
    by = {}
    for _, t, s, _ in rows:
        by[s] = by.get(s, 0) + size(t)
    want = brute_targets(by)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in out) == sorted(
        (i is None, i or 0, size(t)) for i, t, _, _ in rows)
    taken, longest = dict.fromkeys(by, 0), dict.fromkeys(by, 0)
    for r in out:
        assert r.source_size == by[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-12)
        expected = r.target / r.source_size if r.source_size else 0
        assert math.floor(expected) <= r.copies <= math.ceil(expected) <= 3
        taken[r.source] += r.copies * r.size
        longest[r.source] = max(longest[r.source], r.size)
    for s in by:
        assert abs(taken[s] - want[s]) <= 2 * longest[s], s
    return taken


def rows_for(spark):
    # A source with most of all rows, sources far under their share, one without words, a null one.
    rows = [(i, "w " * (i * i % 97 + 1), "hot", None) for i in range(700)]
    rows += [(1000 + i, "a b c " * (i % 5), "asmall", None) for i in range(40)]
    rows += [(2000 + i, "x " * (3 + i % 11), None, None) for i in range(90)]
    rows += [(3000 + i, "", "empty", None) for i in range(5)] + [(None, None, "empty", None)]
    rows += [(4000 + i, "y\x0bz\x1c " * 50, "Big", None) for i in range(60)] + [(4000, "y " * 7, "Big", None)] * 9
    return rows


def test_targets_and_copies(spark):
    rows = rows_for(spark)
    out = mixing.mix(frame(spark, rows)).collect()
    check(rows, out)
    again = mixing.mix(frame(spark, rows[::-1]).repartition(9)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.copies)
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_copies_follow_the_prefix_sum(spark):
    rows = [(i, "w " * (i % 13), "s", None) for i in range(500)] + [(i, "v " * 40, "t", None) for i in range(500, 600)]
    out = mixing.mix(frame(spark, rows), weights=(1, 7)).collect()
    for s in ("s", "t"):
        mine = sorted((r for r in out if r.source == s), key=lambda r: (r.size, r.doc_id))
        step = math.floor(mine[0].target / mine[0].source_size * 2 ** 40)
        import hashlib
        at = int(hashlib.sha256(f"1={s}".encode()).hexdigest()[:10], 16)
        for r in mine:
            assert r.copies == ((at + step) >> 40) - (at >> 40)
            at += step


def test_emitted_rows_are_the_mix(spark):
    rows = rows_for(spark)
    df = frame(spark, rows)
    mixed = mixing.mix(df, keep=df.columns)
    out = mixing.emit(mixed)
    assert out.columns == [*df.columns, "copy"]
    taken = {}
    for r in out.select("source", "text").collect():
        taken[r.source] = taken.get(r.source, 0) + size(r.text)
    assert {s: n for s, n in check(rows, mixed.collect()).items() if n} == {s: n for s, n in taken.items() if n}


def test_no_rows_and_no_words(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    out = mixing.mix(frame(spark, [(1, None, None, None), (1, None, None, None), (2, "", "a", None)])).collect()
    assert [(r.target, r.copies, r.size) for r in out] == [(0.0, 0, 0)] * 3


def test_equal_rows_spread_over_ranges(spark):
    rows = [(1, "w w", "hot", None)] * 2000 + [(2, "a b c", "cold", None)] * 10
    check(rows, mixing.mix(frame(spark, rows)).collect())
    placed = mixing.placed(spark, frame(spark, rows), [F.asc("source"), F.asc("doc_id")], "t")
    assert placed.groupBy("part").count().agg(F.max("count")).first()[0] < 1200
