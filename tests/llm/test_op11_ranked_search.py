import math
import re

from llm_rows import *  # noqa: F403
from pyspark.sql import functions as F

from gateflow.llm import ranked_search


def terms(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(ranked_search.TERM, low)


def brute(docs, items, k=10):
    """docs: (id, text); items: (id, text).  The contract, term by term."""
    words = [(i, terms(t)) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    total, length = len(words), sum(len(w) for _, w in words)
    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(terms(t))
    holds = {}
    for _, w in words:
        for t in set(w):
            holds[t] = holds.get(t, 0) + 1
    out = []
    for item, want in queries.items():
        found = []
        for i, w in words:
            m = 100 - 90 + (90 * len(w) * total) // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * holds[t] + 1)))
                        * ((1000000000 * w.count(t)) // (1000 * w.count(t) + 8 * m)) for t in want if t in w)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, i, -s))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


BASE = ["the cat sat on the mat", "The CAT; the dog", "a-b_c d1 É é", "cat", "cat", "mat mat mat cat", None, "", " ; ",
        "naïve café cat", "x" * 5000 + " cat", "dog " * 3000]


def test_equals_brute_force(spark, docs):
    texts = [*BASE, *ODD]
    ids = [7 if k in (3, 4) else None if k == 9 else 100 - k for k in range(len(texts))]
    items = [(1, "cat mat"), (2, "CAFÉ café naïve"), (3, "nothing at hand"), (4, None), (5, ""), (6, "the the THE"),
             (1, "dog"), (1, "dog"), (None, "again words"), (8, "é")]
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("id", F.lit("x")).withColumn("term", F.lit(1))
    df = docs(texts, ids)
    want = brute(list(zip(ids, texts)), items)
    assert got(ranked_search.search(df, q)) == want and len(want) > 10
    # Items in several blocks, each with its own scans, and one row a task.
    assert got(ranked_search.search(df.repartition(20), q, block_bytes=20)) == want
    assert got(ranked_search.search(df, q, k=2)) == brute(list(zip(ids, texts)), items, 2)


def test_rows_that_repeat_and_ties(spark, docs):
    texts = ["same text"] * 30 + ["other"]
    q = spark.createDataFrame([("a", "same"), ("b", "other")], "item_id string, text string")
    rows = got(ranked_search.search(docs(texts, [5] * 15 + list(range(15)) + [99]).repartition(7), q))
    assert [r[1:3] for r in rows if r[0] == "a"] == [
        (1, 0), (10, 5), (2, 1), (3, 2), (4, 3), (5, 4), (6, 5), (7, 5), (8, 5), (9, 5)]
    assert [r[1:3] for r in rows if r[0] == "b"] == [(1, 99)]


def test_empty_tables(spark, docs):
    q = spark.createDataFrame([(1, "cat")], "item_id long, text string")
    assert got(ranked_search.search(docs([]), q)) == []
    assert got(ranked_search.search(docs(["cat"]), q.limit(0))) == []


def test_slices_keep_terms_whole(monkeypatch):
    monkeypatch.setattr(ranked_search, "SLICE", 5)
    found = ranked_search.automaton(["cat", "cats", "at"])
    n, tf = ranked_search.frequencies(b"cat  cats;cat at concat cat\n", found)
    assert n == 6 and dict(tf) == {0: 3, 1: 1, 2: 1}
