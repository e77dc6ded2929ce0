import random

from llm_rows import *  # noqa: F403

from gateflow.llm import decontam, queries

ITEMS = "item_id long, text string"


def plain(item, window):
    row, best = list(range(len(item) + 1)), (len(item), 0)
    for j, w in enumerate(window):
        new = [0]
        for i, x in enumerate(item):
            new.append(min(row[i] + (x != w), row[i + 1] + 1, new[i] + 1))
        row = new
        if row[-1] < best[0]:
            best = (row[-1], j + 1)
    return best


def test_bit_vectors_equal_plain_distance():
    r = random.Random(1)
    for _ in range(800):
        item = [r.choice("abcd") for _ in range(r.randrange(1, 90))]
        window = [r.choice("abcd") for _ in range(r.randrange(100))]
        assert decontam.distance(item, window) == plain(item, window)


def words(r, n):
    return [f"w{r.randrange(200)}" for _ in range(n)]


def test_find_equals_brute_force(spark, docs):
    r = random.Random(2)
    items = [" ".join(words(r, r.randrange(3, 40))) for _ in range(30)]
    texts = []
    for _ in range(60):
        t = words(r, r.randrange(5, 60))
        for item in r.sample(items, r.randrange(3)):
            part = item.split()
            for _ in range(r.randrange(1 + int(len(part) * 0.2))):
                at = r.randrange(len(part))
                part[at:at + r.randrange(2)] = ["new"] * r.randrange(2)
            at = r.randrange(len(t))
            t[at:at] = part
        texts.append(" ".join(t).upper() + ".")
    frame = spark.createDataFrame(list(enumerate(items)), ITEMS)
    got = {(x.doc_id, x.item_id): x.distance for x in decontam.find(docs(texts), frame).collect()}
    want = {}
    for i, t in enumerate(texts):
        for k, item in enumerate(items):
            ws = item.split()
            d, _ = plain(ws, decontam.words_of(t))
            if len(ws) >= decontam.LEAST_WORDS and d <= int(len(ws) * decontam.ERROR_RATE):
                want[i, k] = d
    assert got == want and len(want) > 20


def test_blocks_give_the_same(spark, docs, monkeypatch):
    texts = [f"before some words number {i} that are quite unique {i * 7} here after" for i in range(20)]
    items = spark.createDataFrame([(i, f"words number {i} that are quite unique {i * 7} here") for i in range(20)], ITEMS)
    once = sorted(map(tuple, decontam.find(docs(texts), items).collect()))
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 200)
    assert sorted(map(tuple, decontam.find(docs(texts), items).collect())) == once and len(once) >= 20
    assert decontam.clean(docs([*texts, "clean"]), items).count() == 1


def test_places(spark, docs):
    items = spark.createDataFrame([(1, "One two, three four five six seven eight")], ITEMS)
    got = decontam.find(docs(["x y one two three four FIVE new seven eight z"]), items).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 10)]


def test_odd_rows(spark, docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (None, "c d e f g h i"), (4, "c d e f g h i"),
                                   (4, "c d e f g h i")], ITEMS).selectExpr("*", "1 as distance")
    df = docs([*ODD, *ODD], [*range(len(ODD)), *[None] * len(ODD)])
    rows = decontam.find(df, items).collect()
    assert len(rows) == 6 and {r.item_id for r in rows} == {None, 4} and {r.doc_id for r in rows} == {None, 5}
    kept = decontam.clean(df, items)
    assert kept.columns == df.columns and kept.count() == 2 * len(ODD) - 2
    assert decontam.find(df, items.limit(0)).count() == 0 and decontam.find(docs([]), items).count() == 0


def test_query_finds_whole_items(spark):
    rows = queries.op6_decontamination(spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()
    lines = {d.doc_id: f" {' '.join(decontam.words_of(d.text))} " for d in docs}
    whole = {(d, b.item_id) for b in items for d, t in lines.items() if f" {' '.join(decontam.words_of(b.text))} " in t}
    assert whole and whole == {(r.doc_id, r.item_id) for r in rows if r.distance == 0}


def test_short_and_repeated_items(spark, docs):
    items = spark.createDataFrame([(1, "Yes."), (2, "two words"), (3, "c d e f g h")] * 3 + [(4, "...")], ITEMS)
    df = docs(["a yes b", "two  WORDS", "words two", "c d e f g h i"])
    assert {(r.doc_id, r.item_id) for r in decontam.find(df, items).collect()} == {(3, 3)}
    rows = [(r.doc_id, r.item_id) for r in decontam.find(df, items, least_words=1).collect()]
    assert sorted(rows) == [(0, 1)] * 3 + [(1, 2)] * 3 + [(3, 3)] * 3
    assert decontam.clean(df, items, least_words=1).count() == 1
    blocks = list(decontam.item_blocks(items, "item_id", "text"))
    assert [sorted(x[2] for x in b) for b in blocks] == [[1, 3, 3, 3]]
