import itertools
import random

import numpy as np
from llm_rows import *  # noqa: F403

from gateflow.llm import near_dup, queries
from gateflow.llm.common import components, word_hashes


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


def parts(text):
    flat, _ = word_hashes([text or ""])
    return flat, near_dup.kmers(flat)


def near(a, b):
    """The rule for two texts, without sketches, families or blocks."""
    (a, ka), (b, kb) = a, b
    shared = len(set(ka.tolist()) & set(kb.tolist()))
    return bool(shared) and shared >= 0.2 * min(len(ka), len(kb)) and near_dup.aligned(a, b, ka, kb) >= 0.8 - 1e-9


def brute_classes(texts):
    ks = [parts(t) for t in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if (texts[i] or "") == (texts[j] or "") or top(i) != top(j) and near(ks[i], ks[j]):
            a, b = sorted((top(i), top(j)))
            root[b] = a
    return [top(i) for i in range(len(texts))]


def edited(r, words, rate):
    out = []
    for w in words:
        x = r.random()
        if x < rate / 3:
            continue
        out.append(f"new{r.randrange(10**6)}" if x < 2 * rate / 3 else w)
        if 2 * rate / 3 <= x < rate:
            out.append(f"more{r.randrange(10**6)}")
    return out


def test_edits_equal_the_distance():
    r = random.Random(5)
    for _ in range(400):
        a = [r.choice("abcde") for _ in range(r.randrange(0, 25))]
        b = edited(r, a, r.choice([0, 0.1, 0.4])) + [r.choice("abcde") for _ in range(r.randrange(6))]
        code = {w: i for i, w in enumerate({*a, *b})}
        x, y = (np.array([code[w] for w in t], dtype=np.uint64) for t in (a, b))
        true = distance(a, b)
        for most in (0, 1, 3, 8, 40):
            assert near_dup.edits(x, y, most) == min(true, most + 1)


def test_aligned_is_the_edit_similarity():
    r = random.Random(2)
    agree = total = 0
    for n in range(400):
        few = [f"w{i}" for i in range(r.choice([8, 3000]))]
        a = [r.choice(few) for _ in range(r.randrange(1, 90))]
        b = edited(r, a, r.choice([0, 0.02, 0.05, 0.1, 0.2, 0.3])) + a[:r.randrange(6)]
        if r.random() < 0.2:        # a moved passage
            at = r.randrange(len(b) + 1)
            b = b[at:] + b[:at]
        if not b:
            continue
        x, y = parts(" ".join(a)), parts(" ".join(b))
        true = 1 - distance(a, b) / max(len(a), len(b))
        got = near_dup.aligned(x[0], y[0], x[1], y[1])
        assert got == 0 or 0.8 - 1e-9 <= got <= true + 1e-9
        if true >= 0.8 and set(x[1].tolist()) & set(y[1].tolist()):
            total += 1
            agree += got > 0
    assert total > 100 and agree >= 0.98 * total


def test_recall_of_edited_copies_and_precision():
    """Pairs of which 1 to 5 % of the words were changed meet in a sketch and
    are near; texts of other words or with half of another text are not."""
    r = random.Random(11)
    words = [f"w{i}" for i in range(5000)]
    for rate in (0.01, 0.02, 0.03, 0.05):
        found = 0
        for _ in range(60):
            a = r.choices(words, k=r.randrange(60, 400))
            x, y = parts(" ".join(a)), parts(" ".join(edited(r, a, rate)))
            found += bool((near_dup.sketches(x[1]) == near_dup.sketches(y[1])).any()) and near(x, y)
        assert found >= 0.95 * 60, (rate, found)
    for _ in range(60):
        a = r.choices(words, k=200)
        assert not near(parts(" ".join(a)), parts(" ".join(a[:100] + r.choices(words, k=100))))


def test_sketches_follow_order_similarity():
    r = random.Random(3)
    base = [f"w{i}" for i in range(400)]
    flat, _ = word_hashes([" ".join(base)])
    k = near_dup.kmers(flat)
    for _ in range(40):
        other = near_dup.kmers(word_hashes([" ".join(edited(r, base, 0.02))])[0])
        assert (near_dup.sketches(k) == near_dup.sketches(other)).any()
    far = near_dup.kmers(word_hashes([" ".join(f"v{i}" for i in range(400))])[0])
    assert not (near_dup.sketches(k) == near_dup.sketches(far)).any()
    # Very long texts are sketched one order at a time, with the same result.
    long = near_dup.kmers(word_hashes([" ".join(str(i) for i in range(300_000))])[0])
    part = np.array([long[np.sort(np.argsort(near_dup.mix(long ^ s))[:near_dup.KEPT])] for s in near_dup._SEEDS])
    want = near_dup.mix((part * near_dup._MULTS[None, :near_dup.KEPT]).sum(axis=1, dtype=np.uint64) ^ near_dup._SEEDS)
    assert (near_dup.sketches(long) == want).all()


def corpus(seed, families=6, most=25, passage=False):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    shared = r.choices(words, k=60)
    texts = []
    for _ in range(families):
        base = r.choices(words, k=r.randrange(20, 150)) + (shared if passage else [])
        for _ in range(r.randrange(1, most)):
            texts.append(" ".join(edited(r, base, r.choice([0, 0.01, 0.03, 0.08]))))
    r.shuffle(texts)
    return texts


def check(got, texts):
    want = brute_classes(texts)
    ids = {r.doc_id: r for r in got}
    assert [ids[i].class_id for i in range(len(texts))] == want
    assert all(ids[i].class_rows == want.count(want[i]) for i in range(len(texts)))
    assert sorted(i for i, r in ids.items() if r.head) == sorted(set(want))


def test_classes_equal_brute_force(docs):
    texts = corpus(1) + corpus(2, passage=True) + [None, "", "one two", "one two", "One  two", "a b c d e f"]
    check(near_dup.classes(docs(texts)).collect(), texts)


def test_families_in_blocks_equal_brute_force(docs, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_KMERS", 500)
    texts = corpus(4, families=2, most=60)
    check(near_dup.classes(docs(texts)).collect(), texts)


def test_odd_rows_and_keep_one(docs):
    texts = [*ODD, *ODD, "lost id words here now", "lost id words here now"]
    ids = [*range(len(ODD)), *range(len(ODD)), None, None]
    df = docs(texts, ids)
    rows = near_dup.classes(df).collect()
    assert len(rows) == len(texts)
    null = [r for r in rows if r.doc_id == 0][0]
    assert null.class_id == 0 and null.class_rows == 4  # null and empty texts are copies
    assert [r.class_rows for r in rows if r.doc_id is None] == [2, 2]
    kept = near_dup.keep_one(df)
    assert kept.columns == df.columns
    got = [r.doc_id for r in kept.collect()]
    assert sorted(got, key=str) == sorted([None, *(i for i in range(len(ODD)) if i != 1)], key=str)
    assert near_dup.classes(docs([])).count() == 0 and near_dup.keep_one(docs([])).count() == 0


def test_components(spark):
    r = random.Random(7)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 150)] + [(200, 200)]
    pairs += [(r.randrange(300, 340), r.randrange(300, 340)) for _ in range(30)]
    root = {}

    def top(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in pairs:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    want = {i: top(i) for a, b in pairs if a != b for i in (a, b)}
    got = components(spark, spark.createDataFrame(pairs, "a long, b long"), "test_components").collect()
    assert {x.node: x.root for x in got} == want and len(got) == len(want)
    assert components(spark, spark.createDataFrame([], "a long, b long"), "test_components").count() == 0


def test_query_covers_every_document(spark):
    rows = queries.op3_near_duplicates(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    assert sorted(r.doc_id for r in rows) == [d.doc_id for d in docs]
    least = {}
    for d in docs:
        least.setdefault(d.text, d.doc_id)
    by = {r.doc_id: r.class_id for r in rows}
    assert all(by[d.doc_id] == by[least[d.text]] <= d.doc_id for d in docs)


def test_any_column_names_stay(docs):
    df = docs(["a b c d e f", "a b c d e f", "other words"], clash=False)
    for c in ("__place", "place", "row", "a.b", "text2"):
        df = df.withColumn(c, df.doc_id * 10)
    kept = near_dup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.place, r["__place"], r["a.b"]) for r in kept.collect()) == [(0, 0, 0, 0), (2, 20, 20, 20)]


def test_a_task_sends_equal_texts_once(docs, monkeypatch):
    monkeypatch.setattr(near_dup, "REMEMBERED", 2)
    df = docs(["hot"] * 50 + [f"t{i}" for i in range(20)] + ["hot"] * 50).coalesce(1)
    rows = [r.text for r in near_dup._one_each(df, "text").collect()]
    assert set(rows) == {"hot", *(f"t{i}" for i in range(20))} and len(rows) <= 23
