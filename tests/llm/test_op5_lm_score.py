import math
from collections import Counter

import numpy as np
from llm_rows import *  # noqa: F403
from pyspark.sql import functions as F

from gateflow.llm import lm_score
from gateflow.llm.common import word_hashes

LABELS = "doc_id long, quality int"


def brute(texts, target):
    """Scores by plain counting over (text, token) lists."""
    def numbers(t):
        flat, _ = word_hashes([t or ""], symbols=True)
        return [0, *flat.tolist(), 0]

    seqs = [numbers(t) for t in texts]
    pairs = [list(zip(s, s[1:])) for s in seqs]
    out = []
    for i, ps in enumerate(pairs):
        losses = []
        for chosen in (set(range(len(texts))), set(target)):
            two = Counter(p for j, q in enumerate(pairs) if j in chosen and j != i for p in q)
            one = Counter()
            for p, n in two.items():
                one[p[1]] += n
            total = sum(one.values())
            a, b, c = lm_score.MIXTURE
            losses.append([-math.log(a * min(two[p] / max(one[p[0]], 1), 1) + b * one[p[1]] / max(total, 1)
                                     + c / lm_score.VOCABULARY) for p in ps])
        out.append((len(ps), np.mean(losses[1]), np.mean(losses[0])))
    return out


def test_equals_plain_counting(spark, docs):
    texts = ["the cat sat on the mat", "the dog sat", None, "", "a cat; a dog!!", "the cat sat on the mat", "x | y | z | z"]
    labels = spark.createDataFrame([(0, 1), (1, 1), (4, 0), (4, 0), (5, 1), (None, 1), (99, 1)], LABELS)
    got = {r.doc_id: r for r in lm_score.score(docs(texts), labels, F.col("quality") == 1).collect()}
    for i, (n, t, b) in enumerate(brute(texts, {0, 1, 5})):
        assert got[i].n_tokens == n
        assert math.isclose(got[i].target_loss, t, rel_tol=1e-9) and math.isclose(got[i].background_loss, b, rel_tol=1e-9)
        assert math.isclose(got[i].score, t - b, abs_tol=1e-9)


def test_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = lm_score.score(d, labels.where("doc_id % 2 = 0"), F.col("quality") == 1)
    rows = scored.join(labels.where("doc_id % 2 = 1"), "doc_id").select("score", "quality").collect()
    good = np.array([r.score for r in rows if r.quality == 1])
    bad = np.array([r.score for r in rows if r.quality == 0])
    assert (good[:, None] < bad[None, :]).mean() > 0.8


def test_odd_rows(spark, docs):
    df = docs([*ODD, *ODD], [*range(len(ODD)), *[None] * len(ODD)])
    none = spark.createDataFrame([], LABELS)
    rows = lm_score.score(df, none, F.col("quality") == 1).collect()
    assert len(rows) == 2 * len(ODD) and all(math.isfinite(r.score) for r in rows)
    assert lm_score.score(docs([]), none, F.col("quality") == 1).count() == 0
    many = spark.createDataFrame([(i, 1) for i in range(50)], LABELS)
    assert lm_score.targets(many, F.col("quality") == 1, rows=10).count() == 10
    assert lm_score.targets(many, F.col("quality") == 1).count() == 50


def test_counts_are_exact_beyond_the_old_cells(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    pairs, words = Counter(), Counter()
    for r in d.collect():
        flat = [0, *word_hashes([r.text or ""], symbols=True)[0].tolist(), 0]
        pairs.update(zip(flat, flat[1:]))
        words.update(flat[1:])
    rows = lm_score.counts(d, np.zeros(0, dtype=np.int64)).collect()
    assert sorted(r.n for r in rows if r.key % 2) == sorted(pairs.values())
    assert sorted(r.n for r in rows if r.key % 2 == 0) == sorted(words.values())


def test_every_good_label_is_a_target(spark):
    docs = spark.range(21_000).selectExpr("id as doc_id", "'a' as text")
    labels = docs.selectExpr("doc_id", "1 as quality")
    rows = lm_score.score(docs, labels, F.col("quality") == 1).collect()
    assert len(rows) == 21_000 and all(r.score == 0 for r in rows)
    cut = lm_score.packed(docs, lm_score.targets(labels, F.col("quality") == 1))
    assert lm_score._buckets(cut)[1] == (42_000, 42_000)
