import re

from llm_rows import *  # noqa: F403
from pyspark.sql import functions as F

from gateflow.llm import quality


def brute(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = {}
    for g in grams:
        count[g] = count.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


MORE = ["a b a b a b a", "x\ny\nx\n \n\n x", "a b c d a b c e a b", "# * $ % & | < > !", "p q r " * 40, "w" + " w" * 60]


def test_measures_equal_brute_force(docs):
    texts = [*ODD, *MORE]
    df = docs([*texts, *texts], [*range(len(texts)), *[None] * len(texts)])
    rows = quality.score(df).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        if r.doc_id is not None:
            got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
            assert got == brute(texts[r.doc_id]), texts[r.doc_id]
            assert not (r.base_failed and r.kept)
    assert quality.score(docs([])).count() == 0


def test_rules_compile_from_the_table(docs):
    good = " ".join(f"the word{i} of thing{i}" for i in range(30))
    texts = [good, good.replace("word", "w%$#%"), good.replace(" ", "! "), " ".join(f"zyx{i}q" for i in range(80)), good]
    rows = {r.doc_id: r for r in quality.score(docs(texts)).collect()}
    assert [rows[i].kept for i in range(5)] == [True, False, False, False, True]
    assert [rows[i].broken_rules for i in range(4)] == [[], ["symbols"], ["shouting", "stop_words"], ["stop_words"]]
    assert all(r.kept for r in quality.score(docs(texts), rules={}).collect())


def test_keep_returns_all_columns(docs):
    good = " ".join(f"the word{i} of thing{i}" for i in range(30))
    df = docs([good, None, good, "short"], [1, 2, None, 4])
    kept = quality.keep(df)
    assert kept.columns == df.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1]
    assert quality.keep(docs([])).count() == 0


def test_no_python_in_the_plan(docs, capsys):
    quality.keep(docs(["x"])).explain()
    assert "Python" not in (plan := capsys.readouterr().out) and "Exchange" not in plan
    # The filter stays above the measures, which would else be taken once for each use.
    assert plan.index("Filter") < plan.index("split(")


def test_labelled_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.score(docs).join(labels, "doc_id").where(~F.col("base_failed")).collect()
    assert all(r.kept for r in rows if r.quality == 1) and not any(r.kept for r in rows if r.quality == 0)
