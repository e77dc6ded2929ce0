import hashlib
import re

import pyarrow as pa
from llm_rows import *  # noqa: F403
from pyspark.sql import functions as F

from gateflow.llm import fim


def brute(doc_id, t):
    t = t or ""
    h = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if t == "" or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = [*ODD, "a", "<P>", "x <S> y", "tail <M", "<", "\n", "ab12cd", "日本", "áé", "\U0001f600" * 50]


def rows_of(df):
    restored = fim.restore(F.col("output"), F.col("form"))
    return fim.transform(df).withColumn("restored", restored).collect()


def test_equals_brute_force_and_restores(docs):
    texts = TEXTS * 12
    rows = rows_of(docs(texts, [*range(len(texts) - 1), None]))
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[-1 if r.doc_id is None else r.doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.doc_id, t)
        assert r.restored == (t or "")
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_repeated_ids_and_empty_table(docs):
    rows = rows_of(docs(["one two three", "other text here", "one two three"], [1, 1, 1]))
    assert sorted(r.restored for r in rows) == ["one two three", "one two three", "other text here"]
    assert fim.transform(docs([])).count() == 0
    assert fim.digests(fim.transform(docs([None]))).columns == [
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def test_slices_give_the_same_as_whole_texts():
    texts = [t or "" for t in TEXTS if len(t or "") < 10_000] + ["word " * 300 + "é1" * 100, "z" * 700]
    h = [fim.np.arange(len(texts)) * m % 999_983 for m in (7919, 104_729, 31, 37)]
    whole = fim.transformed(pa.array(texts), h)
    for size in (1, 7, 64):
        cut = fim.transformed(pa.array(texts), h, size=size)
        assert [c.to_pylist() for c in cut] == [w.to_pylist() for w in whole]


def test_rates(docs):
    df = docs([f"some words {i}" for i in range(200)])
    assert {r.form for r in fim.transform(df, rate=0).collect()} == {"plain"}
    assert {r.form for r in fim.transform(df, rate=100, spm_rate=100).collect()} == {"spm"}
