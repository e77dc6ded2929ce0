"""Rows that the operators' tests share."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Column names that the operators use inside.
CLASH = ["id", "node", "t", "w", "s", "r", "row", "kept", "n", "spans", "key", "root", "cell", "words", "kmers"]


@pytest.fixture
def docs(spark):
    def make(texts, ids=None, clash=True):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, None if k % 5 == 4 else "en", "src", None) for k, (i, t) in enumerate(zip(ids, texts))]
        df = spark.createDataFrame(rows, DOCS)
        if clash:
            for c in CLASH:
                df = df.selectExpr("*", f"'x' as {c}")
        return df

    return make


#: Odd texts that every operator on documents must take.
ODD = [None, "", " \n\t ", "word", "the same words again and again " * 3, "a b c d e f g h i j " * 20_000, "é" * 200_000,
       "line one here\nline one here\n\nline one here", "\x00\x1c\x85   ", "👍🏽 مرحبا 日本語 ﬁ İ Σας", "\\ $1 \" ' | <s> <|im_end|>"]
