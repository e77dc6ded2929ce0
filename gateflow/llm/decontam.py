"""Operator 6: benchmark decontamination by pigeonhole edit matching.

Texts and test items are reduced to lower-cased words.  An item of n words may
be met with up to k = n * ERROR_RATE word edits; it is cut into k + 1 pieces,
of which one at least must then stand unchanged in the text.  An Aho-Corasick
automaton over all pieces finds those hits in one pass, and Myers' bit-parallel
distance over words, free at both ends of a window around the hit, verifies
them.

The items are a stated query set: they go to the tasks in blocks of about
BLOCK_BYTES of text, one pass over the documents each, so that neither the
driver nor a task ever holds more items than one block.

Edge cases: null and empty texts match nothing; items of fewer than
``least_words`` words (LEAST_WORDS) say too little to be recognised and match
nothing: with ``least_words`` 1 they match where their words stand unchanged;
items without words match nothing; repeated rows and repeated items each give
their own rows, and equal items are searched for once; null ids stay null; only the named
columns are read; no items, or no documents, give an empty table.  Texts are
searched whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gateflow.llm.common import blocks, ship, text_of

ship(__name__)

ERROR_RATE = 0.125
LEAST_WORDS = 5
BLOCK_BYTES = 4_000_000
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def pieces(words: list[str], rate: float = ERROR_RATE) -> tuple[int, list[tuple[int, list[str]]]]:
    """The error budget of an item and its pieces (first word, words)."""
    k = int(len(words) * rate)
    cut = [len(words) * i // (k + 1) for i in range(k + 2)]
    return k, [(a, words[a:b]) for a, b in zip(cut, cut[1:])]


def distance(item: list[str], window: list[str]) -> tuple[int, int]:
    """Least word edits that turn the item into a part of the window, and the
    end of that part (the first one, of several as good): Myers' bit vectors."""
    places: dict[str, int] = {}
    for i, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    top = 1 << (len(item) - 1)
    plus, minus, score = full, 0, len(item)
    best, end = score, 0
    for j, w in enumerate(window):
        eq = places.get(w, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = (minus | ~(xh | plus)) & full
        mh = plus & xh & full
        score += bool(ph & top) - bool(mh & top)
        ph = ph << 1 & full
        mh = mh << 1 & full
        plus = (mh | ~(xv | ph)) & full
        minus = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Index:
    """The pieces of a block of items."""

    def __init__(self, items: list[tuple], rate: float = ERROR_RATE, least_words: int = LEAST_WORDS):
        """``items``: (item_id, text, number of equal rows)."""
        self.items = []
        self.times: list[int] = []
        at: dict[str, list[tuple[int, int]]] = {}
        for item_id, text, times in items:
            words = words_of(text or "")
            if len(words) >= max(1, least_words):
                k, cut = pieces(words, rate)
                for first, part in cut:
                    at.setdefault(f" {' '.join(part)} ", []).append((len(self.items), first))
                self.items.append((item_id, words, k))
                self.times.append(times)
        self.found = ahocorasick.Automaton()
        for piece, where in at.items():
            self.found.add_word(piece, (len(piece), where))
        if at:
            self.found.make_automaton()

    def matches(self, text: str) -> list[tuple]:
        """(item_id, distance, first word, end, number of equal items) of the
        best place of each item in the text; the first place, of several as good."""
        if not self.items:
            return []
        words = words_of(text)
        line = f" {' '.join(words)} "
        hits = [(last - size + 1, where) for last, (size, where) in self.found.iter(line)]
        if not hits:
            return []
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])
        best: dict[int, tuple[int, int, int]] = {}
        seen: set[tuple[int, int]] = set()
        for at, where in hits:
            word = int(np.searchsorted(starts, at))
            for n, first in where:
                if (n, word - first) in seen:
                    continue
                seen.add((n, word - first))
                _, item, k = self.items[n]
                a, b = max(0, word - first - k), min(len(words), word - first + len(item) + k)
                d, end = distance(item, words[a:b])
                if d <= k:
                    # The same backwards from the end gives the beginning.
                    back = distance(item[::-1], words[a:a + end][::-1])[1]
                    new = (d, a + end - back, a + end)
                    if n not in best or new < best[n]:
                        best[n] = new
        return [(self.items[n][0], *best[n], self.times[n]) for n in sorted(best)]


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """The distinct items (item_id, text, number of rows), one block of about
    BLOCK_BYTES after another."""
    narrow = items.select(F.col(item_id).alias("item_id"), text_of(text).alias("text")).groupBy("item_id", "text").agg(
        F.count("*").alias("n"))
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(size) // BLOCK_BYTES))
    for k in range(n):
        part = narrow if n == 1 else narrow.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield sorted((tuple(r) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text", rate: float = ERROR_RATE,
         least_words: int = LEAST_WORDS) -> DataFrame:
    """(id_col, item_id, distance, first_word, end_word) of every item met in
    a text within its error budget."""
    spark = docs.sparkSession
    kinds = [docs.schema[id_col].dataType, items.schema[item_id].dataType]
    item_kind = to_arrow_type(kinds[1])
    schema = f"id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, distance int, first_word int, end_word int, times int"
    narrow = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))

    def one(block: list[tuple]) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, rate, least_words)
            for b in blocks(batches, 1):
                rows = [(i, *m) for i, m in enumerate(map(index.matches, b.column(1).to_pylist())) for m in m]
                if rows:
                    n, item, *rest = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(n, pa.int64())), pa.array(item, item_kind),
                         *(pa.array(x, pa.int32()) for x in rest)],
                        ["id", "item_id", "distance", "first_word", "end_word", "times"])

        return narrow.mapInArrow(run, schema)

    out = None
    for block in item_blocks(items, item_id, item_text):
        out = one(block) if out is None else out.union(one(block))
    # Equal items were searched for once; each has its row.
    each = F.explode(F.array_repeat(F.lit(0), F.col("times")))
    return out.select(F.col("id").alias(id_col), "item_id", "distance", "first_word", "end_word", each.alias("times")).drop("times")


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
          item_text: str = "text", rate: float = ERROR_RATE, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents in which no item was met; all columns stay."""
    spark = docs.sparkSession
    at = docs.columns.index(text_col)
    out = docs
    for block in item_blocks(items, item_id, item_text):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, rate, least_words)
            for b in blocks(batches, at):
                yield b.filter(pa.array([not index.matches(t or "") for t in b.column(at).to_pylist()], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
