"""Operator 11: ranked lexical search by an Aho-Corasick scan of the documents.

No index of the documents is made.  The terms of a block of items stand in one
automaton, each between two guards, and a text is scanned with every run of
other characters turned into a guard, so that the automaton meets whole terms
only and its hits are the term frequencies.  An automaton output is the number
of a term, which maps to the items that hold it.

1. A first scan counts the documents with a term (N), all their terms (L) and
   the documents that hold each item term (df).
2. A second scan scores each document for all items of the block that share a
   term with it; a task keeps the best ``k`` rows of each item.
3. The tasks' rows meet in two steps, by item and a part of the tasks (one for
   each shuffle partition), then by item.

The items are a stated query set.  They are cut into blocks of about
BLOCK_BYTES of terms, equal terms of an item counted once; a block is what the
driver, an automaton and a task hold, and each takes its own two scans.

Ranking: score, highest first, then id, ascending, null ids last.  Scores are
64-bit integers (see ``weights`` and ``norm``).

Edge cases: null and empty texts have no term and count nowhere; rows that
repeat a document are documents of their own; rows that repeat an item id are one
item with the terms of all of them; a null item id is an item like others;
items without terms, and items that no document shares a term with, give no
rows; only the named columns are read; no items, or no documents, give an empty
table.  Texts are scanned whole, in slices of SLICE bytes cut at guards.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gateflow.llm.common import blocks, ship, text_of

ship(__name__)

TOP = 10
BLOCK_BYTES = 4_000_000
SLICE = 1_000_000
#: Length normalisation in percent; see ``norm``.
B_PERCENT = 90
SATURATION = 8
#: A term: letters and digits of ASCII and all other code points.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GUARD = 32
#: A byte of a text to its lower-case letter, itself, or the guard.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else _GUARD
               for c in range(256))


def guarded(text: bytes) -> Iterator[bytes]:
    """The text's terms with a guard on both sides, in slices."""
    raw = text.translate(_BYTES)
    at = 0
    while at < len(raw):
        to = len(raw) if len(raw) - at <= SLICE else raw.find(b" ", at + SLICE)
        to = len(raw) if to < 0 else to
        yield b" " + raw[at:to] + b" "
        at = to


def n_terms(line: bytes) -> int:
    """Terms of a guarded slice: places where a guard ends and a term begins."""
    term = np.frombuffer(line, dtype=np.uint8) != _GUARD
    return int(np.count_nonzero(term[1:] & ~term[:-1]))


def automaton(terms: list[str]) -> ahocorasick.Automaton:
    """Guarded terms, in bytes, each with its place in the list as output."""
    found = ahocorasick.Automaton()
    for k, t in enumerate(terms):
        found.add_word(f" {t} ".encode().decode("latin-1"), k)
    if terms:
        found.make_automaton()
    return found


def frequencies(text: bytes, found: ahocorasick.Automaton) -> tuple[int, Counter]:
    """Number of terms of a text, and how often each item term occurs."""
    n, tf = 0, Counter()
    for line in guarded(text):
        n += n_terms(line)
        if len(found):
            tf.update(k for _, k in found.iter(line.decode("latin-1")))
    return n, tf


def weights(df: np.ndarray, total: int) -> np.ndarray:
    """Of a term that ``df`` of ``total`` documents hold: floor(1000 ln((2N+2)/(2df+1)))."""
    return np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)


def norm(n: int, total: int, length: int) -> int:
    """The length of a document against the mean, in percent, weighed by B_PERCENT."""
    return 100 - B_PERCENT + (B_PERCENT * n * total) // length


class Block:
    """The distinct terms of a block of items and the items that hold each."""

    def __init__(self, pairs: list[tuple]):
        """``pairs``: (item_id, term), each once."""
        self.items = list({i: None for i, _ in pairs})
        self.terms = list({t: None for _, t in pairs})
        item, term = ({x: k for k, x in enumerate(xs)} for xs in (self.items, self.terms))
        at = np.array([(term[t], item[i]) for i, t in pairs], dtype=np.int64).reshape(-1, 2)
        at = at[np.lexsort((at[:, 1], at[:, 0]))]
        self.holders = at[:, 1]
        self.starts = np.searchsorted(at[:, 0], np.arange(len(self.terms) + 1), "left")

    def scores(self, tf: Counter, m: int, w: np.ndarray) -> np.ndarray:
        """The score of a document for every item."""
        term = np.fromiter(tf.keys(), dtype=np.int64, count=len(tf))
        often = np.fromiter(tf.values(), dtype=np.int64, count=len(tf))
        gain = w[term] * ((1_000_000_000 * often) // (1000 * often + SATURATION * m))
        start, size = self.starts[term], self.starts[term + 1] - self.starts[term]
        place = np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)
        out = np.zeros(len(self.items), dtype=np.int64)
        np.add.at(out, self.holders[place], np.repeat(gain, size))
        return out


def item_blocks(items: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple]]:
    """(item_id, term) pairs of the items, each once, one block after another."""
    lower = F.translate(text_of(text), _UPPER, _LOWER)
    pairs = items.select(F.col(item_id).alias("item_id"),
                         F.explode(F.array_distinct(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0)))).alias("term")
                         ).distinct()
    size = pairs.agg(F.sum(F.octet_length("term") + 9)).first()[0] or 0
    n = max(1, -(-int(size) // block_bytes))
    for k in range(n):
        part = pairs if n == 1 else pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k)
        yield sorted((tuple(r) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def _counts(spark: SparkSession, narrow: DataFrame, block: Block) -> tuple[int, int, np.ndarray]:
    """N, L and df of the block's terms over all documents."""
    shared = spark.sparkContext.broadcast(block.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(shared.value)
        df = np.zeros(len(shared.value), dtype=np.int64)
        docs = length = 0
        for b in blocks(batches, 1):
            for t in b.column(1).to_pylist():
                n, tf = frequencies(t, found)
                docs, length = docs + (n > 0), length + n
                df[np.fromiter(tf.keys(), dtype=np.int64, count=len(tf))] += 1
        met = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *met], pa.int64()),
                                          pa.array([docs, length, *df[met]], pa.int64())], ["term", "n"])

    rows = narrow.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r["term"]: int(r["n"]) for r in rows}
    return found.get(-2, 0), found.get(-1, 0), np.array([found.get(k, 0) for k in range(len(block.terms))], dtype=np.int64)


def _best(spark: SparkSession, narrow: DataFrame, block: Block, counts: tuple[int, int, np.ndarray], k: int,
          id_type, item_type) -> DataFrame:
    """The best k documents of each item in each task: (item_id, id, score)."""
    total, length, df = counts
    shared = spark.sparkContext.broadcast((block, weights(df, total)))
    item_kind, id_kind = to_arrow_type(item_type), to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, w = shared.value
        found = automaton(block.terms)
        none = (np.zeros(0, dtype=np.int64),) * 2
        held, ids = none, pa.array([], id_kind)
        for b in blocks(batches, 1):
            more = [(held[0], held[1], np.arange(len(ids)))]
            for row, t in enumerate(b.column(1).to_pylist()):
                n, tf = frequencies(t, found)
                if tf:
                    score = block.scores(tf, norm(n, total, length), w)
                    item = np.flatnonzero(score)
                    more.append((item, score[item], np.full(len(item), len(ids) + row)))
            item, score, place = (np.concatenate(x) for x in zip(*more))
            ids = pa.concat_arrays([ids, b.column(0).cast(id_kind)])
            # The rank of each id, null last, makes ties exact for ids of any type.
            rank = np.empty(len(ids), dtype=np.int64)
            rank[np.asarray(pa.compute.sort_indices(ids, null_placement="at_end"))] = np.arange(len(ids))
            order = np.lexsort((rank[place], -score, item))
            item, score, place = item[order], score[order], place[order]
            first = np.searchsorted(item, item, "left")
            keep = np.arange(len(item)) - first < k
            held = item[keep], score[keep]
            ids = ids.take(pa.array(place[keep]))
        yield pa.RecordBatch.from_arrays([pa.array([block.items[i] for i in held[0]], item_kind), ids,
                                          pa.array(held[1], pa.int64())], ["item_id", "id", "score"])

    schema = f"item_id {item_type.simpleString()}, id {id_type.simpleString()}, score long"
    return narrow.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
           item_text: str = "text", k: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, id_col, score): the k highest-scoring documents of each
    item, those of score 0 left out."""
    spark = docs.sparkSession
    types = docs.schema[id_col].dataType, items.schema[item_id].dataType
    narrow = docs.select(F.col(id_col).alias("id"), text_of(text_col).cast("binary").alias("text"))
    parts = []
    for pairs in item_blocks(items, item_id, item_text, block_bytes):
        block = Block(pairs)
        parts.append(_best(spark, narrow, block, _counts(spark, narrow, block), k, *types))
    found = reduce(DataFrame.union, parts)
    order = F.desc("score"), F.asc_nulls_last("id")
    salt = F.pmod(F.spark_partition_id(), F.lit(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    some = found.withColumn("salt", salt).withColumn(
        "rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).where(F.col("rank") <= k)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return best.where(F.col("rank") <= k).select("item_id", "rank", F.col("id").alias(id_col), "score")
