"""Helpers shared by the operators: scratch tables, Arrow blocks, word hashes
and connected components."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gateflow.session import scratch_path

#: Text handled by one numpy step; bounds the arrays inside a task.
BLOCK_CHARS = 1_000_000


def ship(module_name: str) -> None:
    """Send a module's functions to the workers by value, so that executors
    need no copy of the repository on their import path."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.
    This cuts lineage: a lost executor only repeats work after this point."""
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    for paths in _MADE:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables that ``written`` made, for each open ``scratch``.
_MADE: list[list[str]] = []


@contextmanager
def scratch() -> Iterator[list[str]]:
    """Collects the paths that ``written`` makes meanwhile."""
    paths: list[str] = []
    _MADE.append(paths)
    try:
        yield paths
    finally:
        _MADE.remove(paths)


def delete(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete scratch tables whose readers are done."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def text_of(column: str = "text"):
    """The text of a row; a null text counts as empty everywhere."""
    return F.coalesce(F.col(column), F.lit(""))


def blocks(batches: Iterable[pa.RecordBatch], text: int, chars: int = BLOCK_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of about ``chars`` of the column
    number ``text`` (at least one row each)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(text)
        size = np.asarray(pa.compute.binary_length(col).fill_null(0), dtype=np.int64)
        ends = np.cumsum(size)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + chars, "right")))
            yield batch.slice(at, to - at)
            at = to


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Kinds of bytes: 1 in words, 0 between them; with symbols, 2 for those.
_WORD = np.zeros(256, dtype=np.int8)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_SYMBOL = np.where(_WORD == 1, 1, 2).astype(np.int8)
_SYMBOL[[*range(0, 33), 127]] = 0
_MULT = 0x9E3779B97F4A7C15
_STEP = 1 << 20


def word_hashes(texts: list[str], symbols: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of each text, flat, with the
    offsets of the texts.  A word is a run of ASCII letters, digits and
    non-ASCII characters; with ``symbols``, a run of other visible characters
    is a word too.  Works on slices of about a megabyte, so that one
    very long text needs no more memory than many short ones."""
    kinds = _SYMBOL if symbols else _WORD
    out, counts = [], np.zeros(len(texts) + 1, dtype=np.int64)
    pending: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if pending:
            hashes, per = _slice_hashes([b for _, b in pending], kinds)
            out.append(hashes)
            for (i, _), n in zip(pending, per):
                counts[i + 1] += n
            pending.clear()
            size = 0

    for i, t in enumerate(texts):
        raw = t.lower().encode("utf-8", "surrogatepass")
        at = 0
        while at < len(raw):
            to = min(len(raw), at + _STEP)
            while to < len(raw) and kinds[raw[to]] and kinds[raw[to]] == kinds[raw[to - 1]]:
                to += 1  # never cut inside a word
            pending.append((i, raw[at:to]))
            size += to - at
            at = to
            if size >= _STEP:
                flush()
    flush()
    flat = np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)
    return flat, np.cumsum(counts)


def _slice_hashes(parts: list[bytes], kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    kind = np.concatenate(([0], kinds[data], [0]))
    inside = kind[1:-1] > 0
    change = kind[1:] != kind[:-1]
    start, stop = np.flatnonzero(change & (kind[1:] > 0)), np.flatnonzero(change & (kind[:-1] > 0))
    length = stop - start
    ends = np.cumsum([len(p) + 1 for p in parts])
    per = np.diff(np.concatenate(([0], np.searchsorted(start, ends, "left"))))
    if not len(start):
        return np.zeros(0, dtype=np.uint64), per
    chars = data[inside].astype(np.uint64) + np.uint64(1)
    first = np.cumsum(length) - length
    place = np.arange(len(chars)) - np.repeat(first, length)
    power = np.ones(int(length.max()), dtype=np.uint64)
    power[1:] = np.multiply.accumulate(np.full(len(power) - 1, _MULT, dtype=np.uint64))
    value = np.add.reduceat(chars * power[place], first)
    return mix(value ^ (length.astype(np.uint64) << np.uint64(40))), per


def components(spark: SparkSession, links: DataFrame, name: str) -> DataFrame:
    """Connected components of an undirected graph given as rows (a, b).
    Returns (node, root), root being the least node of the component, for
    every node with a link to another.

    Alternates two steps until nothing changes: every node links its larger
    neighbours to its least neighbour, then every node links its smaller
    neighbours to the least of them.  Each round is two joins and two partial
    aggregates over a table no larger than the links and is written to the
    shared folder; the number of rounds grows with the logarithm of the
    longest path, not with the size of a component."""

    def star(edges: DataFrame, larger: bool) -> DataFrame:
        if larger:
            near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
                edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        out = near.join(least, "u")
        if larger:
            out = out.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = out.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
                least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def state(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = written(spark, links.where("a <> b").select("a", "b").distinct(), name)
    before = None
    now = state(edges)
    while now[0] and now != before:
        edges = written(spark, star(star(edges, True), False), name)
        before, now = now, state(edges)
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return pairs.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
