"""Operator 3: near duplicates by order MinHash.

A text's k-mers are its runs of five words, each labelled with its number
among equal ones.  A sketch keeps, for one random order of the k-mers, the
KEPT least of them in the order in which the text has them, so that texts
share sketches where they share k-mers in the same order.  Texts with a sketch
in common are candidates.

1. Equal texts become one node (a partial aggregate, whatever their number).
2. Nodes that share a sketch are tied to the least of them, the head.  Each
   tie is verified by banded alignment, the texts of one head in groups of
   about BLOCK_KMERS that read the head's text and pass the others by.  This
   is one comparison a tie, however many texts a head has.
3. The connected components of the verified ties are classes.  The texts of a
   sketch that these do not make one class are cut into blocks of about
   BLOCK_KMERS, every pair of blocks a group of rows, so that a sketch of any
   size is spread over many tasks.  A pair is looked at in the first sketch that
   its texts share, and verified if it differs in few enough words by their
   counts and is not in one class yet.  No pair is dropped or capped.
4. Classes between which a group found a link are joined.

Similarity: 1 - word edits / words of the longer text, at least 0.8.  The
alignment follows the longest chain of k-mers that both texts have in one
order, inside the band of diagonals that a pair of the threshold can use;
between the k-mers of the chain it is the least number of edits.  Pairs that
share fewer than SHARED of the shorter text's k-mers are no candidates.

Edge cases: a null text counts as empty; empty texts are copies of each other;
texts of fewer than five words have one k-mer, all their words; a text without
words has equal texts only; rows that repeat an id are rows of their own, and a
class's id is its least id (null if all its ids are null); only the id and text
columns are read, and columns of any name stay in ``keep_one``; an empty table
gives an empty table.  Texts are read whole.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gateflow.llm.common import blocks, components, mix, ship, text_of, word_hashes, written

ship(__name__)

WORDS = 5
SIMILARITY = 0.8
#: With 5 % of the words changed at random places 0.77 of the k-mers stay, with 10 % 0.59: all but 0.003 % and 2 % of such
#: pairs then share one of 20 sketches of 2.
SKETCHES, KEPT = 20, 2
SHARED = 0.2
BLOCK_KMERS = 200_000
#: Distinct texts that a task remembers to send equal ones on once.
REMEMBERED = 200_000
#: Cells of a text's word counts by hash.
CELLS, COARSE = 512, 64
_MULTS = np.array([0xD6E8FEB86659FD93, 0xA5A3564E1C1C6D5B, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                   0x27D4EB2F165667C5], dtype=np.uint64)
_SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def kmers(words: np.ndarray) -> np.ndarray:
    """Labelled k-mers of a text's word hashes, in text order."""
    n = len(words)
    if not n:
        return words
    k = min(n, WORDS)
    out = np.zeros(n - k + 1, dtype=np.uint64)
    for i in range(k):
        out += words[i:n - k + 1 + i] * _MULTS[i]
    out = mix(out + np.uint64(k))
    order = np.argsort(out, kind="stable")
    same = np.concatenate(([False], out[order][1:] == out[order][:-1]))
    if same.any():
        at = np.arange(len(out))
        label = np.empty(len(out), dtype=np.uint64)
        label[order] = at - np.maximum.accumulate(np.where(same, 0, at))
        out = np.where(label > 0, mix(out + label * _MULTS[0]), out)
    return out


def sketches(k: np.ndarray) -> np.ndarray:
    """One 64-bit key a sketch: the least KEPT k-mers, in text order."""
    if len(k) <= KEPT:
        part = np.broadcast_to(k, (SKETCHES, len(k)))
    elif len(k) * SKETCHES <= 4_000_000:
        at = np.argpartition(mix(k[None, :] ^ _SEEDS[:, None]), KEPT - 1, axis=1)[:, :KEPT]
        part = k[np.sort(at, axis=1)]
    else:  # a very long text: one sketch at a time
        part = np.array([k[np.sort(np.argpartition(mix(k ^ s), KEPT - 1)[:KEPT])] for s in _SEEDS])
    return mix((part * _MULTS[None, :part.shape[1]]).sum(axis=1, dtype=np.uint64) ^ _SEEDS)


def edits(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Least word edits between two runs of words; ``most`` + 1 if there are
    more.  A band of diagonals, doubled until the edits fit into it."""
    if len(a) > len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if m - n > most:
        return most + 1
    _, code = np.unique(np.concatenate((a, b)), return_inverse=True)
    band = min(most, max(4, 2 * (m - n)))
    while True:
        # Column k of a row is the place i + k - band in b.
        width = 2 * band + 1
        far = n + m + 1
        step = np.arange(width)
        padded = np.full(m + 2 * width, -1, dtype=np.int64)
        first, padded[band:band + m] = code[:n], code[n:]
        row = np.where(step >= band, step - band, far)
        row[step - band > m] = far
        for i in range(1, n + 1):
            at = i - band + step
            new = row + (padded[i - 1:i - 1 + width] != first[i - 1])
            new[:-1] = np.minimum(new[:-1], row[1:] + 1)
            new = np.where((at < 0) | (at > m), far, new)
            if i <= band:
                new[band - i] = i
            row = np.minimum(np.minimum.accumulate(new - step) + step, far)
        found = int(row[m - n + band])
        if found <= band:
            return found
        if band >= most:
            return most + 1
        band = min(most, 2 * band)


def _chain(ka: np.ndarray, kb: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the longest chain of k-mers that both texts have in one
    order, at most ``shift`` diagonals from the first."""
    order_a, order_b = np.argsort(ka), np.argsort(kb)
    _, in_a, in_b = np.intersect1d(ka[order_a], kb[order_b], assume_unique=True, return_indices=True)
    at_a, at_b = order_a[in_a], order_b[in_b]
    band = np.abs(at_a - at_b) <= shift
    order = np.argsort(at_a[band])
    at_a, at_b = at_a[band][order], at_b[band][order]
    if (np.diff(at_b) < 0).any():
        tails: list[int] = []
        last: list[int] = []
        before = np.full(len(at_b), -1)
        for k, x in enumerate(at_b.tolist()):
            i = bisect_left(tails, x)
            before[k] = last[i - 1] if i else -1
            tails[i:i + 1] = [x]
            last[i:i + 1] = [k]
        chain, k = [], last[-1]
        while k >= 0:
            chain.append(k)
            k = before[k]
        at_a, at_b = at_a[chain[::-1]], at_b[chain[::-1]]
    return at_a, at_b


def aligned(a: np.ndarray, b: np.ndarray, ka: np.ndarray, kb: np.ndarray, least: float = SIMILARITY) -> float:
    """Similarity of two texts, given by their words and k-mers, by banded
    alignment; 0 if it is below ``least``."""
    longer = max(len(a), len(b))
    most = int((1 - least) * longer + 1e-9)
    if abs(len(a) - len(b)) > most:
        return 0.0
    at_a, at_b = _chain(ka, kb, most)
    if not len(at_a):
        return 0.0
    k = min(len(a), len(b), WORDS)
    # Between one k-mer's end and the next one's start, the words that they share taken off the second.
    da, db = np.diff(at_a), np.diff(at_b)
    over = np.maximum(0, k - np.minimum(da, db))
    from_a = np.concatenate(([0], at_a + k))
    from_b = np.concatenate(([0], at_b + k))
    to_a = np.concatenate((at_a[:1], at_a[1:] + over, [len(a)]))
    to_b = np.concatenate((at_b[:1], at_b[1:] + over, [len(b)]))
    gap_a, gap_b = to_a - from_a, to_b - from_b
    cost = np.maximum(gap_a, gap_b)
    total = int(cost.sum())
    if total > most:
        both = np.flatnonzero(np.minimum(gap_a, gap_b) > 0)
        # No alignment of a gap does better than its common words.
        common = {g: _common(a[from_a[g]:to_a[g]], b[from_b[g]:to_b[g]]) for g in both.tolist()}
        best = total - sum(common.values())
        for g in both[np.argsort(-cost[both], kind="stable")].tolist():
            if total <= most or best > most:
                break
            if common[g]:
                room = most - (best - (int(cost[g]) - common[g]))
                found = min(edits(a[from_a[g]:to_a[g]], b[from_b[g]:to_b[g]], min(room, int(cost[g]))), int(cost[g]))
                total += found - int(cost[g])
                best += found - (int(cost[g]) - common[g])
    return 1 - total / longer if total <= most else 0.0


def profile(words: np.ndarray) -> np.ndarray:
    """Words by cell of their hash.  An edit changes two cells by one at most,
    so texts whose profiles differ by more than two an edit are not near."""
    return np.bincount((words >> np.uint64(40)).astype(np.int64) % CELLS, minlength=CELLS).astype(np.int32)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Words that two runs have in common, repeats counted."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return int(np.minimum(n[i], m[j]).sum())


def _differ(profiles: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.abs(profiles - one).sum(axis=1)


def links_in(texts: list[str], side: list[int], cross: bool, least: float = SIMILARITY, known: list | None = None,
             sketch: np.ndarray | None = None, number: int = 0) -> list[tuple[int, int]]:
    """Links (i, j) that join the texts into their classes.  ``cross``: only
    pairs of the two sides; ``known``: a class that each text is in already.
    Pairs whose sketches agree before the ``number``-th have met there."""
    flat, ends = word_hashes(texts)
    words = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
    ks = [kmers(w) for w in words]
    length = np.array([len(w) for w in words], dtype=np.int64)
    fine = np.array([profile(w) for w in words])
    coarse = fine.reshape(len(words), -1, COARSE).sum(axis=1, dtype=np.int32)
    root = list(range(len(ks)))
    if known is not None:
        heads: dict = {}
        root = [heads.setdefault(c, i) for i, c in enumerate(known)]
    class_, sides = np.array(root), np.array(side)

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i in range(len(ks)):
        fit = (class_[i + 1:] != class_[i]) & (
            np.minimum(length[i + 1:], length[i]) >= least * np.maximum(length[i + 1:], length[i]) - 1e-9)
        if cross:
            fit &= sides[i + 1:] != sides[i]
        near = np.flatnonzero(fit) + i + 1
        most = ((1 - least) * np.maximum(length[near], length[i]) + 1e-9).astype(np.int64)
        for profiles in (coarse, fine):
            some = _differ(profiles[near], profiles[i]) <= 2 * most
            near, most = near[some], most[some]
        if sketch is not None and number:
            near = near[(sketch[near, :number] != sketch[i, :number]).all(axis=1)]
        for j in near[np.argsort(_differ(fine[near], fine[i]), kind="stable")].tolist():
            if top(i) != top(j) and similar(words[i], words[j], ks[i], ks[j], least):
                root[top(i)] = top(j)
                out.append((i, j))
    return out


def similar(a: np.ndarray, b: np.ndarray, ka: np.ndarray, kb: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether two texts are near: k-mers enough in common, and an alignment."""
    shared = len(np.intersect1d(ka, kb, assume_unique=True))
    return (shared >= max(1, SHARED * min(len(ka), len(kb)))) and aligned(a, b, ka, kb, least) >= least - 1e-9


def linked_to_head(head: tuple, text: str, least: float) -> bool:
    """Whether a text is near its head's (words, k-mers, profile)."""
    words, _ = word_hashes([text])
    ks = kmers(words)
    n, m = sorted((len(words), len(head[0])))
    if n < least * m - 1e-9 or np.abs(profile(words) - head[2]).sum() > 2 * int((1 - least) * m + 1e-9):
        return False
    return similar(head[0], words, head[1], ks, least)


def sketched(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, node, kmers, sketch) of every row; node: 16 bytes of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, 2):
            flat, ends = word_hashes(b.column(2).to_pylist())
            ks = [kmers(flat[x:y]) for x, y in zip(ends[:-1], ends[1:])]
            rows = [sketches(k).astype(np.int64) if len(k) else None for k in ks]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(k) for k in ks], pa.int64()),
                 pa.array(rows, pa.list_(pa.int64()))], ["id", "node", "kmers", "sketch"])

    kind = df.schema[id_col].dataType.simpleString()
    text = text_of(text_col)
    return df.select(F.col(id_col).alias("id"), F.unhex(F.md5(text)).alias("node"), text.alias("text")).mapInArrow(
        run, f"id {kind}, node binary, kmers long, sketch array<long>")


def _one_each(df: DataFrame, text_col: str) -> DataFrame:
    """(node, text): of equal texts in a task one, of the last REMEMBERED
    distinct ones, so that a text with very many copies is sent once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, None] = {}
        for b in blocks(batches, 1):
            new = []
            for i, node in enumerate(b.column(0).to_pylist()):
                if node not in seen:
                    new.append(i)
                seen.pop(node, None)
                seen[node] = None
            while len(seen) > REMEMBERED:
                del seen[next(iter(seen))]
            yield b.take(pa.array(new, pa.int64()))

    text = text_of(text_col)
    return df.select(F.unhex(F.md5(text)).alias("node"), text.alias("text")).mapInArrow(run, "node binary, text string")


def _verified_ties(ties: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The ties (head a, node b) whose texts are near, as links (a, b)."""
    parts = ties.join(texts.select(F.col("node").alias("b"), "kmers"), "b").groupBy("a").agg(
        F.ceil(F.sum("kmers") / BLOCK_KMERS).cast("int").alias("parts"))
    heads = parts.join(texts.select(F.col("node").alias("a"), "text"), "a").select(
        "a", F.lit(None).cast("binary").alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "text")
    placed = ties.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    members = placed.join(texts.select(F.col("node").alias("b"), "text"), "b").select("a", "b", "part", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None
        for batch in batches:
            near = []
            for i, (node, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(3).to_pylist())):
                if node is None:        # a head stands before its texts
                    flat, _ = word_hashes([text])
                    head = flat, kmers(flat), profile(flat)
                elif linked_to_head(head, text, least):
                    near.append(i)
            yield batch.select(["a", "b"]).take(pa.array(near, pa.int64()))

    return heads.union(members).repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b")).mapInArrow(
        run, "a binary, b binary")


def _roots(spark: SparkSession, df: DataFrame, text_col: str, nodes: DataFrame, least: float) -> DataFrame:
    """(node, root): the classes of the nodes that are tied to another one."""
    cells = nodes.select("node", F.posexplode("sketch").alias("number", "key")).select(
        F.xxhash64("number", "key").alias("key"), "number", "node")
    heads = cells.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head <> last")
    met = written(spark, cells.join(heads.select("key", "head"), "key"), "near_met")
    ties = written(spark, met.where("head <> node").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct(),
                   "near_ties")
    tied = nodes.join(met.select("node").distinct(), "node", "left_semi").select("node", "kmers", "sketch")
    texts = written(spark, _one_each(df, text_col).join(tied, "node").dropDuplicates(["node"]), "near_texts")
    near = written(spark, _verified_ties(ties, texts, least), "near_direct")
    joined = components(spark, near, "near_joined").withColumnRenamed("root", "known")
    known = written(spark, tied.join(joined, "node", "left").select(
        "node", "kmers", F.coalesce("known", "node").alias("known")), "near_known")
    # Sketches whose texts the ties have not made one class, and in which a pair without the head is left.
    in_class = met.join(known, "node").select("key", "number", "node", "kmers", "known")
    parts = in_class.groupBy("key").agg(
        F.ceil(F.sum("kmers") / BLOCK_KMERS).cast("int").alias("parts"), F.count("*").alias("n"),
        F.min("known").alias("low"), F.max("known").alias("high")).where("n > 2 and low <> high")
    placed = in_class.join(parts, "key").select(
        "key", "number", "node", "known", "parts", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"))
    # Every block of a sketch meets every other one and, if it is alone, itself.
    rows = texts.join(placed, "node").select(
        "key", "number", "node", "known", "text", "sketch", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    rows = rows.select("key", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"),
                       "node", "part", "text", "known", "number", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []

        def done():
            part, text, known, sketch = zip(*group)
            pairs = links_in(text, part, key[1] != key[2], least, known, np.array(sketch), key[3])
            return pa.RecordBatch.from_arrays([pa.array([group[p[k]][2] for p in pairs], pa.binary()) for k in (0, 1)],
                                              ["a", "b"])

        for b in batches:
            for k, p, q, _, part, text, known, number, sketch in zip(*(c.to_pylist() for c in b.columns)):
                if (k, p, q, number) != key:
                    if len(group) > 1:
                        yield done()
                    key, group = (k, p, q, number), []
                group.append((part, text, known, sketch))
        if len(group) > 1:
            yield done()

    rest = rows.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "node").mapInArrow(
        run, "a binary, b binary")
    # Links between classes that the ties have made already: few rows.
    joined = components(spark, written(spark, rest, "near_links"), "near_classes")
    return known.join(joined.select(F.col("node").alias("known"), "root"), "known", "left").select(
        "node", F.coalesce("root", "known").alias("root"))


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """(id_col, class_id, class_rows, node, head) of every row: class_id is
    the least id of its class, class_rows its number of rows, head whether the
    row's id and text are the ones that stand for the class."""
    spark = df.sparkSession
    rows = written(spark, sketched(df, id_col, text_col), "near_rows")
    nodes = written(spark, rows.groupBy("node").agg(
        F.min("id").alias("id"), F.count("*").alias("n"), F.first("kmers").alias("kmers"),
        F.first("sketch").alias("sketch")), "near_nodes")
    roots = _roots(spark, df, text_col, nodes, least)
    placed = nodes.select("node", "id", "n").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    heads = placed.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("head"),
        F.sum("n").alias("class_rows"))
    named = placed.select("node", "root").join(heads, "root").select(
        "node", F.col("head.id").alias("class_id"), F.col("head.node").alias("head_node"), "class_rows")
    return rows.select("id", "node").join(named, "node").select(
        F.col("id").alias(id_col), "class_id", "class_rows", "node",
        ((F.col("node") == F.col("head_node")) & F.col("id").eqNullSafe(F.col("class_id"))).alias("head"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row of each class: that with the least id (one of them, if rows
    repeat it).  All columns stay."""
    def place(node, ident):
        return F.concat(F.hex(node), F.lit(":"), F.coalesce(ident.cast("string"), F.lit("")))

    found = classes(df, id_col, text_col, least)
    heads = found.where("head").select(place(F.col("node"), F.col(id_col)).alias("place")).distinct()
    # The row goes in a struct, whatever its columns are called.
    rows = df.select(place(F.unhex(F.md5(text_of(text_col))), F.col(id_col)).alias("place"),
                     F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))
    return rows.join(heads, "place", "left_semi").dropDuplicates(["place"]).select("row.*")
