"""Operator 5: language-model scoring by cross-entropy difference.

A target and a background bigram model count real words (runs of letters and
digits, and runs of symbols) and real pairs of words, by 63-bit hashes.  The
background counts come from every document, the target counts from every
document with a good label; both grow with the corpus and no task or driver
holds a whole model.

Texts are cut into blocks, tokenised once and written.  Each block sends its
distinct words and pairs with its own counts to buckets of hashes; a bucket sums
what all blocks sent and sends each block the totals of what it asked for.  A
block asks for a common word once, so it weighs no more than a rare one there,
and the number of buckets grows with the number of tokens.

The loss of a token is the negative logarithm of a fixed mixture of bigram,
unigram and uniform (one in VOCABULARY) probabilities.  A document never vouches
for itself: its own counts are taken from the models before it is scored.  The
score is the mean over its tokens of target loss minus background loss: the
lower, the more like the target.  The models share vocabulary, mixture and order
but not size: the background is the whole corpus, since a sample of it as small
as the target would not know the corpus' rare words and would not grow with it;
a document's rank among all is what the difference is for, and a constant part
of it, which the sizes make, does not move ranks.

Edge cases: a null text counts as empty; every text ends in one end token, so
an empty text has one token and a defined score; a null id is never a target;
repeated rows count, and are scored, each by itself; with no target rows the
target model is uniform; only the named columns are read; an empty table gives
an empty table.  Texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gateflow.llm.common import blocks, mix, ship, text_of, word_hashes, written

ship(__name__)

#: One in VOCABULARY is the uniform probability.
VOCABULARY = 1 << 16
#: Weights of bigram, unigram and uniform probability.
MIXTURE = (0.5, 0.4, 0.1)
#: Characters of a block, and tokens of the corpus for each bucket of hashes.
BLOCK, BUCKET = 4_000_000, 1_000_000
_PAIR, _SINGLE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous, current, text number) of all tokens, flat; hash 0 stands
    before the first word and after the last one."""
    flat, ends = word_hashes(texts, symbols=True)
    count = np.diff(ends)
    whose = np.repeat(np.arange(len(texts)), count + 1)
    current = np.zeros(len(flat) + len(texts), dtype=np.uint64)
    inner = np.ones(len(current), dtype=bool)
    inner[np.cumsum(count + 1) - 1] = False
    current[inner] = flat
    previous = np.concatenate((np.zeros(1, np.uint64), current[:-1]))  # a text's last token is 0, what the next begins with
    return previous, current, whose


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers from 0 on, first their lowest bytes, then the next ones,
    as far as the largest needs, compressed."""
    width = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + len(x).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpack(raw: bytes, kind=np.int64) -> np.ndarray:
    width, n = raw[0], int.from_bytes(raw[1:9], "little")
    planes = pa.decompress(raw[9:], n * width, "zstd", asbytes=True)
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8").astype(kind)


def _steps(keys: np.ndarray) -> bytes:
    """Rising keys, by what each adds to the one before."""
    return _pack(np.diff(keys, prepend=np.zeros(1, np.uint64)))


def _keys(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack(raw, np.uint64), dtype=np.uint64)


class Block:
    """The tokens of a block: its words and pairs, each once, and their keys
    in the order of ``order``."""

    def __init__(self, words: bytes, numbers: bytes, sizes: list[int]):
        hashes = np.frombuffer(words, np.uint64)
        self.current = _unpack(numbers)
        self.previous = np.concatenate(([0], self.current[:-1]))  # number 0 is the end token
        self.sizes = np.asarray(sizes, dtype=np.int64)
        self.whose = np.repeat(np.arange(len(sizes)), self.sizes)
        self.words = len(hashes)
        pairs, self.pair = np.unique(self.previous * self.words + self.current, return_inverse=True)
        self.pairs = len(pairs)
        keys = np.concatenate((mix(hashes ^ _SINGLE) & ~np.uint64(1), np.uint64(1) | mix(
            hashes[pairs // self.words] * _PAIR + hashes[pairs % self.words])))
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def counts(self, chosen=None) -> np.ndarray:
        """How often the block, or its chosen tokens, have each key."""
        current, pair = (self.current, self.pair) if chosen is None else (self.current[chosen], self.pair[chosen])
        return np.concatenate((np.bincount(current, minlength=self.words),
                               np.bincount(pair, minlength=self.pairs)))[self.order]

    def marked(self, places: list[int] | None) -> np.ndarray:
        """Which tokens are of the texts at these places."""
        good = np.zeros(len(self.sizes), dtype=bool)
        good[np.asarray(places or [], dtype=np.int64)] = True
        return good[self.whose]


def targets(labels: DataFrame, good, id_col: str = "doc_id", rows: int | None = None) -> DataFrame:
    """(id): the ids of all well-labelled documents; only a sample of ``rows``
    of them if a caller asks for one."""
    ids = labels.where(good).where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct()
    return ids if rows is None else ids.orderBy(F.xxhash64("id"), "id").limit(rows)


def packed(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(block, ids, sizes, words, tokens, marks): the tokenised texts in written
    blocks; ``marks`` are the places of target documents in ``ids``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for b in blocks(batches, 1, BLOCK):
            _, current, whose = tokens(b.column(1).to_pylist())
            words, at, n = np.unique(current, return_inverse=True, return_counts=True)
            # The end token (hash 0) first, then the common words: small numbers pack well.
            order = np.lexsort((-n, words != 0))
            number_of = np.empty(len(words), dtype=np.int64)
            number_of[order] = np.arange(len(words))
            sizes = np.bincount(whose, minlength=b.num_rows)
            ends = pa.array([0, b.num_rows], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.ListArray.from_arrays(ends, b.column(0)),
                 pa.ListArray.from_arrays(ends, pa.array(sizes, pa.int64())),
                 pa.array([words[order].tobytes()], pa.binary()), pa.array([_pack(number_of[at])], pa.binary())],
                ["block", "ids", "sizes", "words", "tokens"])
            number += 1

    narrow = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    spark = docs.sparkSession
    cut = written(spark, narrow.mapInArrow(
        run, f"block long, ids array<{kind}>, sizes array<long>, words binary, tokens binary"), "lm_blocks")
    met = cut.select("block", F.posexplode("ids").alias("place", "id")).join(target, "id", "left_semi")
    marks = written(spark, met.groupBy("block").agg(F.collect_list("place").alias("marks")), "lm_marks")
    return cut.join(marks, "block", "left")


def asked(cut: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, keys, n, n_target): each block's distinct keys with its
    own counts, cut by bucket, in rising order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                number, sizes, words, numbers, marks = (batch.column(c)[r].as_py() for c in range(5))
                b = Block(words, numbers, sizes)
                n, of_target = b.counts(), b.counts(b.marked(marks))
                bucket = ((b.keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                at = np.flatnonzero(np.diff(bucket, prepend=-1))
                parts = list(zip(at, [*at[1:], len(bucket)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[at]), pa.array(np.full(len(at), number)),
                     pa.array([_steps(b.keys[i:j]) for i, j in parts], pa.binary()),
                     *(pa.array([_pack(x[i:j]) for i, j in parts], pa.binary()) for x in (n, of_target))],
                    ["bucket", "block", "keys", "n", "n_target"])

    return cut.select("block", "sizes", "words", "tokens", "marks").mapInArrow(
        run, "bucket long, block long, keys binary, n binary, n_target binary")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each value of the first column, which are neighbours."""
    rows: list[tuple] = []
    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and rows[0][0] != r[0]:
                yield rows
                rows = []
            rows.append(r)
    if rows:
        yield rows


def _summed(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """The keys of a bucket, each once, where each row's are, where the rows
    end, and the summed counts of both models."""
    parts = [_keys(r[2]) for r in rows]
    keys, at = np.unique(np.concatenate(parts), return_inverse=True)
    sums = [np.bincount(at, np.concatenate([_unpack(r[c]) for r in rows])).astype(np.int64) for c in (3, 4)]
    return keys, at, np.cumsum([len(x) for x in parts]), sums


def _by_bucket(asked_for: DataFrame) -> DataFrame:
    return asked_for.repartition("bucket").sortWithinPartitions("bucket")


def answered(asked_for: DataFrame) -> DataFrame:
    """(block, bucket, n, n_target): the totals over all blocks of the keys
    that a block asked for, in the order of its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            _, at, ends, sums = _summed(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[1] for r in rows], pa.int64()), pa.array([r[0] for r in rows], pa.int64()),
                 *(pa.array([_pack(x) for x in np.split(s[at], ends[:-1])], pa.binary()) for s in sums)],
                ["block", "bucket", "n", "n_target"])

    return _by_bucket(asked_for).mapInArrow(run, "block long, bucket long, n binary, n_target binary")


def counts(docs: DataFrame, target, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, n, n_target): the counts of both models over all documents; odd
    keys are pairs, even ones words.  ``target``: ids, as a table (id) or an array."""
    if not isinstance(target, DataFrame):
        kind = T.StructType([T.StructField("id", docs.schema[id_col].dataType)])
        target = docs.sparkSession.createDataFrame([(i,) for i in target.tolist()], kind)
    cut = packed(docs, target, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            keys, _, _, sums = _summed(rows)
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), *map(pa.array, sums)],
                                             ["key", "n", "n_target"])

    return _by_bucket(asked(cut, _buckets(cut)[0])).mapInArrow(run, "key long, n long, n_target long")


def _buckets(cut: DataFrame) -> tuple[int, tuple[int, int]]:
    """The number of buckets, and the tokens of all and of target documents."""
    def add(x):
        return F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b)

    good = F.transform(F.coalesce("marks", F.array().cast("array<int>")), lambda p: F.element_at("sizes", p + 1))
    all_, of_target = cut.agg(F.sum(add("sizes")), F.sum(add(good))).first()
    return max(1, -(-(all_ or 0) // BUCKET)), (all_ or 0, of_target or 0)


def losses(pair, before, single, total, own) -> np.ndarray:
    """Loss of each token under a model without the token's own document.
    ``own``: the document's counts of the pair, the previous and current word,
    and all its tokens, a token each (zero where it is not in the model)."""
    pair, before, single = (np.maximum(x - o, 0) for x, o in zip((pair, before, single), own))
    rest = np.maximum(total - own[3], 0)
    p = (MIXTURE[0] * np.minimum(pair / np.maximum(before, 1), 1.0) + MIXTURE[1] * single / np.maximum(rest, 1)
         + MIXTURE[2] / VOCABULARY)
    return -np.log(p)


def _own(whose: np.ndarray, key: np.ndarray, width: int) -> np.ndarray:
    """For each token, how often its text has its key."""
    _, inverse, n = np.unique(whose * width + key, return_inverse=True, return_counts=True)
    return n[inverse]


def _scored(b: Block, marks, totals, answers) -> list[np.ndarray]:
    """Background and target loss of each text of a block."""
    mine = b.marked(marks)
    # A text has each word as often before another token as by itself.
    own = (_own(b.whose, b.pair, b.pairs), _own(b.whose, b.previous, b.words), _own(b.whose, b.current, b.words),
           b.sizes[b.whose])
    out = []
    for raw, total, of in zip(answers, totals, (own, tuple(x * mine for x in own))):
        n = np.empty(len(b.keys), dtype=np.int64)
        n[b.order] = np.concatenate([_unpack(x) for x in raw])
        loss = losses(n[b.words:][b.pair], n[b.previous], n[b.current], total, of)
        out.append(np.bincount(b.whose, loss, len(b.sizes)) / b.sizes)
    return out


def score(docs: DataFrame, labels: DataFrame, good, id_col: str = "doc_id", text_col: str = "text",
          label_id: str = "doc_id", rows: int | None = None) -> DataFrame:
    """(id_col, n_tokens, target_loss, background_loss, score) of every row;
    ``good``: the condition on a label row that makes its document a target;
    ``rows``: only a sample of so many targets, if a caller asks for one."""
    cut = packed(docs, targets(labels, good, label_id, rows), id_col, text_col)
    buckets, totals = _buckets(cut)
    kind = docs.schema[id_col].dataType.simpleString()
    none = F.lit(None)
    texts = cut.select("block", F.lit(-1).cast("long").alias("bucket"), none.cast("binary").alias("n"),
                       none.cast("binary").alias("n_target"), "ids", "sizes", "words", "tokens", "marks")
    totals_of = answered(asked(cut, buckets)).select(
        "*", *(none.cast(texts.schema[c].dataType).alias(c) for c in ("ids", "sizes", "words", "tokens", "marks")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def by_block():
            open_, ids, answers = None, None, []
            for batch in batches:
                bucket = batch.column(1).to_pylist()
                for r in range(batch.num_rows):
                    if bucket[r] < 0:
                        if open_:
                            yield open_, ids, answers
                        open_ = [batch.column(c)[r].as_py() for c in (5, 6, 7, 8)]
                        ids, answers = batch.column(4)[r].values, []
                    else:
                        answers.append((batch.column(2)[r].as_py(), batch.column(3)[r].as_py()))
            if open_:
                yield open_, ids, answers

        for (sizes, words, numbers, marks), ids, answers in by_block():
            b = Block(words, numbers, sizes)
            background, of_target = _scored(b, marks, totals, zip(*answers))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(b.sizes), pa.array(of_target), pa.array(background), pa.array(of_target - background)],
                ["id", "n_tokens", "target_loss", "background_loss", "score"])

    out = texts.unionByName(totals_of).repartition("block").sortWithinPartitions("block", "bucket").mapInArrow(
        run, f"id {kind}, n_tokens long, target_loss double, background_loss double, score double")
    return out.withColumnRenamed("id", id_col)
