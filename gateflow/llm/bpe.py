"""Operator 1: BPE encoding and decoding in batched numpy merge rounds.

Texts are cut at white space, and the pieces that a task has not met before are
split into words, laid out as one flat array of symbols.  In every round the ranks of all neighbouring pairs are
looked up by binary search over the sorted pair keys, each word's lowest rank
is found by a segmented minimum, and that pair is merged at all its places in
the word at once.  Words whose pairs have no rank leave the array.  Very long
words take rounds of their own, one a rank, in which only the neighbours of
merged places are looked up anew.

This equals merging one pair at a time from the left as long as every merge
ranks behind the merges that made its parts, which is checked when the file is
loaded.

Edge cases: a null text encodes as an empty one (no tokens, empty decoding);
repeated rows give repeated results; a null id stays null; other columns are
not read; an empty table gives an empty table.  Texts of any length are
encoded whole.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gateflow.llm.common import blocks, ship, text_of

ship(__name__)

#: Pieces between white space kept with their tokens by a task before it starts anew.
KNOWN_PIECES = 300_000
#: Words of more symbols are merged by ``_merge_long``.
LONG_WORD = 200
#: Marks a piece of plain text that spells an added token (after lower-casing).
_APART = "\0plain "


class _Places(dict):
    """Numbers pieces in the order in which they are first asked for."""

    def __init__(self, first):
        super().__init__((x, k) for k, x in enumerate(first))
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = k = len(self)
        self.new.append(piece)
        return k


class WordBPE:
    """A vocabulary file of the kind "BPE with word ends": NFC, lower case,
    white space dropped, byte-level symbols, the last one marked ``</w>``."""

    #: The file's split pattern, as its "pattern" entry gives it.
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    #: Characters that the file's library takes as white space.
    SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    # Code points that are letters or digits since Unicode 17, and neither
    # in the version (16) that the file's library follows; in hexadecimal, with ranges.
    NEWER = """
        558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
        10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8
        16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128
        1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED
        1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"""
    NONE = np.int64(1 << 40)

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"]
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.width = max([*vocab.values(), *self.added.values()]) + 1
        self.tokens = [""] * self.width
        for t, i in (vocab | self.added).items():
            self.tokens[i] = t
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made: dict[str, int] = {}
        for rank, (a, b) in enumerate(merges):
            if a + b in made:
                raise ValueError("two merges make the same token")
            made[a + b] = rank
        if any(made.get(x, -1) >= rank for rank, pair in enumerate(merges) for x in pair):
            raise ValueError("a merge ranks before the one that makes its part")
        key = np.array([vocab[a] * self.width + vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(key)
        self.keys, self.ranks = key[order], order.astype(np.int64)
        self.products = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        shown = _byte_characters()
        self.inner = np.array([vocab[c] for c in shown], dtype=np.int64)
        self.last = np.array([vocab[c + end] for c in shown], dtype=np.int64)
        self.split = regex.compile(self.SPLIT.replace(r"\s", self.SPACE))
        newer = "".join("-".join(chr(int(x, 16)) for x in r.split("-")) for r in self.NEWER.split())
        self.newer = regex.compile(f"[{newer}]")
        self.split_newer = regex.compile(
            "(?V1)" + self.SPLIT.replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]||[{newer}]]").replace(
                r"[\p{L}]", rf"[\p{{L}}--[{newer}]]").replace(r"[\p{N}]", rf"[\p{{N}}--[{newer}]]").replace(
                r"\s", self.SPACE))
        self.split_space = regex.compile(f"[{self.SPACE}]+")
        self.control = re.compile("[\x1c-\x1f]")
        self.special = re.compile("(" + "|".join(re.escape(x) for x in self.added) + ")")
        self.forget()

    def forget(self) -> None:
        """Drop the pieces kept so far; the added tokens come first."""
        self.place = _Places(self.added)
        self.shown = list(self.added)
        self.word = _Places(())
        self.word_ids, self.word_size = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        self.table = np.array(list(self.added.values()), dtype=np.int32)
        self.size = np.ones(len(self.added), dtype=np.int64)
        self.first = np.arange(len(self.added), dtype=np.int64)

    def pieces(self, text: str) -> list[str]:
        """The runs between white space of a text, added tokens apart."""
        if not any(x in text for x in self.added):
            return self._runs(_normal(text))
        out: list[str] = []
        for k, part in enumerate(self.special.split(text)):
            out.extend([part] if k % 2 else self._runs(_normal(part)))
        return out

    def words(self, piece: str) -> list[str]:
        if not piece.isascii() and self.newer.search(piece):
            return self.split_newer.findall(piece)
        return self.split.findall(piece)

    def _runs(self, text: str) -> list[str]:
        # str.split() also splits at four control characters that are no white space here.
        runs = text.split()
        if self.control.search(text):
            runs = [x for x in self.split_space.split(text) if x]
        # An added token counts only as it stands in the given text, not after lower-casing.
        return [_APART + x if x in self.added else x for x in runs] if "<|" in text else runs

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words in turn and the number of each word's, by
        merge rounds over all words together."""
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        length = np.array([len(w) for w in words], dtype=np.int64)
        count = np.zeros(len(words), dtype=np.int64)
        who = np.flatnonzero(length)
        length = length[who]
        sym = self.inner[data]
        stop = np.cumsum(length) - 1
        sym[stop] = self.last[data[stop]]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        long = length > LONG_WORD
        if long.any():
            out = np.repeat(long, length)
            ids, size = self._merge_long(sym[out], length[long])
            count[who[long]] = size
            done.append((np.repeat(who[long], size), ids))
            sym, who, length = sym[~out], who[~long], length[~long]
        while len(who):
            start = np.cumsum(length) - length
            rank = np.full(len(sym), self.NONE)
            key = sym[:-1] * self.width + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank[:-1] = np.where(self.keys[at] == key, self.ranks[at], self.NONE)
            rank[start + length - 1] = self.NONE  # a word's last symbol has no partner
            least = np.minimum.reduceat(rank, start)
            over = least == self.NONE
            if over.any():
                out = np.repeat(over, length)
                count[who[over]] = length[over]
                done.append((np.repeat(who[over], length[over]), sym[out]))
                sym, rank = sym[~out], rank[~out]
                who, length, least = who[~over], length[~over], least[~over]
                if not len(who):
                    break
            spot = np.flatnonzero(rank == np.repeat(least, length))
            # In a run of hits (x x x) only every other one, from the left, can merge.
            fresh = np.ones(len(spot), dtype=bool)
            fresh[1:] = np.diff(spot) > 1
            head = np.maximum.accumulate(np.where(fresh, np.arange(len(spot)), 0))
            spot = spot[(np.arange(len(spot)) - head) % 2 == 0]
            sym[spot] = self.products[rank[spot]]
            gone = np.zeros(len(sym), dtype=np.int64)
            gone[spot + 1] = 1
            length = length - np.add.reduceat(gone, np.cumsum(length) - length)
            sym = sym[gone == 0]
        if not done:
            return np.zeros(0, dtype=np.int32), count
        word = np.concatenate([w for w, _ in done])
        return np.concatenate([x for _, x in done])[np.argsort(word, kind="stable")].astype(np.int32), count

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.NONE)

    def _merge_long(self, sym: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols left of the words, and their numbers: a round takes the
        least rank that any pair has, at all its places.  A merge's new pairs
        rank behind it, so no rank comes up twice."""
        n = len(sym)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        ends = np.cumsum(length)
        after[ends - 1] = n
        before[ends - length] = -1
        rank = np.full(n, self.NONE)
        places: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def look(at: np.ndarray) -> None:
            """Rank the pairs that begin at these places."""
            new = np.full(len(at), self.NONE)
            two = after[at] < n
            new[two] = self._ranks(sym[at[two]], sym[after[at[two]]])
            rank[at] = new
            order = np.argsort(new, kind="stable")
            cut = np.flatnonzero(np.diff(new[order])) + 1
            for part in np.split(order, cut):
                r = int(new[part[0]]) if len(part) else int(self.NONE)
                if r < self.NONE:
                    if r not in places:
                        heapq.heappush(queue, r)
                    places.setdefault(r, []).append(at[part])

        look(np.arange(n))
        while queue:
            r = heapq.heappop(queue)
            at = np.unique(np.concatenate(places.pop(r)))
            at = at[rank[at] == r]
            # In a run of hits (x x x) only every other one, from the left, can merge.
            fresh = np.ones(len(at), dtype=bool)
            fresh[1:] = after[at[:-1]] != at[1:]
            head = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - head) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            sym[at] = self.products[r]
            sym[gone] = -1
            rank[gone] = self.NONE
            after[at] = after[gone]
            more = after[at] < n
            before[after[at[more]]] = at[more]
            left = before[at]
            look(np.unique(np.concatenate((at, left[left >= 0]))))
        kept = sym >= 0
        return sym[kept], np.add.reduceat(kept.astype(np.int64), ends - length)

    def learn(self) -> None:
        """Encode the pieces that were met for the first time.  Their words
        repeat a good deal ("the" in "the," and "the."), so only words that
        are new as well go through merge rounds."""
        new, self.place.new = self.place.new, []
        if not new:
            return
        words = [self.words(x.removeprefix(_APART)) for x in new]
        part = np.array([self.word[w] for x in words for w in x], dtype=np.int64)
        fresh, self.word.new = self.word.new, []
        ids, size = self.merge([w.encode("utf-8", "surrogatepass") for w in fresh])
        self.word_ids = np.concatenate((self.word_ids, ids))
        self.word_size = np.concatenate((self.word_size, size))
        ids, ends = _ragged(self.word_ids, np.cumsum(self.word_size) - self.word_size, self.word_size, part)
        ends = ends[np.concatenate(([0], np.cumsum([len(x) for x in words])))]
        named = list(map(self.tokens.__getitem__, ids.tolist()))
        self.shown += [" ".join(named[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        self.first = np.concatenate((self.first, ends[:-1] + len(self.table)))
        self.size = np.concatenate((self.size, np.diff(ends)))
        self.table = np.concatenate((self.table, ids))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Flat ids, offsets of the texts, and the decoded texts."""
        if len(self.place) > KNOWN_PIECES:
            self.forget()
        known = [list(map(self.place.__getitem__, self.pieces(t))) for t in texts]
        self.learn()
        count = np.concatenate(([0], np.cumsum([len(x) for x in known])))
        piece = np.array([k for x in known for k in x], dtype=np.int64)
        ids, ends = _ragged(self.table, self.first, self.size, piece)
        shown = self.shown
        return ids, ends[count], [" ".join([shown[k] for k in x]) for x in known]

    def decode(self, ids) -> str:
        """The file names no decoder: tokens are joined by one space."""
        return " ".join(map(self.tokens.__getitem__, ids))


# Capital letters that have small ones since Unicode 16.
_NEWER_CASE = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
               **{c: c + 32 for c in range(0x10D50, 0x10D66)}}
_NEWER_CAPITAL = re.compile("[" + "".join(map(chr, _NEWER_CASE)) + "]")


def _normal(text: str) -> str:
    if not text.isascii():
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if _NEWER_CAPITAL.search(text):
            text = text.translate(_NEWER_CASE)
    # Each character is lowered by itself; str.lower() alone would look at a sigma's place.
    return text.replace("Σ", "σ").lower()


def _ragged(table: np.ndarray, first: np.ndarray, size: np.ndarray, rows: np.ndarray):
    """The entries of the rows in turn, each size[row] long from first[row]
    on in the table, and where each one begins (and the last one ends)."""
    length = size[rows]
    ends = np.concatenate(([0], np.cumsum(length)))
    return table[np.repeat(first[rows] - ends[:-1], length) + np.arange(ends[-1])], ends


def _byte_characters() -> list[str]:
    """The visible character that stands for each byte: itself where it is
    printable Latin-1, else the next character from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def encode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>, decoded string) of every row.

    ``vocabulary``: the path of the vocabulary file on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBPE(vocabulary)
        for block in blocks(batches, 1):
            ids, ends, decoded = bpe.encode(block.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                 pa.array(decoded, pa.string())], ["id", "ids", "decoded"])

    kind = df.schema[id_col].dataType.simpleString()
    out = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("id", id_col)


def decode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, decoded string) of rows with token ids; null ids decode as
    an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBPE(vocabulary)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([bpe.decode(x or ()) for x in batch.column(1).to_pylist()], pa.string())],
                ["id", "decoded"])

    kind = df.schema[id_col].dataType.simpleString()
    out = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {kind}, decoded string")
    return out.withColumnRenamed("id", id_col)


def digests(encoded: DataFrame, id_col: str = "doc_id", more: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) of ``encode``'s rows,
    and the columns ``more`` of them."""
    return encoded.select(
        id_col, *more, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
