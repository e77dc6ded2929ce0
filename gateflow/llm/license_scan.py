"""Operator 10: licence scan with a generalised suffix automaton.

The words of all licence templates and phrases build one automaton.  A text is
streamed through it word by word, which gives at each word the longest run
ending there that some template holds (the matching statistics).  Places of
phrases are read off the automaton's states.  Runs of at least LEAST_RUN words
are chained, in order in the text and in the template, into covered template
spans.  A template covered to LEAST_COVER (SHORT_COVER, if it is short) gives
its label where the span holds the name and version that tell it from its
neighbours, and no other label covers the same place better.

Words are runs of digits, letters a-z and non-ASCII characters, after A-Z are
lower-cased.  The score is the largest covered share of any template, 0 to 1.

Edge cases: a null text counts as empty: no words, no labels, null first and
last word, score 0.  Repeated rows give repeated results, a null id stays
null, only the id and text columns are read, an empty table gives an empty
table, and texts of any length are streamed whole: memory beside the text's
words is the automaton and the runs found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gateflow.llm.common import blocks, ship, text_of
from gateflow.llm.license_texts import NEEDS, PHRASES, TEMPLATES

ship(__name__)

LEAST_RUN = 3
LEAST_COVER = 0.6
#: Templates of fewer than SHORT words must be covered to SHORT_COVER.
SHORT, SHORT_COVER = 30, 0.85
#: Words that may lie between two runs of one chain, in text and template.
MOST_GAP = 8

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate(_LOWER) if not text.isascii() else text.lower())


class Automaton:
    """Generalised suffix automaton over word numbers."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.number: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        self.templates = [(label, words_of(t)) for label, t in templates]
        self.phrases = [(label, words_of(t)) for label, t in phrases]
        #: The phrases that a span of each template must hold.
        self.needs = [[f" {x} " for x in NEEDS.get(label, ()) if f" {x} " in f" {' '.join(ws)} "]
                      for label, ws in self.templates]
        for k, (_, ws) in enumerate(self.templates + self.phrases):
            last = 0
            for i, w in enumerate(ws):
                last = self._extend(last, self.number.setdefault(w, len(self.number)))
                if k < len(self.templates):
                    self.ends[last].append((k, i))
        order = sorted(range(len(self.next)), key=self.length.__getitem__)
        #: Phrases that end wherever a state's longest run ends: (words, number).
        self.spoken: list[list[tuple[int, int]]] = [[] for _ in order]
        for n, (_, ws) in enumerate(self.phrases):
            v = 0
            for w in ws:
                v = self.next[v][self.number[w]]
            self.spoken[v].append((len(ws), n))
        for v in order[1:]:
            self.spoken[v] = self.spoken[v] + self.spoken[self.link[v]]
        for v in reversed(order[1:]):
            self.ends[self.link[v]] = sorted({*self.ends[self.link[v]], *self.ends[v]})

    def _state(self, nxt: dict, link: int, length: int) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        clone = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = clone
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if (q := self.next[last].get(c)) is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, c)
        cur = self._state({}, 0, self.length[last] + 1)
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
        return cur

    def stream(self, words: list[str]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
        """(start, phrase) of every place of a phrase, and the runs (start,
        length, state) of LEAST_RUN words or more that cannot be longer."""
        places: list[tuple[int, int]] = []
        runs: list[tuple[int, int, int]] = []
        number, nxt, link, length, spoken = self.number.get, self.next, self.link, self.length, self.spoken
        known = [(i, c) for i, c in enumerate(map(number, words)) if c is not None]
        v = size = 0
        before = -2
        for i, c in known:
            if i != before + 1:
                if size >= LEAST_RUN:
                    runs.append((before + 1 - size, size, v))
                v = size = 0
            elif size >= LEAST_RUN and c not in nxt[v]:
                runs.append((i - size, size, v))
            while v and c not in nxt[v]:
                v = link[v]
                size = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                size += 1
            before = i
            for n, k in spoken[v]:
                if n <= size:
                    places.append((i - n + 1, k))
        if size >= LEAST_RUN:
            runs.append((before + 1 - size, size, v))
        return places, runs

    def chains(self, runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
        """Covered template spans (template, covered words, first word and end
        in the text, words of the template): each run continues the chain of
        its template that it follows in both, or begins one.  A template holds
        a run at few places, so the open chains are few."""
        open_: dict[int, list[list[int]]] = {}
        done: list[list[int]] = []
        for start, size, v in runs:
            for k, last in self.ends[v]:
                first = last - size + 1
                best = None
                keep = []
                for c in open_.get(k, ()):
                    # c: covered, text start, text end, template end
                    if start - c[2] > MOST_GAP:
                        done.append([k, *c])
                        continue
                    keep.append(c)
                    # Runs overlap where a later one begins inside an earlier one.
                    if (start + size > c[2] and last >= c[3] and 0 <= first + MOST_GAP - c[3] + size
                            and first - c[3] <= MOST_GAP and (best is None or c[0] > best[0])):
                        best = c
                if best is not None:
                    best[0] += min(size, start + size - best[2], last + 1 - best[3])
                    best[2], best[3] = start + size, last + 1
                else:
                    keep.append([size, start, start + size, last + 1])
                open_[k] = keep
        done += [[k, *c] for k, cs in open_.items() for c in cs]
        return [(k, covered, a, b, len(self.templates[k][1])) for k, covered, a, b, _ in done]


ROW = ("n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
       "labels array<string>, score double, spans array<struct<label:string,start:int,end:int,cover:double>>")


def strongest(words: list[str], found: Automaton, chained) -> list[tuple[str, int, int, float]]:
    """The spans (label, start, end, cover) that give their labels."""
    spans = []
    for k, c, a, b, n in chained:
        if c / n >= (SHORT_COVER if n < SHORT else LEAST_COVER):
            said = f" {' '.join(words[a:b])} "
            if all(x in said for x in found.needs[k]):
                spans.append((found.templates[k][0], a, b, min(1.0, c / n)))
    out, near = [], []
    for s in sorted(spans, key=lambda s: s[1]):
        near = [t for t in near if t[2] > s[1]] + [s]
        out.append((s, near[:-1]))
    beaten = set()
    for s, others in out:
        for t in others:
            common = 2 * (min(s[2], t[2]) - s[1])
            if s[0] != t[0] and (s[3], s[2] - s[1]) != (t[3], t[2] - t[1]):
                # The less covered one, or of two as well covered the shorter.
                less = min(s, t, key=lambda x: (x[3], x[2] - x[1]))
                if common > less[2] - less[1]:
                    beaten.add(less)
    return [s for s in spans if s not in beaten]


def examine(text: str, found: Automaton) -> dict:
    words = words_of(text)
    places, runs = found.stream(words)
    chained = found.chains(runs)
    base = {found.phrases[k][0] for _, k in places}
    strong = strongest(words, found, chained)
    starts = [i for i, _ in places]
    return {
        "n_words": len(words), "n_base": len(places), "first_word": min(starts, default=None),
        "last_word": max(starts, default=None), "base_labels": sorted(base),
        "labels": sorted(base | {s[0] for s in strong}), "score": max((min(1.0, c / n) for _, c, _, _, n in chained), default=0.0),
        "spans": [dict(zip(("label", "start", "end", "cover"), s)) for s in sorted(strong, key=lambda s: (s[1], s[2], s[0]))]}


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
         phrases=PHRASES) -> DataFrame:
    """(id_col, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans) of every row; spans are the covered template spans, in
    words of the text."""
    kinds = pa.schema([
        ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                      ("cover", pa.float64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Automaton(templates, phrases)
        for block in blocks(batches, 1):
            rows = [examine(t, found) for t in block.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [block.column(0), *(pa.array([r[f.name] for r in rows], f.type) for f in kinds)],
                ["id", *kinds.names])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, {ROW}").withColumnRenamed("id", id_col)


def digests(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``scan``'s rows with the label lists joined by commas."""
    return scanned.select(
        id_col, "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")
