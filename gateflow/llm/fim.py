"""Operator 12: fill-in-middle transformation as a pyarrow.compute pipeline.

A text is cut into units, runs of ASCII letters or single other code points.
Two numbers drawn for the document cut the units into prefix, middle and
suffix; two more choose the form.  Each Arrow batch goes through the same
steps: the units of its texts as list arrays, flattened with the indices of
their lists, each unit's ordinal in its text, a role from the ordinal and the
cuts, the units of one role filtered and rebuilt into lists, and
``binary_join`` of these and of the pieces with the markers.

Forms: ``plain`` (the text itself), ``psm`` (prefix, suffix, middle) and ``spm``
(suffix, prefix, middle), each piece behind its marker.  A text that is empty
or holds a marker stays plain, so that ``restore`` gives back every text from
output and form alone.

A text longer than SLICE bytes is cut into slices, never inside a unit, and a
few slices are worked on at a time: a task needs memory for one text and a
few slices of units, however long the text is.

Edge cases: a null text counts as empty; a null id draws as ``<seed>:null``;
rows that repeat an id draw the same numbers, each for its own text; only the id
and text columns are read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gateflow.llm.common import blocks, ship, text_of

ship(__name__)

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
#: Share in percent of the texts that are transformed, and of these in spm form.
RATE, SPM_RATE = 90, 20
SLICE = 1_000_000
#: One unit in UTF-8: ASCII letters, another ASCII byte, or a sequence of bytes.
_UNIT = r"[A-Za-z]+|[\x00-\x7F]|[\x{C0}-\x{FF}][\x{80}-\x{BF}]*"
#: A byte that UTF-8 never has; it ends each unit before the split.
_END = b"\xff"
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True

SCHEMA = ("output string, form string, n long, prefix_chars long, middle_chars long")


def draws(id_col: str, seed: int) -> list[Column]:
    """Four numbers of 32 bits from the SHA-256 of ``<seed>:<id>``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def _cut(text: bytes, size: int) -> list[bytes]:
    """Slices of about ``size`` bytes that end where a unit ends."""
    out, at = [], 0
    raw = np.frombuffer(text, dtype=np.uint8)
    while at < len(raw):
        to = min(len(raw), at + size)
        while to < len(raw) and (raw[to] & 0xC0 == 0x80 or _LETTERS[raw[to]] and _LETTERS[raw[to - 1]]):
            to += 1
        out.append(text[at:to])
        at = to
    return out


def _units(slices: pa.Array) -> pa.ListArray:
    """The units of each slice as a list array."""
    parts = pc.split_pattern(pc.replace_substring_regex(slices, pattern=_UNIT, replacement=b"\\0" + _END), pattern=_END)
    # Behind the last unit's end stands one empty piece a slice: it goes.
    flat, parent = pc.list_flatten(parts), pc.list_parent_indices(parts)
    some = pc.greater(pc.binary_length(flat), 0)
    return _lists(flat.filter(some), parent.filter(some), len(parts))


def _lists(flat: pa.Array, parent: pa.Array, n: int) -> pa.ListArray:
    """Rebuild n lists from values and the (ascending) indices of their lists."""
    offsets = np.searchsorted(np.asarray(parent), np.arange(n + 1), "left")
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)


def _join(lists: pa.ListArray) -> pa.Array:
    return pc.binary_join(lists, pa.scalar(b"", pa.binary()))


def _pieces(slices: pa.Array, owner: np.ndarray, n: int, cuts, groups: list[tuple[int, int]]
            ) -> tuple[np.ndarray, list[pa.Array] | None]:
    """Units per text; then, with ``cuts`` of that count, the pieces (prefix, middle,
    suffix) of each text.  ``owner``: the text of each slice."""
    kept = _units(slices) if len(groups) == 1 else None

    def lists(a: int, b: int) -> pa.ListArray:
        return _units(slices.slice(a, b - a)) if kept is None else kept

    size = np.concatenate([np.asarray(pc.list_value_length(lists(a, b)), dtype=np.int64) for a, b in groups])
    total = np.bincount(owner, size, n).astype(np.int64)
    low, high = cuts(total)
    # The ordinal, within its text, of each slice's first unit.
    before = np.cumsum(size) - size
    first = np.searchsorted(owner, np.arange(n), "left")
    ordinal0 = before - before[first[owner]]
    joined: list[list[pa.Array]] = [[], [], []]
    for a, b in groups:
        units = lists(a, b)
        flat, parent = pc.list_flatten(units), pc.list_parent_indices(units)
        starts = pa.array(ordinal0[a:b] - np.asarray(units.offsets, dtype=np.int64)[:-1])
        ordinal = pc.add(pa.array(np.arange(len(flat), dtype=np.int64)), starts.take(parent))
        of = owner[a:b]
        role = pc.add(pc.cast(pc.greater_equal(ordinal, pa.array(low[of]).take(parent)), pa.int8()),
                      pc.cast(pc.greater_equal(ordinal, pa.array(high[of]).take(parent)), pa.int8()))
        for k in range(3):
            mine = pc.equal(role, pa.scalar(k, pa.int8()))
            joined[k].append(_join(_lists(flat.filter(mine), parent.filter(mine), b - a)))
    return total, [_join(_lists(pa.concat_arrays(j), pa.array(owner), n)) for j in joined]


def _groups(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """Runs of slices of about ``most`` bytes together."""
    out, at, held = [], 0, 0
    for k, s in enumerate(sizes):
        if held and held + s > most:
            out.append((at, k))
            at, held = k, 0
        held += s
    return [*out, (at, len(sizes))]


def transformed(texts: pa.Array, h: list[np.ndarray], rate: int = RATE, spm_rate: int = SPM_RATE,
                size: int = SLICE) -> list[pa.Array]:
    """(output, form, n, prefix_chars, middle_chars) of a block of texts."""
    n = len(texts)
    raw = texts.cast(pa.binary())
    length = np.asarray(pc.binary_length(raw), dtype=np.int64)
    if n and length.max() > size:
        cut = [_cut(t, size) or [b""] for t in raw.to_pylist()]
        owner = np.repeat(np.arange(n), [len(c) for c in cut])
        slices = pa.array([s for c in cut for s in c], pa.binary())
        groups = _groups([len(s) for c in cut for s in c], 2 * size)
    else:
        owner, slices, groups = np.arange(n), raw, [(0, n)]

    def cuts(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = h[0] % (total + 1), h[1] % (total + 1)
        return np.minimum(a, b), np.maximum(a, b)

    total, (prefix, middle, suffix) = _pieces(slices, owner, n, cuts, groups)
    plain = pc.or_(pc.equal(pc.binary_length(raw), 0), pa.array(h[2] % 100 >= rate))
    for marker in MARKERS:
        plain = pc.or_(plain, pc.match_substring(raw, marker))
    spm = pa.array(h[3] % 100 < spm_rate)
    none = b""
    p, s, m = (pa.scalar(x.encode(), pa.binary()) for x in MARKERS[:3])
    psm_text = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)
    spm_text = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none)
    output = pc.if_else(plain, raw, pc.if_else(spm, spm_text, psm_text)).cast(pa.string())
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    null = pa.scalar(None, pa.int64())
    chars = [pc.if_else(plain, null, pc.cast(pc.utf8_length(x.cast(pa.string())), pa.int64())) for x in (prefix, middle)]
    return [output, form, pa.array(total, pa.int64()), *chars]


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, rate: int = RATE,
              spm_rate: int = SPM_RATE) -> DataFrame:
    """(id_col, output, form, n, prefix_chars, middle_chars) of every row; the
    lengths are null for plain texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, 1):
            h = [np.asarray(b.column(k), dtype=np.int64) for k in range(2, 6)]
            out = transformed(b.column(1), h, rate, spm_rate)
            yield pa.RecordBatch.from_arrays([b.column(0), *out], ["id", "output", "form", "n", "prefix_chars",
                                                                  "middle_chars"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), *draws(id_col, seed))
    return rows.mapInArrow(run, f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col)


def restore(output: Column, form: Column) -> Column:
    """The text before the transformation: no piece holds a marker, so the
    output falls apart at its three markers."""
    parts = F.split(output, "|".join(MARKERS))
    first, second, middle = (parts.getItem(k) for k in (1, 2, 3))
    return (F.when(form == "plain", output)
            .when(form == "psm", F.concat(first, middle, second))
            .otherwise(F.concat(second, middle, first)))


def digests(out: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return out.select(id_col, "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
