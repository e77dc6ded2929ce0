"""Operator 4: personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of a text in one pass: at-signs,
plus signs, digits, URL schemes and identifier cues such as ``token``, in
letters of any case.  Each
anchor has a deterministic parser that expands it to both sides and validates
what it found; a parser never goes back behind the end of its last match.

Kinds, in output order: email, ip, card and phone (the base kinds, leftmost
and non-overlapping within a kind), then url, secret, account and iban, which
the anchors add.  Behind the cues ``account`` and ``iban`` stands a number in
groups, an account of 8 digits or more or an IBAN with right check digits, or
else a secret.  Positions are code points, the end exclusive.

Edge cases: a null text counts as empty and has no spans; repeated rows give
repeated results; a null id stays null; only the id and text columns are read;
an empty table gives an empty table; a text of any length is searched whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gateflow.llm.common import blocks, ship, text_of

ship(__name__)

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "secret", "account", "iban")
DIGITS = frozenset("0123456789")
ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
LABEL = ALNUM | {"-"}
LOCAL = LABEL | frozenset("._%+")
PHONE = DIGITS | frozenset(" ().-")
SECRET = ALNUM | frozenset("_-")
SCHEMES = ("http://", "https://", "ftp://")
CUES = ("token", "secret", "password", "passwd", "api_key", "apikey")
NUMBER_CUES = ("account", "iban")
LEAST_SECRET = 12
LEAST_ACCOUNT, MOST_ACCOUNT = 8, 30
#: What may stand between a cue and its number.
_BETWEEN = re.compile(r"""[ \t]*(?:(?:number|num|no|nr)\b\.?|#)?[ \t"']*(?:(?:is\b|[:=#])[ \t"']*)?""", re.I)
_ACCOUNT = re.compile(r"[0-9]+(?:[ -][0-9]+)*(?![0-9A-Za-z])")
_DATE = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}$|[0-9]{2}-[0-9]{2}-[0-9]{4}$")
_IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:[ -]?[0-9A-Za-z]){11,30}")
# The lengths of the registered countries' IBANs.
IBAN_LENGTHS = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 "
    "FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 "
    "LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 "
    "SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20").split()}


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for d in DIGITS:
        found.add_word(d, ("number", 1))
    found.add_word("@", ("email", 1))
    found.add_word("+", ("phone", 1))
    for kind, words in (("url", SCHEMES), ("secret", CUES), ("account", NUMBER_CUES)):
        for x in words:
            found.add_word(x, (kind, len(x)))
    found.make_automaton()
    return found


def _run(t: str, i: int, allowed: frozenset) -> int:
    """The end of the run of allowed characters from i on."""
    n = len(t)
    while i < n and t[i] in allowed:
        i += 1
    return i


def _email(t: str, at: int, since: int) -> tuple[int, int] | None:
    """Around the at-sign at ``at``, not before ``since``."""
    start = at
    while start > since and t[start - 1] in LOCAL:
        start -= 1
    end = _run(t, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    whole = end
    while whole < len(t) and t[whole] == "." and (to := _run(t, whole + 1, LABEL)) > whole + 1:
        whole = to
    return (start, whole) if whole > end else None


def _address(t: str, i: int) -> tuple[int, bool]:
    """From a digit: the end of a chain of up to four numbers with dots
    between, and whether it has four."""
    end, n = _run(t, i, DIGITS), 1
    while n < 4 and end < len(t) and t[end] == "." and (to := _run(t, end + 1, DIGITS)) > end + 1:
        end, n = to, n + 1
    return end, n == 4


def _chain(t: str, i: int) -> int:
    """From a digit: the end of digits with at most one space or hyphen
    between any two."""
    n = len(t)
    while i < n:
        if t[i] in DIGITS:
            i += 1
        elif t[i] in " -" and i + 1 < n and t[i + 1] in DIGITS:
            i += 2
        else:
            break
    return i


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _phone(t: str, plus: int) -> int | None:
    """The end of a number behind the plus sign, or None."""
    if plus + 1 >= len(t) or t[plus + 1] not in DIGITS:
        return None
    end = _run(t, plus + 2, PHONE)
    while end > plus + 2 and t[end - 1] not in DIGITS:
        end -= 1
    return end if end >= plus + 4 else None


def _secret(t: str, i: int) -> tuple[int, int] | None:
    """Behind a cue: a separator, then a value of letters and digits."""
    i = _run(t, i, frozenset(" \t\"'"))
    if i >= len(t) or t[i] not in "=:":
        return None
    i = _run(t, i + 1, frozenset(" \t\"'"))
    end = _run(t, i, SECRET)
    value = t[i:end]
    if len(value) < LEAST_SECRET or not any(c in DIGITS for c in value):
        return None
    return i, end


def _iban(t: str, i: int) -> int | None:
    """The end of an IBAN from i on whose check digits are right, or None."""
    if (m := _IBAN.match(t, i)) is None:
        return None
    want = IBAN_LENGTHS.get(m[0][:2].upper())
    at = [k for k in range(i, m.end()) if t[k] in ALNUM]
    for n in (want,) if want else range(len(at), 14, -1):
        if n <= len(at):
            end = at[n - 1] + 1
            value = "".join(t[k] for k in at[:n]).upper()
            if (end == len(t) or t[end] not in ALNUM) and int(
                    "".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1:
                return end
    return None


def _account(t: str, i: int) -> tuple[str, int, int] | None:
    """Behind a cue: (kind, start, end) of an IBAN, an account number or a
    secret."""
    to = _BETWEEN.match(t, i).end()
    if to > i or t[i:i + 1] in DIGITS:
        if (end := _iban(t, to)) is not None:
            return "iban", to, end
        if (m := _ACCOUNT.match(t, to)) and not _DATE.match(m[0]) and (
                LEAST_ACCOUNT <= sum(c in DIGITS for c in m[0]) <= MOST_ACCOUNT):
            return "account", to, m.end()
    return None if (span := _secret(t, i)) is None else ("secret", *span)


_SMALL = {c: c + 32 for c in range(65, 91)}


def _folded(t: str) -> str:
    """The text in small letters, place by place."""
    low = t.lower()
    # One letter (a dotted capital I) becomes two characters.
    return low if len(low) == len(t) else t.translate(_SMALL)


def find(t: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """The spans (kind, start, end) of a text, by kind, then start."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys((*KINDS, "chain"), 0)
    for last, (kind, size) in anchors.iter(_folded(t)):
        i = last - size + 1
        if kind == "number":
            if i >= done["ip"]:
                end, four = _address(t, i)
                done["ip"] = end
                if four and all(int(x[-4:]) <= 255 and not x[:-4].strip("0") for x in t[i:end].split(".")):
                    out["ip"].append((i, end))
            if i >= done["card"]:
                done["card"] = end = _chain(t, i)
                digits = t[i:end].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    out["card"].append((i, end))
        elif kind == "email":
            if (span := _email(t, i, done["email"])) is not None:
                out["email"].append(span)
                done["email"] = span[1]
        elif kind == "phone":
            if i >= done["phone"] and (end := _phone(t, i)) is not None:
                done["phone"] = end
                if 8 <= sum(c in DIGITS for c in t[i:end]) <= 15:
                    out["phone"].append((i, end))
        elif kind == "url":
            if i >= done["url"]:
                end = last + 1
                while end < len(t) and not t[end].isspace() and t[end] not in "\"'<>()[]{}|":
                    end += 1
                done["url"] = end
                while end > last + 1 and t[end - 1] in ".,;:!?":
                    end -= 1
                if end > last + 1:
                    out["url"].append((i, end))
        elif kind == "account":
            if (met := _account(t, last + 1)) is not None and met[1] >= done[met[0]]:
                out[met[0]].append(met[1:])
                done[met[0]] = met[2]
        elif (span := _secret(t, last + 1)) is not None and span[0] >= done["secret"]:
            out["secret"].append(span)
            done["secret"] = span[1]
    return [(k, a, b) for k in KINDS for a, b in out[k]]


def masked(t: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets.  Spans that
    overlap count as one, named after the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [t[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, t[at:]])


SPANS = "array<struct<kind:string,start:int,end:int>>"


def detect(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, spans) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = _automaton()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for block in blocks(batches, 1):
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t, anchors)]
                     for t in block.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(found, kind)], ["id", "spans"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, spans {SPANS}").withColumnRenamed("id", id_col)


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the personal data of its texts masked; all columns and
    rows stay, a null text stays null."""
    schema, at = df.schema, df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = _automaton()
        for block in blocks(batches, at):
            texts = [None if t is None else masked(t, find(t, anchors)) for t in block.column(at).to_pylist()]
            columns = list(block.columns)
            columns[at] = pa.array(texts, block.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=block.schema)

    return df.mapInArrow(run, schema)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as
    text."""
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(list(BASE_KINDS)))
    return found.select(id_col, *map(count, BASE_KINDS), F.sha2(line(base), 256).alias("base_sha256"),
                        line(F.col("spans")).alias("spans"))
