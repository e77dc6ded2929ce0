"""Operator 7: relational chat formatting, with Spark expressions only.

Turns are collected as structs in two steps (per run of CHUNK turn numbers,
then per conversation), so that a conversation with very many rows is sorted in
bounded pieces by many tasks and only its pieces meet.  Adjacent turns of one
role are merged into one marked turn; the borders between the merged texts are
marked too, so that the rows can be read back.

Template, for a turn of the texts a, b::

    <|im_start|>role\\na\\n<|im_sep|>\\nb\\n<|im_end|>\\n

A control string inside a text (this template's and those of other common ones)
gets a backslash in front, which ``read`` takes away again.  A line break
always stands between a text and a marker, so that a text's own last backslash
cannot be taken for one.  Roles are URL-encoded.

Edge cases: a null text counts as empty, a null role as an empty role; turns
with equal numbers are ordered by role, then text, null numbers first; repeated
rows are turns of their own; rows without conversation id form one conversation
with a null id; only the four named columns are read; an empty table gives an
empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turn numbers collected together in the first step.
CHUNK = 256
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = r"<\|im_(?:start|sep|end)\|>|</?s>|\[/?INST\]|<</?SYS>>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, f"({CONTROL})", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\({CONTROL})", "$1")


def format_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", learn: str = "assistant") -> DataFrame:
    """(conv_col, formatted, mask): the formatted conversation and its loss
    mask, the places (start, end) of the texts of the role ``learn`` in it, in
    bytes of UTF-8, the end exclusive."""
    rows = df.select(
        F.col(conv_col).alias("conv"), F.floor(F.col(turn_col) / CHUNK).alias("chunk"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"),
                 F.coalesce(text_col, F.lit("")).alias("text")).alias("row"))
    pieces = rows.groupBy("conv", "chunk").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    turns = pieces.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("chunk", "rows"))).alias("pieces"))
    turns = turns.select("conv", F.flatten(F.transform("pieces", lambda p: p["rows"])).alias("r"))

    def before(x: Column, k: Column) -> Column:
        head = F.concat(F.lit(START), F.url_encode(x["role"]), F.lit("\n"))
        same = F.get("r", k - 1)["role"] == x["role"]
        return F.when(k == 0, head).when(same, f"\n{SEP}\n").otherwise(F.concat(F.lit(f"\n{END}\n"), head))

    # Two strings a turn: what stands before its text, and the text.
    parts = F.flatten(F.transform("r", lambda x, k: F.array(before(x, k), escaped(x["text"]))))
    out = turns.select("conv", "r", parts.alias("parts"))
    sizes = F.transform("parts", lambda p: F.octet_length(p).cast("long"))
    mask = _let(running_sums(sizes), lambda ends: F.transform("r", lambda x, k: F.when(x["role"] == learn, F.struct(
        F.get(ends, 2 * k).alias("start"), F.get(ends, 2 * k + 1).alias("end")))))
    return out.select(F.col("conv").alias(conv_col),
                      F.concat(F.array_join("parts", ""), F.lit(f"\n{END}\n")).alias("formatted"),
                      F.array_compact(mask).alias("mask"))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value made once: what stands inside a lambda is
    else made anew for each entry."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_sums(sizes: Column) -> Column:
    """The sums of an array's first 1, 2, ... entries, in pieces of CHUNK:
    an array that grows by one entry a step is copied with each."""
    zero = F.array(F.lit(0).cast("long"))

    def sums(values: Column) -> Column:
        grown = F.aggregate(values, zero, lambda have, x: F.array_append(have, F.element_at(have, -1) + x))
        return F.slice(grown, 2, F.size(values))

    def pieces(values: Column) -> Column:
        count = F.ceil(F.size(values) / CHUNK).cast("int")
        places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda k: _let(F.slice(values, k * CHUNK + 1, F.lit(CHUNK)), sums))

    def joined(parts: Column, before: Column) -> Column:
        return F.flatten(F.transform(parts, lambda p, k: _let(
            F.get(before, k), lambda have: F.transform(p, lambda x: x + have))))

    return _let(_let(sizes, pieces), lambda parts: _let(
        F.concat(zero, _let(F.transform(parts, lambda p: F.element_at(p, -1)), sums)),
        lambda before: joined(parts, before)))


def read(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv_col, turns array<struct<role, text>>, loss_text, formatted): the
    rows read back from the formatted string, merged ones apart again, and the
    unescaped text that the loss mask cuts out of it."""
    marked = F.filter(F.split("formatted", r"(?<!\\)<\|im_start\|>", -1), lambda x, k: k > 0)
    d = formatted.select(conv_col, "formatted", "mask", marked.alias("marked"))
    d = d.withColumn("merged", F.transform("marked", lambda c: F.struct(
        F.substring_index(c, "\n", 1).alias("role"), c.alias("c"))))

    def rows(m: Column) -> Column:
        begin = F.length(m["role"]) + 2
        body = F.substring(m["c"], begin, F.length(m["c"]) - begin + 1 - len(f"\n{END}\n"))
        return F.transform(F.split(body, r"\n<\|im_sep\|>\n", -1), lambda t: F.struct(
            F.url_decode(m["role"]).alias("role"), unescaped(t).alias("text")))

    # Of bytes a part is cut out without a walk from the start, as one of a string would take.
    loss = F.array_join(_let(F.encode("formatted", "UTF-8"), lambda raw: F.transform("mask", lambda m: unescaped(
        F.decode(F.substring(raw, (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int")), "UTF-8")))), "")
    return d.select(conv_col, F.flatten(F.transform("merged", rows)).alias("turns"), loss.alias("loss_text"), "formatted")


def digests(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        conv_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
