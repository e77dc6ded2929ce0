"""Operator 9: quality rules as a threshold table compiled into one Spark
projection, with built-in expressions only.

``RULES`` names each ratio and the bounds that it must keep.  ``measures``
makes the counts, ``ratios`` the figures of the table and ``verdict`` compiles
the table into columns.  Everything is a projection of one row: no shuffle, no
user function.

Edge cases: a null text counts as one without words; such a row, an empty text
and one of white space only have zero counts and are rejected.  Ratios over no
words are 0.  A null or unknown language skips the stop-word rule.  Repeated
rows give repeated results.  Only the id, text and language columns are read,
so other columns cannot clash.  Repeated windows are found by sorting the
64-bit hashes of a text's windows; two different windows of one text meet in a
hash with a probability of about 1e-8 for a million words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gateflow.llm.common import text_of

SYMBOLS = "#*$%&|<>"
#: Frequent function words by language (the stop-word ratio).
STOP_WORDS = {
    "en": "the of and to in a is that for it was on are as with be by this at from or an have not but they which you",
    "fr": "de la le et les des en un une du que est pour qui dans par sur au pas plus avec il elle ce sont se ne aux",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ya este sí",
}
#: name: (figure, least, most, languages it holds for); None: no such bound.
RULES: dict[str, tuple[str, float | None, float | None, tuple[str, ...] | None]] = {
    "word_length": ("chars_per_word", 2.0, 14.0, None),
    "symbols": ("symbols_per_word", None, 0.2, None),
    "shouting": ("marks_per_word", None, 0.5, None),
    "stop_words": ("stop_words_per_word", 0.02, None, tuple(STOP_WORDS)),
    "repeated_lines": ("repeated_lines_per_line", None, 0.5, None),
}


def _count_of(characters: str) -> Column:
    """How many of the characters the text ``t`` has."""
    rest = F.col("t")
    for x in characters:
        rest = F.replace(rest, F.lit(x), F.lit(""))
    return (F.length("t") - F.length(rest)).cast("long")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once, also where the optimizer copies
    the expression elsewhere and where ``body`` uses it for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """How many words stand in a window of three that the text has twice."""
    def windows(w: Column) -> Column:
        at = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))
        return F.array_sort(F.transform(at, lambda i: F.struct(
            F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        # Starts of windows that stand beside an equal one in hash order, in text order.
        again = F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def covered(r: Column) -> Column:
        # A window covers three words, fewer where the next one begins inside it.
        cover = F.transform(r, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(r, k + 1) - x, F.lit(3))))
        return F.aggregate(cover, F.lit(0), lambda a, x: a + x)

    return _let(_let(_let(words, windows), repeated), covered)


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """(id_col, lang, counts) of every row."""
    lang = F.col(lang_col) if lang_col else F.lit(None).cast("string")
    d = df.select(F.col(id_col).alias("id"), lang.alias("lang"), text_of(text_col).alias("t"))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike("[^ \t-\r]"))
    d = d.select(
        "id", "lang", F.length("t").cast("long").alias("n_chars"),
        _count_of(SYMBOLS).alias("n_symbols"), _count_of("!?").alias("n_marks"),
        F.array_remove(F.split("t", "[ \t-\r]+", -1), "").alias("w"), lines.alias("lines"))
    stop = F.filter("w", lambda x: F.lower(x).isin(sorted({s for v in STOP_WORDS.values() for s in v.split()})))
    d = d.select(
        "id", "lang", F.length(F.array_join("w", "")).cast("long").alias("word_chars"), "n_chars", "n_symbols",
        "n_marks", F.size("w").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(stop).cast("long").alias("n_stop_words"), _repeat_words(F.col("w")).cast("long").alias("n_repeat_words"))
    return d.withColumnRenamed("id", id_col)


def ratios() -> dict[str, Column]:
    """The figures that the table bounds, from the counts."""
    def per(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return {"chars_per_word": per("word_chars", "n_words"), "symbols_per_word": per("n_symbols", "n_words"),
            "marks_per_word": per("n_marks", "n_words"), "stop_words_per_word": per("n_stop_words", "n_words"),
            "repeated_lines_per_line": per("n_dup_lines", "n_lines")}


def base_failed() -> Column:
    """Fewer than 50 words, or over half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def verdict(rules=None) -> tuple[Column, Column]:
    """(kept, names of the broken rules) compiled from the table."""
    figures = ratios()
    broken = []
    for name, (figure, least, most, langs) in (RULES if rules is None else rules).items():
        bad = F.lit(False)
        if least is not None:
            bad = bad | (figures[figure] < least)
        if most is not None:
            bad = bad | (figures[figure] > most)
        if langs is not None:
            bad = bad & F.coalesce(F.col("lang").isin(list(langs)), F.lit(False))
        broken.append(F.when(bad, F.lit(name)))
    names = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return ~base_failed() & (F.size(names) == 0), names


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang",
          rules=None) -> DataFrame:
    """Counts, base_failed, broken_rules and kept of every row."""
    kept, names = verdict(rules)
    return measures(df, id_col, text_col, lang_col).withColumn("base_failed", base_failed()).withColumn(
        "broken_rules", names).withColumn("kept", kept)


def keep(df: DataFrame, text_col: str = "text", lang_col: str | None = "lang", rules=None) -> DataFrame:
    """The rows of ``df`` that pass; all columns stay."""
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("id")
    lang = F.col(lang_col) if lang_col else F.lit(None).cast("string")
    scored = score(df.select(whole, F.col(text_col).alias("text"), lang.alias("lang")), "id", "text", "lang", rules)
    # The row number holds the filter above the measures: pushed below them it
    # would measure every text again for each use of a count.
    numbered = scored.select("id", "kept", F.monotonically_increasing_id().alias("n"))
    return numbered.where("kept and n >= 0").select("id.*")
