"""Operator 13: mixing sources to target weights by systematic sampling.

Every source has a target, a number of words that the mix should take of it.  A
document of a source is expected target / source size times in the mix.  These
expected copies are summed along the documents of the source, one random offset
is added, and a document is emitted once for each integer boundary that its
stretch of the sum crosses: the floor or the ceiling of its expected copies.

The documents of a source stand in the order of their sizes, then ids, then
text hashes, so that each boundary stands for documents of about one size: the
words taken differ from the target by about one longest document at most.

The prefix sum is exact and distributed.  Expected copies are fixed-point
integers of FRACTION bits.  The rows are range-partitioned and sorted by source
and place once, as a table in the shared folder; each range's rows of a source
are counted (at most one row a range and source), the counts summed along the
ranges, and a row's sum follows from its place.  A source with most of all rows
is spread over many ranges.  Only boundaries modulo one matter, so the sums
wrap and no table is too large for 64 bits.

Targets (``targets``): the sources, sorted by code point with null last, weigh
5, 2, 1, 5, 2, 1, ... and share the words of all of them; a target stops at
MOST_COPIES times its source's size and what is over is shared among the others
by weight until none is above.  It is found by raising one level, the words
per weight; each round is one sum over the sources, which stay a table.

Edge cases: a null text has size 0; documents of size 0 are sampled like others
and add no words; a null source is a source of its own; null ids come first;
rows equal in source, size, id and text are interchangeable; columns
of any name may be kept; an empty table gives an empty table.  A source without words has target 0 and
is not taken.  Reruns give the same copies, whatever the partitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gateflow.llm.common import written

#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Bits of the fraction of expected copies.
FRACTION = 40
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text_col: str = "text") -> Column:
    """The size of a document; 0 for a null text."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def placed(spark: SparkSession, df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` as a table in the shared folder, range-partitioned and sorted, with
    the range (``part``) and the place inside it (``place``) of each row."""
    # Rows equal in all of ``order`` may fall on both sides of a range's end.
    spread = df.withColumn("tie", F.monotonically_increasing_id())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return written(spark, spread.repartitionByRange(parts, *order, "tie").sortWithinPartitions(*order, "tie")
                   .withColumn("part", F.spark_partition_id())
                   .withColumn("place", F.monotonically_increasing_id()).drop("tie"), name)


def starts(rows: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """(part, *within, first, before): for each range and group of ``within``, the
    place of its first row there and the number of its rows in ranges before."""
    runs = rows.groupBy("part", *within).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    along = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("n").over(along.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return runs.select("part", *within, "first", before.alias("before"))


#: The place (from 0) of a row in its group, of a row joined with its start.
RANK = "before + place - first"


def targets(spark: SparkSession, sized: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST_COPIES
            ) -> DataFrame:
    """(name, source_size, target) of rows with source and size; name is the
    source."""
    sums = placed(spark, sized.groupBy(F.col("source").alias("name")).agg(F.sum("size").alias("source_size")),
                  [F.asc_nulls_last("name")], "mix_sources")
    turn = (F.pmod(F.expr(RANK), F.lit(len(weights))) + 1).cast("int")
    sources = written(spark, sums.join(starts(sums), "part").select(
        "name", "source_size", F.element_at(F.array(*map(F.lit, weights)), turn).alias("weight")), "mix_weights")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    ceiling = F.col("source_size") * most
    level, last = 0.0, None
    while level != last:
        above = F.lit(level) * F.col("weight") > ceiling
        held, open_ = sources.agg(F.sum(F.when(above, ceiling)), F.sum(F.when(~above, F.col("weight")))).first()
        level, last = (total - (held or 0)) / open_ if open_ else math.inf, level
        if not total:
            break
    at_level = F.lit(level if total else 0.0) * F.col("weight")
    return sources.select("name", "source_size", F.when(at_level > ceiling, ceiling.cast("double")).otherwise(
        at_level.cast("double")).alias("target"))


def offset(seed: int, source: str) -> Column:
    """The random offset of a source, a fraction of FRACTION bits."""
    name = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}"), name), 256)
    return F.conv(F.substring(digest, 1, FRACTION // 4), 16, 10).cast("long")


def mix(docs: DataFrame, keep: Sequence[str] = (), id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: Sequence[float] = WEIGHTS, most: int = MOST_COPIES, seed: int = 1
        ) -> DataFrame:
    """(id_col, source, size, source_size, target, copies, row) of every row of
    ``docs``; ``row`` has the columns named in ``keep``, which are shuffled along."""
    spark = docs.sparkSession
    row = F.struct(*(F.col(f"`{c}`") for c in keep)) if keep else F.lit(None).cast("boolean")
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                        n_words(text_col).alias("size"), F.xxhash64(text_col).alias("hash"), row.alias("row"))
    if not keep:
        # Range partitioning reads its input twice: once to find the ranges.
        sized = written(spark, sized, "mix_sizes")
    rows = placed(spark, sized, [F.asc_nulls_last("source"), F.asc("size"), F.asc_nulls_first("id"), F.asc("hash")],
                  "mix_rows")
    one = 1 << FRACTION
    step = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * F.lit(float(one)))
                  ).otherwise(F.lit(0)).cast("long")
    # One row a range and source: rates join these, so that no source's rows meet in one task.
    begin = starts(rows, ["source"]).join(targets(spark, rows, weights, most), F.col("source").eqNullSafe(F.col("name")))
    begin = begin.select(F.col("part").alias("of"), "name", "first", "before", "source_size", "target",
                         step.alias("step"), offset(seed, "name").alias("offset"))
    joined = rows.join(begin, (F.col("part") == F.col("of")) & F.col("source").eqNullSafe(F.col("name")))
    # The sum before the row, modulo one.
    wide = "decimal(38,0)"
    behind = F.pmod(F.col("step").cast("decimal(16,0)") * F.expr(RANK).cast("decimal(20,0)")
                    + F.col("offset").cast(wide), F.lit(one).cast(wide)).cast("long")
    return joined.select(F.col("id").alias(id_col), "source", "size", "source_size", "target",
                         F.shiftright(behind + F.col("step"), FRACTION).alias("copies"), "row")


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: the kept columns of each row, once for each copy."""
    return mixed.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")
                                            ).select("row.*", "copy")


def digests(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return mixed.select(id_col, "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                        "source", "copies")
