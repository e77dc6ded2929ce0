"""A corpus pipeline of five operators.  Each stage works on all that the
stage before it kept, and its result is written as Parquet in the shared folder
and read again, so that an executor lost later repeats one stage only.  The
tables that a stage read or made on its way are deleted once it is written.

Every stage but the last returns the columns of ``documents``: the quality
rules and the benchmark check drop rows, near-duplicate removal keeps the row
with the least id of each class, and the personal-data stage masks spans in the
text and sets ``n_chars`` anew.  The last stage returns the token ids, their
digest and that of their decoding.  Null texts, ids and languages, repeated
rows and empty tables are treated as the stages' operators say.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gateflow.llm import bpe, decontam, near_dup, pii, quality
from gateflow.llm.common import delete, scratch, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return bpe.digests(encoded, more=("ids",))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: SQL cannot express order MinHash classes, edit matching and BPE merges: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for name, stage in STAGES:
        with scratch() as made:
            docs = written(spark, stage(spark, docs, sf_dir), f"pipeline_{name}")
        # The last table made is the stage's result: what it was made from is done with.
        delete(spark, [*before, *made[:-1]])
        before = made[-1:]
    return docs
