"""Daily swipe files.

One scan over the whole folder replaces the per-day loop; the day key comes
from the file name (not from ``time``), exactly as the studied programs key
their results.  A day list becomes a glob, so unneeded files are never
listed or opened.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DAILY_FILE_REGEX, RAW_COLUMNS, RAW_SCHEMA, RAW_WITH_DAY_SCHEMA


def daily_file_glob(folder: str, days: Iterable[str] | None = None,
                    prefix: str = "record_", suffix: str = ".csv") -> str:
    """The files of all days, or of some: a day may have several parts."""
    folder = folder.rstrip("/")
    if days is None:
        return f"{folder}/{prefix}*{suffix}"
    days = sorted(set(days))
    if len(days) == 1:
        return f"{folder}/{prefix}{days[0]}*{suffix}"
    return f"{folder}/{prefix}{{{','.join(days)}}}*{suffix}"


def read_daily_csv(spark: SparkSession, folder: str, days: Iterable[str] | None = None,
                   file_regex: str = DAILY_FILE_REGEX) -> DataFrame:
    """Header line skipped, seven string columns by position,
    plus ``service_date`` taken from the file name."""
    df = (spark.read.schema(RAW_SCHEMA)
          .option("header", True)
          .option("mode", "PERMISSIVE")
          .csv(daily_file_glob(folder, days)))
    day = F.regexp_extract(F.col("_metadata.file_name"), file_regex, 1)
    return df.select(day.alias("service_date"), *RAW_COLUMNS)


#: The text of a row that has too few or too many fields; NULL for others.
MALFORMED = "malformed"
_LINE = "_line"
_WITH_LINE = T.StructType([*RAW_SCHEMA.fields, T.StructField(_LINE, T.StringType())])
_RECORDS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _LINE,
    # A scan of some columns must count the fields of a row all the same.
    "columnPruning": "false",
}


def _told_apart(df: DataFrame, file_regex: str) -> DataFrame:
    good = F.col(_LINE).isNull()
    return df.select(F.regexp_extract(F.col("_metadata.file_name"), file_regex, 1).alias("service_date"),
                     *(F.when(good, F.col(c)).alias(c) for c in RAW_COLUMNS), F.col(_LINE).alias(MALFORMED))


def read_daily_records(spark: SparkSession, folder: str, days: Iterable[str] | None = None,
                       file_regex: str = DAILY_FILE_REGEX) -> DataFrame:
    """``read_daily_csv`` with malformed rows told apart.  A row of
    another field count has its text in ``malformed`` and NULL in all seven
    columns, instead of fields that are filled up or cut off."""
    return _told_apart(spark.read.schema(_WITH_LINE).options(**_RECORDS).csv(daily_file_glob(folder, days)), file_regex)


def daily_file_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None,
                      file_regex: str = DAILY_FILE_REGEX) -> DataFrame:
    """The same as a file stream, which takes each new file once."""
    reader = spark.readStream.schema(_WITH_LINE).options(**_RECORDS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _told_apart(reader.csv(daily_file_glob(folder)), file_regex)


def read_clean_layer(spark: SparkSession, path: str, days: Iterable[str] | None = None,
                     fmt: str = "parquet") -> DataFrame:
    """The cleaned layer written by ``sinks.files.write_by_day``; a day list
    prunes partitions at planning time."""
    # The schema keeps the partition value a string (no date inference).
    reader = spark.read.format(fmt).schema(RAW_WITH_DAY_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True)
    df = reader.load(path)
    if days is not None:
        df = df.filter(F.col("service_date").isin(list(days)))
    return df.select("service_date", *RAW_COLUMNS)


def rename_positional(df: DataFrame) -> DataFrame:
    """S3: ``toDF`` with the seven fixed names (for frames read without a schema)."""
    extra = [c for c in df.columns[len(RAW_COLUMNS):]]
    return df.toDF(*RAW_COLUMNS, *extra)
