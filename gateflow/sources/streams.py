"""Stream sources (S4 stand-in, S6).

Without the Kafka connector, streams come from files: a folder of text
files (one message per line) or the ``events`` table, projected to the
same ``value`` messages the producer would publish.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .fixture import raw_swipes
from .lines import to_line


def text_line_stream(spark: SparkSession, folder: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Message stream from text files: column ``value``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)


def events_line_stream(spark: SparkSession, sf_dir: str, faults: bool = True,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """The ``events`` table read as a file stream and encoded as messages."""
    folder = sf_dir.rstrip("/")
    schema = spark.read.parquet(f"{folder}/events.parquet").schema          # footer only
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # As a pattern the path may be one file or a folder of parts.
    events = reader.parquet(f"{folder}/event[s].parquet").select("event_id", "ts", "user_id")
    return to_line(raw_swipes(events, faults))
