"""Message-bus source and sink options.

The Kafka connector jar is not on this image's class path, so these
builders are exercised through the file stream, which yields the same
``value`` column.  On a cluster with the connector they are used as is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.lines import to_line


def kafka_source_options(servers: str, topic: str, starting_offsets: str = "latest",
                         fail_on_data_loss: bool = False,
                         max_offsets_per_trigger: int | None = None,
                         min_partitions: int | None = None) -> dict[str, str]:
    """Subscribe, start at latest, tolerate lost offsets.
    ``min_partitions`` splits few topic partitions into more tasks without
    a shuffle (the studied topic had one partition)."""
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    return opts


def read_kafka_lines(spark: SparkSession, servers: str, topic: str, **kw) -> DataFrame:
    """The message stream as one string ``value`` column."""
    df = spark.readStream.format("kafka").options(**kafka_source_options(servers, topic, **kw)).load()
    return df.selectExpr("CAST(value AS STRING) AS value")


def write_kafka_lines(df: DataFrame, servers: str, topic: str) -> None:
    """Publish each row as one comma-joined message (batch write)."""
    (to_line(df).write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save())
