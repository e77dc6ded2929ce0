"""Day-partitioned overwrite of the clean layer (K1, K2).

The studied job writes each day through ``coalesce(1)`` (one task for the
whole day) and renames the part file.  Here all days go in one write:
``partitionBy("service_date")`` with dynamic partition overwrite replaces
exactly the days present in the output, atomically per day.  A REBALANCE
hint lets AQE split a hot day into several files and merge small ones,
instead of sending a whole day to one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

NO_SUCCESS_MARKER = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


def write_by_day(df: DataFrame, path: str, fmt: str = "parquet", day_col: str = "service_date",
                 success_marker: bool = False, header: bool = True,
                 empty_days: Iterable[str] = ()) -> None:
    """Replace the days that ``df`` has, and clear ``empty_days``: days that
    this run covers but for which it has no row."""
    writer = (df.hint("rebalance", day_col)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(day_col)
                .format(fmt))
    if not success_marker:
        writer = writer.options(**NO_SUCCESS_MARKER)      # K2
    if fmt == "csv":
        writer = writer.option("header", header)
    writer.save(path)
    drop_days(df.sparkSession, path, empty_days, day_col)


def drop_days(spark: SparkSession, path: str, days: Iterable[str], day_col: str = "service_date") -> None:
    """Delete the folders of these days."""
    for day in days:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{day_col}={day}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def write_daily_files(df: DataFrame, folder: str, day_col: str = "service_date", mode: str = "overwrite",
                      tag: str = "", options: Mapping[str, str] | None = None) -> None:
    """Headed CSV files ``record_<day>.csv`` as the studied input has them;
    a day that is written in several parts (a hot day, a limit on the rows of a
    file) gets ``record_<day>_<n>.csv`` files.  ``overwrite`` replaces all daily
    files of the folder, ``append`` adds files, whose names must be new:
    ``tag`` tells one arrival of a day from another.  A file that cannot take
    its name is an error, and no row is deleted then."""
    spark = df.sparkSession
    folder = folder.rstrip("/")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    top = hadoop.Path(folder)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    coming = f"{folder}/_coming-{uuid.uuid4().hex}"
    (df.hint("rebalance", day_col).write.mode("overwrite").option("partitionOverwriteMode", "static")
       .options(**{"header": True, **(options or {}), **NO_SUCCESS_MARKER}).partitionBy(day_col).csv(coming))
    if mode == "overwrite":
        for old in fs.globStatus(hadoop.Path(f"{folder}/record_*.csv")) or ():
            fs.delete(old.getPath(), False)
    for day in fs.listStatus(hadoop.Path(coming)):
        name = day.getPath().getName()
        if not name.startswith(f"{day_col}="):
            continue
        parts = sorted((p.getPath() for p in fs.listStatus(day.getPath()) if p.getPath().getName().endswith(".csv")),
                       key=lambda p: p.getName())
        stem = f"{folder}/record_{name.split('=', 1)[1]}{tag and '_' + tag}"
        for n, part in enumerate(parts):
            to = hadoop.Path(f"{stem}.csv" if len(parts) == 1 else f"{stem}_{n}.csv")
            if fs.exists(to) or not fs.rename(part, to):
                raise OSError(f"{part} cannot become {to}")
    fs.delete(hadoop.Path(coming), True)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None, empty_days: Iterable[str] = ()) -> None:
    """Plain result-table write (report, rejects, analyses); ``empty_days``:
    as for ``write_by_day``, for tables partitioned by ``service_date``."""
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.save(path)
    drop_days(df.sparkSession, path, empty_days)
