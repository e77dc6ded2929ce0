"""Keyed upsert into a file table, latest version wins.

The studied programs send ``REPLACE INTO`` one row and one connection at a
time from the driver, and HBase puts from ``collect()``.  Here a table is a
set of update folders that are only ever added, below its partition columns::

    target/day=<d>/hour=<h>/_update=0.<version>.<writer>/part-*

An upsert writes its rows once into the folders of its writer and version and
reads nothing of the table.  A replay overwrites those folders with the same
rows, whenever it comes, so a stop between or inside writes needs no repair.
``read_table`` resolves the latest row of each key with ``max_by`` (partial
aggregation, so a hot key costs nothing extra).  A reader that names its
partitions lists and opens those alone.

Rows are ranked by writer, then version.  A stream's writer id is made when
its checkpoint is, and starts with the time: it stays the same over restarts,
and a new checkpoint, whose batch ids begin at 0 again, ranks above the old.

``fold`` joins the updates of some partitions into one folder each
(``_update=1...``, then 2, ...), in which every row keeps its own rank.  Folded rows
and the updates that they come from say the same, so neither a stop
between writing and deleting nor an update that comes meanwhile changes a
result.  A stream folds the partitions that its watermark has passed while it
runs (``upsert_batch_writer``); ``compact`` folds all of a table.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION_COL = "_version"
WRITER_COL = "_writer"
#: The folders of one update: how often its rows were folded, version, writer.
UPDATE_COL = "_update"
RANK_COLS = (WRITER_COL, VERSION_COL)
#: The ranks that folded rows had as updates.
FOLDED = {WRITER_COL: "_row_writer", VERSION_COL: "_row_version"}
#: The writer of plain loads; every stream's id ranks above it.
LOADS = "0"
TABLE_FILE = "_table.json"
FORMATS = ("parquet", "orc")
#: An open partition with more updates than this is folded before it closes.
MOST_UPDATES = 64
#: Seconds for which folded updates stay for readers that have listed them.
FOLD_GRACE = 600.0


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def writer_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that has this checkpoint: made at its first
    start, kept beside the checkpoint's own files, the same after restarts."""
    path = f"{checkpoint.rstrip('/')}/_writer_id"
    known = _read_text(spark, path)
    if known is None:
        known = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        _write_text(spark, path, known)
    return known


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (VERSION_COL,)) -> DataFrame:
    """One row per key: the one that ranks highest."""
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others])
    agg = df.groupBy(*keys).agg(F.max_by(packed, F.struct(*order)).alias("_row"))
    return agg.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])


def _about(updates: DataFrame, keys: Sequence[str], partition_by: Sequence[str], fmt: str) -> dict:
    return {"keys": list(keys), "partition_by": list(partition_by), "fmt": fmt,
            "schema": json.loads(updates.schema.json())}


def _same_table(known: dict, new: dict, target: str) -> None:
    """An update must have the table's keys, partitions, format, columns and types."""
    for part in ("keys", "partition_by"):
        if sorted(known[part]) != sorted(new[part]):
            raise ValueError(f"table at {target} has {part} {known[part]}, the update {new[part]}")
    if known["fmt"] != new["fmt"]:
        raise ValueError(f"table at {target} has format {known['fmt']}, the update {new['fmt']}")
    old, got = ({f["name"]: f["type"] for f in x["schema"]["fields"]} for x in (known, new))
    if old != got:
        differ = sorted(c for c in {*old, *got} if old.get(c) != got.get(c))
        raise ValueError(f"table at {target} and the update differ in columns {differ}: "
                         f"{ {c: old.get(c) for c in differ} } against { {c: got.get(c) for c in differ} }")


def upsert(updates: DataFrame, target: str, keys: Sequence[str], version: int,
           partition_by: Sequence[str] = (), fmt: str = "parquet",
           unique_keys: bool = False, writer: str = LOADS) -> None:
    """Add ``updates`` to the table at ``target`` (created if absent).

    ``writer`` and ``version`` order competing rows for one key and name one
    immutable update: calling again with both the same is a replay of it.  Of
    rows of one call with equal keys the greatest is kept, by their other
    columns in order, NULLs lowest.  Partition columns must follow from the
    key (its day, its hour); their values may be NULL.  Keys, partitions,
    format, columns or types other than the table's are an error.
    ``unique_keys`` states that ``updates`` has one row per key (an
    aggregation's output), which saves a shuffle."""
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt}: folded rows need one of {FORMATS}, which name their columns")
    spark = updates.sparkSession
    about = _about(updates, keys, partition_by, fmt)
    known = _read_text(spark, f"{target}/{TABLE_FILE}")
    if known is None:
        _write_text(spark, f"{target}/{TABLE_FILE}", json.dumps(about))
    else:
        _same_table(json.loads(known), about, target)
    others = [c for c in updates.columns if c not in keys]
    rows = updates if unique_keys else latest_per_key(updates, keys, others) if others else updates.distinct()
    _write(rows.select(*updates.columns), target, 0, writer, version, partition_by, fmt)


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for a write.  The session of a micro-batch has it
    switched off, and without it a REBALANCE leaves one file a shuffle
    partition and folder.  Only for rows that are no longer a stream's plan."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _write(df: DataFrame, target: str, base: int, writer: str, version: int, partition_by: Sequence[str],
           fmt: str) -> None:
    """One file per partition value unless adaptive execution finds it too large."""
    with adaptive(df.sparkSession):         # the hint is read, or dropped, where it is given
        rows = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
        rows = rows.withColumn(UPDATE_COL, F.lit(f"{base}.{int(version)}.{writer}"))
        (rows.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic")
             .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
             .partitionBy(*partition_by, UPDATE_COL).save(target))


def _describe(spark: SparkSession, target: str) -> dict:
    text = _read_text(spark, f"{target}/{TABLE_FILE}")
    if text is None:
        raise ValueError(f"no upsert table at {target}")
    return json.loads(text)


def _load(spark: SparkSession, target: str, about: dict, paths: Sequence[str]) -> DataFrame:
    """All rows below ``paths`` with their ranks."""
    # The stored schema keeps the type of partition values: a "2019-01-05"
    # folder name must not come back as a DATE.
    schema = T.StructType.fromJson(about["schema"])
    names = schema.fieldNames()
    for name, kind in ((FOLDED[WRITER_COL], T.StringType()), (FOLDED[VERSION_COL], T.LongType()),
                       (UPDATE_COL, T.StringType())):
        schema = schema.add(name, kind)
    reader = spark.read.format(about["fmt"]).schema(schema).option("basePath", target)
    rows = reader.load(list(paths)) if paths else spark.createDataFrame([], schema)
    update = F.split(UPDATE_COL, r"\.", 3)
    rank = {WRITER_COL: update[2], VERSION_COL: update[1].cast("long")}
    return rows.select(*names, *(F.coalesce(F.col(FOLDED[c]), rank[c]).alias(c) for c in RANK_COLS))


def _latest(rows: DataFrame, about: dict) -> DataFrame:
    keys = list(dict.fromkeys([*about["keys"], *about["partition_by"]]))
    return latest_per_key(rows, keys, RANK_COLS)


def _folder(spark: SparkSession, target: str, partition: Mapping[str, object], partition_by: Sequence[str]) -> str:
    """The folder of a partition, of which the leading columns at least are given."""
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    path = target.rstrip("/")
    for c in partition_by:
        if c not in partition:
            break
        value = partition[c]
        path += "/" + names.getPartitionPathString(c, None if value is None else str(value))
    return path


def read_table(spark: SparkSession, target: str, keep_version: bool = False,
               partitions: Iterable[Mapping[str, object]] | None = None) -> DataFrame:
    """The latest row of each key.  ``partitions``, as {column: value} of the
    leading partition columns, names the folders to list; else the whole table
    is listed and a filter on partition columns prunes what is opened."""
    about = _describe(spark, target)
    if partitions is None:
        paths = [target]
    else:
        paths = [f for f in dict.fromkeys(_folder(spark, target, p, about["partition_by"]) for p in partitions)
                 if (at := _fs(spark, f))[0].exists(at[1])]
    latest = _latest(_load(spark, target, about, paths), about)
    names = [f["name"] for f in about["schema"]["fields"]]
    return latest.select(*names, *(RANK_COLS if keep_version else ()))


def _found(spark: SparkSession, pattern: str) -> list[str]:
    """The folders that a pattern names, as they are written here."""
    fs, p = _fs(spark, pattern)
    depth = pattern.count("/")
    top = pattern.split("*", 1)[0].rsplit("/", 1)[0]
    # Only the part below the table: a listing may spell the file system's name out.
    return sorted(top + "/" + "/".join(str(s.getPath()).split("/")[-(depth - top.count("/")):])
                  for s in fs.globStatus(p) or () if s.isDirectory())


def partition_folders(spark: SparkSession, target: str, partition_by: Sequence[str]) -> list[str]:
    """The folders of all partition values."""
    target = target.rstrip("/")
    return _found(spark, "/".join([target, *(f"{c}=*" for c in partition_by)])) if partition_by else [target]


def update_folders(spark: SparkSession, partition: str) -> list[str]:
    """The updates and folded updates of one partition folder."""
    return _found(spark, f"{partition}/{UPDATE_COL}=*")


def delete_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    """Delete folders of updates."""
    for folder in folders:
        fs, p = _fs(spark, folder)
        fs.delete(p, True)


def fold(spark: SparkSession, target: str, partitions: Sequence[str], writer: str, version: int,
         known: Iterable[str] = ()) -> list[str]:
    """Join the updates of each of these partition folders, but for the
    folders that are ``known`` to be replaced, in one folder that ``writer``
    adds.  Returns the folders that it replaces, which may be deleted at any
    time later.  Partitions with one folder stay as they are."""
    about, known = _describe(spark, target), set(known)
    old = [fs for p in partitions if len(fs := [f for f in update_folders(spark, p) if f not in known]) > 1]
    replaced = [f for fs in old for f in fs]
    if not replaced:
        return []
    base = 1 + max(int(f.rsplit(f"/{UPDATE_COL}=", 1)[1].split(".", 1)[0]) for f in replaced)
    rows = _latest(_load(spark, target, about, replaced), about).withColumnsRenamed(FOLDED)
    _write(rows, target, base, writer, version, about["partition_by"], about["fmt"])
    return replaced


def compact(spark: SparkSession, target: str) -> None:
    """Fold all partitions and delete what that replaces.  For tables that no
    query is reading from just now; streams may go on writing."""
    about = _describe(spark, target)
    folders = partition_folders(spark, target, about["partition_by"])
    delete_folders(spark, fold(spark, target, folders, LOADS, time.time_ns() // 1000))


class LiveFolding:
    """Folds the partitions of one stream's table that its event time has
    passed, or that have gathered MOST_UPDATES, and deletes what that
    replaced ``grace`` seconds later.

    Only partitions that the stream wrote to are looked at; those of before a
    restart are found by one listing at its first batch.  Nothing is kept that a
    restart needs: updates left beside a folded folder are folded anew."""

    def __init__(self, target: str, partition_by: Sequence[str], writer: str, grace: float = FOLD_GRACE,
                 most: int = MOST_UPDATES):
        self.target, self.partition_by, self.writer = target.rstrip("/"), list(partition_by), writer
        self.grace, self.most = grace, most
        #: folder: (partition values, updates since it was folded)
        self.open: dict[str, tuple[tuple, int]] | None = None
        self.replaced: list[tuple[float, list[str]]] = []

    def after_batch(self, spark: SparkSession, touched: Iterable[tuple], passed: tuple | None, batch_id: int) -> None:
        """``touched``: the partition values of this batch; ``passed``: the
        values that the event time has reached; partitions below them are closed."""
        if self.open is None:
            self.open = {f: (tuple(x.split("=", 1)[1] for x in f[len(self.target) + 1:].split("/")), 0)
                         for f in partition_folders(spark, self.target, self.partition_by)}
        for values in touched:
            f = _folder(spark, self.target, dict(zip(self.partition_by, values)), self.partition_by)
            self.open[f] = (tuple(None if v is None else str(v) for v in values), self.open.get(f, ((), 0))[1] + 1)
        closed = [f for f, (v, _) in self.open.items() if passed is not None and None not in v and v < passed]
        full = [f for f, (_, n) in self.open.items() if n > self.most and f not in closed]
        if closed or full:
            known = [f for _, fs in self.replaced for f in fs]
            self.replaced.append((time.monotonic(), fold(spark, self.target, closed + full, self.writer, batch_id, known)))
            for f in closed:
                del self.open[f]
            for f in full:
                self.open[f] = (self.open[f][0], 0)
        now = time.monotonic()
        for due in [x for x in self.replaced if now - x[0] >= self.grace]:
            delete_folders(spark, due[1])
            self.replaced.remove(due)


def batch_facts(batch: DataFrame, partition_by: Sequence[str], passed: Sequence[Column] | None
                ) -> tuple[int, list[tuple], tuple | None]:
    """Rows of a persisted batch, its partition values (a few) and the
    greatest ``passed`` values, in one job that fills the cache."""
    values = F.collect_set(F.struct(*partition_by)) if partition_by else F.array()
    bound = F.max(F.struct(*passed)) if passed else F.lit(None)
    row = batch.agg(F.count(F.lit(1)), values, bound).first()
    return row[0], [tuple(v) for v in row[1]], None if row[2] is None else tuple(map(str, row[2]))


def upsert_batch_writer(target: str, keys: Sequence[str], partition_by: Sequence[str] = (),
                        fmt: str = "parquet", unique_keys: bool = True, writer: str = LOADS,
                        passed: Sequence[Column] | None = None, grace: float = FOLD_GRACE
                        ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function adding each micro-batch,
    with the batch id as version.  No row is collected to the driver; an
    empty batch is skipped.  ``passed``: the partition values that a row's
    event time puts behind the watermark; partitions below the greatest of
    them are folded (T15), at most once for each that closes."""
    folding = LiveFolding(target, partition_by, writer, grace) if passed and partition_by else None

    def write(batch_df: DataFrame, batch_id: int) -> None:
        # Persist before the first action, so the (stateful) batch plan runs once.
        batch_df.persist()
        try:
            n, touched, bound = batch_facts(batch_df, partition_by, passed)
            if n:
                upsert(batch_df, target, keys, batch_id, partition_by, fmt, unique_keys, writer)
                if folding:
                    folding.after_batch(batch_df.sparkSession, touched, bound, batch_id)
        finally:
            batch_df.unpersist()

    return write
