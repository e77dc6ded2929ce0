"""Session construction and shared-storage helpers.

The library never hard-codes a cluster layout: shuffle width, AQE and the
checkpoint folder come from the session.  ``get_session`` only fills in
settings that are still unset, so a cluster's own configuration wins.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied when the caller (or cluster) has not set them already.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


MB = 1024 * 1024


def sizing_conf(input_bytes: int, cores: int, split_bytes: int = 256 * MB) -> dict[str, str]:
    """Split and shuffle sizes for an input of ``input_bytes`` on ``cores``
    task slots.

    * scan splits of ``split_bytes`` keep each task's input bounded;
    * the initial shuffle width gives the full-row dedup shuffle about one
      split's worth of data per reducer, whatever the input, and at least two
      waves of tasks;
    * AQE coalesces the small aggregate shuffles down to the advisory size
      and splits skewed partitions of joins and rebalances.
    """
    width = max(2 * cores, -(-input_bytes // split_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def size_for_input(spark: SparkSession, path: str) -> dict[str, str]:
    """Measure ``path`` on its file system and apply ``sizing_conf`` for it
    and the session's task slots (all are runtime SQL settings).  Settings
    that the cluster or the user has made stay; returns those applied."""
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(sc._jsc.hadoopConfiguration())
    size = fs.getContentSummary(jpath).getLength()
    conf = sizing_conf(max(int(size), 1), sc.defaultParallelism)
    made = spark._jsparkSession.sessionState().conf().settings()
    conf = {k: v for k, v in conf.items() if not made.containsKey(k) or made.get(k) == _APPLIED.get(k)}
    for key, value in conf.items():
        spark.conf.set(key, value)
        _APPLIED[key] = value
    return conf


#: Settings that size_for_input made itself; it may make them anew.
_APPLIED: dict[str, str] = {}


def get_session(master: str | None = None, app_name: str = "gateflow",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None,
                input_bytes: int | None = None, cores: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset and give
    ``input_bytes`` and ``cores`` (see ``sizing_conf``); AQE then coalesces
    the shuffle width at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if input_bytes and cores:
        conf.update(sizing_conf(input_bytes, cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_session_defaults(spark)
    return spark


def apply_session_defaults(spark: SparkSession) -> None:
    """Pin the settings results depend on (time zone) on an existing session."""
    spark.conf.set("spark.sql.session.timeZone",
                   spark.conf.get("spark.sql.session.timeZone", "UTC") or "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster names it.  A local session (one machine, as in tests) that
    names none gets a private temporary folder, so later calls agree; on a
    cluster a machine-local folder would be lost, so that is an error.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="gateflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared folder (never machine-local
    unless the session itself points at a local folder)."""
    return "/".join([shared_dir(spark), *parts, uuid.uuid4().hex])
