"""Session helpers: building a session and locating the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Session settings the jobs are designed around.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "fieldnotes", shuffle_partitions: int | None = None,
                  **extra: str) -> SparkSession:
    """A session with the settings above. Master, shuffle width and everything else are the submitter's, unless given here."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Sizing for a cluster run over ``input_bytes`` of input on ``cores`` cores.

    Scan splits and the AQE target are ``partition_bytes`` so a task's input
    fits in executor memory. The initial shuffle width follows the input size
    (at least two tasks per core); AQE then merges small partitions toward the
    target and splits skewed join partitions.
    """
    width = max(2 * cores, input_bytes // partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written tables, from ``spark.checkpoint.dir``.

    Only a local session, whose executors are this process, may do without:
    it gets a private folder. Anywhere else a missing setting is an error.
    """
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fieldnotes-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared folder and read from there: it is computed once, and its size is known to the planner."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: rows of the small side of a join that are sent to all tasks, at most
SENT = 1 << 21


def sent(df: DataFrame) -> DataFrame:
    """The stored table ``df`` of a few narrow columns, to be sent to all tasks by a join if it has at most ``SENT`` rows.

    The other side's rows then stay where they are. The planner alone would compare bytes with a setting and
    move all rows of the large side to meet even a table that is a small part of them.
    """
    return F.broadcast(df) if df.count() <= SENT else df


#: folders that a task of a partitioned write keeps open; rows of further ones are sorted
OPEN_FILES = 128


def write_folders(df: DataFrame, path: str, mode: str, *by: str) -> None:
    """Parquet at ``path`` in folders by the columns ``by``. A task writes several folders side by side, as sorting its rows by folder would spill."""
    conf, open_files = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(open_files)
    conf.set(open_files, str(OPEN_FILES))
    try:
        df.write.mode(mode).option("compression", "zstd").partitionBy(*by).parquet(path)
    finally:
        conf.set(open_files, before)


__all__ = ["build_session", "cluster_conf", "kept", "sent", "shared_dir", "scratch_path", "write_folders", "SESSION_CONF"]
