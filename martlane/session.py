"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every martlane job relies on: UTC wall clock, ANSI arithmetic
# (bad casts / x/0 raise unless guarded), adaptive execution with skew-join
# splitting and partition coalescing.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "martlane",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with martlane's settings.

    On a cluster leave ``master`` unset and let spark-submit decide; tests
    pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(
    input_bytes: int, target_partition_bytes: int = 512 << 20, max_shuffle_partitions: int | None = None
) -> dict[str, str]:
    """Settings sized from the input volume (for a cluster run).

    Shuffle partitions are set so the largest shuffle (about the input size)
    lands near ``target_partition_bytes`` per task (100 TB -> 200k partitions
    at the full-row shuffles).  ``max_shuffle_partitions``, if given, bounds
    the map x reduce blocks at the price of larger partitions.  AQE then
    coalesces the small shuffles of the aggregates and splits skewed join
    partitions.  Broadcast stays on Spark's measured-size threshold.
    """
    n = max(200, -(-int(input_bytes) // target_partition_bytes))
    if max_shuffle_partitions is not None:
        n = min(n, max_shuffle_partitions)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        # AQE may replace a sort-merge join by a shuffled hash join when every
        # measured build-side partition is below this size: no sort of the
        # big side (e.g. order lines joined to the returns flag).
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(target_partition_bytes),
    }


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files under ``paths``, from the file system's summary."""
    total = 0
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        total += p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    return total


def apply_scale(spark: SparkSession, *paths: str) -> None:
    """Size this session's shuffles and scans for the inputs at ``paths``."""
    for k, v in scale_conf(input_bytes(spark, *paths)).items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it).  Only in
    local mode, when it is unset (tests), a folder under the temp dir is set;
    on a cluster an unset folder is an error, never a machine-local path.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster[...] is a cluster
            raise RuntimeError("spark.checkpoint.dir is unset: name a shared folder (HDFS/S3/...) for the cluster")
        d = os.path.join(tempfile.gettempdir(), "martlane-checkpoints")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")
