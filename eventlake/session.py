"""Session builder and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  ANSI stays on (Spark 4 default): raw input is
# only ever cast with try_* functions, so bad values become NULL instead of
# failing the job.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.jsonGenerator.ignoreNullFields": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(total_cores: int, daily_bytes: int) -> dict[str, str]:
    """Starting settings for a large cluster (hundreds of executors).

    Shuffle partitions start high enough that each holds ~128 MB of one day's
    data and AQE coalesces them at run time; skew-join splitting stays on; scan
    splits are 256 MB.  ``daily_bytes`` is the size of one day of silver.
    """
    target = 128 * 1024 * 1024
    parts = max(2 * total_cores, -(-daily_bytes // target))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
        "spark.sql.files.maxPartitionBytes": str(2 * target),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName("eventlake")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_job_conf(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Session-level settings that the transforms assume (safe to re-apply)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    spark.conf.set("spark.sql.jsonGenerator.ignoreNullFields", "true")
    broadcast_by_measure(spark)


#: A side of a join is broadcast by its measured bytes up to the threshold, and
#: by a guess of them only up to this part of it.
GUESSED_PART = 64


def broadcast_by_measure(spark: SparkSession) -> None:
    """Leave the choice of broadcasts to the sizes that adaptive execution measures.

    Before a job runs, Spark takes a text for 20 bytes, a line of JSON too: what is
    parsed out of lines is guessed up to a hundred and fifty times too small, and
    would be sent to the driver whole.
    """
    guessed, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    most = spark.conf.get(measured, None) or spark.conf.get(guessed)
    size = -1 if most.startswith("-") else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(most)
    spark.conf.set(measured, most)
    spark.conf.set(guessed, str(size // GUESSED_PART if size > 0 else -1))


def shared_root(spark: SparkSession) -> str:
    """Shared folder for tables and lineage cuts.

    On a cluster this is the folder named in ``spark.checkpoint.dir`` (or the
    one already set on the context).  Where neither is set, a local session
    gets a fresh scratch folder as its checkpoint dir; a cluster must name one,
    because its executors share no local folder.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="eventlake-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared root."""
    return f"{shared_root(spark)}/eventlake/{name}-{uuid.uuid4().hex[:12]}"
