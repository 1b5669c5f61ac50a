"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
INITIAL_CONF = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISORY_CONF = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# Compressed shuffle bytes of one task; narrow rows take some thirty times as much in a sort or a hash map.
TASK_BYTES = 16 * 2**20
INPUT_BYTES = 4 * 2**20


def build_session(app: str = "trackmetrics", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; sizes stay with the cluster's own defaults."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Event dates are defined in UTC, whatever the session was started with."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def size_shuffles(spark: SparkSession, folder: str) -> None:
    """Let shuffles begin with a number of partitions that follows the bytes of the input folder, and join them to at most ``TASK_BYTES`` each.

    A task then holds the same share of a sort or an aggregate however large the input is; a session with smaller tasks keeps them.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    size = system.getContentSummary(place).getLength() if system.exists(place) else 0
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // INPUT_BYTES))
    spark.conf.set(INITIAL_CONF, str(width))
    if _bytes(spark, spark.conf.get(ADVISORY_CONF)) > TASK_BYTES:
        spark.conf.set(ADVISORY_CONF, str(TASK_BYTES))


def shuffle_width(spark: SparkSession) -> int:
    """The number of partitions that shuffles begin with."""
    return int(spark.conf.get(INITIAL_CONF, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def _bytes(spark: SparkSession, text: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors would each write to their own disk.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="trackmetrics-")
        spark.conf.set(CHECKPOINT_CONF, root)
    return f"{root.rstrip('/')}/trackmetrics/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
