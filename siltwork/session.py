"""Session helpers: the shared folder, written intermediates, size estimates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a single-machine session without that setting gets a temporary folder
    of its own; on a cluster the missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="siltwork-")
    return _own_folders[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one written intermediate, grouped per application."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/siltwork-{app}/{label}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder, once nothing reads it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/siltwork-{spark.sparkContext.applicationId}"
    )
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def write_out(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written.

    The scan has no lineage to recompute after an executor is lost, and its file
    sizes tell the planner whether it may be broadcast.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``, the one it uses to choose joins."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def loading_session(spark: SparkSession) -> SparkSession:
    """A session of its own for one load, with the same catalog and settings but two.

    Reads are cut into larger splits than for queries, so that each task writes a file
    worth reading; Spark still cuts a small input into one split per core. Tasks keep
    files of good and of rejected rows open side by side instead of sorting by the flag.
    Queries that run at the same time in ``spark`` keep their settings.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", "512m")
    own.conf.set("spark.sql.maxConcurrentOutputFileWriters", "2")
    return own


def broadcast_limit(spark: SparkSession) -> int:
    """Size up to which Spark broadcasts a join side by itself; negative when never."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
