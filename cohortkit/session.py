"""Session defaults, scratch space and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A summary is broadcast only if its written files hold at most this many bytes, and its rows, which
# files may hold in far less space, at most so many times that in memory.
BROADCAST_BYTES = 4 << 20
_UNPACKED = 8


def build_session(app: str = "cohortkit", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution, skew-join handling and UTC time.

    Values for the cluster (memory, shuffle partitions) come from spark-submit;
    anything given in ``conf`` wins over the defaults here.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    without that setting falls back to a temporary folder.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not (spark.conf.get("spark.master", None) or "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="cohortkit-", dir="/tmp")
    return _local_root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under this application's part of the scratch folder."""
    return f"{_own_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def _own_scratch(spark: SparkSession) -> str:
    app = spark.conf.get("spark.app.id", None) or "session"
    return f"{scratch_root(spark).rstrip('/')}/cohortkit-{app}"


def release_scratch(spark: SparkSession) -> bool:
    """Delete what this application left in the scratch folder; call it when its results are written."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_own_scratch(spark))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Used where several actions need the same result; unlike a cache it outlives
    lost executors.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Write a summary once; broadcast it if its files are small, else join it like any table.

    Either way the written rows are used, so nothing is computed twice and the
    choice changes the plan only, never the result. What is too large is joined by merging, as
    Spark's own limit goes by the size of the files too.
    """
    written = materialise(df, "summary")
    return F.broadcast(written) if is_small(written, max_bytes) else written.hint("merge")


def is_small(written: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a written table is small enough to be broadcast, by its files and by its rows."""
    size = int(str(written._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= max_bytes and written.count() * written._jdf.schema().defaultSize() <= _UNPACKED * max_bytes
