"""Session helpers: shared work folder, lineage cuts, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest estimated side, in bytes, that is broadcast. Beyond it the join is
# left to Catalyst, which shuffles (and lets AQE split skewed partitions). The
# estimate of a stored table is the size of its packed files, many times less
# than its rows take on their way through the driver.
BROADCAST_LIMIT = 8 * 1024 * 1024

# Rows that one task takes where it may hold an entry for each of them.
TASK_ROWS = 500_000


def local_session(cores: str = "8", app: str = "locusframe") -> SparkSession:
    """A local session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def is_local(master: str) -> bool:
    """True if driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only in local mode, when
    neither that setting nor a checkpoint folder exists (tests), is one created
    here: on a cluster each machine would write to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if named:
        if current is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if current is None:
        if not is_local(spark.sparkContext.master):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="locusframe-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared work folder."""
    return f"{work_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage, survives executor loss, and gives Catalyst the true
    size of the table for its join choices.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` stored, once nothing reads them."""
    for stored in tables:
        path = getattr(stored, "stored_at", None)
        if path is not None:
            spark = stored.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` in bytes."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def spread(df: DataFrame, *keys: str, width: int = 1, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df`` dealt to tasks (by ``keys``, if given) of about ``task_rows`` rows
    once each row has become ``width`` rows. A small file is read by one task,
    whatever its rows grow into, and the number of shuffle partitions does not
    follow the input."""
    return df.repartition(tasks_for(df.sparkSession, df.count() * width, task_rows), *keys)


def tasks_for(spark: SparkSession, rows: int, task_rows: int = TASK_ROWS) -> int:
    """Number of tasks of about ``task_rows`` rows, at least one per core."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // task_rows))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only when the estimated size is within ``limit``."""
    return F.broadcast(df) if plan_bytes(df) <= limit else df


def small_side(df: DataFrame, label: str) -> DataFrame:
    """An aggregate to be joined back to the rows it came from: stored first,
    so that its true size, not that of its input, decides on a broadcast."""
    return broadcast_if_small(materialize(df, label))
