"""Session set-up and lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "nightledger", cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; on a cluster the caller brings their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", own_folder())
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def own_folder() -> str:
    """A checkpoint folder for one local session, removed with the process."""
    folder = tempfile.mkdtemp(prefix="nightledger-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{folder}"


def cluster_settings(shuffled_bytes: int, partition_bytes: int = 192 * 1024**2) -> dict[str, str]:
    """Session settings for a run that shuffles about this much.

    Adaptive execution only merges shuffle partitions, so their number has to start
    high enough for one to fit in memory.
    """
    partitions = max(200, -(-shuffled_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024**2),
        "spark.sql.session.timeZone": "UTC",
    }


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the folder that the session names in ``spark.checkpoint.dir`` and read it back.

    All executors have to share that folder. Spark removes the files of frames that are no longer used
    where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    _shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the same folder and read it back.

    Unlike a checkpoint the result has a size that Spark knows and no partitioning, so a join on it adds an exchange, which
    adaptive execution can split.
    """
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession) -> str:
    """A path not yet used in the folder that the session names in ``spark.checkpoint.dir``."""
    return f"{_shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"


def _shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = own_folder()
            spark.conf.set("spark.checkpoint.dir", folder)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()
