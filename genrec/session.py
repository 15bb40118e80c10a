"""Session helpers: a local session for tests/bench, and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "genrec") -> SparkSession:
    """A local session configured the way the tests and the bench expect.

    AQE stays on: it turns shuffle joins into broadcast joins only when the
    measured side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
    Lookups on keys that may be hot are salted (``operators/skew``).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable and return the folder.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that
    setting is always used when present.  Only a local-mode session without
    it (a test) gets a fresh folder of its own; a cluster session without it
    is an error, because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        folder = tempfile.mkdtemp(prefix="genrec-ckpt-")
    sc.setCheckpointDir(folder)
    return folder


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing path below the checkpoint folder (a unique
    name per call), for tables that queries write and read back."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """``(file system, path)`` in the JVM; ``None`` for a Connect session, which has no way there."""
    if not hasattr(spark, "_jvm"):
        return None
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job of this package wrote, on whatever file system it is.  A Connect session
    overwrites it with an empty table, which frees its files."""
    at = _file_system(spark, path)
    if at is not None:
        at[0].delete(at[1], True)
    else:
        spark.createDataFrame([], "nothing int").write.mode("overwrite").parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system it is."""
    at = _file_system(spark, path)
    if at is not None:
        return at[0].exists(at[1])
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).schema  # noqa: B018
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def stored(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` below the checkpoint folder and read it back (one job): later plans
    start from the table, and a lost executor recomputes nothing before it.  ``rows_per_file``
    (0: any number) is for rows of megabytes, since a file's rows may be read at once."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
