"""Session helpers: a local session for tests, and tables in the shared folder that cut lineages."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, partitions: int = 8) -> SparkSession:
    """A ``local[cores]`` session with the settings the library is written for."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("folioframe")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_made: dict[str, list[str]] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder checkpoints go to.

    It is the one the session names in ``spark.checkpoint.dir``. Only where that is unset and all tasks run in this process, as in tests,
    is a temporary folder chosen; on several machines that would lose rows, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="folioframe-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and scanned again, so that later readers prune columns and a lost executor
    costs one task. The table stays until ``drop_stored`` or the end of the folder."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession) -> int:
    """Removes the tables that ``stored`` has written for this application, and tells how many; results that were not written yet can't be read after it."""
    paths = _made.pop(spark.sparkContext.applicationId, [])
    jvm = spark.sparkContext._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)
