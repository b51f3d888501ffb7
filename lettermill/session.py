"""Session settings for local runs, and the shared scratch folder.

On a cluster the caller owns the session; the library only reads from it,
and puts back the one limit that ``sources.mailbox.small_batches`` sets for a while.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lettermill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


@lru_cache(maxsize=1)
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="lettermill-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


@lru_cache(maxsize=8)
def _run_folder(root: str) -> str:
    """Folder of this run below ``root``; it goes when the program ends."""
    folder = f"{root.rstrip('/')}/lettermill/run-{uuid.uuid4().hex}"
    atexit.register(_drop, folder)
    return folder


def _drop(folder: str) -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path below the folder that the session names in spark.checkpoint.dir.

    All executors must see it. Only where the setting is absent and the master
    is local (single-machine tests) a temporary folder is made; on a cluster a
    missing setting is an error, because every machine would write to its own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _own_folder()
    return f"{_run_folder(root)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back.

    For results that several jobs read: computed once, and safe when executors go.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
