"""Tables written once and read back, so that later steps agree on their rows.

A staged table lives in the folder that ``spark.checkpoint.dir`` names, which every
executor shares. Losing an executor therefore loses nothing that was staged.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """Folder of this application's staged tables."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="starmill-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/starmill-{context.applicationId}"


def new_folder(spark: SparkSession) -> str:
    """A folder of its own for what one user of staged tables writes."""
    return f"{staging_root(spark)}/{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` below ``folder`` (default: the application's) and return the written table."""
    spark = df.sparkSession
    path = f"{folder or staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_staged(spark: SparkSession, folder: str | None = None) -> None:
    """Delete staged tables: those of ``folder``, or all of this application.

    Frames built on them become unreadable.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder or staging_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
