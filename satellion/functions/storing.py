"""Tables in the shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; a temporary one only where that is unset and all runs on one machine (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="satellion-")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def store(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it back, so lost executors cost no recomputation."""
    path = shared_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes the table of a frame that `store` gave; nothing may read it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
