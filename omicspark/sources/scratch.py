"""Tables written to the folder that driver and executors share, and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, deleted when the driver's JVM ends.

    Where none is set, a local session gets a temporary one; a cluster must set it, as its executors do not see such a folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/omics-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read again, so what follows starts from files and computes nothing before them twice."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
