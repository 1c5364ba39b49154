"""Cut lineage through the folder that the driver and all executors share.

``spark.checkpoint.dir`` names that folder on a cluster; without it a cluster session is refused. Only on
a local master, as in tests, a temporary folder takes its place.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session; on a local master set to a fresh one if there is none."""
    found = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_KEY} to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set(_KEY, found)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """``df`` computed once and read back from Parquet in the shared folder.

    An executor that is lost later costs a reread of a file, not a recomputation.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
