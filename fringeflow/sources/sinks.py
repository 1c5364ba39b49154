"""Sinks that keep a stack's invariants: phases written once, and manifests with signatures."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fringeflow.functions.phase import finite

KEY = ["point_id", "t"]


def write_phases(stage: DataFrame, path: str, stage_no: int, resume: bool = False) -> None:
    """Appends ``stage(point_id, t, phase)`` as one partition of a linked-phase table.

    Phases that are not finite, keys that repeat within the stage, and keys that an earlier stage wrote are
    errors. With ``resume`` the partition of a stage that was interrupted is replaced.
    """
    spark = stage.sparkSession
    bad = stage.agg(F.count_if(~finite(F.col("phase"))).alias("bad"), F.count("*").alias("n")).head()
    if bad["bad"]:
        raise ValueError(f"{bad['bad']} phases are not finite")
    if stage.groupBy(*KEY).agg(F.count("*").alias("n")).where("n > 1").head():
        raise ValueError("a point and epoch are written twice in this stage")
    known = _written(spark, path)
    if known is not None:
        if not resume and known.where(F.col("stage") == stage_no).head():
            raise ValueError(f"stage {stage_no} is written already")
        if known.where(F.col("stage") != stage_no).join(stage, KEY, "left_semi").head():
            raise ValueError("a point and epoch of this stage are written already")
    stage.select(*KEY, "phase").write.mode("overwrite").parquet(f"{path}/stage={stage_no}")


def _written(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def finite_counts(spark: SparkSession, path: str) -> DataFrame:
    """``t, n``: finite phases of each epoch in a linked-phase table."""
    return spark.read.parquet(path).groupBy("t").agg(F.count_if(finite(F.col("phase"))).alias("n"))


def signature(record: dict) -> str:
    """SHA-256 of the record as canonical JSON."""
    return hashlib.sha256(json.dumps(record, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def write_manifest(spark: SparkSession, path: str, stage: str, settings: dict, parent: str | None = None) -> str:
    """A one-row JSON table of a stage's settings and signature, chained to its parent's signature."""
    own = signature({"stage": stage, "settings": settings, "parent": parent})
    row = [(stage, json.dumps(settings, sort_keys=True, default=str), parent, own)]
    spark.createDataFrame(row, "stage string, settings string, parent string, signature string").coalesce(1).write.mode("overwrite").json(path)
    return own


def is_current(spark: SparkSession, path: str, stage: str, settings: dict, parent: str | None = None) -> bool:
    """Whether the manifest at ``path`` is of the same stage, settings and parent, so that its outputs can be used again."""
    try:
        held = spark.read.schema("stage string, settings string, parent string, signature string").json(path).head()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e):
            return False
        raise
    return held is not None and held["signature"] == signature({"stage": stage, "settings": settings, "parent": parent})
