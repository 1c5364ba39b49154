"""Windowed aggregates of an event stream; an extension beyond the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fringeflow.plans.lineage import shared_path


def read_events(spark: SparkSession, folder: str, files: str = "events.parquet") -> DataFrame:
    """A stream over the event files of a folder."""
    schema = spark.read.parquet(f"{folder}/{files}").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", files).option("maxFilesPerTrigger", 100).parquet(folder)


def window_sums(events: DataFrame, width: str, late: str) -> DataFrame:
    """``window_start, event_type, n, total`` over tumbling windows.

    In update mode windows that the watermark has passed are closed: their state goes, and later events are left out.
    """
    timed = events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value").withWatermark("ts", late)
    sums = timed.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return sums.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def run_available(stream: DataFrame, label: str, keys: tuple[str, ...] = ("window_start", "event_type")) -> DataFrame:
    """The last state of each key of a stream's aggregate once all present input is read.

    Batches tell only what changed. Each replaces the folder of its number, so a batch that is run again after a failure
    leaves one result; of each key the row of the latest batch counts.
    """
    spark = stream.sparkSession
    path = shared_path(spark, label)
    told: list[int] = []

    def put(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/out/batch={number}")
        told.append(number)

    query = stream.writeStream.outputMode("update").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(put).start()
    query.awaitTermination()
    if not told:
        return spark.createDataFrame([], stream.schema)
    rows = spark.read.parquet(f"{path}/out")
    rest = [c for c in stream.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"last.{c}") for c in stream.columns])
