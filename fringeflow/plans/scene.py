"""The scene that the supplied tables stand in for.

A part is a point on a grid ``WIDTH`` wide, a ship year is an epoch, the quantity
shipped is the amplitude and its remainder modulo ``TURN`` is the phase. ``TURN`` is odd,
so no phase difference falls on a half turn, where engines may differ.
A real stack only has to supply the same columns.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH = 50
EPOCHS = 7
FIRST_YEAR = 1995
TURN = 49
AZIMUTH_M, RANGE_M = 2.0, 1.5
HALF_ROWS, HALF_COLS = 2, 2
ALPHA = 0.2
FORMAL_K, STATE_K = 16, 8
ADI_MAX = 0.25
POINT_ADI = 0.38
MOST_DAYS, MOST_METRES = 72, 200.0
# The second scene has the window, the epochs and the limits of production.
WIDE_WIDTH, WIDE_DAYS, WIDE_EPOCHS = 10, 66, 38
WIDE_ROWS, WIDE_COLS, WIDE_ALPHA = 5, 11, 0.005
WIDE_K = 48


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``point_id, r, c, t, amp, phase, re, im``: one row a point and epoch that has a sample."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_partkey").alias("point_id"), (F.year("l_shipdate") - FIRST_YEAR).alias("t"), "l_quantity")
    sums = lines.groupBy("point_id", "t").agg(F.sum("l_quantity").alias("amp"))
    phase = F.pmod(F.col("amp"), F.lit(float(TURN))) * F.lit(2 * math.pi / TURN)
    out = sums.withColumn("r", F.expr(f"CAST(point_id div {WIDTH} AS INT)")).withColumn("c", F.expr(f"CAST(point_id % {WIDTH} AS INT)"))
    out = out.withColumn("phase", phase)
    return out.withColumn("re", F.col("amp") * F.cos("phase")).withColumn("im", F.col("amp") * F.sin("phase"))


def wide_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``samples`` of a second scene in the shape of production: a supplier is a point, 66 days an epoch, 38 epochs in all."""
    t = F.expr(f"datediff(l_shipdate, DATE '{FIRST_YEAR}-01-01') div {WIDE_DAYS}").cast("int")
    sums = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_suppkey").alias("point_id"), t.alias("t"), "l_quantity").groupBy("point_id", "t").agg(F.sum("l_quantity").alias("amp"))
    phase = F.pmod(F.col("amp"), F.lit(float(TURN))) * F.lit(2 * math.pi / TURN)
    out = sums.withColumn("r", F.expr(f"CAST(point_id div {WIDE_WIDTH} AS INT)")).withColumn("c", F.expr(f"CAST(point_id % {WIDE_WIDTH} AS INT)")).withColumn("phase", phase)
    return out.withColumn("re", F.col("amp") * F.cos("phase")).withColumn("im", F.col("amp") * F.sin("phase"))


def heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``point_id, height``: a stand-in in which a part of size one has no height."""
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("point_id"), (F.col("p_size") - 1).cast("double").alias("height"))


def acquisitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``idx, day, bperp``: order months in time with a pseudo-baseline."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    months = orders.groupBy(F.trunc("o_orderdate", "month").alias("day")).agg((F.avg("o_totalprice") / 100).alias("bperp"))
    first = F.to_date(F.lit(f"{FIRST_YEAR}-01-01"))
    return months.withColumn("idx", F.months_between("day", first).cast("int")).select("idx", "day", "bperp")
