"""Amplitude statistics per point and the selections made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fringeflow.functions.phase import nonzero_sample, rayleigh_scale2
from fringeflow.operators.quantiles import medians
from fringeflow.plans.lineage import settle

POINT = ["point_id", "r", "c"]


def amplitude_statistics(samples: DataFrame, epochs: int) -> DataFrame:
    """Moments of points with a usable sample in every epoch; populations, not samples, throughout."""
    ok = nonzero_sample(F.col("re"), F.col("im"))
    sums = samples.groupBy(*POINT).agg(F.count_if(ok).alias("n"), F.count("*").alias("seen"), F.avg("amp").alias("mean_amp"), F.var_pop("amp").alias("var_amp"), F.stddev_pop("amp").alias("std_amp"))
    full = sums.where((F.col("n") == epochs) & (F.col("seen") == epochs))
    full = full.withColumn("scale2", rayleigh_scale2(F.col("mean_amp"), F.col("var_amp"))).withColumn("adi", F.col("std_amp") / F.col("mean_amp"))
    return full.select(*POINT, "n", "mean_amp", "var_amp", "scale2", "adi")


def with_ps_flag(stats: DataFrame, adi_max: float) -> DataFrame:
    """``stats`` with ``ps``: a finite dispersion index up to the limit."""
    return stats.withColumn("ps", F.coalesce(F.col("adi") <= adi_max, F.lit(False)))


def ps_selection_fractional(samples: DataFrame, epochs: int, adi_max: float, fraction: float = 0.9) -> DataFrame:
    """Candidates among points that miss some epochs: a valid fraction, a positive mean and a low dispersion."""
    amp = F.when(nonzero_sample(F.col("re"), F.col("im")), F.col("amp"))
    sums = samples.groupBy(*POINT).agg((F.count(amp) / F.lit(epochs)).alias("valid_fraction"), F.avg(amp).alias("mean_amp"), F.stddev_pop(amp).alias("std_amp"))
    kept = sums.where((F.col("valid_fraction") >= fraction) & (F.col("mean_amp") > 0))
    return kept.withColumn("adi", F.col("std_amp") / F.col("mean_amp")).where(F.col("adi") <= adi_max).drop("std_amp")


def window_scan(samples: DataFrame, rows: tuple[int, int], cols: tuple[int, int], epochs: list[int]) -> DataFrame:
    """Samples of a raster window and some epochs, bounds included."""
    return samples.where(F.col("r").between(*rows) & F.col("c").between(*cols) & F.col("t").isin(epochs))


def acquisition_gain(samples: DataFrame) -> DataFrame:
    """Median over points of log amplitude less the point's own median, by epoch."""
    logs = settle(samples.where("amp > 0").select("point_id", "t", F.log("amp").alias("log_amp")), "log-amplitude")
    own = logs.groupBy("point_id").agg(F.median("log_amp").alias("own"))
    over = logs.join(own, "point_id").select("t", (F.col("log_amp") - F.col("own")).alias("over"))
    return medians(over, ["t"], "over", "gain_log").drop("n")


def two_way_threshold_counts(values: DataFrame, col: str, thresholds: list[float]) -> DataFrame:
    """How many rows reach each threshold, and how many do not; one pass."""
    sums = values.agg(*[F.count_if(F.col(col) >= v).alias(f"a{i}") for i, v in enumerate(thresholds)], F.count(col).alias("n"))
    rows = F.array(*[F.struct(F.lit(float(v)).alias("threshold"), F.col(f"a{i}").alias("direct"), (F.col("n") - F.col(f"a{i}")).alias("fallback")) for i, v in enumerate(thresholds)])
    return sums.select(F.inline(rows))


def point_numbers(points: DataFrame) -> DataFrame:
    """``points`` with ``point_no``, the rank in row-major order from 0, without a window over all points."""
    rows = points.groupBy("r").agg(F.count("*").alias("n"))
    heads = rows.withColumn("head", F.coalesce(F.sum("n").over(Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inner = points.withColumn("in_row", F.row_number().over(Window.partitionBy("r").orderBy("c")) - 1)
    return inner.join(heads, "r").withColumn("point_no", F.col("head") + F.col("in_row")).drop("head", "in_row")
