"""Two-sample distances of amplitude histories, in array expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fringeflow.operators.support import half_window, neighbour_pairs


def ks_gap(a: Column, b: Column, n: int) -> Column:
    """Largest difference in count, of n, as two sorted histories are merged; equal values move both on."""
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("gap"))

    def step(s: Column, _: Column) -> Column:
        live = (s["i"] < n) & (s["j"] < n)
        x, y = F.get(a, s["i"]), F.get(b, s["j"])
        i = s["i"] + F.when(live & (x <= y), 1).otherwise(0)
        j = s["j"] + F.when(live & (x >= y), 1).otherwise(0)
        return F.struct(i.alias("i"), j.alias("j"), F.greatest(s["gap"], F.abs(j - i)).alias("gap"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(2 * n)), start, step, lambda s: s["gap"])


def ks_probability(distance: float, n: int, terms: int = 100) -> float:
    """Alternating series of the asymptotic distribution at the corrected distance."""
    root = math.sqrt(n / 2)
    x = distance * (root + 0.12 + 0.11 / root)
    return sum((2.0 if k % 2 else -2.0) * math.exp(-2.0 * x * x * k * k) for k in range(1, terms + 1))


def ks_probabilities(gap: Column, n: int) -> Column:
    """The probability of a gap; there are only n + 1, so they are a table of literals."""
    return F.element_at(F.array(*[F.lit(ks_probability(k / n, n)) for k in range(n + 1)]), gap + 1)


def prior_counts(samples: DataFrame, epochs: int, half_rows: int, half_cols: int, p_max: float = 0.05) -> DataFrame:
    """``point_id, selected, available``: neighbours whose probability falls below the limit, the point itself included.

    The sense of the test (a small probability selects) is that of the prior it reproduces.
    """
    rows = samples.groupBy("point_id", "r", "c").agg(F.array_sort(F.collect_list(F.col("amp").cast("float"))).alias("h")).where(F.size("h") == epochs)
    met = neighbour_pairs(rows, half_window(half_rows, half_cols), ["point_id", "h"])
    hit = (ks_probabilities(ks_gap(F.col("a_h"), F.col("b_h"), epochs), epochs) < p_max).alias("hit")
    told = met.select(hit, F.explode(F.array("a_point_id", "b_point_id")).alias("point_id")).select("point_id", "hit")
    own = rows.select("point_id", F.lit(ks_probability(0.0, epochs) < p_max).alias("hit"))
    return told.union(own).groupBy("point_id").agg(F.count_if("hit").alias("selected"), F.count("*").alias("available"))
