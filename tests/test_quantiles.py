"""Exact quantiles by counting, against the built-in aggregate and numpy."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from fringeflow.operators import quantiles

SHARES = [0.0, 0.01, 0.25, 0.5, 0.9, 0.95, 1.0]


def _awkward(spark):
    rng = random.Random(3)
    rows = []
    for group in "abcd":
        for _ in range(rng.randint(1, 500)):
            x = rng.choice([rng.gauss(0, 1), 5.0, 5.0, rng.gauss(0, 1) * 10 ** rng.randint(-200, 200), 0.0, -0.0, None, float("inf"), -float("inf"), float(rng.randint(-3, 3))])
            rows.append((group, x))
    rows += [("e", 7.0)] * 50 + [("f", None)] * 3 + [(None, 1.0), ("g", float("nan")), ("g", 1.0), ("h", 2.5)]
    return spark.createDataFrame(rows, "group string, v double")


def test_equal_to_percentile_on_awkward_values(spark):
    df = _awkward(spark)
    want = {r["group"]: r["p"] for r in df.where("group IS NOT NULL AND v IS NOT NULL").groupBy("group").agg(F.percentile("v", F.array(*[F.lit(q) for q in SHARES])).alias("p")).collect()}
    for keep in (7, quantiles.KEEP):
        got = {r["group"]: r["p"] for r in quantiles.quantiles(df, ["group"], "v", SHARES, keep).collect()}
        assert got.keys() == want.keys()
        for key, values in want.items():
            assert all(a == b or math.isclose(a, b, rel_tol=1e-12) or (a != a and b != b) for a, b in zip(got[key], values)), key


def test_many_groups_are_joined_instead_of_broadcast(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "MOST_BROADCAST", 3)
    df = spark.range(6000).select((F.col("id") % 20).alias("k"), F.sin(F.col("id").cast("double")).alias("v"))
    got = {r["k"]: r["m"] for r in quantiles.medians(df, ["k"], "v", "m", 40).collect()}
    for k in range(20):
        assert math.isclose(got[k], np.median(np.sin(np.arange(k, 6000, 20, dtype=float))), rel_tol=1e-12)


def test_one_group_of_ten_million_values_runs_in_several_tasks(spark):
    n = 10_000_000
    df = spark.range(0, n, 1, 8).select(F.lit(1).alias("k"), F.sin(F.col("id").cast("double")).alias("v"))
    spark.sparkContext.setJobGroup("quantiles", "quantiles")
    got = quantiles.quantiles(df, ["k"], "v", [0.1, 0.5, 0.9]).head()
    want = np.quantile(np.sin(np.arange(n, dtype=float)), [0.1, 0.5, 0.9])
    assert got["n"] == n and np.allclose(got["p"], want, rtol=0, atol=1e-9)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("quantiles") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) >= 4


def test_no_rows_and_no_keys(spark):
    df = spark.createDataFrame([(1.0,), (4.0,), (None,)], "v double")
    assert quantiles.quantiles(df.where("false"), [], "v", [0.5]).collect() == []
    row = quantiles.medians(df, [], "v", "m").head()
    assert (row["n"], row["m"]) == (2, 2.5)
