"""Exact quantiles of groups of any size, by counting.

A quantile of a group is one or two of its values in order, so what is wanted are ranks. All values of a group are
one range at first; a range that holds more than ``KEEP`` rows is cut into cells, the rows of each are counted with
map-side combine, and only the cells that hold a wanted rank stay, with their rows. The first cut goes by sign and power of
two, so that a few huge values don't spoil the later even cuts. Ranges of equal values are done. What is left
are ranges of at most ``KEEP`` rows, which are sorted. So no task sees a group, however few groups there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fringeflow.plans.lineage import settle

KEEP = 1 << 16
CELLS = 1024
MOST_BROADCAST = 10_000
_INF = float("inf")


def _power(x: Column) -> Column:
    """A cell that grows with x: sign and power of two; zero, infinities and NaN have cells of their own."""
    size = F.floor(F.log2(F.abs(x))).cast("int") + 1100
    return F.when(F.isnan(x), 3000).when(x == _INF, 2500).when(x == -_INF, -2500).when(x == 0, 0).when(x > 0, size).otherwise(-size)


def _even(x: Column) -> Column:
    """One of ``CELLS`` even parts of the range [lo, hi]."""
    return F.least(F.floor((x - F.col("lo")) / (F.col("hi") - F.col("lo")) * CELLS), F.lit(CELLS - 1)).cast("int")


def _beside(rows: DataFrame, ranges: DataFrame, keys: list[str], count: int) -> DataFrame:
    """``rows`` with the range they fall into; ranges are broadcast up to ``MOST_BROADCAST``, beyond that joined and split where skewed."""
    table = ranges.select(*keys, "lo", "hi", "base", "goals")
    return rows.join(F.broadcast(table) if count <= MOST_BROADCAST else table, keys).where(F.col("x").between(F.col("lo"), F.col("hi")))


def order_statistics(rows: DataFrame, wanted: DataFrame, keys: list[str], keep: int = KEEP) -> DataFrame:
    """``keys, goal, value``: the value at each 0-based rank of ``goals``.

    ``rows`` has the keys and x, without nulls; ``wanted`` has the keys, n, lo, hi and goals, a row a group.
    """
    done = None
    ranges = wanted.withColumn("base", F.lit(0).cast("long"))
    cell = _power
    while True:
        ranges = settle(ranges, "rank-range")
        equal = (F.col("lo") == F.col("hi")) | F.isnan("lo")
        same = ranges.where(equal).select(*keys, F.explode("goals").alias("goal"), F.col("lo").alias("value"))
        done = same if done is None else done.unionByName(same)
        ranges = ranges.where(~equal)
        count, largest = ranges.agg(F.count("*"), F.max("n")).head()
        if not count:
            return done
        met = _beside(rows, ranges, keys, count)
        if largest <= keep:
            break
        counts = met.groupBy(*keys, "lo", "base", "goals", cell(F.col("x")).alias("cell")).agg(F.count("*").alias("n"), F.min("x").alias("least"), F.max("x").alias("most"))
        before = Window.partitionBy(*keys, "lo").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # at most a range's cells
        placed = counts.withColumn("base", F.col("base") + F.coalesce(F.sum("n").over(before), F.lit(0)))
        inside = F.filter("goals", lambda g: (g >= F.col("base")) & (g < F.col("base") + F.col("n")))
        ranges = settle(placed.select(*keys, "n", F.col("least").alias("lo"), F.col("most").alias("hi"), "base", inside.alias("goals")).where(F.size("goals") > 0), "rank-range")
        rows = settle(_beside(rows, ranges, keys, ranges.count()).select(*keys, "x"), "rank-row")
        cell = _even
    rank = F.col("base") + F.row_number().over(Window.partitionBy(*keys, "lo").orderBy("x")) - 1
    sorted_ = met.select(*keys, "x", "goals", rank.alias("goal")).where(F.array_contains("goals", F.col("goal")))
    return done.unionByName(sorted_.select(*keys, "goal", F.col("x").alias("value")))


def quantiles(values: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float], keep: int = KEEP) -> DataFrame:
    """``keys, n, p``: how many values each group has and their quantiles, with linear interpolation as ``percentile`` has it.

    Nulls are left out, as values and as keys; NaN is larger than all. Without keys there is one group, and no row for an empty table.
    """
    own = [f"k{i}" for i in range(max(1, len(keys)))]
    named = [F.col(k).alias(o) for k, o in zip(keys, own)] or [F.lit(0).alias("k0")]
    full = F.col(value).isNotNull()
    for k in keys:
        full = full & F.col(k).isNotNull()
    rows = settle(values.where(full).select(*named, F.col(value).cast("double").alias("x")), "quantile-row")
    at = F.array(*[F.lit(float(q)) for q in shares])
    goals = F.array_distinct(F.flatten(F.transform(at, lambda q: F.array(F.floor(q * (F.col("n") - 1)), F.ceil(q * (F.col("n") - 1))))))
    sums = rows.groupBy(*own).agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    wanted = settle(sums.withColumn("goals", goals), "quantile-group")
    found = order_statistics(rows, wanted, own, keep).groupBy(*own).agg(F.map_from_entries(F.collect_list(F.struct("goal", "value"))).alias("v"))
    place = lambda q: q * (F.col("n") - 1)
    pick = lambda g: F.element_at("v", g)
    mixed = lambda q: F.when(F.floor(place(q)) == F.ceil(place(q)), pick(F.floor(place(q)))).otherwise((F.ceil(place(q)) - place(q)) * pick(F.floor(place(q))) + (place(q) - F.floor(place(q))) * pick(F.ceil(place(q))))
    p = F.transform(at, mixed)
    back = [F.col(o).alias(k) for k, o in zip(keys, own)]
    return wanted.select(*own, "n").join(found, own).select(*back, "n", p.alias("p"))


def medians(values: DataFrame, keys: Sequence[str], value: str, name: str, keep: int = KEEP) -> DataFrame:
    """``keys, n, name``: the median of each group."""
    return quantiles(values, keys, value, [0.5], keep).withColumn(name, F.col("p")[0]).drop("p")
