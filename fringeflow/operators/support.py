"""Statistically homogeneous neighbours on the grid, and the states that follow from their number.

Neighbours are found by an equi-join. For small windows half of the offsets are moved onto the rows and
joined on the cell; for larger ones the grid is cut into blocks of half a window, and a row is sent to its own block
and the five blocks that its later neighbours may lie in, whatever the number of offsets. The
statistic is symmetric, so each pair is tested once and then told to both ends.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fringeflow.functions.phase import glrt_statistic, glrt_threshold
from fringeflow.plans.lineage import settle


MOST_MOVED = 24


def half_window(half_rows: int, half_cols: int) -> list[tuple[int, int]]:
    """Offsets of a window that come after its centre in row-major order."""
    return [(dr, dc) for dr in range(half_rows + 1) for dc in range(-half_cols, half_cols + 1) if (dr, dc) > (0, 0)]


def neighbour_pairs(points: DataFrame, offsets: list[tuple[int, int]], columns: list[str]) -> DataFrame:
    """Pairs of points that lie an offset apart: ``a_*``, ``b_*``, ``dr``, ``dc``."""
    rows, cols = max(dr for dr, _ in offsets), max(abs(dc) for _, dc in offsets)
    if len(offsets) > MOST_MOVED and set(offsets) == set(half_window(rows, cols)):
        return _block_pairs(points, rows, cols, columns)
    moves = F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for dr, dc in offsets])
    a = points.select(*[F.col(c).alias(f"a_{c}") for c in columns], F.col("r").alias("ar"), F.col("c").alias("ac"), F.inline(moves))
    a = a.withColumn("r", F.col("ar") + F.col("dr")).withColumn("c", F.col("ac") + F.col("dc")).drop("ar", "ac")
    b = points.select("r", "c", *[F.col(c).alias(f"b_{c}") for c in columns])
    return a.join(b, ["r", "c"]).drop("r", "c")


def _block_pairs(points: DataFrame, half_rows: int, half_cols: int, columns: list[str]) -> DataFrame:
    """``neighbour_pairs`` of a whole half window over blocks of ``half_rows x half_cols`` cells."""
    high, wide = max(half_rows, 1), max(half_cols, 1)
    near = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (-1, 0, 1)])
    block = lambda of, n: F.floor(F.col(of) / F.lit(n)).cast("int")
    a = points.select(*[F.col(c).alias(f"a_{c}") for c in columns], F.col("r").alias("ar"), F.col("c").alias("ac"), F.inline(near))
    a = a.withColumn("br", block("ar", high) + F.col("i")).withColumn("bc", block("ac", wide) + F.col("j")).drop("i", "j")
    b = points.select(F.col("r").alias("cr"), F.col("c").alias("cc"), *[F.col(c).alias(f"b_{c}") for c in columns], block("r", high).alias("br"), block("c", wide).alias("bc"))
    dr, dc = F.col("cr") - F.col("ar"), F.col("cc") - F.col("ac")
    after = (dr.between(1, half_rows) & dc.between(-half_cols, half_cols)) | ((dr == 0) & dc.between(1, half_cols))
    met = a.join(b, ["br", "bc"]).where(after)
    return met.select(*[f"a_{c}" for c in columns], *[f"b_{c}" for c in columns], dr.alias("dr"), dc.alias("dc"))


def glrt_support(stats: DataFrame, epochs: int, half_rows: int, half_cols: int, alpha: float) -> DataFrame:
    """``center_id, neighbor_id, bit, stat``: neighbours whose statistic stays strictly below the threshold.

    ``stats`` has ``point_id, r, c, scale2, ps``. Points with a flag are no neighbours and no centres;
    a point is never its own neighbour; ``bit`` numbers the window's cells in row-major order.
    """
    usable = stats.where("NOT ps AND scale2 > 0")
    met = neighbour_pairs(usable, half_window(half_rows, half_cols), ["point_id", "scale2"])
    stat = glrt_statistic(epochs, F.col("a_scale2"), F.col("b_scale2"))
    near = met.withColumn("stat", stat).where(F.col("stat") < glrt_threshold(alpha))
    middle = half_rows * (2 * half_cols + 1) + half_cols
    shift = F.col("dr") * (2 * half_cols + 1) + F.col("dc")
    both = F.array(
        F.struct(F.col("a_point_id").alias("center_id"), F.col("b_point_id").alias("neighbor_id"), (F.lit(middle) + shift).alias("bit")),
        F.struct(F.col("b_point_id").alias("center_id"), F.col("a_point_id").alias("neighbor_id"), (F.lit(middle) - shift).alias("bit")),
    )
    return near.select("stat", F.inline(both)).select("center_id", "neighbor_id", "bit", "stat")


def shp_count(stats: DataFrame, support: DataFrame) -> DataFrame:
    """``center_id, k`` for every usable centre, those without neighbours too."""
    counts = support.groupBy("center_id").agg(F.count("*").alias("k"))
    centres = stats.where("NOT ps").select(F.col("point_id").alias("center_id"))
    return centres.join(counts, "center_id", "left").select("center_id", F.coalesce("k", F.lit(0)).alias("k"))


def support_bits(support: DataFrame, cells: int = 64) -> DataFrame:
    """``center_id, word_0 .. , k``: the window as a bit set, 64 cells a word; a bit past ``cells`` is an error."""
    words = -(-cells // 64)
    bit = F.when(F.col("bit") < cells, F.col("bit")).otherwise(F.raise_error(F.format_string("bit %d is past the window", "bit")).cast("int"))
    place = support.select("center_id", bit.alias("bit")).withColumn("set", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit") % 64))
    one = lambda w: F.coalesce(F.bit_or(F.when(F.expr("bit div 64") == w, F.col("set"))), F.lit(0).cast("long"))
    out = place.groupBy("center_id").agg(*[one(w).alias(f"word_{w}") for w in range(words)])
    return out.withColumn("k", sum((F.bit_count(f"word_{w}") for w in range(words)), F.lit(0)).cast("long"))


def unpack_bits(words: DataFrame, cells: int) -> DataFrame:
    """``center_id, bit`` for each cell that is set."""
    held = F.array(*[f"word_{w}" for w in range(-(-cells // 64))])
    bits = F.filter(F.sequence(F.lit(0), F.lit(cells - 1)), lambda b: F.call_function("shiftright", F.get(held, F.floor(b / 64).cast("int")), b % 64).bitwiseAND(F.lit(1)) == 1)
    return words.select("center_id", F.explode(bits).alias("bit"))


def effective_counts(support: DataFrame, state: DataFrame) -> DataFrame:
    """``center_id, effective_k``: neighbours that are in ``state(point_id)``."""
    held = state.select(F.col("point_id").alias("neighbor_id"))
    return support.join(held, "neighbor_id", "left_semi").groupBy("center_id").agg(F.count("*").alias("effective_k"))


def state_core(support: DataFrame, counts: DataFrame, threshold: int, max_rounds: int = 100) -> DataFrame:
    """``point_id, effective_k`` of the largest state in which every point has enough neighbours of the state.

    All points that fall short leave at once, again and again until none does. Each round's state is cut off
    through the shared folder, and its edges are those of the beginning between points of the state, so no round's
    plan holds the rounds before.
    """
    edges = settle(support.select("center_id", "neighbor_id"), "core-edges")
    state = settle(counts.where(F.col("k") >= threshold).select(F.col("center_id").alias("point_id"), F.col("k").alias("effective_k")), "core")
    size = state.count()
    for _ in range(max_rounds):
        ids = state.select(F.col("point_id").alias("center_id"))
        kept = effective_counts(edges.join(ids, "center_id", "left_semi"), state).where(F.col("effective_k") >= threshold).withColumnRenamed("center_id", "point_id")
        state = settle(kept, "core")
        now = state.count()
        if now == size:
            return state
        size = now
    raise RuntimeError(f"the state did not settle in {max_rounds} rounds")


def _settled_cores(rows: pd.DataFrame) -> pd.DataFrame:
    """Core numbers of a tile's centres while those of all other points stay as they are."""
    centres, at = np.unique(rows["center_id"].to_numpy(), return_inverse=True)
    near, value = rows["neighbor_id"].to_numpy(), rows["core"].to_numpy(np.int64).copy()
    own = np.minimum(np.searchsorted(centres, near), len(centres) - 1)
    inside = centres[own] == near
    core = np.zeros(len(centres), np.int64)
    core[at] = rows["own"].to_numpy(np.int64)
    first = np.searchsorted(np.sort(at), np.arange(len(centres)))
    while True:
        value[inside] = core[own[inside]]
        order = np.lexsort((-value, at))
        found = np.zeros(len(centres), np.int64)
        np.maximum.at(found, at[order], np.minimum(value[order], np.arange(len(order)) - first[at[order]] + 1))
        found = np.minimum(found, core)
        if (found == core).all():
            return pd.DataFrame({"point_id": centres, "now": core})
        core = found


def core_numbers(support: DataFrame, counts: DataFrame, tiles: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """``point_id, core``: the largest threshold at which ``state_core`` holds the point, for every point of ``counts``.

    A point's number starts as its count of neighbours and becomes, again and again, the largest h such that h of its
    neighbours have h or more; it never falls below the answer, whatever the order, and stops there. So one run answers
    all thresholds. ``tiles(point_id, tile)`` names groups of neighbouring points of bounded size: a tile is brought to rest by
    itself, and a round looks again at the tiles beside a change.
    """
    edges = settle(support.select("center_id", "neighbor_id").join(tiles.withColumnRenamed("point_id", "center_id"), "center_id"), "core-edges")
    core = settle(counts.select(F.col("center_id").alias("point_id"), F.col("k").cast("long").alias("core")), "core")
    alone = core.join(edges.select(F.col("center_id").alias("point_id")).distinct(), "point_id", "left_anti").select("point_id", F.lit(0).cast("long").alias("core"))
    core = settle(core.join(alone.select("point_id"), "point_id", "left_anti").union(alone), "core")
    beside = edges.select("tile").distinct()
    for _ in range(max_rounds):
        at = lambda p, name: core.select(F.col("point_id").alias(p), F.col("core").alias(name))
        values = edges.join(beside, "tile", "left_semi").join(at("neighbor_id", "core"), "neighbor_id", "left").join(at("center_id", "own"), "center_id")
        found = values.select("tile", "center_id", "neighbor_id", F.coalesce("core", F.lit(0).cast("long")).alias("core"), "own").groupBy("tile").applyInPandas(_settled_cores, "point_id long, now long")
        told = settle(core.join(found, "point_id", "left").select("point_id", "core", F.coalesce("now", "core").alias("now")), "core-round")
        changed = told.where("now < core").select(F.col("point_id").alias("neighbor_id"))
        core = told.select("point_id", F.col("now").alias("core"))
        if changed.isEmpty():
            return core
        beside = settle(edges.join(changed, "neighbor_id", "left_semi").select("tile").distinct(), "core-tile")
    raise RuntimeError(f"the core numbers did not settle in {max_rounds} rounds")


def safe_thresholds(support: DataFrame, cores: DataFrame, least: int) -> DataFrame:
    """``center_id, k, safe_threshold``: the largest threshold whose state leaves a centre ``least`` neighbours; null if none does.

    That is the core number of its neighbour at that rank.
    """
    values = support.select("center_id", "neighbor_id").join(cores.withColumnRenamed("point_id", "neighbor_id"), "neighbor_id")
    lists = values.groupBy("center_id").agg(F.sort_array(F.collect_list("core"), asc=False).alias("held"))
    return lists.select("center_id", F.size("held").cast("long").alias("k"), F.nullif(F.get("held", F.lit(least - 1)), F.lit(0)).alias("safe_threshold"))


def routing(stats: DataFrame, counts: DataFrame, effective: DataFrame, formal_k: int) -> DataFrame:
    """``point_id, route``: formal points with enough neighbours of the state are sequential, other formal ones fall back."""
    known = stats.join(counts.withColumnRenamed("center_id", "point_id"), "point_id", "left").join(effective.withColumnRenamed("center_id", "point_id"), "point_id", "left")
    formal = ~F.col("ps") & (F.coalesce("k", F.lit(0)) >= formal_k)
    route = F.when(formal & (F.coalesce("effective_k", F.lit(0)) >= formal_k), "sequential").when(formal, "fallback").otherwise("outside")
    return known.select("point_id", route.alias("route"))
