"""Complex coherence over neighbours, and what is derived from it.

A pixel carries its epochs as arrays. Sums over a centre's neighbours are plain aggregates, one for
each pair of epochs, so partial sums are formed before the shuffle and no row is multiplied by the
number of pairs. For many epochs ``coherence_arrays`` does the same in matrix products over tiles of the grid.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fringeflow.functions.phase import conj_im, conj_re
from fringeflow.plans.lineage import settle


def epoch_pairs(epochs: int) -> list[tuple[int, int]]:
    """The strict upper triangle in row order."""
    return [(i, j) for i in range(epochs) for j in range(i + 1, epochs)]


def wide(samples: DataFrame, epochs: int) -> DataFrame:
    """``point_id, re0, im0, re1, ...``: one row for each point with all epochs."""
    at = lambda c, t: F.max(F.when(F.col("t") == t, F.col(c))).alias(f"{c}{t}")
    rows = samples.groupBy("point_id").agg(F.count("*").alias("n"), *[at(c, t) for t in range(epochs) for c in ("re", "im")])
    return rows.where(F.col("n") == epochs).drop("n")


def coherence_wide(support: DataFrame, pixels: DataFrame, epochs: int) -> DataFrame:
    """``center_id`` and ``cre_i_j, cim_i_j`` for each pair; null where the power is zero."""
    met = support.select("center_id", F.col("neighbor_id").alias("point_id")).join(pixels, "point_id")
    z = [(F.col(f"re{t}"), F.col(f"im{t}")) for t in range(epochs)]
    pairs = epoch_pairs(epochs)
    sums = [F.sum(conj_re(*z[i], *z[j])).alias(f"sre_{i}_{j}") for i, j in pairs] + [F.sum(conj_im(*z[i], *z[j])).alias(f"sim_{i}_{j}") for i, j in pairs]
    powers = [F.sum(re * re + im * im).alias(f"p{t}") for t, (re, im) in enumerate(z)]
    rows = met.groupBy("center_id").agg(*sums, *powers)
    den = lambda i, j: F.nullif(F.sqrt(F.col(f"p{i}") * F.col(f"p{j}")), F.lit(0.0))
    return rows.select("center_id", *[(F.col(f"s{part}_{i}_{j}") / den(i, j)).alias(f"c{part}_{i}_{j}") for i, j in pairs for part in ("re", "im")])


def coherence_long(rows: DataFrame, epochs: int) -> DataFrame:
    """``center_id, i, j, cre, cim``."""
    each = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"cre_{i}_{j}").alias("cre"), F.col(f"cim_{i}_{j}").alias("cim")) for i, j in epoch_pairs(epochs)])
    return rows.select("center_id", F.inline(each))


def median_coherence(rows: DataFrame, epochs: int) -> DataFrame:
    """``center_id, median_coh``: the middle of the pairs' magnitudes, without another shuffle."""
    sizes = F.array_sort(F.array_compact(F.array(*[F.hypot(f"cre_{i}_{j}", f"cim_{i}_{j}") for i, j in epoch_pairs(epochs)])))
    n = F.size("sizes")
    low, high = F.element_at("sizes", F.expr("CAST((size(sizes) + 1) div 2 AS INT)")), F.element_at("sizes", F.expr("CAST(size(sizes) div 2 + 1 AS INT)"))
    return rows.select("center_id", sizes.alias("sizes")).where(n > 0).select("center_id", ((low + high) / 2).alias("median_coh"))


def temporal_coherence(rows: DataFrame, theta: DataFrame, epochs: int) -> DataFrame:
    """``center_id, tc``: how well phases ``theta(point_id, th0, th1, ...)`` explain the coherence phases."""
    met = rows.join(theta.withColumnRenamed("point_id", "center_id"), "center_id")
    turns: list[tuple[Column, Column]] = []
    for i, j in epoch_pairs(epochs):
        off = F.atan2(f"cim_{i}_{j}", f"cre_{i}_{j}") - (F.col(f"th{i}") - F.col(f"th{j}"))
        turns.append((F.cos(off), F.sin(off)))
    valid = sum((F.when(c.isNotNull(), 1).otherwise(0) for c, _ in turns), F.lit(0))
    total = lambda k: sum((F.coalesce(t[k], F.lit(0.0)) for t in turns), F.lit(0.0))
    return met.select("center_id", (F.hypot(total(0), total(1)) / F.nullif(valid, F.lit(0))).alias("tc"))


def mean_phase(support: DataFrame, pixels: DataFrame, epochs: int) -> DataFrame:
    """``point_id, th0, ...``: angle of the neighbours' summed samples, referenced to epoch 0."""
    met = support.select("center_id", F.col("neighbor_id").alias("point_id")).join(pixels, "point_id")
    sums = met.groupBy("center_id").agg(*[F.sum(f"{p}{t}").alias(f"{p}{t}") for t in range(epochs) for p in ("re", "im")])
    angle = [F.atan2(f"im{t}", f"re{t}") for t in range(epochs)]
    return sums.select(F.col("center_id").alias("point_id"), *[(a - angle[0]).alias(f"th{t}") for t, a in enumerate(angle)])


def compress(pixels: DataFrame, theta: DataFrame, first: int, stop: int) -> DataFrame:
    """``point_id, amp, phase``: real epochs ``first`` to ``stop`` of a stage projected on its linked phase.

    The phase is referenced over the whole stage by the caller before compressed inputs are left out.
    """
    met = pixels.join(theta, "point_id")
    span = range(first, stop)
    c, s = (lambda t: F.cos(f"th{t}")), (lambda t: F.sin(f"th{t}"))
    re = sum((F.col(f"re{t}") * c(t) + F.col(f"im{t}") * s(t) for t in span), F.lit(0.0))
    im = sum((F.col(f"im{t}") * c(t) - F.col(f"re{t}") * s(t) for t in span), F.lit(0.0))
    amp = sum((F.hypot(f"re{t}", f"im{t}") for t in span), F.lit(0.0)) / len(span)
    return met.select("point_id", amp.alias("amp"), F.atan2(im, re).alias("phase"), F.hypot(re, im).alias("strength")).where("strength > 0").drop("strength")


def sample_arrays(samples: DataFrame, epochs: int) -> DataFrame:
    """``point_id, re, im``: arrays by epoch of the points that have all of them."""
    own = samples.groupBy("point_id").agg(F.array_sort(F.collect_list(F.struct("t", "re", "im"))).alias("s")).where(F.size("s") == epochs)
    return own.select("point_id", F.transform("s", lambda x: x["re"]).alias("re"), F.transform("s", lambda x: x["im"]).alias("im"))


def coherence_arrays(support: DataFrame, pixels: DataFrame, points: DataFrame, epochs: int, tile: tuple[int, int] = (32, 64)) -> DataFrame:
    """``center_id, re, im``: normalised complex sums of a centre's neighbours for all epoch pairs, in the order of ``epoch_pairs``.

    For many epochs, where one aggregate a pair outgrows generated code: the links and the neighbours of the centres of one
    tile of the grid meet in one group, bounded by the tile and its margin, and each centre is a matrix product.
    ``pixels`` has ``point_id, re, im`` as arrays, ``points`` has ``point_id, r, c``.
    """
    cell = points.select(F.col("point_id").alias("center_id"), F.concat_ws("_", F.expr(f"r div {tile[0]}"), F.expr(f"c div {tile[1]}")).alias("tile"))
    links = settle(support.select("center_id", "neighbor_id").join(cell, "center_id").select("tile", "center_id", "neighbor_id"), "tile-links")
    near = links.select(F.col("tile").alias("part"), F.col("neighbor_id").alias("point_id")).distinct().join(pixels, "point_id").select("part", "point_id", "re", "im")
    upper = np.triu_indices(epochs, 1)

    def sums(edges: pa.Table, rows: pa.Table) -> pa.Table:
        ids = rows.column("point_id").to_numpy()
        z = sum(unit * np.array(rows.column(name).combine_chunks().flatten()).reshape(len(ids), epochs) for name, unit in (("re", 1), ("im", 1j))) if len(ids) else np.zeros((0, epochs), complex)
        order = np.argsort(ids)
        centre, other = edges.column("center_id").to_numpy(), edges.column("neighbor_id").to_numpy()
        known = np.isin(other, ids)
        centre, other = centre[known], other[known]
        at = order[np.searchsorted(ids, other, sorter=order)]
        by = np.argsort(centre, kind="stable")
        centre, at = centre[by], at[by]
        heads, starts = np.unique(centre, return_index=True)
        re, im = [], []
        for a, b in zip(starts, [*starts[1:], len(centre)]):
            own = z[at[a:b]]
            power = np.sqrt((np.abs(own) ** 2).sum(axis=0))
            with np.errstate(invalid="ignore", divide="ignore"):
                coh = (own.T @ own.conj() / np.outer(power, power))[upper]
            re.append(coh.real)
            im.append(coh.imag)
        kind = pa.list_(pa.float64())
        return pa.table({"center_id": pa.array(heads, pa.int64()), "re": pa.array(re, kind), "im": pa.array(im, kind)})

    sums.__annotations__ = {"edges": pa.Table, "rows": pa.Table, "return": pa.Table}
    return links.groupBy("tile").cogroup(near.groupBy("part")).applyInArrow(sums, "center_id long, re array<double>, im array<double>")


def pairs_of_arrays(rows: DataFrame, epochs: int) -> DataFrame:
    """``center_id, i, j, cre, cim`` of ``coherence_arrays``."""
    pairs = epoch_pairs(epochs)
    ends = [F.array(*[F.lit(p[k]) for p in pairs]) for k in (0, 1)]
    each = F.transform(F.sequence(F.lit(0), F.lit(len(pairs) - 1)), lambda n: F.struct(F.get(ends[0], n).alias("i"), F.get(ends[1], n).alias("j"), F.get("re", n).alias("cre"), F.get("im", n).alias("cim")))
    return rows.select("center_id", F.inline(each))
