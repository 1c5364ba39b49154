"""Graphs of points on the grid: nearest neighbours, shells, components and anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fringeflow.functions.phase import metres
from fringeflow.operators.components import connected_components
from fringeflow.operators.support import half_window, neighbour_pairs
from fringeflow.plans.lineage import settle


#: Rows and columns of the tiles in which nearest neighbours are looked up.
_TILE = 256


def nearest(points: DataFrame, radius: int, k: int, azimuth: float, ground_range: float) -> DataFrame:
    """``u, v, dist`` of undirected edges to the k nearest points within a square of cells.

    Neighbours are ranked by distance, then the larger cell offset, then row and column offset, then point. A
    tile is given all points within two radii of it, so that it knows what both ends of its edges choose; an edge is told by the
    tile of its smaller point.
    """
    spark, span = points.sparkSession, range(-radius, radius + 1)
    offsets = spark.createDataFrame([(dr, dc) for dr in span for dc in span if (dr, dc) != (0, 0)], "dr int, dc int")
    dist, wide = metres(F.col("dr"), F.col("dc"), azimuth, ground_range), F.greatest(F.abs("dr"), F.abs("dc"))
    order = [(r["dr"], r["dc"], r["dist"]) for r in offsets.withColumn("dist", dist).orderBy("dist", wide, "dr", "dc").collect()]  # the cells of a window
    near = lambda of: F.explode(F.sequence(F.floor((F.col(of) - 2 * radius) / _TILE), F.floor((F.col(of) + 2 * radius) / _TILE)))
    dealt = points.select("point_id", "r", "c", near("r").alias("tr")).withColumn("tc", near("c"))
    kind = points.schema["point_id"].dataType.simpleString()
    return dealt.groupBy("tr", "tc").applyInPandas(_nearest_of(order, radius, k), f"u {kind}, v {kind}, dist double")


def _nearest_of(order: list[tuple[int, int, float]], radius: int, k: int):
    def told(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("point_id")
        ids = rows["point_id"].to_numpy()
        tr, tc = rows["tr"].iloc[0] * _TILE, rows["tc"].iloc[0] * _TILE
        r, c = rows["r"].to_numpy().astype("int64"), rows["c"].to_numpy().astype("int64")
        core = (r >= tr) & (r < tr + _TILE) & (c >= tc) & (c < tc + _TILE)
        r, c = r - r.min() + radius, c - c.min() + radius
        shape = (r.max() + radius + 1, c.max() + radius + 1)
        layer = pd.Series(r * shape[1] + c).groupby(r * shape[1] + c).cumcount().to_numpy()  # points of one cell
        cells = np.full((layer.max() + 1, *shape), -1)
        cells[layer, r, c] = np.arange(len(ids))
        count, found = np.zeros(len(ids), np.int64), []
        for n, (dr, dc, _) in enumerate(order):
            for held in cells:
                other = held[r + dr, c + dc]
                own = np.flatnonzero((other >= 0) & (count < k))
                count[own] += 1
                found.append(np.stack([np.minimum(own, other[own]), np.maximum(own, other[own]), np.full(len(own), n)]))
        u, v, n = np.concatenate(found, axis=1)
        _, first = np.unique(u * len(ids) + v, return_index=True)
        first = first[core[u[first]]]
        return pd.DataFrame({"u": ids[u[first]], "v": ids[v[first]], "dist": np.array([x for *_, x in order])[n[first]]})

    return told


def shell_edges(points: DataFrame, radii: int) -> DataFrame:
    """``radius, edges``: pairs of points whose larger cell offset is the radius."""
    pairs = neighbour_pairs(points, half_window(radii, radii), ["point_id"])
    return pairs.groupBy(F.greatest(F.abs("dr"), F.abs("dc")).alias("radius")).agg(F.count("*").alias("edges"))


def grid_components(points: DataFrame, radius: int, four: bool = False) -> DataFrame:
    """``point_id, component`` of points joined within a radius of cells (or across cell sides alone)."""
    offsets = [(0, 1), (1, 0)] if four else half_window(radius, radius)
    pairs = neighbour_pairs(points, offsets, ["point_id"]).select(F.col("a_point_id").alias("u"), F.col("b_point_id").alias("v"))
    alone = points.select(F.col("point_id").alias("u"), F.col("point_id").alias("v"))
    return settle(connected_components(pairs.union(alone)).withColumnRenamed("node", "point_id"), "labels")


def component_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("component").agg(F.count("*").alias("size"))


def size_summary(sizes: DataFrame) -> DataFrame:
    """One row: components, points, the largest and its share, single points, and small ones."""
    s = F.col("size")
    return sizes.agg(F.count("*").alias("components"), F.sum(s).alias("points"), F.max(s).alias("largest"), (F.max(s) / F.sum(s)).alias("largest_share"), F.count_if(s == 1).alias("singletons"), F.count_if(s <= 10).alias("upto_10"), F.count_if(s <= 100).alias("upto_100"))


def main_component(sizes: DataFrame) -> DataFrame:
    """The largest component, the smallest label of equals, in a single row."""
    return sizes.orderBy(F.desc("size"), "component").limit(1).select(F.col("component").alias("main"))


def anchors(points: DataFrame, labels: DataFrame, most_radius: int, keep: int = 2) -> DataFrame:
    """``component, rank, p, q, radius2, class``: for each other component the nearest points of the main one.

    A range join on cells of the radius: a point meets the points of its cell and the eight around
    it. For each (component, q) the nearest p counts; then the nearest ``keep`` distinct q.
    """
    placed = points.join(labels, "point_id").crossJoin(F.broadcast(main_component(component_sizes(labels))))  # one row
    size = most_radius + 1
    cell = placed.withColumn("cr", F.expr(f"r div {size}")).withColumn("cc", F.expr(f"c div {size}"))
    main = cell.where("component = main").select(F.col("point_id").alias("q"), F.col("r").alias("qr"), F.col("c").alias("qc"), "cr", "cc")
    around = F.array(*[F.struct((F.col("cr") + a).alias("cr"), (F.col("cc") + b).alias("cc")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    rest = cell.where("component <> main").select("component", F.col("point_id").alias("p"), "r", "c", F.inline(around))
    far2 = (F.col("r") - F.col("qr")) * (F.col("r") - F.col("qr")) + (F.col("c") - F.col("qc")) * (F.col("c") - F.col("qc"))
    met = rest.join(main, ["cr", "cc"]).withColumn("radius2", far2).where(F.col("radius2") <= most_radius * most_radius)
    by_q = met.groupBy("component", "q").agg(F.min(F.struct("radius2", "p")).alias("best")).select("component", "q", "best.radius2", "best.p")
    order = Window.partitionBy("component").orderBy("radius2", "p", "q")
    ranked = by_q.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
    tier = F.when(F.col("radius2") > 400, 3).when(F.col("radius2") > 144, 2).otherwise(1)
    return ranked.select("component", "rank", "p", "q", "radius2", tier.alias("class"))


def occupancy_degrees(points: DataFrame) -> DataFrame:
    """``point_id, degree4, degree8``: occupied neighbour cells."""
    pairs = neighbour_pairs(points, half_window(1, 1), ["point_id"])
    side = (F.abs("dr") + F.abs("dc") == 1).cast("int").alias("side")
    ends = F.array(F.col("a_point_id"), F.col("b_point_id"))
    counts = pairs.select(F.explode(ends).alias("point_id"), side).groupBy("point_id").agg(F.sum("side").alias("degree4"), F.count("*").alias("degree8"))
    return points.select("point_id").join(counts, "point_id", "left").select("point_id", F.coalesce("degree4", F.lit(0)).alias("degree4"), F.coalesce("degree8", F.lit(0)).alias("degree8"))


_STEP = 1 << 40  # a cell's value is its distance and then the point it leads to, so the smaller of two is the nearer, ties by point
_FAR = 1 << 62
#: Binary digits of a tile's number that one step of the search goes finer.
_FINER = 2


def _sweep(cells: np.ndarray) -> np.ndarray:
    """Values carried down, up and along the rows, a step for each cell to any of eight neighbours.

    A shortest way never turns back in its rows, so both directions once are exact; it ends at every nearest point, as
    the nearest points of a cell are those of its neighbours that are one step nearer.
    """
    ramp = np.arange(cells.shape[1]) * _STEP
    for order in (range(len(cells)), range(len(cells) - 1, -1, -1)):
        last = None
        for i in order:
            row = cells[i]
            if last is not None:
                row = np.minimum(row, last + _STEP)
                row[1:] = np.minimum(row[1:], last[:-1] + _STEP)
                row[:-1] = np.minimum(row[:-1], last[1:] + _STEP)
            row = np.minimum.accumulate(row - ramp) + ramp
            row = (np.minimum.accumulate((row + ramp)[::-1]))[::-1] - ramp
            last = cells[i] = np.minimum(row, _FAR)
    return cells


def _start_of(tile: tuple[int, int]):
    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for points in batch["points"]:
                cells = np.full(tile, _FAR)
                for p in points:
                    at = (p["r"] % tile[0], p["c"] % tile[1])
                    cells[at] = min(cells[at], p["point_id"])
                out.append(_sweep(cells))
            rings = [_border(cells).tobytes() for cells in out]
            yield batch[["tr", "tc"]].assign(data=[cells.tobytes() for cells in out], ring=rings)

    return start


def _border(cells: np.ndarray) -> np.ndarray:
    return np.concatenate([cells[0], cells[-1], cells[1:-1, 0], cells[1:-1, -1]])


def _ring(tile: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a tile's border cells."""
    high, wide = np.indices(tile)
    return _border(high), _border(wide)


def _look_of(tile: tuple[int, int]):
    """The nearest points of a tile's asked cells, from its own cells and the borders of the tiles that can matter.

    Every way into a tile and out of another one passes their borders, so values at borders are all that has to be
    brought across; the inside is swept.
    """
    rows, cols = _ring(tile)

    def look(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"p": [], "q": [], "chebyshev": []}).astype("int64")
        cells = np.full(tile, _FAR)
        tr, tc = asked["tr"].iloc[0], asked["tc"].iloc[0]
        for r, c, data, ring in zip(held["sr"], held["sc"], held["data"], held["ring"]):
            if r == tr and c == tc:
                cells = np.minimum(cells, np.frombuffer(data, np.int64).reshape(tile))
                continue
            far = np.maximum(np.abs(rows[:, None] - rows - (r - tr) * tile[0]), np.abs(cols[:, None] - cols - (c - tc) * tile[1]))
            best = (np.frombuffer(ring, np.int64) + far * _STEP).min(axis=1)
            np.minimum.at(cells, (rows, cols), best)
        found = _sweep(cells)[asked["r"].to_numpy() % tile[0], asked["c"].to_numpy() % tile[1]]
        return pd.DataFrame({"p": asked["point_id"], "q": found % _STEP, "chebyshev": (found // _STEP).astype(np.int32)})

    return look


def _tiles_that_matter(asked: DataFrame, main: DataFrame, digits: int) -> DataFrame:
    """``tr, tc, sr, sc``: for each tile of ``asked(tr, tc, r, c)`` those of ``main(tr, tc, r, c)`` that may hold a nearest point.

    Both are searched from coarse to fine: of the boxes of ``main`` those stay that begin no farther from the asked box than
    another one ends.
    """

    def boxes(points: DataFrame, name: str, bits: int) -> DataFrame:
        at = [F.shiftright(f"t{k}", bits).alias(f"{name}{k}") for k in "rc"]
        ends = [f(k).alias(f"{name}_{n}_{k}") for k in "rc" for n, f in (("low", F.min), ("high", F.max))]
        return points.groupBy(*at).agg(*ends)

    pairs, bits = None, digits
    while True:
        a, b = boxes(asked, "a", bits), boxes(main, "b", bits)
        if pairs is None:
            met = a.crossJoin(b)  # of four boxes each at most
        else:
            up = lambda x, name: x.withColumns({f"{name}{k}_up": F.shiftright(f"{name}{k}", last - bits) for k in "rc"})  # noqa: E731, B023
            met = pairs.join(up(a, "a"), ["ar_up", "ac_up"]).join(up(b, "b"), ["br_up", "bc_up"])
        apart = [F.greatest(F.col(f"a_low_{k}") - F.col(f"b_high_{k}"), F.col(f"b_low_{k}") - F.col(f"a_high_{k}"), F.lit(0)) for k in "rc"]
        most = [F.greatest(F.col(f"a_high_{k}") - F.col(f"b_low_{k}"), F.col(f"b_high_{k}") - F.col(f"a_low_{k}")) for k in "rc"]
        met = settle(met.select("ar", "ac", "br", "bc", F.greatest(*apart).alias("least"), F.greatest(*most).alias("most")), "distance-pair")
        bound = met.groupBy("ar", "ac").agg(F.min("most").alias("bound"))
        kept = met.join(bound, ["ar", "ac"]).where("least <= bound").select("ar", "ac", "br", "bc")
        if not bits:
            return kept.toDF("tr", "tc", "sr", "sc")
        pairs, last, bits = kept.toDF("ar_up", "ac_up", "br_up", "bc_up"), bits, max(0, bits - _FINER)


def nearest_in_main(points: DataFrame, labels: DataFrame, tile: tuple[int, int] = (128, 128)) -> DataFrame:
    """``p, q, chebyshev``: for each point outside the main component the nearest point in it by the larger cell offset, however far.

    Which tiles of the main component can matter to a tile is searched from coarse boxes to fine ones; each tile is then swept
    with the borders of those. The number of rounds is that of the binary digits of the scene's size in tiles, halved. Ties
    take the smallest point. Points are numbered below 2**40.
    """
    cell = [F.floor(F.col("r") / tile[0]).cast("int").alias("tr"), F.floor(F.col("c") / tile[1]).cast("int").alias("tc")]
    placed = points.join(labels, "point_id").crossJoin(F.broadcast(main_component(component_sizes(labels))))  # one row
    placed = settle(placed.select("point_id", F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), (F.col("component") == F.col("main")).alias("inside"), *cell), "distance-point")
    box = placed.agg(*[f(k).alias(f"{n}_{k}") for k in ("tr", "tc") for n, f in (("low", F.min), ("high", F.max))], F.min("point_id").alias("least"), F.max("point_id").alias("most")).head()
    if box["low_tr"] is None:
        return placed.select(F.col("point_id").alias("p"), F.col("point_id").alias("q"), F.lit(0).alias("chebyshev"))
    if box["least"] < 0 or box["most"] >= _STEP:
        raise ValueError("a point is not numbered below 2**40")
    main, asked = placed.where("inside"), placed.where("NOT inside").select("tr", "tc", "point_id", "r", "c")
    own = main.groupBy("tr", "tc").agg(F.collect_list(F.struct("r", "c", "point_id")).alias("points"))  # at most a tile's cells
    state = settle(own.mapInPandas(_start_of(tile), "tr int, tc int, data binary, ring binary"), "distance-tile")
    digits = max(abs(box[k]) for k in ("low_tr", "low_tc", "high_tr", "high_tc")).bit_length()
    pairs = _tiles_that_matter(asked, main, digits)
    near = (F.col("tr") == F.col("sr")) & (F.col("tc") == F.col("sc"))
    told = pairs.join(state.toDF("sr", "sc", "data", "ring"), ["sr", "sc"]).select("tr", "tc", "sr", "sc", F.when(near, F.col("data")).alias("data"), F.when(~near, F.col("ring")).alias("ring"))
    return asked.groupBy("tr", "tc").cogroup(told.groupBy("tr", "tc")).applyInPandas(_look_of(tile), "p long, q long, chebyshev int")
