"""Interferograms, their gradients, integer jumps and closures."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fringeflow.functions.phase import ambiguity, wrap
from fringeflow.operators import forests
from fringeflow.operators.components import connected_components
from fringeflow.operators.consistency import levels, turns_of
from fringeflow.operators.forests import Potentials, bottlenecks, in_one_task, spanning_forest
from fringeflow.operators.quantiles import quantiles
from fringeflow.plans.lineage import settle

SAFE = math.pi / 2
#: Rows and columns of cells that are integrated at once, where tiles are smaller.
BLOCK = (128, 256)


def pair_table(spark: SparkSession, pairs: list[tuple[int, int]]) -> DataFrame:
    """``pair_id, i, j``: a row for each pair of epochs."""
    return spark.createDataFrame([(k, i, j) for k, (i, j) in enumerate(pairs)], "pair_id int, i int, j int")


def virtual_ifgs(phases: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pair_id, point_id, phase``: wrapped difference of two epochs of ``phases(point_id, t, phase)``.

    Each point's epochs become one map, so no join on the large side is needed.
    """
    rows = phases.groupBy("point_id").agg(F.map_from_entries(F.collect_list(F.struct("t", "phase"))).alias("at"))
    each = rows.crossJoin(F.broadcast(pairs))  # pairs of epochs, a few for each epoch
    value = wrap(F.try_element_at("at", F.col("j")) - F.try_element_at("at", F.col("i")))
    return each.select("pair_id", "point_id", value.alias("phase")).where("phase IS NOT NULL")


def triangle_closures(ifgs: DataFrame, triangles: list[tuple[int, int, int]]) -> DataFrame:
    """``triangle_id, point_id, closure``: phase around pairs (ab, bc, ac), not wrapped."""
    terms = [(k, pair, sign) for k, (ab, bc, ac) in enumerate(triangles) for pair, sign in ((ab, 1.0), (bc, 1.0), (ac, -1.0))]
    table = ifgs.sparkSession.createDataFrame(terms, "triangle_id int, pair_id int, sign double")
    return ifgs.join(F.broadcast(table), "pair_id").groupBy("triangle_id", "point_id").agg(F.sum(F.col("sign") * F.col("phase")).alias("closure"))


def closure_summary(closures: DataFrame) -> DataFrame:
    off = F.abs(wrap(F.col("closure")))
    return closures.groupBy("triangle_id").agg(F.avg(off).alias("mean_abs"), F.max(off).alias("max_abs"), F.count_if(off > 1e-4).alias("above_1e4"), F.count("*").alias("points"))


def integer_closures(closures: DataFrame) -> DataFrame:
    """``triangle_id, point_id, k``: whole turns left around the triangle."""
    return closures.select("triangle_id", "point_id", ambiguity(F.col("closure")).alias("k"))


def modal_closures(integers: DataFrame) -> DataFrame:
    """``triangle_id, modal_k, bad_points``: the most frequent integer (the smallest of equals) and the points off it."""
    counts = integers.groupBy("triangle_id", "k").agg(F.count("*").alias("n"))
    best = F.max_by("k", F.struct("n", -F.col("k")))
    return counts.groupBy("triangle_id").agg(best.alias("modal_k"), (F.sum("n") - F.max("n")).alias("bad_points"))


def gradients(ifgs: DataFrame, edges: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``pair_id, u, v, g`` and ``keep``: wrapped phase difference along each edge ``(u, v)``.

    A point's interferograms travel as one row, so that what is joined grows with the points and edges alone.
    """
    rows = ifgs.groupBy("point_id").agg(F.collect_list(F.struct("pair_id", "phase")).alias("at"))
    met = edges.select("u", "v", *keep).join(rows.select(F.col("point_id").alias("u"), F.col("at").alias("at_u")), "u")
    met = met.join(rows.select(F.col("point_id").alias("v"), F.map_from_entries("at").alias("at_v")), "v")
    each = met.select("u", "v", *keep, "at_v", F.inline("at_u")).where(F.map_contains_key("at_v", F.col("pair_id")))
    return each.select("pair_id", "u", "v", wrap(F.try_element_at("at_v", F.col("pair_id")) - F.col("phase")).alias("g"), *keep)


def gradient_stats(grads: DataFrame) -> DataFrame:
    size = F.abs("g")
    share = lambda limit: F.avg((size > limit).cast("double"))
    grads = settle(grads.select("pair_id", "g"), "gradient")
    sums = grads.groupBy("pair_id").agg(F.count("*").alias("edges"), F.avg(size).alias("mean_abs"), share(SAFE).alias("frac_pi2"), share(2 * math.pi / 3).alias("frac_2pi3"), share(0.9 * math.pi).alias("frac_09pi"))
    ends = quantiles(grads.withColumn("size", size), ["pair_id"], "size", [0.9, 0.95]).select("pair_id", F.col("p")[0].alias("p90"), F.col("p")[1].alias("p95"))
    return sums.join(F.broadcast(ends), "pair_id")  # a row a pair


def gradient_histogram(grads: DataFrame, bins: int = 180) -> DataFrame:
    """``bin, n, cdf``: counts over [0, pi] and the share up to each bin; the last bin takes the upper end."""
    bin_of = F.least(F.floor(F.abs("g") / F.lit(math.pi) * bins), F.lit(bins - 1)).cast("int")
    counts = grads.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"))
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counts.withColumn("cdf", F.sum("n").over(upto) / F.sum("n").over(every))


def gradient_percentiles(grads: DataFrame, shares: list[float]) -> DataFrame:
    """``pair_id, n, p``: quantiles of the sizes of the gradients of each pair."""
    return quantiles(grads.select("pair_id", F.abs("g").alias("size")), ["pair_id"], "size", shares)


def histogram_quantile(histogram: DataFrame, q: float, bins: int = 180) -> DataFrame:
    """``value``: the middle of the first bin whose share reaches q."""
    return histogram.where(F.col("cdf") >= q).agg(((F.min("bin") + 0.5) * F.lit(math.pi / bins)).alias("value"))


def pair_components(edges: DataFrame, alone: DataFrame | None = None) -> DataFrame:
    """``pair_id, point_id, fragment``: points joined by ``edges(pair_id, u, v)`` and those of ``alone``, a component by its smallest point.

    All interferograms are labelled in one run of the component algorithm over (pair, point) nodes. Points are numbered below 2**40.
    """
    bound = F.lit(1 << 40)
    whole = lambda p: F.when((F.col(p) >= 0) & (F.col(p) < bound), F.col(p)).otherwise(F.raise_error(F.format_string("point %d is not below 2**40", p)).cast("long"))
    node = lambda p: F.call_function("shiftleft", F.col("pair_id").cast("long"), F.lit(40)) + whole(p)
    links = edges.select(node("u").alias("u"), node("v").alias("v"))
    if alone is not None:
        links = links.union(alone.select(node("point_id").alias("u"), node("point_id").alias("v")))
    found = connected_components(links)
    low = F.lit((1 << 40) - 1)
    return found.select(F.call_function("shiftright", "node", F.lit(40)).cast("int").alias("pair_id"), F.col("node").bitwiseAND(low).alias("point_id"), F.col("component").bitwiseAND(low).alias("fragment"))


def fragment_sizes(fragments: DataFrame) -> DataFrame:
    """``pair_id, component, size``."""
    return fragments.groupBy("pair_id", F.col("fragment").alias("component")).agg(F.count("*").alias("size"))


def safe_fragments(grads: DataFrame, ifgs: DataFrame) -> DataFrame:
    """``pair_id, point_id, fragment``: points of an interferogram joined by edges of at most half a half-turn."""
    return pair_components(grads.where(F.abs("g") <= SAFE), ifgs)


def safe_conflicts(grads: DataFrame, values: DataFrame) -> DataFrame:
    """``pair_id, u, v, jump`` of the edges that are safe, yet across which ``values(pair_id, point_id, value)`` jump by whole turns."""
    at = lambda name: values.select("pair_id", F.col("point_id").alias(name), F.col("value").alias(f"value_{name}"))
    met = grads.where(F.abs("g") <= SAFE).join(at("u"), ["pair_id", "u"]).join(at("v"), ["pair_id", "v"])
    return met.select("pair_id", "u", "v", ambiguity(F.col("value_v") - F.col("value_u") - F.col("g")).alias("jump")).where("jump <> 0")


def tiles(points: DataFrame, tile: tuple[int, int]) -> DataFrame:
    """``point_id, tile, block``: the tile of each point, and the group of small tiles that it is integrated in."""
    high, wide = (n * max(1, most // n) for n, most in zip(tile, BLOCK))
    block = F.struct(F.expr(f"r div {high}").alias("r"), F.expr(f"c div {wide}").alias("c"))
    return points.select("point_id", F.concat_ws("_", F.expr(f"r div {tile[0]}"), F.expr(f"c div {tile[1]}")).alias("tile"), block.alias("block"))


def inner_blocks(edges: DataFrame, points: DataFrame, tile: tuple[int, int]) -> DataFrame:
    """``edges`` with the ``block`` that both ends lie in, null where an edge leaves its tile."""
    cell = tiles(points, tile)
    near = edges.join(cell.select(F.col("point_id").alias("u"), F.col("tile").alias("tile_u"), "block"), "u").join(cell.select(F.col("point_id").alias("v"), F.col("tile").alias("tile_v")), "v")
    return near.withColumn("block", F.when(F.col("tile_u") == F.col("tile_v"), F.col("block"))).drop("tile_u", "tile_v")


def unwrap_fragments(ifgs: DataFrame, grads: DataFrame, fragments: DataFrame | None, points: DataFrame, tile: tuple[int, int] = (128, 256)) -> DataFrame:
    """``pair_id, point_id, tile, root, unwrapped, phase``: phase integrated along safe edges inside tiles of the grid, with ``fragments`` if given.

    A group is one interferogram's tile, or as many small tiles as make up a ``BLOCK``, so its size is bounded; pieces of a fragment that
    lie in several tiles have roots of their own and are tied together by ``fragment_votes``. ``grads`` may have the
    ``block`` of ``inner_blocks``.
    """
    nodes = ifgs.join(tiles(points, tile), "point_id").select("pair_id", "block", F.col("point_id").alias("u"), F.lit(None).cast("long").alias("v"), F.col("phase").alias("g"), "tile")
    safe = grads.where(F.abs("g") <= SAFE)
    safe = safe if "block" in grads.columns else inner_blocks(safe, points, tile)
    rows = nodes.union(safe.where("block IS NOT NULL").select("pair_id", "block", "u", "v", "g", F.lit(None).cast("string")))
    out = rows.groupBy("pair_id", "block").applyInPandas(_integrate, "pair_id int, tile string, point_id long, root long, unwrapped double, phase double")
    return out if fragments is None else out.join(fragments, ["pair_id", "point_id"])


def _integrate(rows: pd.DataFrame) -> pd.DataFrame:
    """Phase from the smallest point of each piece along the forest of the flattest safe edges, all of which stay inside tiles.

    Rounds of the flattest edge of each component, on arrays: every component hangs itself on the one that its edge
    leads to, and the sums along the way are doubled up to the root.
    """
    nodes = rows[rows["v"].isna()].sort_values("u")
    point, start = nodes["u"].to_numpy(), nodes["g"].to_numpy()
    links = rows[rows["v"].notna()].assign(size=lambda x: x["g"].abs()).sort_values(["size", "u", "v"])
    u, v, g = np.searchsorted(point, links["u"].to_numpy()), np.searchsorted(point, links["v"].to_numpy().astype("int64")), links["g"].to_numpy()
    root, above = np.arange(len(point)), np.zeros(len(point))  # above: phase of a point less that of its root
    while len(u):
        a, b = root[u], root[v]
        apart = a != b
        u, v, g, a, b = u[apart], v[apart], g[apart], a[apart], b[apart]
        if not len(u):
            break
        step = above[u] + g - above[v]  # phase of root b less that of root a
        best = np.full(len(point), len(u))
        np.minimum.at(best, a, np.arange(len(u)))
        np.minimum.at(best, b, np.arange(len(u)))
        c = np.flatnonzero(best < len(u))
        e = best[c]
        up, rise = np.arange(len(point)), np.zeros(len(point))
        up[c] = np.where(a[e] == c, b[e], a[e])
        rise[c] = np.where(a[e] == c, -step[e], step[e])
        tops = c[(up[up[c]] == c) & (c < up[c])]  # the lower of two that chose the same edge
        up[tops], rise[tops] = tops, 0.0
        while (up != up[up]).any():
            rise, up = rise + rise[up], up[up]
        above, root = above + rise[root], up[root]
    low = np.full(len(point), len(point))
    np.minimum.at(low, root, np.arange(len(point)))
    low = low[root]
    return pd.DataFrame({"pair_id": np.int32(rows["pair_id"].iloc[0]), "tile": nodes["tile"].to_numpy(), "point_id": point, "root": point[low], "unwrapped": start[low] + above - above[low], "phase": start})


def fragment_votes(grads: DataFrame, labelled: DataFrame, edges: DataFrame) -> DataFrame:
    """Votes between pieces of an interferogram on the whole turns from one to the other.

    ``labelled`` has ``pair_id, point_id, piece, value``. Reported are the edges, the modal shift (the
    smallest of equals), its edges, their share, and the middle and least gradient, for piece a < b.
    """
    at = lambda name: labelled.select("pair_id", F.col("point_id").alias(name), F.col("piece").alias(f"piece_{name}"), F.col("value").alias(f"value_{name}"))
    met = grads.join(edges.select("u", "v", "dist"), ["u", "v"]).join(at("u"), ["pair_id", "u"]).join(at("v"), ["pair_id", "v"]).where("piece_u <> piece_v")
    return _tallied(met)


def _tallied(met: DataFrame) -> DataFrame:
    """``fragment_votes`` of edges ``pair_id, piece_u, value_u, piece_v, value_v, g, dist`` between pieces."""
    jump = ambiguity(F.col("value_v") - F.col("value_u") - F.col("g"))
    flip = F.col("piece_u") > F.col("piece_v")
    votes = met.select("pair_id", F.least("piece_u", "piece_v").alias("frag_a"), F.greatest("piece_u", "piece_v").alias("frag_b"), F.when(flip, -jump).otherwise(jump).alias("shift"), F.abs("g").alias("size"), "dist")
    key = ["pair_id", "frag_a", "frag_b"]
    sums = votes.groupBy(*key).agg(F.count("*").alias("edge_count"), F.mode("shift", True).alias("mode_shift"), F.median("size").alias("median_abs"), F.min("size").alias("min_abs"), F.median("dist").alias("median_dist"))
    modal = votes.groupBy(*key, "shift").agg(F.count("*").alias("mode_count")).withColumnRenamed("shift", "mode_shift")
    out = sums.join(modal, [*key, "mode_shift"])
    return out.withColumn("ratio", F.col("mode_count") / F.col("edge_count")).withColumn("exact", F.col("mode_count") == F.col("edge_count"))


def strong_votes(votes: DataFrame, least_edges: int = 3, least_ratio: float = 0.8) -> DataFrame:
    """Votes with enough edges of one mind, the surest first."""
    return votes.where((F.col("edge_count") >= least_edges) & (F.col("ratio") >= least_ratio)).orderBy(F.desc("ratio"), F.desc("edge_count"), "median_abs", "median_dist", "frag_a", "frag_b")


def attribution(grads: DataFrame, phases: DataFrame, pairs: DataFrame, margin: float = 0.15) -> DataFrame:
    """``t, wins, ties``: which epoch of an unsafe gradient has the clearly larger gradient of its own."""
    at = lambda p, t: phases.select(F.col("point_id").alias(p), F.col("t").alias(t), F.col("phase").alias(f"ph_{p}_{t}"))
    bad = grads.where(F.abs("g") > SAFE).join(F.broadcast(pairs), "pair_id")
    for p in ("u", "v"):
        for t in ("i", "j"):
            bad = bad.join(at(p, t), [p, t])
    gi, gj = (F.abs(wrap(F.col(f"ph_v_{t}") - F.col(f"ph_u_{t}"))) for t in ("i", "j"))
    winner = F.when(gi > gj + margin, F.col("i")).when(gj > gi + margin, F.col("j"))
    told = bad.withColumn("winner", winner).select(F.inline(F.array(F.struct(F.col("i").alias("t"), (F.col("winner") == F.col("i")).alias("won"), F.col("winner").isNull().alias("tie")), F.struct(F.col("j").alias("t"), (F.col("winner") == F.col("j")).alias("won"), F.col("winner").isNull().alias("tie")))))
    return told.groupBy("t").agg(F.count_if("won").alias("wins"), F.count_if("tie").alias("ties"))


def correction_patterns(integers: DataFrame) -> DataFrame:
    """``pattern, points``: points by their whole turns around all triangles in order."""
    own = integers.groupBy("point_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("triangle_id", "k"))), lambda s: s["k"].cast("string")), ",").alias("pattern"))
    return own.groupBy("pattern").agg(F.count("*").alias("points"))


def signature_groups(labels: DataFrame, bad: DataFrame) -> DataFrame:
    """``signature, size, bad_points, status``: points that share every label, and whether all, some or none are bad.

    ``labels`` has ``point_id, pair_id, label``; equality of label lists is what counts.
    """
    own = labels.groupBy("point_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pair_id", "label"))), lambda s: s["label"].cast("string")), ",").alias("signature"))
    marked = own.join(bad.select("point_id").distinct().withColumn("bad", F.lit(1)), "point_id", "left")
    sums = marked.groupBy("signature").agg(F.count("*").alias("size"), F.count("bad").alias("bad_points"))
    return sums.withColumn("status", F.when(F.col("bad_points") == 0, "good").when(F.col("bad_points") == F.col("size"), "bad").otherwise("mixed"))


def registration(anchors: DataFrame, ifgs: DataFrame) -> DataFrame:
    """``pair_id, component, shift, agree``: whole turns from a component to the main one, and whether its anchors agree."""
    at = lambda name: ifgs.select("pair_id", F.col("point_id").alias(name), F.col("phase").alias(f"phase_{name}"))
    met = anchors.select("component", "p", "q").join(at("p"), "p").join(at("q"), ["pair_id", "q"])
    diff = F.col("phase_q") - F.col("phase_p")
    shift = ambiguity(diff - wrap(diff))
    return met.groupBy("pair_id", "component").agg(F.min(shift).alias("shift"), (F.min(shift) == F.max(shift)).alias("agree"), F.count("*").alias("anchors"))


def gates(stats: DataFrame, most_steep: float, most_middle: float) -> DataFrame:
    """``pair_id, reasons, verdict``: why an interferogram wants a review, from ``gradient_stats``."""
    reasons = F.array_compact(F.array(F.when(F.col("frac_pi2") > most_steep, "steep"), F.when(F.col("mean_abs") > most_middle, "rough"), F.when(F.col("edges") == 0, "empty")))
    return stats.select("pair_id", F.array_join(reasons, "+").alias("reasons"), F.when(F.size(reasons) > 0, "REVIEW").otherwise("PASS").alias("verdict"))


def worst_pair(stats: DataFrame) -> DataFrame:
    """The one pair with the largest share of steep edges, then the larger upper percentile, then the smaller number."""
    return stats.orderBy(F.desc("frac_pi2"), F.desc("p95"), "pair_id").limit(1)


def antisymmetry(phases: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pair_id, worst``: largest wrapped sum of a difference and its reverse; zero up to rounding."""
    back = pairs.select("pair_id", F.col("j").alias("i"), F.col("i").alias("j"))
    both = virtual_ifgs(phases, pairs).join(virtual_ifgs(phases, back).withColumnRenamed("phase", "reverse"), ["pair_id", "point_id"])
    return both.groupBy("pair_id").agg(F.max(F.abs(wrap(F.col("phase") + F.col("reverse")))).alias("worst"))


def _tied(votes: pd.DataFrame) -> pd.DataFrame:
    """``piece_shifts`` of a bounded number of votes, the surest first."""
    trees = Potentials()
    rows = list(zip(votes["a"].tolist(), votes["b"].tolist(), votes["k"].tolist()))
    for a, b, k in rows:
        trees.link(a, b, k)
    found = {n: trees.root(n) for n in sorted(trees.up)}
    low: dict[int, int] = {}
    for n, (root, _) in found.items():
        low.setdefault(root, n)  # nodes come in order
    against = dict.fromkeys(found, 0)
    for a, b, k in rows:
        if found[b][1] + k != found[a][1]:
            against[a] += 1
            against[b] += 1
    mask = (1 << 40) - 1
    told = [(n >> 40, n & mask, low[root] & mask, turns - found[low[root]][1], against[n]) for n, (root, turns) in found.items()]
    return pd.DataFrame(told, columns=["pair_id", "piece", "root", "shift", "against"]).astype({"pair_id": "int32"})


def piece_shifts(votes: DataFrame, least_ratio: float = 0.0) -> DataFrame:
    """``pair_id, piece, root, shift, against``: whole turns that bring each piece to its root, along the surest votes.

    All interferograms are tied in one run over (pair, piece) nodes, in a task while the votes are few (``ONE_TASK``) and beyond by
    ranges of their numbers (``spanning_forest``, ``levels``), so no group holds an interferogram.
    The root is the smallest piece. ``against`` counts the votes of a piece that the shifts do not obey.
    """
    node = lambda p: F.call_function("shiftleft", F.col("pair_id").cast("long"), F.lit(40)) + F.col(p)
    order = F.struct((-F.col("ratio")).alias("r"), (-F.col("edge_count")).alias("n"), "median_abs", "median_dist", "frag_a", "frag_b")
    own = votes.where(F.col("ratio") >= least_ratio)
    own = settle(own.select(node("frag_a").alias("a"), node("frag_b").alias("b"), F.col("mode_shift").cast("long").alias("k"), order.alias("order")), "votes")
    if own.count() <= forests.ONE_TASK:
        return in_one_task(own.coalesce(1).sortWithinPartitions("order").select("a", "b", "k"), _tied, "pair_id int, piece long, root long, shift long, against long")
    links = own.select(F.col("a").alias("u"), F.col("b").alias("v"), F.col("k").alias("shift"), "order")
    tree = links.join(spanning_forest(links, F.col("order")), ["u", "v"]).select("u", "v", "shift")
    at = settle(turns_of(levels(tree)).select("node", "root", F.col("turns").alias("shift")), "pieces")
    end = lambda name: at.select(F.col("node").alias(name), F.col("shift").alias(f"shift_{name}"))
    off = own.join(end("a"), "a").join(end("b"), "b").where("shift_b + k <> shift_a")
    off = off.select(F.col("a").alias("node")).union(off.select(F.col("b").alias("node"))).groupBy("node").agg(F.count("*").alias("against"))
    mask = F.lit((1 << 40) - 1)
    piece = lambda name: F.col(name).bitwiseAND(mask)
    return at.join(off, "node", "left").select(F.call_function("shiftright", "node", F.lit(40)).cast("int").alias("pair_id"), piece("node").alias("piece"), piece("root").alias("root"), "shift", F.coalesce("against", F.lit(0)).cast("long").alias("against"))


def piece_bottlenecks(votes: DataFrame, pieces: DataFrame) -> DataFrame:
    """``pair_id, frag_a, frag_b, smaller, total``: points on the smaller side of each vote of the surest spanning forest, and of its tree."""
    node = lambda p: F.call_function("shiftleft", F.col("pair_id").cast("long"), F.lit(40)) + F.col(p)
    order = F.struct((-F.col("ratio")).alias("r"), (-F.col("edge_count")).alias("n"), "median_abs", "median_dist")
    forest = spanning_forest(votes.select(node("frag_a").alias("u"), node("frag_b").alias("v"), order.alias("o")), F.col("o"))
    sizes = pieces.groupBy(node("root").alias("node")).agg(F.count("*").alias("w"))
    mask = F.lit((1 << 40) - 1)
    rows = bottlenecks(forest, sizes)
    return rows.select(F.call_function("shiftright", "u", F.lit(40)).cast("int").alias("pair_id"), F.col("u").bitwiseAND(mask).alias("frag_a"), F.col("v").bitwiseAND(mask).alias("frag_b"), "smaller", "total")


def piece_votes(pieces: DataFrame, grads: DataFrame, edges: DataFrame) -> DataFrame:
    """Votes between the pieces that ``unwrap_fragments`` gives, by their unwrapped values."""
    return fragment_votes(grads, pieces.select("pair_id", "point_id", F.col("root").alias("piece"), F.col("unwrapped").alias("value")), edges)


def phase_votes(pieces: DataFrame, edges: DataFrame) -> DataFrame:
    """``piece_votes`` by the pieces' own phases. A point's interferograms travel as one row, and edges inside a piece go no further."""
    rows = pieces.groupBy("point_id").agg(F.collect_list(F.struct("pair_id", F.struct("root", "unwrapped", "phase").alias("own"))).alias("at"))
    met = edges.select("u", "v", "dist").join(rows.select(F.col("point_id").alias("u"), F.col("at").alias("at_u")), "u")
    met = met.join(rows.select(F.col("point_id").alias("v"), F.map_from_entries("at").alias("at_v")), "v")
    each = met.select("dist", "at_v", F.inline("at_u")).select("pair_id", "dist", F.col("own").alias("a"), F.try_element_at("at_v", F.col("pair_id")).alias("b")).where("a.root <> b.root")
    g = wrap(F.col("b.phase") - F.col("a.phase"))
    return _tallied(each.select("pair_id", F.col("a.root").alias("piece_u"), F.col("a.unwrapped").alias("value_u"), F.col("b.root").alias("piece_v"), F.col("b.unwrapped").alias("value_v"), g.alias("g"), "dist"))


def tie_pieces(pieces: DataFrame, shifts: DataFrame) -> DataFrame:
    """``pieces`` with the whole turns of ``piece_shifts`` added and the root they lead to."""
    turns = shifts.select("pair_id", F.col("piece").alias("root"), F.col("root").alias("tied"), "shift")
    tied = pieces.join(turns, ["pair_id", "root"], "left").withColumn("unwrapped", F.col("unwrapped") + 2 * math.pi * F.coalesce("shift", F.lit(0)))
    return tied.withColumn("root", F.coalesce("tied", "root")).drop("tied", "shift")
