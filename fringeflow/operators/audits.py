"""Gates and audits: what is kept and why the rest is not, whether two results agree, and verdicts on networks and series."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fringeflow.functions.phase import wrap
from fringeflow.operators.components import connected_components
from fringeflow.operators.network import cycle_counts, requirements

OUTSIDE, VALID, FEW_NEIGHBOURS, NOT_LINKED, NOT_COMPRESSED, BAD_CENTRE = range(6)
TOLERANCE = 1e-4
LEAST_FULL_K = 48
MOST_SUSPECTS = 5_000


def height_valid(height: Column) -> Column:
    """Heights of zero, no number or none give no geometry."""
    return F.coalesce((height != 0) & ~F.isnan(height), F.lit(False))


def final_scatterers(points: DataFrame, heights: DataFrame, epochs: int) -> DataFrame:
    """``points(point_id, r, c, n)`` with ``status``: kept, no_geometry, or incomplete phase of a point with geometry.

    ``n`` is the point's number of finite phases; ``heights`` has ``point_id, height``.
    """
    met = points.join(heights, "point_id", "left")
    status = F.when(~height_valid(F.col("height").cast("double")), "no_geometry").when(F.col("n") < epochs, "incomplete").otherwise("kept")
    return met.select("point_id", "r", "c", status.alias("status"))


def require_complete(scatterers: DataFrame) -> DataFrame:
    """The kept points; a point with geometry whose phase is incomplete is an error."""
    state = F.when(F.col("status") == "incomplete", F.raise_error(F.format_string("point %d has geometry and no complete phase", "point_id")).cast("string")).otherwise(F.col("status"))
    return scatterers.withColumn("status", state).where("status = 'kept'").drop("status")


def state_codes(centres: DataFrame, least_k: int) -> DataFrame:
    """``point_id, code`` of ``centres(point_id, inside, centre_ok, k, linked, compressed)``; the first that holds of: outside, bad centre, few neighbours, not linked, not compressed, valid."""
    code = F.when(~F.col("inside"), OUTSIDE).when(~F.col("centre_ok"), BAD_CENTRE).when(F.coalesce("k", F.lit(0)) < least_k, FEW_NEIGHBOURS)
    code = code.when(~F.coalesce("linked", F.lit(False)), NOT_LINKED).when(~F.coalesce("compressed", F.lit(False)), NOT_COMPRESSED).otherwise(VALID)
    return centres.select("point_id", code.cast("short").alias("code"))


def parity(computed: DataFrame, expected: DataFrame, key: str, value: str) -> DataFrame:
    """``computed`` where ``expected(key, value)`` says the same of every key; a difference or a key without an expectation is an error."""
    met = computed.join(expected.select(key, F.col(value).alias("_expected")), key, "left")
    same = F.col(value).eqNullSafe(F.col("_expected"))
    told = F.format_string(f"{value} of %s is %s, expected %s", F.col(key).cast("string"), F.col(value).cast("string"), F.col("_expected").cast("string"))
    return met.withColumn(value, F.when(same, F.col(value)).otherwise(F.raise_error(told).cast(computed.schema[value].dataType))).drop("_expected")


def full_scm_centres(centres: DataFrame, counts: DataFrame, expected: DataFrame, least_k: int = LEAST_FULL_K) -> DataFrame:
    """``center_id, k`` of the centres to link over the full span; fewer neighbours than ``least_k`` or another count than expected is an error."""
    rows = parity(centres.join(counts, "center_id"), expected, "center_id", "k")
    told = F.format_string(f"centre %s has fewer than {least_k} neighbours", F.col("center_id").cast("string"))
    return rows.select("center_id", F.when(F.col("k") >= least_k, F.col("k")).otherwise(F.raise_error(told).cast("long")).alias("k"))


def spread_sample(numbered: DataFrame, number: str, total: int, wanted: int) -> DataFrame:
    """The rows at ``wanted`` evenly spread places of ``total`` rows numbered from 0; all rows where no more are wanted than there are.

    Place k is floor(k (total - 1) / (wanted - 1)); a row is kept if its number is such a place, so no row is compared with another.
    """
    if wanted >= total:
        return numbered
    if wanted < 2:
        return numbered.where(F.col(number) == 0) if wanted else numbered.limit(0)
    k = F.expr(f"({number} * {wanted - 1}L + {total - 2}L) div {total - 1}L")
    return numbered.withColumn("_k", k).where(F.expr(f"(_k * {total - 1}L) div {wanted - 1}L") == F.col(number)).drop("_k")


def known_only(ids: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """``ids``; one that ``known`` lacks is an error."""
    met = ids.join(known.select(key).distinct().withColumn("_known", F.lit(True)), key, "left")
    kind = ids.schema[key].dataType
    return met.withColumn(key, F.when(F.col("_known"), F.col(key)).otherwise(F.raise_error(F.format_string(f"unknown {key} %s", F.col(key).cast("string"))).cast(kind))).drop("_known")


def mask_agreement(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: ``both, only_a, only_b, iou`` of two sets of keys."""
    marked = a.select(key).distinct().withColumn("a", F.lit(1)).join(b.select(key).distinct().withColumn("b", F.lit(1)), key, "full")
    sums = marked.agg(F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("both"), F.count_if(F.col("b").isNull()).alias("only_a"), F.count_if(F.col("a").isNull()).alias("only_b"))
    return sums.withColumn("iou", F.try_divide(F.col("both"), F.col("both") + F.col("only_a") + F.col("only_b")))


def same_partition(labels: DataFrame, a: str, b: str) -> DataFrame:
    """One row: labels of either kind, how many of each meet several of the other, and whether both part the rows alike."""
    pairs = labels.select(a, b).distinct()
    split = lambda one, other: pairs.groupBy(one).agg(F.count("*").alias("n")).agg(F.count("*").alias(f"labels_{other}"), F.count_if(F.col("n") > 1).alias(f"split_{other}"))
    both = split(a, "a").crossJoin(split(b, "b"))  # one row each
    return both.withColumn("equal", (F.col("split_a") == 0) & (F.col("split_b") == 0))


def bridge_sides(edges: DataFrame) -> DataFrame:
    """``i, j, side_i, side_j, smaller`` of the edges whose loss would split the network: nodes on either side, and the lesser.

    An edge on a cycle of three or four is none. Each other edge is a world of its own, in which it is missing; all
    worlds are labelled in one run. An epoch network has few such edges, and more than ``MOST_SUSPECTS`` are an error.
    """
    suspects = cycle_counts(edges, (3, 4)).where(F.col("shortest").isNull()).select(F.col("i").alias("ei"), F.col("j").alias("ej"))
    n = suspects.count()
    if n > MOST_SUSPECTS:
        raise ValueError(f"{n} edges are on no short cycle, more than {MOST_SUSPECTS}")
    ids = edges.select(F.explode(F.array("i", "j")).alias("node")).distinct()
    world = F.col("ei").cast("long") * F.lit(1 << 21) + F.col("ej")
    if (ids.agg(F.max("node")).head()[0] or 0) >= 1 << 20:
        raise ValueError("epochs are numbered below 2**20")
    missing = (F.col("i") == F.col("ei")) & (F.col("j") == F.col("ej"))
    at = lambda c: world * F.lit(1 << 21) + F.col(c)
    links = edges.select("i", "j").crossJoin(F.broadcast(suspects)).where(~missing)  # edges of one epoch network times its suspects
    alone = suspects.select(at("ei").alias("u"), at("ei").alias("v")).union(suspects.select(at("ej").alias("u"), at("ej").alias("v")))
    found = connected_components(links.select(at("i").alias("u"), at("j").alias("v")).union(alone))
    low = F.lit((1 << 21) - 1)
    parts = found.select(F.call_function("shiftright", "node", F.lit(21)).alias("world"), F.col("node").bitwiseAND(low).alias("node"), "component")
    sizes = parts.groupBy("world", "component").agg(F.count("*").alias("nodes"))
    end = lambda c: parts.join(sizes, ["world", "component"]).select(F.col("world"), F.col("node").alias(c), F.col("component").alias(f"comp_{c}"), F.col("nodes").alias(f"side_{c[1]}"))
    met = suspects.withColumn("world", world).join(end("ei"), ["world", "ei"]).join(end("ej"), ["world", "ej"]).where("comp_ei <> comp_ej")
    kinds = {f.name: f.dataType for f in edges.schema.fields}
    return met.select(F.col("ei").cast(kinds["i"]).alias("i"), F.col("ej").cast(kinds["j"]).alias("j"), "side_i", "side_j", F.least("side_i", "side_j").alias("smaller"))


def network_gate(candidates: DataFrame, chosen: DataFrame, per_side: int, longest: int = 4) -> DataFrame:
    """One row on a chosen network: its figures, the reasons against it, and PASS or REVIEW.

    It should have one component, no bridge, no fewer edges than nodes, the links a side that its candidates allow, and every edge on a
    cycle of three or four, none of whose shortest is longer than ``longest``.
    """
    both = chosen.select(F.col("i").alias("u"), F.col("j").alias("v"))
    comps = connected_components(both).agg(F.count_distinct("component").alias("components"), F.count("*").alias("nodes"))
    cut = bridge_sides(chosen).agg(F.count("*").alias("bridges"))
    short = requirements(candidates, chosen, per_side).agg(F.count_if(~F.col("met")).alias("short_of_links"))
    cyc = cycle_counts(chosen).agg(F.count("*").alias("edges"), F.count_if((F.col("c3") == 0) & (F.col("c4") == 0)).alias("uncovered"), F.max("shortest").alias("longest_shortest"))
    row = comps.crossJoin(cut).crossJoin(short).crossJoin(cyc)  # one row each
    against = F.array_compact(
        F.array(
            F.when(F.col("components") != 1, "components"),
            F.when(F.col("bridges") > 0, "bridges"),
            F.when(F.col("edges") < F.col("nodes"), "edges"),
            F.when(F.col("short_of_links") > 0, "links"),
            F.when(F.col("uncovered") > 0, "uncovered"),
            F.when(F.coalesce(F.col("longest_shortest") > longest, F.lit(False)), "cycles"),
        )
    )
    return row.withColumn("reasons", F.array_join(against, "+")).withColumn("verdict", F.when(F.size(against) > 0, "REVIEW").otherwise("PASS"))


def cycle_rank(edges: DataFrame, cycles: list[list[tuple[int, int]]], pairs: int) -> DataFrame:
    """One row: ``edges, nodes, components, expected, rank``: independent cycles that a network has, and the rank of those given."""
    comps = connected_components(edges.select(F.col("i").alias("u"), F.col("j").alias("v"))).agg(F.count_distinct("component").alias("components"), F.count("*").alias("nodes"))
    row = edges.agg(F.count("*").alias("edges")).crossJoin(comps)  # one row each
    design = np.zeros((max(len(cycles), 1), pairs))
    for k, cycle in enumerate(cycles):
        for e, s in cycle:
            design[k, e] = s
    rank = int(np.linalg.matrix_rank(design)) if cycles else 0
    return row.select("edges", "nodes", "components", (F.col("edges") - F.col("nodes") + F.col("components")).alias("expected"), F.lit(rank).cast("long").alias("rank"))


def anchor_stats(anchors: DataFrame, ifgs: DataFrame) -> DataFrame:
    """``pair_id, class, n, mean_abs, frac_pi2``: wrapped differences across the anchors of each class."""
    at = lambda name: ifgs.select("pair_id", F.col("point_id").alias(name), F.col("phase").alias(f"phase_{name}"))
    met = anchors.select("class", "p", "q").join(at("p"), "p").join(at("q"), ["pair_id", "q"])
    size = F.abs(wrap(F.col("phase_q") - F.col("phase_p")))
    return met.groupBy("pair_id", "class").agg(F.count("*").alias("n"), F.avg(size).alias("mean_abs"), F.avg((size > F.lit(np.pi / 2)).cast("double")).alias("frac_pi2"))


def inversion_parity(series: DataFrame, tree: DataFrame, ifgs: DataFrame, pairs: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """One row: the residuals' root mean square and largest, the largest gap between both series and the largest wrapped residual; PASS within the tolerance."""
    at = lambda t: series.select("point_id", F.col("t").alias(t), F.col("phase").alias(f"phase_{t}"))
    met = ifgs.join(F.broadcast(pairs), "pair_id").join(at("i"), ["point_id", "i"]).join(at("j"), ["point_id", "j"])
    off = F.col("phase") - (F.col("phase_j") - F.col("phase_i"))
    left = met.agg(F.sqrt(F.avg(off * off)).alias("rms"), F.max(F.abs(off)).alias("largest"), F.max(F.abs(wrap(off))).alias("wrap_back"))
    gap = series.join(tree.withColumnRenamed("phase", "other"), ["point_id", "t"]).agg(F.max(F.abs(F.col("phase") - F.col("other"))).alias("tree_gap"))
    row = left.crossJoin(gap)  # one row each
    good = (F.col("largest") <= tolerance) & (F.col("tree_gap") <= tolerance) & (F.col("wrap_back") <= tolerance)
    return row.withColumn("verdict", F.when(good, "PASS").otherwise("REVIEW"))


def epoch_fragments(fragments: DataFrame) -> DataFrame:
    """``t, points, fragments, largest`` of ``fragments(pair_id, point_id, fragment)`` that were made with epochs in the place of pairs."""
    sizes = fragments.groupBy(F.col("pair_id").alias("t"), "fragment").agg(F.count("*").alias("n"))
    return sizes.groupBy("t").agg(F.sum("n").alias("points"), F.count("*").alias("fragments"), F.max("n").alias("largest"))


def epoch_hits(grads: DataFrame, pairs: DataFrame, limit: float) -> DataFrame:
    """``t, pairs, hits``: unsafe edges in all pairs of an epoch."""
    bad = grads.groupBy("pair_id").agg(F.count_if(F.abs("g") > limit).alias("hits")).join(F.broadcast(pairs), "pair_id")
    return bad.select("hits", F.explode(F.array("i", "j")).alias("t")).groupBy("t").agg(F.count("*").alias("pairs"), F.sum("hits").alias("hits"))


def pair_tags(pairs: DataFrame, epochs: DataFrame) -> DataFrame:
    """``pair_id, tag``: number and both dates of a pair; ``epochs`` has ``t, day``."""
    day = lambda t: F.broadcast(epochs.select(F.col("t").alias(t), F.date_format("day", "yyyyMMdd").alias(f"day_{t}")))
    met = pairs.join(day("i"), "i").join(day("j"), "j")
    return met.select("pair_id", F.format_string("pair%03d_%s_%s", "pair_id", "day_i", "day_j").alias("tag"))
