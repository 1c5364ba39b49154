"""Network inversion, referencing and rates of phase series."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fringeflow.operators.quantiles import medians, quantiles
from fringeflow.plans.lineage import settle


def invert(ifgs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``point_id, t, phase``: least-squares series of ``ifgs(pair_id, point_id, phase)``.

    The weights are one number for each epoch and pair; a point's series is one aggregation.
    """
    epochs = range(weights.shape[0])
    lists = ifgs.sparkSession.createDataFrame([(e, [float(w) for w in weights[:, e]]) for e in range(weights.shape[1])], "pair_id int, w array<double>")
    sums = ifgs.join(F.broadcast(lists), "pair_id").groupBy("point_id").agg(*[F.sum(F.col("w")[t] * F.col("phase")).alias(f"s{t}") for t in epochs])
    return sums.select("point_id", F.posexplode(F.array(*[f"s{t}" for t in epochs])).alias("t", "phase"))


def residual_rms(series: DataFrame, ifgs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``point_id, rms``: how far the series is from each interferogram."""
    at = lambda t: series.select("point_id", F.col("t").alias(t), F.col("phase").alias(f"phase_{t}"))
    met = ifgs.join(F.broadcast(pairs), "pair_id").join(at("i"), ["point_id", "i"]).join(at("j"), ["point_id", "j"])
    off = F.col("phase") - (F.col("phase_j") - F.col("phase_i"))
    return met.groupBy("point_id").agg(F.sqrt(F.avg(off * off)).alias("rms"))


def reference_window(values: DataFrame, row: int, col: int, half_rows: int, half_cols: int, least: int = 100, strict: bool = False) -> DataFrame:
    """``t, points, ref_median, mad_sigma`` of the points in a window; epochs with fewer than ``least`` points are left out, or an error if ``strict``."""
    inside = values.where((F.abs(F.col("r") - row) <= half_rows) & (F.abs(F.col("c") - col) <= half_cols))
    middle = settle(medians(inside, ["t"], "phase", "ref_median").withColumnRenamed("n", "points"), "epoch-median")
    few = middle.where(F.col("points") < least).orderBy("t").head() if strict else None
    if few:
        raise ValueError(f"epoch {few['t']} has {few['points']} points in the window, fewer than {least}")
    middle = middle.where(F.col("points") >= least)
    off = inside.join(F.broadcast(middle), "t").withColumn("off", F.abs(F.col("phase") - F.col("ref_median")))  # a row an epoch
    return middle.join(medians(off, ["t"], "off", "mad"), "t").select("t", "points", "ref_median", (F.lit(1.4826) * F.col("mad")).alias("mad_sigma"))


def subtract_reference(values: DataFrame, reference: DataFrame) -> DataFrame:
    """``values`` with the epoch's reference median taken off; a row for each epoch is broadcast."""
    return values.join(F.broadcast(reference.select("t", "ref_median")), "t").withColumn("phase", F.col("phase") - F.col("ref_median")).drop("ref_median")


def rates(values: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """``key, n, rate, rms``: slope of y over x and the residuals' root mean square, in one aggregation.

    The residual sum is Syy - Sxy**2 / Sxx, from population moments.
    """
    sums = values.groupBy(key).agg(F.count("*").alias("n"), F.regr_slope(y, x).alias("rate"), F.regr_sxx(y, x).alias("sxx"), F.regr_sxy(y, x).alias("sxy"), F.regr_syy(y, x).alias("syy"))
    left = F.greatest(F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx"), F.lit(0.0))
    return sums.where("sxx > 0").select(key, "n", "rate", F.sqrt(left / F.col("n")).alias("rms"))


def robust_sigma(values: DataFrame, key: str, y: str) -> DataFrame:
    """``key, middle, mad_sigma``: 1.4826 times the median distance from the median."""
    middle = settle(medians(values, [key], y, "middle").drop("n"), "group-median")
    off = values.join(middle, key).select(key, F.abs(F.col(y) - F.col("middle")).alias("off"))
    return middle.join(medians(off, [key], "off", "mad"), key).select(key, "middle", (F.lit(1.4826) * F.col("mad")).alias("mad_sigma"))


def reference_scores(points: DataFrame, noise: str, network: str, half: int) -> DataFrame:
    """``r, c, score`` of cells with a full box: 0.85 noise + 0.15 network, each scaled between its 5th and 95th percentile and averaged over the box."""
    points = settle(points, "candidate-point")
    ends = lambda x, name: quantiles(points, [], x, [0.05, 0.95]).select(F.col("p").alias(name))
    lim = ends(noise, "a").crossJoin(ends(network, "b"))  # one row each
    scaled = lambda x, q: F.least(F.greatest((F.col(x) - F.col(q)[0]) / F.nullif(F.col(q)[1] - F.col(q)[0], F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    scored = points.crossJoin(F.broadcast(lim)).select("r", "c", (0.85 * scaled(noise, "a") + 0.15 * scaled(network, "b")).alias("own"))  # one row
    moves = F.array(*[F.struct((F.col("r") + a).alias("r"), (F.col("c") + b).alias("c")) for a in range(-half, half + 1) for b in range(-half, half + 1)])
    box = scored.select("own", F.inline(moves)).groupBy("r", "c").agg(F.avg("own").alias("score"), F.count("*").alias("n"))
    return box.where(F.col("n") == (2 * half + 1) ** 2).select("r", "c", "score")


def reference_candidates(points: DataFrame, noise: str, network: str, half: int, top: int) -> DataFrame:
    """``rank, r, c, score`` of the best cells by ``reference_scores``."""
    full = reference_scores(points, noise, network, half).orderBy(F.round("score", 9), "r", "c").limit(top)
    return full.withColumn("rank", F.row_number().over(Window.orderBy(F.round("score", 9), "r", "c"))).select("rank", "r", "c", "score")


def distinct_regions(scores: DataFrame, apart: int, top: int) -> DataFrame:
    """``rank, r, c, score``: the best cells, of which any two are ``apart`` rows or columns away; what choosing one by one gives.

    In each round the best cell left of each square of that size is taken if no better one left is too near, and what is too
    near to those taken goes. Two cells of one square are too near, so a square gives one cell a round, and a round
    compares it with the cells of nine squares.
    """
    cell = lambda k: F.floor(F.col(k) / apart)
    order = F.struct(F.round("score", 9).alias("s"), "r", "c")
    left = settle(scores.select("r", "c", "score", cell("r").alias("cr"), cell("c").alias("cc"), order.alias("order")), "region-left")
    taken = left.select("r", "c", "score").where("false")
    around = F.array(*[F.struct((F.col("cr") + a).alias("cr"), (F.col("cc") + b).alias("cc")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    near = F.greatest(F.abs(F.col("r") - F.col("own.r")), F.abs(F.col("c") - F.col("own.c"))) < apart
    while not left.isEmpty():
        best = settle(left.groupBy("cr", "cc").agg(F.min(F.struct("order", "score")).alias("best")).select("cr", "cc", F.col("best.order").alias("own"), F.col("best.score").alias("own_score")), "region-best")
        beside = best.select("own", F.inline(around))
        beaten = left.join(beside, ["cr", "cc"]).where(near & (F.col("order") < F.col("own"))).select("own").distinct()
        now = settle(best.join(beaten, "own", "left_anti"), "region-taken")
        taken = taken.union(now.select("own.r", "own.c", "own_score"))
        gone = left.join(now.select("own", F.inline(around)), ["cr", "cc"]).where(near).select("order").distinct()
        left = settle(left.join(gone, "order", "left_anti").select("r", "c", "score", "cr", "cc", "order"), "region-left")
    first = taken.orderBy(F.round("score", 9), "r", "c").limit(top)
    return first.withColumn("rank", F.row_number().over(Window.orderBy(F.round("score", 9), "r", "c"))).select("rank", "r", "c", "score")


def vector_similarity(vectors: DataFrame, reach: int) -> DataFrame:
    """``vec_id, neighbors, median_similarity``: median cosine of a vector with those up to ``reach`` ids away."""
    unit = vectors.withColumn("norm", F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))))
    a = unit.select(F.col("vec_id").alias("a"), F.col("embedding").alias("ea"), F.col("norm").alias("na"), F.explode(F.sequence(F.lit(1), F.lit(reach))).alias("step")).withColumn("b", F.col("a") + F.col("step"))
    b = unit.select(F.col("vec_id").alias("b"), F.col("embedding").alias("eb"), F.col("norm").alias("nb"))
    dot = F.aggregate(F.zip_with("ea", "eb", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    met = a.join(b, "b").select("a", "b", (dot / (F.col("na") * F.col("nb"))).alias("cosine"))
    both = met.select("cosine", F.explode(F.array("a", "b")).alias("vec_id"))
    return both.groupBy("vec_id").agg(F.count("*").alias("neighbors"), F.median("cosine").alias("median_similarity"))


def partial_fit(values: DataFrame, key: str, x: str, s: str, y: str) -> DataFrame:
    """``key, n, k, k_se, rms_before, rms_after``: the slope of y on s with a trend over x taken from both.

    Closed forms of the second moments, so one aggregation does. ``k_se`` has n - 3 degrees of freedom.
    """
    c = lambda a, b: F.covar_pop(a, b)
    m = values.groupBy(key).agg(F.count("*").alias("n"), c(x, x).alias("xx"), c(s, s).alias("ss"), c(x, s).alias("xs"), c(x, y).alias("xy"), c(s, y).alias("sy"), c(y, y).alias("yy"))
    m = m.where("n > 3 AND xx > 0").withColumn("rs", F.col("ss") - F.col("xs") * F.col("xs") / F.col("xx")).where("rs > 1e-12")
    m = m.withColumn("k", (F.col("sy") - F.col("xs") * F.col("xy") / F.col("xx")) / F.col("rs")).withColumn("before", F.greatest(F.col("yy") - F.col("xy") * F.col("xy") / F.col("xx"), F.lit(0.0)))
    m = m.withColumn("after", F.greatest(F.col("before") - F.col("k") * F.col("k") * F.col("rs"), F.lit(0.0)))
    return m.select(key, "n", "k", F.sqrt(F.col("after") / (F.col("n") - 3) / F.col("rs")).alias("k_se"), F.sqrt("before").alias("rms_before"), F.sqrt("after").alias("rms_after"))


def cross_validated_fit(values: DataFrame, key: str, x: str, s: str, y: str, part: Column) -> DataFrame:
    """``key, n, corr, retained, vif, cv_reduced, cv_full``: can s be told from a trend over x, and does it help on rows held out?

    ``corr`` is that of s and x, ``retained`` the share of s (as a root mean square) that the trend leaves, ``vif`` the
    variance inflation. ``part`` deals rows to folds; the two errors are root mean squares over all held-out rows
    of fits to the rest, by x alone and with s. One aggregation has the moments of each fold; a fit's are the total less its
    fold, and a fold's error follows from its own moments. Null where a fit has too few rows or s is no more than the trend; rows all in one fold are left out.
    """
    names = {"1": F.lit(1.0), "x": F.col(x).cast("double"), "s": F.col(s).cast("double"), "y": F.col(y).cast("double")}
    pairs = [(a, b) for i, a in enumerate(names) for b in list(names)[i:]]
    moments = values.groupBy(key, part.alias("fold")).agg(*[F.sum(names[a] * names[b]).alias(f"g{a}{b}") for a, b in pairs])
    total = moments.groupBy(key).agg(F.collect_list(F.struct("fold", *[f"g{a}{b}" for a, b in pairs])).alias("parts"), *[F.sum(f"g{a}{b}").alias(f"t{a}{b}") for a, b in pairs])

    def centred(rows: DataFrame, head: str, to: str) -> DataFrame:
        mean = {f"{to}m{a}": F.col(f"{head}1{a}") / F.col(f"{head}11") for a in "xsy"}
        about = {f"{to}{a}{b}": F.col(f"{head}{a}{b}") - F.col(f"{head}1{a}") * F.col(f"{to}m{b}") for a, b in (("x", "x"), ("s", "s"), ("x", "s"), ("x", "y"), ("s", "y"))}
        return rows.withColumns(mean).withColumns(about)

    whole = centred(total, "t", "c").withColumn("rho", F.col("cxs") / F.sqrt(F.nullif(F.col("cxx") * F.col("css"), F.lit(0.0))))
    fits = whole.select(key, "t11", "rho", *[f"t{a}{b}" for a, b in pairs], F.inline("parts")).withColumns({f"r{a}{b}": F.col(f"t{a}{b}") - F.col(f"g{a}{b}") for a, b in pairs})
    fits = centred(fits.where("r11 > 0"), "r", "c").withColumn("left", F.col("css") - F.col("cxs") * F.col("cxs") / F.nullif(F.col("cxx"), F.lit(0.0)))
    able = F.coalesce((F.col("r11") >= 3) & (F.col("cxx") > 0) & (F.col("left") > 1e-9), F.lit(False))
    fits = fits.withColumn("able", able).withColumn("k", F.when(F.col("able"), (F.col("csy") - F.col("cxs") * F.col("cxy") / F.col("cxx")) / F.col("left")))
    for name, slope in (("reduced", F.lit(0.0)), ("full", F.col("k"))):
        fits = fits.withColumn("vs", slope).withColumn("vx", (F.col("cxy") - F.col("vs") * F.col("cxs")) / F.nullif(F.col("cxx"), F.lit(0.0)))
        fits = fits.withColumn("v1", F.col("cmy") - F.col("vx") * F.col("cmx") - F.col("vs") * F.col("cms")).withColumn("vy", F.lit(-1.0))
        # The squared errors of the held-out rows, from their own moments.
        fits = fits.withColumn(name, sum((F.lit(1.0 if a == b else 2.0) * F.col(f"v{a}") * F.col(f"v{b}") * F.col(f"g{a}{b}") for a, b in pairs), F.lit(0.0)))
    rms = lambda c: F.when(F.bool_and("able"), F.sqrt(F.greatest(F.sum(c), F.lit(0.0)) / F.first("t11")))
    out = fits.groupBy(key).agg(F.first("t11").cast("long").alias("n"), F.first("rho").alias("corr"), rms("reduced").alias("cv_reduced"), rms("full").alias("cv_full"))
    apart = F.greatest(1 - F.col("corr") * F.col("corr"), F.lit(0.0))
    return out.select(key, "n", "corr", F.sqrt(apart).alias("retained"), (1 / F.nullif(apart, F.lit(0.0))).alias("vif"), "cv_reduced", "cv_full")


def agreement(pairs: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """``key, agreement, median_abs``: length of the mean unit vector of phase differences, and their median size."""
    off = F.col(a) - F.col(b)
    return pairs.groupBy(key).agg(F.hypot(F.avg(F.cos(off)), F.avg(F.sin(off))).alias("agreement"), F.median(F.abs(F.atan2(F.sin(off), F.cos(off)))).alias("median_abs"))


def neighbour_similarity(edges: DataFrame, wide: DataFrame, epochs: int) -> DataFrame:
    """``point_id, neighbors, similarity``: median over a point's edges of the mean cosine of phase differences."""
    at = lambda name: wide.select(F.col("point_id").alias(name), *[F.col(f"th{t}").alias(f"{name}{t}") for t in range(epochs)])
    mean = sum((F.cos(F.col(f"v{t}") - F.col(f"u{t}")) for t in range(epochs)), F.lit(0.0)) / epochs
    rows = edges.select("u", "v").join(at("u"), "u").join(at("v"), "v").select("u", "v", mean.alias("mean"))
    return rows.select("mean", F.explode(F.array("u", "v")).alias("point_id")).groupBy("point_id").agg(F.count("*").alias("neighbors"), F.median("mean").alias("similarity"))


def epoch_rates(values: DataFrame) -> DataFrame:
    """``point_id, n, rate, rms`` of ``values(point_id, t, phase)`` against the median of each epoch over all points."""
    values = settle(values, "series")
    middle = medians(values, ["t"], "phase", "ref_median")
    return rates(subtract_reference(values, middle), "point_id", "t", "phase")


def quadrants(values: DataFrame, row: int, col: int, half_rows: int, half_cols: int) -> DataFrame:
    """``t, q0..q3, spread``: medians of a window's four quarters by epoch, and how far apart they are."""
    inside = values.where((F.abs(F.col("r") - row) <= half_rows) & (F.abs(F.col("c") - col) <= half_cols))
    quarter = 2 * (F.col("r") > row).cast("int") + (F.col("c") > col).cast("int")
    middles = medians(inside.withColumn("q", quarter), ["t", "q"], "phase", "middle")
    rows = middles.groupBy("t").agg(*[F.max(F.when(F.col("q") == q, F.col("middle"))).alias(f"q{q}") for q in range(4)])
    names = [f"q{q}" for q in range(4)]
    return rows.withColumn("spread", F.greatest(*names) - F.least(*names))


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The n rows with the least hash of key and seed: the same rows on every run and layout."""
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)
