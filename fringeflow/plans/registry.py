"""Named queries over the supplied tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fringeflow.functions.phase import tidy
from fringeflow.operators import amplitude, coherence, components, corrections, linking, network, sequential, series, similarity, spatial, support, unwrap
from fringeflow.plans import oracle, temporal
from fringeflow.plans import scene as S
from fringeflow.plans.lineage import settle
from fringeflow.plans.oracle import build, x6
from fringeflow.streaming import windows

PAIRS = [(i, j) for i in range(S.EPOCHS) for j in (i + 1, i + 2) if j < S.EPOCHS]
TRIANGLES = [(PAIRS.index((a, a + 1)), PAIRS.index((a + 1, a + 2)), PAIRS.index((a, a + 2))) for a in range(S.EPOCHS - 2)]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


# Steps that several queries share.


def _stats(spark, d) -> DataFrame:
    return amplitude.with_ps_flag(amplitude.amplitude_statistics(S.samples(spark, d), S.EPOCHS), S.ADI_MAX)


def _support(stats: DataFrame) -> DataFrame:
    return support.glrt_support(stats, S.EPOCHS, S.HALF_ROWS, S.HALF_COLS, S.ALPHA)


def _pixels(spark, d) -> DataFrame:
    return coherence.wide(S.samples(spark, d), S.EPOCHS)


def _coherence(spark, d) -> DataFrame:
    return coherence.coherence_wide(_support(_stats(spark, d)), _pixels(spark, d), S.EPOCHS)


def _own_phase(pixels: DataFrame) -> DataFrame:
    return pixels.select("point_id", *[F.atan2(f"im{t}", f"re{t}").alias(f"th{t}") for t in range(S.EPOCHS)])


def _full(spark, d) -> DataFrame:
    """Samples of points that have every epoch."""
    samples = S.samples(spark, d)
    full = samples.groupBy("point_id").agg(F.count("*").alias("n")).where(F.col("n") == S.EPOCHS).select("point_id")
    return samples.join(full, "point_id", "left_semi")


def _ifgs(spark, d) -> DataFrame:
    return unwrap.virtual_ifgs(_full(spark, d).select("point_id", "t", "phase"), unwrap.pair_table(spark, PAIRS))


def _knn(spark, d) -> DataFrame:
    return _near(_stats(spark, d).select("point_id", "r", "c"))


def _near(points: DataFrame) -> DataFrame:
    return spatial.nearest(points, 4, 8, S.AZIMUTH_M, S.RANGE_M)


def _grads(spark, d) -> DataFrame:
    return unwrap.gradients(_ifgs(spark, d), _knn(spark, d))


def _some(spark, d) -> DataFrame:
    return _stats(spark, d).where(F.col("adi") <= S.POINT_ADI).select("point_id", "r", "c")


def _candidates(spark, d) -> DataFrame:
    return network.candidates(S.acquisitions(spark, d), S.MOST_DAYS, S.MOST_METRES)


def _net(spark, d, side: int = 3) -> DataFrame:
    return network.directional(_candidates(spark, d), side)


def _unsafe_points(spark, d) -> DataFrame:
    """Points of whose edges more than half are unsafe."""
    ends = _grads(spark, d).select("g", F.explode(F.array("u", "v")).alias("point_id"))
    return ends.groupBy("point_id").agg(F.avg((F.abs("g") > unwrap.SAFE).cast("double")).alias("share")).where("share > 0.5").select("point_id")


def _integers(spark, d) -> DataFrame:
    return unwrap.integer_closures(unwrap.triangle_closures(_ifgs(spark, d), TRIANGLES))


# Amplitudes and selection.


@query(build(f"SELECT point_id, r, c, n, {x6('mean_amp')} AS mean_amp, {x6('var_amp')} AS var_amp, {x6('scale2')} AS scale2, {x6('adi')} AS adi FROM stats", "stats"))
def amplitude_statistics(spark, d):
    return amplitude.amplitude_statistics(S.samples(spark, d), S.EPOCHS).select("point_id", "r", "c", "n", *[tidy(F.col(x)).alias(x) for x in ("mean_amp", "var_amp", "scale2", "adi")])


@query(build(f"SELECT point_id, r, c, {x6('adi')} AS adi FROM flagged WHERE ps", "flagged"))
def ps_selection(spark, d):
    return _stats(spark, d).where("ps").select("point_id", "r", "c", tidy(F.col("adi")).alias("adi"))


@query(build(f"SELECT point_id, {x6(f'count(*) / {float(S.EPOCHS)}')} AS valid_fraction, {x6('stddev_pop(amp) / avg(amp)')} AS adi FROM samples GROUP BY point_id HAVING count(*) / {float(S.EPOCHS)} >= 0.8 AND avg(amp) > 0 AND stddev_pop(amp) / avg(amp) <= {S.ADI_MAX}", "samples"))
def ps_selection_fractional(spark, d):
    return amplitude.ps_selection_fractional(S.samples(spark, d), S.EPOCHS, S.ADI_MAX, 0.8).select("point_id", tidy(F.col("valid_fraction")).alias("valid_fraction"), tidy(F.col("adi")).alias("adi"))


@query(build("SELECT point_id, t, amp FROM samples WHERE r BETWEEN 1 AND 30 AND c BETWEEN 10 AND 29 AND t IN (1, 3, 5)", "samples"))
def roi_scan(spark, d):
    return amplitude.window_scan(S.samples(spark, d), (1, 30), (10, 29), [1, 3, 5]).select("point_id", "t", "amp")


@query(build(f", o AS (SELECT point_id, median(ln(amp)) AS own FROM samples GROUP BY 1) SELECT t, {x6('median(ln(amp) - own)')} AS gain_log FROM samples JOIN o USING (point_id) GROUP BY t", "samples"))
def acquisition_gain(spark, d):
    return amplitude.acquisition_gain(S.samples(spark, d)).select("t", tidy(F.col("gain_log")).alias("gain_log"))


@query(build("SELECT threshold, count(*) FILTER (median_coh >= threshold) AS direct, count(*) FILTER (median_coh < threshold) AS fallback FROM median_coh, (SELECT CAST(unnest([0.3, 0.35, 0.4, 0.45, 0.5]) AS DOUBLE) AS threshold) GROUP BY 1", "median_coh"))
def quality_sweep(spark, d):
    return amplitude.two_way_threshold_counts(coherence.median_coherence(_coherence(spark, d), S.EPOCHS), "median_coh", [0.3, 0.35, 0.4, 0.45, 0.5])


# Neighbourhoods and states.


@query(build(f"SELECT center_id, neighbor_id, {x6('stat')} AS stat FROM support", "support"))
def glrt_support(spark, d):
    return _support(_stats(spark, d)).select("center_id", "neighbor_id", tidy(F.col("stat")).alias("stat"))


@query(build("SELECT center_id, k FROM counts", "counts"))
def shp_count(spark, d):
    stats = _stats(spark, d)
    return support.shp_count(stats, _support(stats))


@query(build("SELECT center_id, CAST(sum(CAST(1 AS BIGINT) << bit) AS BIGINT) AS word_0, count(*) AS k FROM support GROUP BY 1", "support"))
def support_bitset(spark, d):
    return support.support_bits(_support(_stats(spark, d)))


@query(oracle.state_core_sql() + "\nSELECT point_id, effective_k FROM s14")
def state_core(spark, d):
    stats = _stats(spark, d)
    edges = settle(_support(stats), "support")
    return support.state_core(edges, support.shp_count(stats, edges), S.STATE_K)


@query(oracle.state_core_sql() + f"""
, eff AS (SELECT e.center_id, count(*) AS effective_k FROM support e JOIN s14 b ON b.point_id = e.neighbor_id GROUP BY 1)
SELECT f.point_id, CASE WHEN NOT ps AND coalesce(k, 0) >= {S.FORMAL_K} AND coalesce(effective_k, 0) >= {S.FORMAL_K} THEN 'sequential' WHEN NOT ps AND coalesce(k, 0) >= {S.FORMAL_K} THEN 'fallback' ELSE 'outside' END AS route
FROM flagged f LEFT JOIN counts ON counts.center_id = f.point_id LEFT JOIN eff ON eff.center_id = f.point_id""")  # fmt: skip
def routing(spark, d):
    stats = settle(_stats(spark, d), "stats")
    edges = settle(_support(stats), "support")
    counts = support.shp_count(stats, edges)
    effective = support.effective_counts(edges, support.state_core(edges, counts, S.STATE_K))
    return support.routing(stats, counts, effective, S.FORMAL_K)


# Coherence and linking.


@query(build(f"SELECT center_id, i, j, {x6('sqrt(cre * cre + cim * cim)')} AS coh_abs, round(atan2(cim, cre), 5) + 0.0 AS coh_phase FROM coh", "coh"))
def pair_coherence(spark, d):
    rows = coherence.coherence_long(_coherence(spark, d), S.EPOCHS)
    return rows.select("center_id", "i", "j", tidy(F.hypot("cre", "cim")).alias("coh_abs"), tidy(F.atan2("cim", "cre"), 5).alias("coh_phase"))


@query(build(f"SELECT center_id, {x6('median_coh')} AS median_coh FROM median_coh", "median_coh"))
def median_pair_coherence(spark, d):
    return coherence.median_coherence(_coherence(spark, d), S.EPOCHS).select("center_id", tidy(F.col("median_coh")).alias("median_coh"))


def _tc(spark, d) -> DataFrame:
    return coherence.temporal_coherence(_coherence(spark, d), _own_phase(_pixels(spark, d)), S.EPOCHS)


@query(build(f"SELECT center_id, {x6('tc')} AS tc FROM tc", "tc"))
def temporal_coherence(spark, d):
    return _tc(spark, d).select("center_id", tidy(F.col("tc")).alias("tc"))


@query(build(f"""
, th AS (SELECT center_id AS point_id, t, atan2(sum(im), sum(re)) AS a FROM support JOIN full_z ON point_id = neighbor_id GROUP BY ALL),
rel AS (SELECT point_id, t, a - first_value(a) OVER (PARTITION BY point_id ORDER BY t) AS th FROM th)
SELECT point_id, {x6('avg(amp)')} AS amp, round(atan2(sum(im * cos(th) - re * sin(th)), sum(re * cos(th) + im * sin(th))), 5) + 0.0 AS phase FROM rel JOIN full_z USING (point_id, t) GROUP BY point_id""", "support", "full_z"))  # fmt: skip
def compressed_slc(spark, d):
    pixels = _pixels(spark, d)
    theta = coherence.mean_phase(_support(_stats(spark, d)), pixels, S.EPOCHS)
    return coherence.compress(pixels, theta, 0, S.EPOCHS).select("point_id", tidy(F.col("amp")).alias("amp"), tidy(F.col("phase"), 5).alias("phase"))


@query()
def emi_phase_linking(spark, d):
    rows = linking.link_phases(_coherence(spark, d), S.EPOCHS)
    return rows.select("center_id", "estimator", F.posexplode("phase").alias("t", "phase"))


@query()
def linked_quality(spark, d):
    """Temporal coherence of the linked phases over all epochs, with the estimator that gave them."""
    rows = settle(_coherence(spark, d), "coherence")
    linked = settle(linking.link_phases(rows, S.EPOCHS), "linked")
    theta = linked.select(F.col("center_id").alias("point_id"), *[F.col("phase")[t].alias(f"th{t}") for t in range(S.EPOCHS)])
    return coherence.temporal_coherence(rows, theta, S.EPOCHS).join(linked.select("center_id", "estimator"), "center_id")


@query(build("""
, n AS (SELECT count(*) AS n FROM acq), k AS (SELECT unnest(generate_series(0, CAST(ceil(n / 15.0) AS INT) - 1)) AS stage, n FROM n)
SELECT CAST(stage AS INT) AS stage, CAST(stage * 15 AS INT) AS real_start, CAST(least(n, stage * 15 + 15) AS INT) AS real_stop, CAST(stage AS INT) AS n_compressed, CAST(least(n, stage * 15 + 15) - stage * 15 + stage AS INT) AS solver_size FROM k""", "acq"))  # fmt: skip
def sequential_plan(spark, d):
    epochs = S.acquisitions(spark, d).count()
    rows = [(s.number, s.start, s.stop, len(s.compressed), s.solver_size) for s in temporal.sequential_plan(epochs, 15)]
    return spark.createDataFrame(rows, "stage int, real_start int, real_stop int, n_compressed int, solver_size int")


def _ds(spark, d) -> DataFrame:
    stats = _stats(spark, d)
    rows = settle(coherence.coherence_wide(_support(stats), _pixels(spark, d), S.EPOCHS), "coherence")
    tc = coherence.temporal_coherence(rows, _own_phase(_pixels(spark, d)), S.EPOCHS)
    quality = tc.join(coherence.median_coherence(rows, S.EPOCHS), "center_id").withColumnRenamed("center_id", "point_id")
    points = stats.join(quality, "point_id").withColumn("estimator", F.lit(linking.EMI))
    return linking.ds_selection(points, 0.2, 0.3).select("point_id", "r", "c", "tc", "median_coh")


@query(build("SELECT point_id FROM ds", "ds"))
def ds_selection(spark, d):
    return _ds(spark, d).select("point_id")


@query(build(f"""
, p AS (SELECT point_id, r, c, 1 AS point_type, CAST(NULL AS DOUBLE) AS tc FROM flagged WHERE ps UNION ALL SELECT point_id, r, c, 2, {x6('tc')} FROM ds WHERE point_id NOT IN (SELECT point_id FROM flagged WHERE ps))
SELECT row_number() OVER (ORDER BY r, c) - 1 AS point_no, point_id, r, c, point_type, tc FROM p""", "flagged", "ds"))  # fmt: skip
def point_stack(spark, d):
    ps = settle(_stats(spark, d).where("ps"), "ps").select("point_id", "r", "c", F.lit(1).alias("point_type"), F.lit(None).cast("double").alias("tc"))
    ds = _ds(spark, d).join(ps.select("r", "c"), ["r", "c"], "left_anti").select("point_id", "r", "c", F.lit(2).alias("point_type"), tidy(F.col("tc")).alias("tc"))
    return amplitude.point_numbers(settle(ps.unionByName(ds), "points")).select("point_no", "point_id", "r", "c", "point_type", "tc")


# The epoch network.


@query(build(f"SELECT i, j, dt_days, {x6('dbperp')} AS dbperp, {x6('score')} AS score FROM cand", "cand"))
def network_candidates(spark, d):
    return _candidates(spark, d).select("i", "j", "dt_days", tidy(F.col("dbperp")).alias("dbperp"), tidy(F.col("score")).alias("score"))


@query(build(f"SELECT i, j, {x6('score')} AS score FROM net", "net"))
def network_directional(spark, d):
    return _net(spark, d).select("i", "j", tidy(F.col("score")).alias("score"))


@query("WITH RECURSIVE " + build("", "net1").removeprefix("WITH ").rstrip() + ", b AS (SELECT i, j FROM net1 UNION ALL SELECT j, i FROM net1), w AS (SELECT i AS node, i AS root FROM b UNION SELECT b.j, w.root FROM w JOIN b ON b.i = w.node) SELECT node, min(root) AS component FROM w GROUP BY node")
def network_components(spark, d):
    edges = _net(spark, d, 1).select(F.col("i").alias("u"), F.col("j").alias("v"))
    return components.connected_components(edges).select(F.col("node").cast("int").alias("node"), F.col("component").cast("int").alias("component"))


@query(build("SELECT i AS node, count(*) AS degree, count(*) FILTER (j < i) AS left, count(*) FILTER (j > i) AS right FROM twoway GROUP BY i", "twoway"))
def network_degree(spark, d):
    return network.degrees(_net(spark, d))


@query(build("SELECT x.i AS a, x.j AS b, y.j AS c FROM net x JOIN net y ON y.i = x.j JOIN net w ON w.i = x.i AND w.j = y.j", "net"))
def network_triangles(spark, d):
    return network.triangles(_net(spark, d))


@query(oracle.cycle_counts_sql())
def network_cycles(spark, d):
    return network.cycle_counts(_net(spark, d))


@query("WITH RECURSIVE " + build("", "net1").removeprefix("WITH ").rstrip() + ", b AS (SELECT i, j FROM net1 UNION ALL SELECT j, i FROM net1), w AS (SELECT i AS ei, j AS ej, i AS node FROM net1 UNION SELECT w.ei, w.ej, b.j FROM w JOIN b ON b.i = w.node AND NOT (b.i = w.ei AND b.j = w.ej) AND NOT (b.j = w.ei AND b.i = w.ej)) SELECT i, j FROM net1 WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.ei = net1.i AND w.ej = net1.j AND w.node = net1.j)")
def network_bridges(spark, d):
    return network.bridges(_net(spark, d, 1))


# Interferograms and closures.


@query(build(f"SELECT pair_id, point_id, {x6('phase')} AS phase FROM ifg", "ifg"))
def virtual_ifg(spark, d):
    return _ifgs(spark, d).select("pair_id", "point_id", tidy(F.col("phase")).alias("phase"))


@query(build("SELECT triangle_id, round(avg(abs(atan2(sin(closure), cos(closure)))), 6) + 0.0 AS mean_abs, round(max(abs(atan2(sin(closure), cos(closure)))), 6) + 0.0 AS max_abs, count(*) FILTER (abs(atan2(sin(closure), cos(closure))) > 1e-4) AS above_1e4, count(*) AS points FROM closure GROUP BY 1", "closure"))
def triangle_closure(spark, d):
    rows = unwrap.closure_summary(unwrap.triangle_closures(_ifgs(spark, d), TRIANGLES))
    return rows.select("triangle_id", tidy(F.col("mean_abs")).alias("mean_abs"), tidy(F.col("max_abs")).alias("max_abs"), "above_1e4", "points")


@query(build("SELECT triangle_id, modal_k, CAST(bad_points AS BIGINT) AS bad_points FROM modes", "modes"))
def integer_closure(spark, d):
    return unwrap.modal_closures(_integers(spark, d))


@query(build(", p AS (SELECT point_id, string_agg(CAST(k AS VARCHAR), ',' ORDER BY triangle_id) AS pattern FROM ints GROUP BY 1) SELECT pattern, count(*) AS points FROM p GROUP BY 1", "ints"))
def correction_patterns(spark, d):
    return unwrap.correction_patterns(_integers(spark, d))


@query(build("""
, p AS (SELECT point_id, string_agg(CAST(k AS VARCHAR), ',' ORDER BY triangle_id) AS signature FROM ints GROUP BY 1),
bad AS (SELECT p AS point_id FROM (SELECT u AS p, g FROM grad UNION ALL SELECT v, g FROM grad) GROUP BY 1 HAVING avg(CAST(abs(g) > pi() / 2 AS INT)) > 0.5)
SELECT signature, count(*) AS size, count(bad.point_id) AS bad_points, CASE WHEN count(bad.point_id) = 0 THEN 'good' WHEN count(bad.point_id) = count(*) THEN 'bad' ELSE 'mixed' END AS status FROM p LEFT JOIN bad USING (point_id) GROUP BY 1""", "ints", "grad"))  # fmt: skip
def signature_groups(spark, d):
    """Points that share the whole turns around every triangle, and how many of them lie on mostly unsafe edges."""
    labels = _integers(spark, d).select("point_id", F.col("triangle_id").alias("pair_id"), F.col("k").alias("label"))
    return unwrap.signature_groups(labels, _unsafe_points(spark, d))


# Spatial graphs.


@query(build(f"SELECT u, v, {x6('dist')} AS dist FROM knn", "knn"))
def spatial_knn(spark, d):
    return _knn(spark, d).select("u", "v", tidy(F.col("dist")).alias("dist"))


@query(build("SELECT component, count(*) AS size FROM comp GROUP BY 1", "comp"))
def spatial_components(spark, d):
    return spatial.component_sizes(spatial.grid_components(_some(spark, d), 1))


@query(build(f", s AS (SELECT component, count(*) AS size FROM comp GROUP BY 1) SELECT count(*) AS components, CAST(sum(size) AS BIGINT) AS points, max(size) AS largest, {x6('max(size) / sum(size)')} AS largest_share, count(*) FILTER (size = 1) AS singletons, count(*) FILTER (size <= 10) AS upto_10, count(*) FILTER (size <= 100) AS upto_100 FROM s", "comp"))
def component_summary(spark, d):
    rows = spatial.size_summary(spatial.component_sizes(spatial.grid_components(_some(spark, d), 1)))
    return rows.withColumn("largest_share", tidy(F.col("largest_share")))


@query(build("SELECT greatest(abs(a.r - b.r), abs(a.c - b.c)) AS radius, count(*) AS edges FROM stats a JOIN stats b ON abs(a.r - b.r) <= 6 AND abs(a.c - b.c) <= 6 AND (b.r > a.r OR b.r = a.r AND b.c > a.c) GROUP BY 1", "stats"))
def shell_edges(spark, d):
    return spatial.shell_edges(_stats(spark, d).select("point_id", "r", "c"), 6)


@query(build("SELECT a.point_id, count(b.point_id) FILTER (abs(a.r - b.r) + abs(a.c - b.c) = 1) AS degree4, count(b.point_id) AS degree8 FROM chosen a LEFT JOIN chosen b ON abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 AND a.point_id <> b.point_id GROUP BY 1", "chosen"))
def occupancy_degrees(spark, d):
    return spatial.occupancy_degrees(_some(spark, d))


@query(build("SELECT component, CAST(rank AS INT) AS rank, p, q, radius2, class FROM anchor", "anchor"))
def anchors(spark, d):
    points = settle(_some(spark, d), "points")
    return spatial.anchors(points, spatial.grid_components(points, 1), 30)


@query(build("SELECT radius, count(*) FILTER (radius2 <= radius * radius) AS covered FROM anchor, (SELECT unnest([1, 2, 3, 5, 10, 20, 30]) AS radius) WHERE rank = 2 GROUP BY 1", "anchor"))
def anchor_coverage(spark, d):
    points = settle(_some(spark, d), "points")
    found = spatial.anchors(points, spatial.grid_components(points, 1), 30).where("rank = 2")
    radii = [1, 2, 3, 5, 10, 20, 30]
    sums = found.agg(*[F.count_if(F.col("radius2") <= r * r).alias(f"n{r}") for r in radii])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(r).alias("radius"), F.col(f"n{r}").alias("covered")) for r in radii])))


@query(build(f"SELECT a.pair_id, component, CAST(min(round_even((b.phase - a.phase - atan2(sin(b.phase - a.phase), cos(b.phase - a.phase))) / {oracle.TAU}::DOUBLE, 0)) AS INT) AS shift, min(round_even((b.phase - a.phase - atan2(sin(b.phase - a.phase), cos(b.phase - a.phase))) / {oracle.TAU}::DOUBLE, 0)) = max(round_even((b.phase - a.phase - atan2(sin(b.phase - a.phase), cos(b.phase - a.phase))) / {oracle.TAU}::DOUBLE, 0)) AS agree, count(*) AS anchors FROM anchor JOIN ifg a ON a.point_id = p JOIN ifg b ON b.point_id = q AND a.pair_id = b.pair_id GROUP BY 1, 2", "anchor", "ifg"))
def residual_registration(spark, d):
    points = settle(_some(spark, d), "points")
    return unwrap.registration(spatial.anchors(points, spatial.grid_components(points, 1), 30), _ifgs(spark, d))


# Gradients, fragments and unwrapping.


@query(build(f"SELECT pair_id, count(*) AS edges, {x6('avg(abs(g))')} AS mean_abs, {x6(f'avg(CAST(abs(g) > {oracle.PI}::DOUBLE / 2 AS INT))')} AS frac_pi2, {x6(f'avg(CAST(abs(g) > 2 * {oracle.PI}::DOUBLE / 3 AS INT))')} AS frac_2pi3, {x6(f'avg(CAST(abs(g) > 0.9::DOUBLE * {oracle.PI}::DOUBLE AS INT))')} AS frac_09pi, {x6('quantile_cont(abs(g), 0.9)')} AS p90 FROM grad GROUP BY 1", "grad"))
def gradient_stats(spark, d):
    rows = unwrap.gradient_stats(_grads(spark, d))
    return rows.select("pair_id", "edges", *[tidy(F.col(x)).alias(x) for x in ("mean_abs", "frac_pi2", "frac_2pi3", "frac_09pi", "p90")])


@query(build(f", h AS (SELECT CAST(least(floor(abs(g) / {oracle.PI}::DOUBLE * 180), 179) AS INT) AS bin, count(*) AS n FROM grad GROUP BY 1) SELECT bin, n, {x6('sum(n) OVER (ORDER BY bin) / sum(n) OVER ()')} AS cdf FROM h", "grad"))
def gradient_histogram(spark, d):
    return unwrap.gradient_histogram(_grads(spark, d)).withColumn("cdf", tidy(F.col("cdf")))


@query(build("""
, bad AS (SELECT p.i, p.j, abs(atan2(sin(vi.phase - ui.phase), cos(vi.phase - ui.phase))) AS gi, abs(atan2(sin(vj.phase - uj.phase), cos(vj.phase - uj.phase))) AS gj
  FROM grad JOIN pairs p USING (pair_id) JOIN full_z ui ON ui.point_id = u AND ui.t = i JOIN full_z vi ON vi.point_id = v AND vi.t = i JOIN full_z uj ON uj.point_id = u AND uj.t = j JOIN full_z vj ON vj.point_id = v AND vj.t = j WHERE abs(g) > pi() / 2),
w AS (SELECT i, j, CASE WHEN gi > gj + 0.15 THEN i WHEN gj > gi + 0.15 THEN j END AS winner FROM bad)
SELECT t, count(*) FILTER (winner = t) AS wins, count(*) FILTER (winner IS NULL) AS ties FROM (SELECT i AS t, winner FROM w UNION ALL SELECT j, winner FROM w) GROUP BY t""", "grad", "full_z"))  # fmt: skip
def conflict_attribution(spark, d):
    phases = _full(spark, d).select("point_id", "t", "phase")
    return unwrap.attribution(_grads(spark, d), phases, unwrap.pair_table(spark, PAIRS))


@query(build(f"""
, piece AS (SELECT pair_id, point_id, phase, CAST(r // 4 AS BIGINT) AS piece FROM ifg),
votes AS (SELECT g.pair_id, least(a.piece, b.piece) AS frag_a, greatest(a.piece, b.piece) AS frag_b,
   CAST(CASE WHEN a.piece > b.piece THEN -1 ELSE 1 END * round_even((b.phase - a.phase - g) / {oracle.TAU}::DOUBLE, 0) AS INT) AS shift, abs(g) AS size, dist
   FROM grad g JOIN piece a ON a.pair_id = g.pair_id AND a.point_id = u JOIN piece b ON b.pair_id = g.pair_id AND b.point_id = v WHERE a.piece <> b.piece),
m AS (SELECT pair_id, frag_a, frag_b, shift, count(*) AS mode_count, row_number() OVER (PARTITION BY pair_id, frag_a, frag_b ORDER BY count(*) DESC, shift) AS rank FROM votes GROUP BY 1, 2, 3, 4)
SELECT v.pair_id, v.frag_a, v.frag_b, count(*) AS edge_count, any_value(m.shift) AS mode_shift, any_value(mode_count) AS mode_count, {x6('any_value(mode_count) / count(*)')} AS ratio, any_value(mode_count) = count(*) AS exact, {x6('median(v.size)')} AS median_abs, {x6('min(v.size)')} AS min_abs, {x6('median(v.dist)')} AS median_dist
FROM votes v JOIN m ON m.pair_id = v.pair_id AND m.frag_a = v.frag_a AND m.frag_b = v.frag_b AND rank = 1 GROUP BY 1, 2, 3""", "grad", "ifg"))  # fmt: skip
def fragment_votes(spark, d):
    """Votes between bands of four rows, each taken as one piece."""
    ifgs, edges = _ifgs(spark, d), settle(_knn(spark, d), "knn")
    bands = _stats(spark, d).select("point_id", F.expr("r div 4").alias("piece"))
    labelled = ifgs.join(bands, "point_id").withColumnRenamed("phase", "value")
    rows = unwrap.fragment_votes(unwrap.gradients(ifgs, edges), labelled, edges)
    return rows.select("pair_id", "frag_a", "frag_b", "edge_count", "mode_shift", "mode_count", tidy(F.col("ratio")).alias("ratio"), "exact", *[tidy(F.col(x)).alias(x) for x in ("median_abs", "min_abs", "median_dist")])


def _pieces(spark, d, tile: tuple[int, int] = (128, 256), labelled: bool = False) -> tuple[DataFrame, DataFrame]:
    """Interferograms unwrapped inside tiles, with their fragments if ``labelled``, and the votes between those pieces."""
    ifgs, points = settle(_ifgs(spark, d), "ifgs"), settle(_stats(spark, d).select("point_id", "r", "c"), "points")
    edges = settle(unwrap.inner_blocks(_near(points), points, tile), "knn")
    grads = settle(unwrap.gradients(ifgs, edges, ("block",)), "gradients")
    pieces = unwrap.unwrap_fragments(ifgs, grads, unwrap.safe_fragments(grads, ifgs) if labelled else None, points, tile)
    pieces = settle(pieces, "pieces")
    return pieces, unwrap.phase_votes(pieces, edges)


@query()
def unwrap_single_ifg(spark, d):
    """Every interferogram unwrapped along safe edges inside fragments and tiles, whose pieces are tied by votes."""
    pieces, votes = _pieces(spark, d, labelled=True)
    return unwrap.tie_pieces(pieces, unwrap.piece_shifts(votes)).select("pair_id", "point_id", "fragment", "root", "unwrapped")


@query()
def safe_fragments(spark, d):
    ifgs = settle(_ifgs(spark, d), "ifgs")
    return unwrap.safe_fragments(unwrap.gradients(ifgs, _knn(spark, d)), ifgs)


# Series and references.

_WEIGHTS = network.inversion_weights(PAIRS, S.EPOCHS)


@query(oracle.inversion_sql(_WEIGHTS))
def network_inversion(spark, d):
    return series.invert(_ifgs(spark, d), _WEIGHTS).select("point_id", "t", tidy(F.col("phase")).alias("phase"))


@query(build(f", w AS (SELECT t, phase FROM full_z WHERE abs(r - 2) <= 2 AND abs(c - 20) <= 15), m AS (SELECT t, count(*) AS points, median(phase) AS ref_median FROM w GROUP BY t HAVING count(*) >= 100) SELECT t, points, {x6('ref_median')} AS ref_median, {x6('1.4826::DOUBLE * median(abs(phase - ref_median))')} AS mad_sigma FROM w JOIN m USING (t) GROUP BY t, points, ref_median", "full_z"))
def reference_window(spark, d):
    rows = series.reference_window(_full(spark, d), 2, 20, 2, 15)
    return rows.select("t", "points", tidy(F.col("ref_median")).alias("ref_median"), tidy(F.col("mad_sigma")).alias("mad_sigma"))


@query(build(f", m AS (SELECT t, median(phase) AS ref FROM full_z GROUP BY t) SELECT point_id, count(*) AS n, {x6('regr_slope(phase - ref, t)')} AS rate, {x6('sqrt(greatest(regr_syy(phase - ref, t) - pow(regr_sxy(phase - ref, t), 2) / regr_sxx(phase - ref, t), 0) / count(*))')} AS rms FROM full_z JOIN m USING (t) GROUP BY point_id", "full_z"))
def phase_rate(spark, d):
    return series.epoch_rates(_full(spark, d).select("point_id", "t", "phase")).select("point_id", "n", tidy(F.col("rate")).alias("rate"), tidy(F.col("rms")).alias("rms"))


@query(f"SELECT user_id, count(*) AS n, round(regr_slope(value, epoch(ts) / 86400.0 - 19723), 6) + 0.0 AS rate, round(sqrt(greatest(regr_syy(value, epoch(ts) / 86400.0 - 19723) - pow(regr_sxy(value, epoch(ts) / 86400.0 - 19723), 2) / regr_sxx(value, epoch(ts) / 86400.0 - 19723), 0) / count(*)), 6) + 0.0 AS rms FROM events GROUP BY user_id HAVING regr_sxx(value, epoch(ts) / 86400.0 - 19723) > 0")
def event_rate(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet").select("user_id", "value", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 / 86400.0 - 19723).alias("day"))
    return series.rates(events, "user_id", "day", "value").select("user_id", "n", tidy(F.col("rate")).alias("rate"), tidy(F.col("rms")).alias("rms"))


@query(f"WITH m AS (SELECT event_type, median(value) AS middle FROM events GROUP BY 1) SELECT event_type, {x6('middle')} AS middle, {x6('1.4826::DOUBLE * median(abs(value - middle))')} AS mad_sigma FROM events JOIN m USING (event_type) GROUP BY event_type, middle")
def event_spread(spark, d):
    rows = series.robust_sigma(spark.read.parquet(f"{d}/events.parquet").select("event_type", "value"), "event_type", "value")
    return rows.select("event_type", tidy(F.col("middle")).alias("middle"), tidy(F.col("mad_sigma")).alias("mad_sigma"))


@query(build(f"""
, lim AS (SELECT quantile_cont(adi, [0.05, 0.95]) AS a, quantile_cont(scale2, [0.05, 0.95]) AS b FROM stats),
own AS (SELECT r, c, 0.85::DOUBLE * least(greatest((adi - a[1]) / (a[2] - a[1]), 0), 1) + 0.15::DOUBLE * least(greatest((scale2 - b[1]) / (b[2] - b[1]), 0), 1) AS own FROM stats, lim),
box AS (SELECT x.r + dr AS r, x.c + dc AS c, avg(own) AS score FROM own x, (SELECT unnest([-1, 0, 1]) AS dr) p, (SELECT unnest([-1, 0, 1]) AS dc) q GROUP BY 1, 2 HAVING count(*) = 9)
SELECT CAST(row_number() OVER (ORDER BY round(score, 9), r, c) AS INT) AS rank, r, c, {x6('score')} AS score FROM box ORDER BY round(score, 9), r, c LIMIT 25""", "stats"))  # fmt: skip
def reference_candidates(spark, d):
    rows = series.reference_candidates(_stats(spark, d), "adi", "scale2", 1, 25)
    return rows.select("rank", "r", "c", tidy(F.col("score")).alias("score"))


@query(f"WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), p AS (SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.v, b.v) AS s FROM e a JOIN e b ON b.vec_id - a.vec_id BETWEEN 1 AND 5) SELECT vec_id, count(*) AS neighbors, {x6('median(s)')} AS median_similarity FROM (SELECT a AS vec_id, s FROM p UNION ALL SELECT b, s FROM p) GROUP BY 1")
def vector_similarity(spark, d):
    rows = series.vector_similarity(spark.read.parquet(f"{d}/embeddings.parquet"), 5)
    return rows.select("vec_id", "neighbors", tidy(F.col("median_similarity")).alias("median_similarity"))


# Sequences, gauges, corrections and audits.

CYCLES = network.cycle_basis(PAIRS)
_CYCLE_ROWS = ", ".join(f"({k}, {e}, {s})" for k, cycle in enumerate(CYCLES) for e, s in cycle)
_CYCLE_SQL = f"""
, cyc AS (SELECT * FROM (VALUES {_CYCLE_ROWS}) v(triangle_id, pair_id, sign)),
cints AS (SELECT triangle_id, point_id, CAST(round_even(sum(sign * phase) / {oracle.TAU}::DOUBLE, 0) AS INT) AS k FROM ifg JOIN cyc USING (pair_id) GROUP BY ALL),
cmodes AS (SELECT triangle_id, k AS modal_k FROM (SELECT triangle_id, k, row_number() OVER (PARTITION BY triangle_id ORDER BY count(*) DESC, k) AS rank FROM cints GROUP BY 1, 2) WHERE rank = 1)"""


def _cycle_integers(spark, d) -> DataFrame:
    return unwrap.integer_closures(corrections.cycle_closures(_ifgs(spark, d), CYCLES))


@query(build(", " + oracle.prior_sql("samples", S.EPOCHS, 1, 1), "samples"))
def prior_counts(spark, d):
    return similarity.prior_counts(S.samples(spark, d), S.EPOCHS, 1, 1)


@query()
def sequential_phase_linking(spark, d):
    """Ministacks of three epochs over the scene, each carrying what earlier ones compressed."""
    return sequential.run_plan(_support(_stats(spark, d)), _pixels(spark, d), temporal.sequential_plan(S.EPOCHS, 3))


@query()
def sequential_quality(spark, d):
    """Full-span temporal coherence of the sequential phases of points that every stage linked."""
    linked = sequential.run_plan(_support(_stats(spark, d)), _pixels(spark, d), temporal.sequential_plan(S.EPOCHS, 3))
    return coherence.temporal_coherence(_coherence(spark, d), sequential.complete_only(linked, S.EPOCHS), S.EPOCHS)


_TREE = network.tree_weights(PAIRS, S.EPOCHS)


@query(build(f"SELECT point_id, round(max(abs(d)), 6) + 0.0 AS tree_gap FROM (SELECT point_id, t, sum(w * phase) AS d FROM ifg JOIN (VALUES {', '.join(f'({e}, {t}, {float(_WEIGHTS[t, e] - _TREE[t, e])!r}::DOUBLE)' for e in range(len(PAIRS)) for t in range(S.EPOCHS))}) v(pair_id, t, w) USING (pair_id) GROUP BY ALL) GROUP BY 1", "ifg"))
def tree_parity(spark, d):
    """How far the least-squares series is from the one integrated along a spanning tree."""
    gap = series.invert(_ifgs(spark, d), _WEIGHTS - _TREE)
    return gap.groupBy("point_id").agg(tidy(F.max(F.abs("phase"))).alias("tree_gap"))


@query(build(f"{_CYCLE_SQL} SELECT p.pair_id, CAST(coalesce(-modal_k, 0) AS INT) AS delta FROM pairs p LEFT JOIN (VALUES {', '.join(f'({k}, {cycle[0][0]})' for k, cycle in enumerate(CYCLES))}) v(triangle_id, pair_id) USING (pair_id) LEFT JOIN cmodes USING (triangle_id)", "ifg"))
def integer_gauge(spark, d):
    return corrections.gauge(unwrap.modal_closures(_cycle_integers(spark, d)), CYCLES, len(PAIRS))


@query()
def sparse_corrections(spark, d):
    return corrections.sparse_corrections(unwrap.correction_patterns(_cycle_integers(spark, d)), CYCLES, PAIRS)


@query(build(f"""{_CYCLE_SQL},
off AS (SELECT point_id FROM cints JOIN cmodes USING (triangle_id) WHERE k <> modal_k GROUP BY 1 HAVING count(*) > 2),
bad AS (SELECT p AS point_id FROM (SELECT u AS p, g FROM grad UNION ALL SELECT v, g FROM grad) GROUP BY 1 HAVING avg(CAST(abs(g) > pi() / 2 AS INT)) > 0.5)
SELECT point_id, r, c FROM stats WHERE point_id NOT IN (SELECT point_id FROM off) AND point_id NOT IN (SELECT point_id FROM bad)""", "grad", "ifg"))  # fmt: skip
def strict_points(spark, d):
    ifgs = _ifgs(spark, d)
    ints = settle(unwrap.integer_closures(corrections.cycle_closures(ifgs, CYCLES)), "integers")
    bad = _unsafe_points(spark, d)
    return corrections.strict_points(_stats(spark, d).select("point_id", "r", "c"), ifgs, len(PAIRS), ints, unwrap.modal_closures(ints), bad, 2)


def _closing(spark, d) -> DataFrame:
    """The correction that puts a cycle's first pair right where a point is off the cycle's mode."""
    ints = settle(_cycle_integers(spark, d), "integers")
    first = spark.createDataFrame([(k, cycle[0][0]) for k, cycle in enumerate(CYCLES)], "triangle_id int, pair_id int")
    off = ints.join(F.broadcast(unwrap.modal_closures(ints)), "triangle_id").where("k <> modal_k").join(F.broadcast(first), "triangle_id")  # a row a cycle
    return off.select("pair_id", "point_id", (F.col("modal_k") - F.col("k")).alias("correction"))


_CLOSING_SQL = _CYCLE_SQL + f", fix AS (SELECT pair_id, point_id, modal_k - k AS correction FROM cints JOIN cmodes USING (triangle_id) JOIN (VALUES {', '.join(f'({k}, {cycle[0][0]})' for k, cycle in enumerate(CYCLES))}) v(triangle_id, pair_id) USING (triangle_id) WHERE k <> modal_k)"


@query(build(f"""{_CLOSING_SQL},
w AS (SELECT i.pair_id, i.point_id, phase, coalesce(correction, 0) AS add FROM ifg i LEFT JOIN fix USING (pair_id, point_id)),
e AS (SELECT g.pair_id, CAST(round_even((b.phase - a.phase - g) / {oracle.TAU}::DOUBLE, 0) AS INT) AS jump, b.add - a.add AS moved FROM grad g JOIN w a ON a.pair_id = g.pair_id AND a.point_id = u JOIN w b ON b.pair_id = g.pair_id AND b.point_id = v)
SELECT pair_id, count(*) AS edges, count(*) FILTER (jump <> 0) AS before, count(*) FILTER (jump + moved <> 0) AS after, count(*) FILTER (jump <> 0 AND jump + moved = 0) AS resolved, count(*) FILTER (jump = 0 AND jump + moved <> 0) AS created FROM e GROUP BY 1""", "grad", "ifg"))  # fmt: skip
def correction_effect(spark, d):
    ifgs = _ifgs(spark, d)
    return corrections.boundary_effect(unwrap.gradients(ifgs, _knn(spark, d)), ifgs.withColumnRenamed("phase", "value"), _closing(spark, d))


@query(build(f"""{_CLOSING_SQL}
SELECT i.pair_id, CAST(r // 4 AS BIGINT) AS piece, count(*) AS size, count(correction) AS hit, CASE WHEN count(correction) = 0 THEN 'none' WHEN count(correction) = count(*) AND count(DISTINCT correction) = 1 THEN 'full' WHEN count(DISTINCT correction) > 1 THEN 'mixed' ELSE 'partial' END AS status
FROM ifg i LEFT JOIN fix USING (pair_id, point_id) GROUP BY 1, 2""", "ifg"))  # fmt: skip
def piece_coverage(spark, d):
    bands = _stats(spark, d).select("point_id", F.expr("r div 4").alias("piece"))
    return corrections.piece_coverage(_ifgs(spark, d).join(bands, "point_id").select("pair_id", "point_id", "piece"), _closing(spark, d))


@query(oracle.cycle_counts_sql().replace("SELECT net.i, net.j,", ", cc AS (SELECT net.i, net.j,", 1) + ") SELECT (SELECT count(DISTINCT i) FROM twoway) AS nodes, count(*) AS edges, count(*) FILTER (c3 = 0 AND c4 = 0) AS uncovered, max(shortest) AS longest_shortest FROM cc")
def network_acceptance(spark, d):
    return network.acceptance(_net(spark, d))


@query(build(f"SELECT threshold, count(*) FILTER (k >= threshold) AS direct, count(*) FILTER (k < threshold) AS fallback FROM counts, (SELECT CAST(unnest([4, 8, 12, 16, 20]) AS DOUBLE) AS threshold) GROUP BY 1", "counts"))
def state_sweep(spark, d):
    stats = _stats(spark, d)
    return amplitude.two_way_threshold_counts(support.shp_count(stats, _support(stats)), "k", [4, 8, 12, 16, 20])


@query(build("SELECT DISTINCT neighbor_id AS point_id FROM support", "support"))
def support_footprint(spark, d):
    return _support(_stats(spark, d)).select(F.col("neighbor_id").alias("point_id")).distinct()


@query(build(f", th AS (SELECT center_id AS point_id, t, atan2(sum(im), sum(re)) AS a FROM support JOIN full_z ON point_id = neighbor_id GROUP BY ALL), x AS (SELECT point_id, z.phase - a AS off FROM th JOIN full_z z USING (point_id, t)) SELECT point_id, {x6('sqrt(pow(avg(cos(off)), 2) + pow(avg(sin(off)), 2))')} AS agreement, round(median(abs(atan2(sin(off), cos(off)))), 5) + 0.0 AS median_abs FROM x GROUP BY 1", "support", "full_z"))
def phase_agreement(spark, d):
    full = _full(spark, d)
    sums = _support(_stats(spark, d)).join(full.withColumnRenamed("point_id", "neighbor_id"), "neighbor_id").groupBy("center_id", "t").agg(F.atan2(F.sum("im"), F.sum("re")).alias("around"))
    both = full.select("point_id", "t", "phase").join(sums.withColumnRenamed("center_id", "point_id"), ["point_id", "t"])
    return series.agreement(both, "point_id", "phase", "around").select("point_id", tidy(F.col("agreement")).alias("agreement"), tidy(F.col("median_abs"), 5).alias("median_abs"))


@query(build(f", m AS (SELECT u, v, avg(cos(b.phase - a.phase)) AS mean FROM knn JOIN full_z a ON a.point_id = u JOIN full_z b ON b.point_id = v AND a.t = b.t GROUP BY 1, 2) SELECT point_id, count(*) AS neighbors, {x6('median(mean)')} AS similarity FROM (SELECT u AS point_id, mean FROM m UNION ALL SELECT v, mean FROM m) GROUP BY 1", "knn", "full_z"))
def neighbour_similarity(spark, d):
    rows = series.neighbour_similarity(_knn(spark, d), _own_phase(_pixels(spark, d)), S.EPOCHS)
    return rows.select("point_id", "neighbors", tidy(F.col("similarity")).alias("similarity"))


@query(build(f"""
, s AS (SELECT t, avg(amp) AS s FROM full_z GROUP BY t),
m AS (SELECT point_id, count(*) AS n, covar_pop(t, t) AS xx, covar_pop(s, s) AS ss, covar_pop(t, s) AS xs, covar_pop(t, phase) AS xy, covar_pop(s, phase) AS sy, covar_pop(phase, phase) AS yy FROM full_z JOIN s USING (t) GROUP BY 1),
k AS (SELECT *, ss - xs * xs / xx AS rs, (sy - xs * xy / xx) / (ss - xs * xs / xx) AS k, greatest(yy - xy * xy / xx, 0) AS before FROM m)
SELECT point_id, n, {x6('k')} AS k, {x6('sqrt(greatest(before - k * k * rs, 0) / (n - 3) / rs)')} AS k_se, {x6('sqrt(before)')} AS rms_before, {x6('sqrt(greatest(before - k * k * rs, 0))')} AS rms_after FROM k""", "full_z"))  # fmt: skip
def partial_fit(spark, d):
    full = _full(spark, d).select("point_id", "t", "phase", "amp")
    level = full.groupBy("t").agg(F.avg("amp").alias("s"))
    rows = series.partial_fit(full.join(F.broadcast(level), "t"), "point_id", "t", "s", "phase")  # a row an epoch
    return rows.select("point_id", "n", *[tidy(F.col(x)).alias(x) for x in ("k", "k_se", "rms_before", "rms_after")])


@query(build(", n AS (SELECT u, v, count(*) FILTER (abs(g) > pi() / 2) AS hits FROM grad GROUP BY 1, 2) SELECT threshold, count(*) FILTER (hits >= threshold) AS direct, count(*) FILTER (hits < threshold) AS fallback FROM n, (SELECT CAST(unnest([2, 3, 4, 5, 6, 7, 8]) AS DOUBLE) AS threshold) GROUP BY 1", "grad"))
def conflict_recurrence(spark, d):
    hits = _grads(spark, d).groupBy("u", "v").agg(F.count_if(F.abs("g") > unwrap.SAFE).alias("hits"))
    return amplitude.two_way_threshold_counts(hits, "hits", [2, 3, 4, 5, 6, 7, 8])


@query("WITH RECURSIVE " + build("", "grad", "ifg").removeprefix("WITH ").rstrip() + f", e AS (SELECT g.pair_id, u, v FROM grad g JOIN ifg a ON a.pair_id = g.pair_id AND a.point_id = u JOIN ifg b ON b.pair_id = g.pair_id AND b.point_id = v WHERE abs(g) <= {oracle.PI}::DOUBLE / 2 AND round_even((b.phase - a.phase - g) / {oracle.TAU}::DOUBLE, 0) <> 0), b AS (SELECT pair_id, u, v FROM e UNION ALL SELECT pair_id, v, u FROM e), w AS (SELECT pair_id, u AS node, u AS root FROM b UNION SELECT w.pair_id, b.v, w.root FROM w JOIN b ON b.u = w.node AND b.pair_id = w.pair_id), l AS (SELECT pair_id, node, min(root) AS component FROM w GROUP BY 1, 2) SELECT pair_id, component, count(*) AS size FROM l GROUP BY 1, 2")
def conflict_clusters(spark, d):
    """Points joined by safe edges across which the values jump by whole turns, each interferogram's phases taken as its values."""
    ifgs = _ifgs(spark, d)
    jumps = unwrap.safe_conflicts(unwrap.gradients(ifgs, _knn(spark, d)), ifgs.withColumnRenamed("phase", "value"))
    return unwrap.fragment_sizes(unwrap.pair_components(jumps))


_GRAD_STATS = f", gs AS (SELECT pair_id, count(*) AS edges, avg(abs(g)) AS mean_abs, avg(CAST(abs(g) > {oracle.PI}::DOUBLE / 2 AS INT)) AS frac_pi2, quantile_cont(abs(g), 0.9) AS p90, quantile_cont(abs(g), 0.95) AS p95 FROM grad GROUP BY 1)"


@query(build(f"{_GRAD_STATS} SELECT pair_id, concat_ws('+', CASE WHEN frac_pi2 > 0.5 THEN 'steep' END, CASE WHEN mean_abs > 1.57 THEN 'rough' END) AS reasons, CASE WHEN frac_pi2 > 0.5 OR mean_abs > 1.57 THEN 'REVIEW' ELSE 'PASS' END AS verdict FROM gs", "grad"))
def ifg_gates(spark, d):
    return unwrap.gates(unwrap.gradient_stats(_grads(spark, d)), 0.5, 1.57)


@query(build(f"{_GRAD_STATS} SELECT pair_id, {x6('frac_pi2')} AS frac_pi2, {x6('p95')} AS p95 FROM gs ORDER BY frac_pi2 DESC, p95 DESC, pair_id LIMIT 1", "grad"))
def worst_pair(spark, d):
    return unwrap.worst_pair(unwrap.gradient_stats(_grads(spark, d))).select("pair_id", tidy(F.col("frac_pi2")).alias("frac_pi2"), tidy(F.col("p95")).alias("p95"))


@query(build(f"SELECT pair_id, {x6('max(abs(atan2(sin(f + b), cos(f + b))))')} AS worst FROM (SELECT pair_id, atan2(sin(b.phase - a.phase), cos(b.phase - a.phase)) AS f, atan2(sin(a.phase - b.phase), cos(a.phase - b.phase)) AS b FROM pairs JOIN full_z a ON a.t = i JOIN full_z b ON b.t = j AND b.point_id = a.point_id) GROUP BY 1", "pairs", "full_z"))
def antisymmetry(spark, d):
    rows = unwrap.antisymmetry(_full(spark, d).select("point_id", "t", "phase"), unwrap.pair_table(spark, PAIRS))
    return rows.select("pair_id", tidy(F.col("worst")).alias("worst"))


@query()
def piece_shifts(spark, d):
    """Pieces of safe fragments brought to a common whole turn along the surest votes."""
    return unwrap.piece_shifts(_pieces(spark, d)[1])


@query()
def piece_votes(spark, d):
    """Votes between the pieces of safe fragments."""
    return _pieces(spark, d)[1]


@query(build(", c AS (SELECT node, count(*) FILTER (side = 'l') AS l, count(*) FILTER (side = 'r') AS r FROM (SELECT i AS node, 'r' AS side FROM cand UNION ALL SELECT j, 'l' FROM cand) GROUP BY 1), h AS (SELECT node, count(*) FILTER (side = 'l') AS l, count(*) FILTER (side = 'r') AS r FROM (SELECT i AS node, 'r' AS side FROM net UNION ALL SELECT j, 'l' FROM net) GROUP BY 1) SELECT c.node, coalesce(h.l, 0) AS left, coalesce(h.r, 0) AS right, least(c.l, 3) AS need_left, least(c.r, 3) AS need_right, coalesce(h.l, 0) >= least(c.l, 3) AND coalesce(h.r, 0) >= least(c.r, 3) AS met FROM c LEFT JOIN h USING (node)", "net"))
def network_requirements(spark, d):
    return network.requirements(_candidates(spark, d), _net(spark, d), 3)


@query(build(f", w AS (SELECT t, phase, 2 * CAST(r > 2 AS INT) + CAST(c > 20 AS INT) AS q FROM full_z WHERE abs(r - 2) <= 2 AND abs(c - 20) <= 15), m AS (SELECT t, {', '.join(f'median(phase) FILTER (q = {q}) AS q{q}' for q in range(4))} FROM w GROUP BY t) SELECT t, {', '.join(f'{x6(f'q{q}')} AS q{q}' for q in range(4))}, {x6('greatest(q0, q1, q2, q3) - least(q0, q1, q2, q3)')} AS spread FROM m", "full_z"))
def quadrant_consistency(spark, d):
    rows = series.quadrants(_full(spark, d), 2, 20, 2, 15)
    return rows.select("t", *[tidy(F.col(x)).alias(x) for x in ("q0", "q1", "q2", "q3", "spread")])


@query("SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n, round(sum(value), 4) + 0.0 AS total FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    """An extension: the event table read as a stream in six-hour windows."""
    sums = windows.window_sums(windows.read_events(spark, d), "6 hours", "2 days")
    return windows.run_available(sums, "event-windows").select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n", tidy(F.col("total"), 4).alias("total"))


from fringeflow.plans import checks as _checks  # noqa: E402, F401  (registers its queries, which use the steps above)
