"""Named queries of gates and audits, and of the second scene in the shape of production; registered with the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fringeflow.functions.phase import glrt_threshold, nonzero_sample, tidy
from fringeflow.operators import amplitude, audits, bridges, coherence, consistency, corrections, forests, linking, network, series, similarity, spatial, support, unwrap
from fringeflow.plans import oracle, registry, temporal
from fringeflow.plans import scene as S
from fringeflow.plans.lineage import settle, shared_path
from fringeflow.plans.oracle import build, x6
from fringeflow.plans.registry import query
from fringeflow.sources import rasters
from fringeflow.streaming import ministacks

PAIRS = registry.PAIRS
_RECURSIVE = "WITH RECURSIVE "


def _recursive(*names: str) -> str:
    return _RECURSIVE + build("", *names).removeprefix(_RECURSIVE).removeprefix("WITH ").rstrip()


# The second scene: 11 x 23 cells, 38 epochs, significance 0.005, 48 neighbours.

_BIT = f"(b.r - a.r + {S.WIDE_ROWS}) * {2 * S.WIDE_COLS + 1} + (b.c - a.c + {S.WIDE_COLS})"
_STAT = f"{S.WIDE_EPOCHS} * (2 * ln((a.scale2 + b.scale2) / 2) - ln(a.scale2) - ln(b.scale2))"
_WIDE = f"""WITH ws AS (SELECT l_suppkey AS point_id, CAST(l_suppkey // {S.WIDE_WIDTH} AS INT) AS r, CAST(l_suppkey % {S.WIDE_WIDTH} AS INT) AS c, CAST(date_diff('day', DATE '{S.FIRST_YEAR}-01-01', CAST(l_shipdate AS DATE)) // {S.WIDE_DAYS} AS INT) AS t, sum(l_quantity) AS amp FROM lineitem GROUP BY ALL),
wst AS (SELECT point_id, r, c, (var_pop(amp) + avg(amp) * avg(amp)) / 2 AS scale2 FROM ws GROUP BY ALL HAVING count(*) = {S.WIDE_EPOCHS} AND NOT stddev_pop(amp) / avg(amp) <= {S.ADI_MAX}),
wsup AS (SELECT a.point_id AS center_id, b.point_id AS neighbor_id, {_BIT} AS bit FROM wst a JOIN wst b ON abs(a.r - b.r) <= {S.WIDE_ROWS} AND abs(a.c - b.c) <= {S.WIDE_COLS} AND a.point_id <> b.point_id WHERE {_STAT} < {glrt_threshold(S.WIDE_ALPHA)!r}::DOUBLE)"""
_WIDE_CELLS = (2 * S.WIDE_ROWS + 1) * (2 * S.WIDE_COLS + 1)


def _wide_stats(spark, d) -> DataFrame:
    return amplitude.with_ps_flag(amplitude.amplitude_statistics(S.wide_samples(spark, d), S.WIDE_EPOCHS), S.ADI_MAX)


def _wide_support(spark, d) -> DataFrame:
    return support.glrt_support(_wide_stats(spark, d), S.WIDE_EPOCHS, S.WIDE_ROWS, S.WIDE_COLS, S.WIDE_ALPHA)


def _wide_coherence(spark, d) -> DataFrame:
    return _arrays(spark, d, _wide_support(spark, d))


def _arrays(spark, d, near: DataFrame) -> DataFrame:
    samples = S.wide_samples(spark, d)
    return coherence.coherence_arrays(near, coherence.sample_arrays(samples, S.WIDE_EPOCHS), samples.select("point_id", "r", "c").distinct(), S.WIDE_EPOCHS)


def _word(w: int) -> str:
    total = f"coalesce(sum(CAST(1 AS HUGEINT) << (bit % 64)) FILTER (bit // 64 = {w}), 0)"
    return f"CAST(CASE WHEN {total} >= 9223372036854775808 THEN {total} - 18446744073709551616 ELSE {total} END AS BIGINT) AS word_{w}"


@query(f"{_WIDE} SELECT center_id, {', '.join(_word(w) for w in range(4))}, count(*) AS k FROM wsup GROUP BY 1")
def wide_support_bitset(spark, d):
    """The window of 253 cells in four words."""
    return support.support_bits(_wide_support(spark, d), _WIDE_CELLS)


@query(f"""{_WIDE},
wz AS (SELECT *, amp * cos((amp % {S.TURN}) * {2 * 3.141592653589793 / S.TURN!r}::DOUBLE) AS re, amp * sin((amp % {S.TURN}) * {2 * 3.141592653589793 / S.TURN!r}::DOUBLE) AS im FROM ws)
SELECT s.center_id, a.t AS i, b.t AS j, {x6('sqrt(pow(sum(a.re * b.re + a.im * b.im), 2) + pow(sum(a.im * b.re - a.re * b.im), 2)) / sqrt(sum(a.re * a.re + a.im * a.im) * sum(b.re * b.re + b.im * b.im))')} AS coh_abs
FROM wsup s JOIN wz a ON a.point_id = s.neighbor_id JOIN wz b ON b.point_id = s.neighbor_id AND a.t < b.t GROUP BY ALL""")  # fmt: skip
def wide_pair_coherence(spark, d):
    """All 703 pairs of 38 epochs."""
    rows = coherence.pairs_of_arrays(_wide_coherence(spark, d), S.WIDE_EPOCHS)
    return rows.select("center_id", "i", "j", tidy(F.hypot("cre", "cim")).alias("coh_abs"))


@query()
def wide_phase_linking(spark, d):
    """Full-span linking of the centres with enough neighbours, whose counts are held against those of the bit set."""
    near = settle(_wide_support(spark, d), "wide-support")
    counts = near.groupBy("center_id").agg(F.count("*").alias("k"))
    bits = support.support_bits(near, _WIDE_CELLS).select("center_id", "k")
    centres = audits.full_scm_centres(counts.where(F.col("k") >= S.WIDE_K).select("center_id"), counts, bits, S.WIDE_K)
    linked = linking.link_arrays(_arrays(spark, d, near.join(centres.select("center_id"), "center_id", "left_semi")), S.WIDE_EPOCHS)
    return linked.join(centres, "center_id").select("center_id", "k", "estimator", "phase")


@query(_WIDE[: _WIDE.index(",\nwst AS")] + ", " + oracle.prior_sql("ws", S.WIDE_EPOCHS, 5, 5))
def wide_prior_counts(spark, d):
    """Neighbours within five rows and columns whose amplitudes follow the same distribution."""
    return similarity.prior_counts(S.wide_samples(spark, d), S.WIDE_EPOCHS, 5, 5)


_WIDE_PAIRS = [(i, j) for i in range(S.WIDE_EPOCHS) for j in (i + 1, i + 2, i + 3) if j < S.WIDE_EPOCHS]


@query()
def wide_sparse_corrections(spark, d):
    """The least corrections of 38 epochs in 108 pairs, for every pattern of turns around their 71 cycles."""
    samples = S.wide_samples(spark, d)
    whole = samples.groupBy("point_id").agg(F.count("*").alias("n")).where(F.col("n") == S.WIDE_EPOCHS).select("point_id")
    ifgs = unwrap.virtual_ifgs(samples.join(whole, "point_id", "left_semi").select("point_id", "t", "phase"), unwrap.pair_table(spark, _WIDE_PAIRS))
    cycles = network.cycle_basis(_WIDE_PAIRS)
    turns = unwrap.integer_closures(corrections.cycle_closures(ifgs, cycles))
    return corrections.sparse_corrections(unwrap.correction_patterns(turns), cycles, _WIDE_PAIRS)


# Rasters.

_SINGLE = "round(CAST(CAST({0} AS FLOAT) AS DOUBLE), 3) + 0.0 AS {0}"


@query(build(f"SELECT t, r, c, {_SINGLE.format('re')}, {_SINGLE.format('im')} FROM z WHERE r BETWEEN 1 AND 30 AND c BETWEEN 10 AND 29 AND t IN (1, 3, 5)", "z"))
def raster_window(spark, d):
    """The scene written as rasters, and a window of three dates read back."""
    samples = S.samples(spark, d).select("t", "r", "c", "re", "im")
    length = (samples.agg(F.max("r")).head()[0] or 0) + 1
    folder = shared_path(spark, "raster-stack")
    rasters.write_stack(samples, folder, S.WIDTH, length, rows_a_tile=16)
    stack = rasters.read_written_stack(spark, folder, rows_a_partition=16)
    rows = stack.where("t IN (1, 3, 5) AND r BETWEEN 1 AND 30 AND c BETWEEN 10 AND 29").where(nonzero_sample(F.col("re"), F.col("im")))
    return rows.select("t", "r", "c", *[tidy(F.col(x).cast("double"), 3).alias(x) for x in ("re", "im")])


# Streams.


@query()
def streamed_phase_linking(spark, d):
    """``sequential_phase_linking`` as the epochs arrive, a ministack at a time."""
    plan = temporal.sequential_plan(S.EPOCHS, 3)
    near = settle(registry._support(registry._stats(spark, d)).select("center_id", "neighbor_id"), "support")
    samples = settle(S.samples(spark, d).select("point_id", "r", "c", "t", "re", "im"), "samples")
    epochs, work = shared_path(spark, "epochs"), shared_path(spark, "ministacks")
    for stage in plan:
        samples.where(F.col("t").between(stage.start, stage.stop - 1)).write.mode("append").parquet(epochs)
        ministacks.advance(spark, epochs, near, plan, work)
    return ministacks.phases(spark, work)


# What is kept, and states.

_HEIGHT = "(SELECT p_partkey AS point_id, CAST(p_size - 1 AS DOUBLE) AS height FROM part)"


@query(build(f", p AS (SELECT point_id, r, c, count(*) AS n FROM samples GROUP BY ALL HAVING count(*) / {float(S.EPOCHS)} >= 0.8 AND avg(amp) > 0 AND stddev_pop(amp) / avg(amp) <= {S.POINT_ADI}) SELECT point_id, r, c, CASE WHEN coalesce(height, 0) = 0 THEN 'no_geometry' WHEN n < {S.EPOCHS} THEN 'incomplete' ELSE 'kept' END AS status FROM p LEFT JOIN {_HEIGHT} h USING (point_id)", "samples"))
def final_scatterers(spark, d):
    """Candidates with a height and every epoch; the rest are told with the reason."""
    chosen = amplitude.ps_selection_fractional(S.samples(spark, d), S.EPOCHS, S.POINT_ADI, 0.8)
    points = chosen.select("point_id", "r", "c", F.round(F.col("valid_fraction") * S.EPOCHS).cast("long").alias("n"))
    return audits.final_scatterers(points, S.heights(spark, d), S.EPOCHS)


@query(build(f"SELECT point_id, CAST(CASE WHEN n IS NULL THEN 5 WHEN ps THEN 0 WHEN coalesce(k, 0) < {S.STATE_K} THEN 2 WHEN coalesce(tc, 0) < 0.2 THEN 3 WHEN coalesce(median_coh, 0) < 0.3 THEN 4 ELSE 1 END AS SMALLINT) AS code FROM (SELECT DISTINCT point_id FROM samples) LEFT JOIN flagged USING (point_id) LEFT JOIN counts ON counts.center_id = point_id LEFT JOIN tc ON tc.center_id = point_id LEFT JOIN median_coh m ON m.center_id = point_id", "samples", "flagged", "counts", "tc", "median_coh"))
def state_codes(spark, d):
    """Why a point is in the state or not; here linking asks for temporal coherence and compression for pair coherence."""
    stats = settle(registry._stats(spark, d), "stats")
    near = settle(registry._support(stats), "support")
    rows = settle(coherence.coherence_wide(near, registry._pixels(spark, d), S.EPOCHS), "coherence")
    tc = coherence.temporal_coherence(rows, registry._own_phase(registry._pixels(spark, d)), S.EPOCHS).withColumnRenamed("center_id", "point_id")
    middle = coherence.median_coherence(rows, S.EPOCHS).withColumnRenamed("center_id", "point_id")
    counts = support.shp_count(stats, near).withColumnRenamed("center_id", "point_id")
    every = S.samples(spark, d).select("point_id").distinct()
    met = every.join(stats.select("point_id", "ps"), "point_id", "left").join(counts, "point_id", "left").join(tc, "point_id", "left").join(middle, "point_id", "left")
    centres = met.select("point_id", F.coalesce(~F.col("ps"), F.lit(True)).alias("inside"), F.col("ps").isNotNull().alias("centre_ok"), "k", (F.col("tc") >= 0.2).alias("linked"), (F.col("median_coh") >= 0.3).alias("compressed"))
    return audits.state_codes(centres, S.STATE_K)


@query(build(", p AS (SELECT point_id, row_number() OVER (ORDER BY r, c) - 1 AS point_no, count(*) OVER () AS n FROM stats) SELECT point_id, point_no FROM p WHERE n <= 150 OR point_no IN (SELECT (k * (n - 1)) // 149 FROM (SELECT DISTINCT n FROM p), (SELECT unnest(generate_series(0, 149)) AS k))", "stats"))
def spread_sample(spark, d):
    """150 points at even steps through the grid in row-major order."""
    numbered = settle(amplitude.point_numbers(registry._stats(spark, d).select("point_id", "r", "c")), "numbered")
    return audits.spread_sample(numbered.select("point_id", "point_no"), "point_no", numbered.count(), 150)


@query(build(f", a AS (SELECT point_id FROM flagged WHERE adi <= {S.POINT_ADI}), b AS (SELECT center_id AS point_id FROM counts WHERE k >= {S.STATE_K}) SELECT count(*) FILTER (a.point_id IS NOT NULL AND b.point_id IS NOT NULL) AS both, count(*) FILTER (b.point_id IS NULL) AS only_a, count(*) FILTER (a.point_id IS NULL) AS only_b, {x6('count(*) FILTER (a.point_id IS NOT NULL AND b.point_id IS NOT NULL) / count(*)')} AS iou FROM a FULL JOIN b USING (point_id)", "flagged", "counts"))
def mask_agreement(spark, d):
    """Steady points against points with enough neighbours."""
    stats = settle(registry._stats(spark, d), "stats")
    dense = support.shp_count(stats, registry._support(stats)).where(F.col("k") >= S.STATE_K).select(F.col("center_id").alias("point_id"))
    rows = audits.mask_agreement(stats.where(F.col("adi") <= S.POINT_ADI), dense, "point_id")
    return rows.withColumn("iou", tidy(F.col("iou")))


@query(build(", l AS (SELECT DISTINCT component AS a, r // 4 AS b FROM comp JOIN chosen USING (point_id)), x AS (SELECT a, count(*) AS n FROM l GROUP BY 1), y AS (SELECT b, count(*) AS n FROM l GROUP BY 1) SELECT (SELECT count(*) FROM x) AS labels_a, (SELECT count(*) FROM x WHERE n > 1) AS split_a, (SELECT count(*) FROM y) AS labels_b, (SELECT count(*) FROM y WHERE n > 1) AS split_b, NOT EXISTS (SELECT 1 FROM x WHERE n > 1) AND NOT EXISTS (SELECT 1 FROM y WHERE n > 1) AS equal", "comp", "chosen"))
def partition_agreement(spark, d):
    """Components of the grid against bands of four rows."""
    points = settle(registry._some(spark, d), "points")
    bands = points.select("point_id", F.expr("r div 4").alias("band"))
    return audits.same_partition(spatial.grid_components(points, 1).join(bands, "point_id"), "component", "band")


# The epoch network.

_SIDES = """, b AS (SELECT i, j FROM {net} UNION ALL SELECT j, i FROM {net}),
w AS (SELECT i AS ei, j AS ej, i AS node FROM {net} UNION SELECT w.ei, w.ej, b.j FROM w JOIN b ON b.i = w.node AND NOT (b.i = w.ei AND b.j = w.ej) AND NOT (b.j = w.ei AND b.i = w.ej)),
x AS (SELECT j AS ei, i AS ej, j AS node FROM {net} UNION SELECT x.ei, x.ej, b.j FROM x JOIN b ON b.i = x.node AND NOT (b.i = x.ei AND b.j = x.ej) AND NOT (b.j = x.ei AND b.i = x.ej)),
sides AS (SELECT {net}.i, {net}.j, (SELECT count(*) FROM w WHERE w.ei = {net}.i AND w.ej = {net}.j) AS side_i, (SELECT count(*) FROM x WHERE x.ei = {net}.j AND x.ej = {net}.i) AS side_j FROM {net} WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.ei = {net}.i AND w.ej = {net}.j AND w.node = {net}.j))"""


@query(_recursive("net1") + _SIDES.format(net="net1") + " SELECT *, least(side_i, side_j) AS smaller FROM sides")
def bridge_sides(spark, d):
    """Nodes on either side of each bridge of a sparse network."""
    return audits.bridge_sides(registry._net(spark, d, 1).select("i", "j"))


@query(
    _recursive("net1", "cand") + _SIDES.format(net="net1")
    + """, over AS (SELECT s.i AS ei, s.j AS ej, c.i, c.j, c.score FROM sides s JOIN cand c ON NOT EXISTS (SELECT 1 FROM net1 n WHERE n.i = c.i AND n.j = c.j)
  AND EXISTS (SELECT 1 FROM w WHERE w.ei = s.i AND w.ej = s.j AND w.node = c.i) <> EXISTS (SELECT 1 FROM w WHERE w.ei = s.i AND w.ej = s.j AND w.node = c.j)
  AND (EXISTS (SELECT 1 FROM x WHERE x.ei = s.j AND x.ej = s.i AND x.node = c.i) OR EXISTS (SELECT 1 FROM x WHERE x.ei = s.j AND x.ej = s.i AND x.node = c.j))),
best AS (SELECT DISTINCT arg_min(i, struct_pack(s := score, i := i, j := j)) AS i, arg_min(j, struct_pack(s := score, i := i, j := j)) AS j FROM over GROUP BY ei, ej)
SELECT i, j, 'chosen' AS why, EXISTS (SELECT 1 FROM sides s WHERE s.i = net1.i AND s.j = net1.j) AND NOT EXISTS (SELECT 1 FROM over o WHERE o.ei = net1.i AND o.ej = net1.j) AS bridge FROM net1
UNION ALL SELECT i, j, 'doubles', false FROM best"""
)
def doubled_network(spark, d):
    """A sparse network with the best candidate across each of its bridges."""
    candidates = settle(registry._candidates(spark, d), "candidates")
    return bridges.doubled_network(candidates, settle(network.directional(candidates, 1).select("i", "j"), "network"))


_CYCLES = oracle.cycle_counts_sql()


@query(
    _RECURSIVE + _CYCLES.removeprefix("WITH ").replace("SELECT net.i, net.j,", "cc AS (SELECT net.i, net.j,", 1).replace("\ncc AS", ", cc AS", 1) + ")" + _SIDES.format(net="net")
    + """, reach2 AS (SELECT i AS node, i AS root FROM b UNION SELECT b.j, reach2.root FROM reach2 JOIN b ON b.i = reach2.node), comps AS (SELECT count(DISTINCT root) AS components, count(*) AS nodes FROM (SELECT node, min(root) AS root FROM reach2 GROUP BY 1)),
c0 AS (SELECT node, count(*) FILTER (side = 'l') AS l, count(*) FILTER (side = 'r') AS r FROM (SELECT i AS node, 'r' AS side FROM cand UNION ALL SELECT j, 'l' FROM cand) GROUP BY 1), h0 AS (SELECT node, count(*) FILTER (side = 'l') AS l, count(*) FILTER (side = 'r') AS r FROM (SELECT i AS node, 'r' AS side FROM net UNION ALL SELECT j, 'l' FROM net) GROUP BY 1),
g AS (SELECT components, nodes, (SELECT count(*) FROM sides) AS bridges, (SELECT count(*) FROM c0 LEFT JOIN h0 USING (node) WHERE NOT (coalesce(h0.l, 0) >= least(c0.l, 3) AND coalesce(h0.r, 0) >= least(c0.r, 3))) AS short_of_links, (SELECT count(*) FROM cc) AS edges, (SELECT count(*) FROM cc WHERE c3 = 0 AND c4 = 0) AS uncovered, (SELECT max(shortest) FROM cc) AS longest_shortest FROM comps),
q AS (SELECT *, concat_ws('+', CASE WHEN components <> 1 THEN 'components' END, CASE WHEN bridges > 0 THEN 'bridges' END, CASE WHEN edges < nodes THEN 'edges' END, CASE WHEN short_of_links > 0 THEN 'links' END, CASE WHEN uncovered > 0 THEN 'uncovered' END, CASE WHEN longest_shortest > 4 THEN 'cycles' END) AS reasons FROM g)
SELECT *, CASE WHEN reasons = '' THEN 'PASS' ELSE 'REVIEW' END AS verdict FROM q"""
)
def network_gate(spark, d):
    """Whether the chosen network may be used, with all figures."""
    candidates = settle(registry._candidates(spark, d), "candidates")
    return audits.network_gate(candidates, settle(network.directional(candidates, 3), "network"), 3)


@query(f"SELECT {len(PAIRS)} AS edges, {S.EPOCHS} AS nodes, 1 AS components, {len(PAIRS) - S.EPOCHS + 1} AS expected, {len(PAIRS) - S.EPOCHS + 1} AS rank")
def cycle_rank(spark, d):
    """Independent cycles of the pairs that the scene's epochs have, and the rank of the cycle basis."""
    present = S.samples(spark, d).select("t").distinct()
    edges = unwrap.pair_table(spark, PAIRS).join(present.withColumnRenamed("t", "i"), "i", "left_semi").join(present.withColumnRenamed("t", "j"), "j", "left_semi")
    return audits.cycle_rank(edges, registry.CYCLES, len(PAIRS))


@query(f"SELECT pair_id, printf('pair%03d_%s_%s', pair_id, CAST({S.FIRST_YEAR} + i AS VARCHAR) || '0101', CAST({S.FIRST_YEAR} + j AS VARCHAR) || '0101') AS tag FROM ({oracle.CTE['pairs']}) WHERE i IN (SELECT year(l_shipdate) - {S.FIRST_YEAR} FROM lineitem) AND j IN (SELECT year(l_shipdate) - {S.FIRST_YEAR} FROM lineitem)")
def pair_tags(spark, d):
    """Names of the pairs by number and dates."""
    epochs = S.samples(spark, d).select("t").distinct().select("t", F.make_date(F.col("t") + S.FIRST_YEAR, F.lit(1), F.lit(1)).alias("day"))
    return audits.pair_tags(unwrap.pair_table(spark, PAIRS), epochs)


_CORE_ROUNDS = 200
_CORES = ", h0 AS (SELECT center_id AS point_id, k AS core FROM counts)" + "".join(
    f", h{i} AS MATERIALIZED (SELECT c.point_id, least(c.core, coalesce(n.h, c.core)) AS core FROM h{i - 1} c LEFT JOIN (SELECT center_id AS point_id, max(least(core, place)) AS h FROM (SELECT e.center_id, p.core, row_number() OVER (PARTITION BY e.center_id ORDER BY p.core DESC) AS place FROM support e JOIN h{i - 1} p ON p.point_id = e.neighbor_id) GROUP BY 1) n USING (point_id))"
    for i in range(1, _CORE_ROUNDS + 1)
)


def _cores(spark, d):
    stats = settle(registry._stats(spark, d), "stats")
    near = settle(registry._support(stats), "support")
    tiles = stats.select("point_id", F.concat_ws("/", F.expr("r div 32").cast("string"), F.expr("c div 32").cast("string")).alias("tile"))
    return near, settle(support.core_numbers(near, support.shp_count(stats, near), tiles), "cores")


@query(build(f"{_CORES} SELECT point_id, CAST(core AS BIGINT) AS core FROM h{_CORE_ROUNDS}", "support", "counts"))
def core_numbers(spark, d):
    """For every point the largest threshold whose state holds it."""
    return _cores(spark, d)[1]


@query(build(f"{_CORES}, t AS (SELECT e.center_id, c.core, row_number() OVER (PARTITION BY e.center_id ORDER BY c.core DESC) AS place FROM support e JOIN h{_CORE_ROUNDS} c ON c.point_id = e.neighbor_id) SELECT center_id, count(*) AS k, CAST(nullif(max(core) FILTER (place = {S.FORMAL_K}), 0) AS BIGINT) AS safe_threshold FROM t GROUP BY 1", "support", "counts"))
def state_rescue(spark, d):
    """The largest threshold of the state that leaves each centre as many neighbours as linking asks for."""
    return support.safe_thresholds(*_cores(spark, d), S.FORMAL_K)


# Reference regions and held-out fits.

_APART, _TOP = 5, 12


@query(_recursive("stats") + f"""
, lim AS (SELECT quantile_cont(adi, [0.05, 0.95]) AS a, quantile_cont(scale2, [0.05, 0.95]) AS b FROM stats),
own AS (SELECT r, c, 0.85::DOUBLE * least(greatest((adi - a[1]) / (a[2] - a[1]), 0), 1) + 0.15::DOUBLE * least(greatest((scale2 - b[1]) / (b[2] - b[1]), 0), 1) AS own FROM stats, lim),
box AS (SELECT x.r + dr AS r, x.c + dc AS c, avg(own) AS score FROM own x, (SELECT unnest([-1, 0, 1]) AS dr) p, (SELECT unnest([-1, 0, 1]) AS dc) q GROUP BY 1, 2 HAVING count(*) = 9),
ord AS MATERIALIZED (SELECT row_number() OVER (ORDER BY round(score, 9), r, c) AS k, r, c, score FROM box),
g AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS ks, CAST([] AS INT[]) AS rs, CAST([] AS INT[]) AS cs UNION ALL
  SELECT o.k, CASE WHEN ok THEN list_append(ks, o.k) ELSE ks END, CASE WHEN ok THEN list_append(rs, o.r) ELSE rs END, CASE WHEN ok THEN list_append(cs, o.c) ELSE cs END
  FROM (SELECT g.*, o.k AS k1, o.r AS r1, o.c AS c1, len(list_filter(list_zip(rs, cs), lambda x: greatest(abs(x[1] - o.r), abs(x[2] - o.c)) < {_APART})) = 0 AS ok FROM g JOIN ord o ON o.k = g.k + 1 WHERE len(ks) < {_TOP}) q JOIN ord o ON o.k = q.k1)
SELECT CAST(row_number() OVER (ORDER BY k) AS INT) AS rank, r, c, {x6('score')} AS score FROM ord WHERE k IN (SELECT unnest(ks) FROM (SELECT ks FROM g ORDER BY k DESC LIMIT 1))""")  # fmt: skip
def reference_regions(spark, d):
    """The best reference cells, no two of them near each other."""
    rows = series.distinct_regions(series.reference_scores(registry._stats(spark, d), "adi", "scale2", 1), _APART, _TOP)
    return rows.select("rank", "r", "c", tidy(F.col("score")).alias("score"))


_FOLDS = 3


@query(build(f"""
, w AS (SELECT point_id, count(*) AS n, corr(amp, t) AS rho FROM full_z GROUP BY 1),
m AS (SELECT point_id, f, count(*) AS n, avg(t) AS mt, avg(amp) AS ms, avg(phase) AS my, covar_pop(t, t) AS xx, covar_pop(amp, amp) AS ss, covar_pop(t, amp) AS xs, covar_pop(t, phase) AS xy, covar_pop(amp, phase) AS sy FROM full_z, (SELECT unnest(generate_series(0, {_FOLDS - 1})) AS f) WHERE t % {_FOLDS} <> f GROUP BY 1, 2),
k AS (SELECT *, n >= 3 AND xx > 0 AND n * (ss - xs * xs / xx) > 1e-9 AS able, CASE WHEN n * (ss - xs * xs / xx) > 1e-9 THEN (sy - xs * xy / xx) / (ss - xs * xs / xx) END AS k FROM m),
e AS (SELECT z.point_id, bool_and(able) AS able, sqrt(avg(pow(phase - my - xy / xx * (t - mt), 2))) AS reduced, sqrt(avg(pow(phase - my - k * (amp - ms) - (xy - k * xs) / xx * (t - mt), 2))) AS whole FROM full_z z JOIN k ON k.point_id = z.point_id AND k.f = z.t % {_FOLDS} GROUP BY 1)
SELECT point_id, n, {x6('rho')} AS corr, {x6('sqrt(1 - rho * rho)')} AS retained, round(1 / (1 - rho * rho), 4) + 0.0 AS vif, CASE WHEN able THEN round(reduced, 4) + 0.0 END AS cv_reduced, CASE WHEN able THEN round(whole, 4) + 0.0 END AS cv_full FROM w JOIN e USING (point_id)""", "full_z"))  # fmt: skip
def held_out_fit(spark, d):
    """Whether a point's amplitude explains its phase beyond a trend, on epochs that the fit has not seen."""
    full = registry._full(spark, d).select("point_id", "t", "phase", "amp")
    rows = series.cross_validated_fit(full, "point_id", "t", "amp", "phase", F.col("t") % _FOLDS)
    return rows.select("point_id", "n", *[tidy(F.col(x)).alias(x) for x in ("corr", "retained")], *[tidy(F.col(x), 4).alias(x) for x in ("vif", "cv_reduced", "cv_full")])


# Forests.

_PARENTS = """, par AS (SELECT a.point_id AS v, min(b.point_id) AS u FROM chosen a JOIN chosen b ON abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 AND b.point_id < a.point_id GROUP BY 1),
up AS (SELECT v AS node, u AS above FROM par UNION SELECT up.node, par.u FROM up JOIN par ON par.v = up.above),
wt AS (SELECT point_id AS node, CAST(sum(amp) AS BIGINT) AS w FROM samples GROUP BY 1),
top AS (SELECT c.point_id AS node, coalesce(min(above), c.point_id) AS root FROM chosen c LEFT JOIN up ON up.node = c.point_id GROUP BY c.point_id),
tot AS (SELECT root, sum(w) AS total FROM top JOIN wt USING (node) GROUP BY 1), low AS (SELECT node, sum(w) AS side FROM (SELECT above AS node, wt.w FROM up JOIN wt ON wt.node = up.node UNION ALL SELECT node, w FROM wt) GROUP BY 1)"""


def _forest(spark, d):
    """Each chosen point tied to the smallest of its neighbours before it; the samples of a point are its weight."""
    points = settle(registry._some(spark, d), "points")
    pairs = support.neighbour_pairs(points, support.half_window(1, 1), ["point_id"])
    edges = pairs.groupBy(F.greatest("a_point_id", "b_point_id").alias("v")).agg(F.min(F.least("a_point_id", "b_point_id")).alias("u"))
    weights = S.samples(spark, d).groupBy(F.col("point_id").alias("node")).agg(F.sum("amp").cast("long").alias("w"))
    return edges.select("u", "v"), weights


@query(_recursive("samples", "chosen") + _PARENTS + " SELECT par.u, par.v, CAST(least(side, total - side) AS BIGINT) AS smaller, CAST(total AS BIGINT) AS total FROM par JOIN low ON low.node = par.v JOIN top ON top.node = par.v JOIN tot USING (root)")
def tree_bottlenecks(spark, d):
    """What hangs on each edge of a forest of the grid."""
    return forests.bottlenecks(*_forest(spark, d))


@query()
def piece_bottlenecks(spark, d):
    """Points that hang on each vote of the surest forest of the pieces of each interferogram."""
    pieces, votes = registry._pieces(spark, d)
    return unwrap.piece_bottlenecks(settle(votes, "votes"), pieces)


@query()
def piece_conflicts(spark, d):
    """Votes between pieces of small tiles that the surest forest contradicts, with the cycle that shows it."""
    return consistency.piece_conflicts(settle(registry._pieces(spark, d, (4, 4))[1], "votes"))


# Gradients, closures and series.


@query(build(f", m AS (SELECT class, a.pair_id, abs(atan2(sin(b.phase - a.phase), cos(b.phase - a.phase))) AS size FROM anchor JOIN ifg a ON a.point_id = p JOIN ifg b ON b.point_id = q AND b.pair_id = a.pair_id) SELECT pair_id, class, count(*) AS n, {x6('avg(size)')} AS mean_abs, {x6('avg(CAST(size > pi() / 2 AS INT))')} AS frac_pi2 FROM m GROUP BY 1, 2", "anchor", "ifg"))
def anchor_stats(spark, d):
    points = settle(registry._some(spark, d), "points")
    rows = audits.anchor_stats(spatial.anchors(points, spatial.grid_components(points, 1), 30), registry._ifgs(spark, d))
    return rows.select("pair_id", "class", "n", tidy(F.col("mean_abs")).alias("mean_abs"), tidy(F.col("frac_pi2")).alias("frac_pi2"))


@query(build(", h AS (SELECT pair_id, count(*) FILTER (abs(g) > pi() / 2) AS hits FROM grad GROUP BY 1), e AS (SELECT i AS t, hits FROM h JOIN pairs USING (pair_id) UNION ALL SELECT j, hits FROM h JOIN pairs USING (pair_id)) SELECT t, count(*) AS pairs, CAST(sum(hits) AS BIGINT) AS hits FROM e GROUP BY 1", "grad"))
def epoch_hits(spark, d):
    """Unsafe edges in all pairs of an epoch."""
    return audits.epoch_hits(registry._grads(spark, d), unwrap.pair_table(spark, PAIRS), unwrap.SAFE)


_LIMITS = {"above_1e7": 1e-7, "above_1e6": 1e-6, "above_1e5": 1e-5, "above_1e4": 1e-4}


@query(build(f", a AS (SELECT triangle_id, abs(atan2(sin(closure), cos(closure))) AS x FROM closure) SELECT triangle_id, {x6('sum(x)')} AS total, {', '.join(f'count(*) FILTER (x > {v!r}::DOUBLE + 1e-9) AS {n}' for n, v in _LIMITS.items())} FROM a GROUP BY 1", "closure"))
def closure_thresholds(spark, d):
    """Closures beyond four limits; a nanoradian is left for rounding."""
    rows = unwrap.triangle_closures(registry._ifgs(spark, d), registry.TRIANGLES)
    x = F.abs(F.atan2(F.sin("closure"), F.cos("closure")))
    return rows.groupBy("triangle_id").agg(tidy(F.sum(x)).alias("total"), *[F.count_if(x > v + 1e-9).alias(n) for n, v in _LIMITS.items()])


_SHARES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


@query(build(f"SELECT pair_id, {', '.join(f'{x6(f'quantile_cont(abs(g), {q})')} AS p{round(q * 100)}' for q in _SHARES)} FROM grad GROUP BY 1", "grad"))
def gradient_percentiles(spark, d):
    """Percentiles of the gradients' sizes, with linear interpolation."""
    rows = unwrap.gradient_percentiles(registry._grads(spark, d), list(_SHARES))
    return rows.select("pair_id", *[tidy(F.col("p")[k]).alias(f"p{round(q * 100)}") for k, q in enumerate(_SHARES)])


def _weights_sql(name: str, weights) -> str:
    rows = ", ".join(f"({e}, {t}, {float(weights[t, e])!r}::DOUBLE)" for e in range(weights.shape[1]) for t in range(weights.shape[0]))
    return f"{name} AS (SELECT point_id, t, sum(w * phase) AS phase FROM ifg JOIN (VALUES {rows}) v(pair_id, t, w) USING (pair_id) GROUP BY ALL)"


@query(build(f""", {_weights_sql('s', registry._WEIGHTS)}, {_weights_sql('tree', registry._TREE)},
o AS (SELECT g.phase - (b.phase - a.phase) AS off FROM ifg g JOIN pairs USING (pair_id) JOIN s a ON a.point_id = g.point_id AND a.t = i JOIN s b ON b.point_id = g.point_id AND b.t = j)
SELECT {x6('sqrt(avg(off * off))')} AS rms, {x6('max(abs(off))')} AS largest, {x6('max(abs(atan2(sin(off), cos(off))))')} AS wrap_back, (SELECT {x6('max(abs(s.phase - tree.phase))')} FROM s JOIN tree USING (point_id, t)) AS tree_gap,
  CASE WHEN max(abs(off)) <= 1e-4 AND (SELECT max(abs(s.phase - tree.phase)) FROM s JOIN tree USING (point_id, t)) <= 1e-4 THEN 'PASS' ELSE 'REVIEW' END AS verdict FROM o""", "ifg"))  # fmt: skip
def inversion_parity(spark, d):
    """Residuals of the series over all points, and whether least squares and the tree say the same."""
    ifgs = settle(registry._ifgs(spark, d), "ifgs")
    solved, tree = series.invert(ifgs, registry._WEIGHTS), series.invert(ifgs, registry._TREE)
    rows = audits.inversion_parity(settle(solved, "series"), tree, ifgs, unwrap.pair_table(spark, PAIRS))
    return rows.select(*[tidy(F.col(x)).alias(x) for x in ("rms", "largest", "wrap_back", "tree_gap")], "verdict")


@query()
def epoch_fragments(spark, d):
    """Safe fragments of each epoch's own phase."""
    phases = registry._full(spark, d).select(F.col("t").alias("pair_id"), "point_id", "phase")
    grads = unwrap.gradients(phases, registry._knn(spark, d))
    return audits.epoch_fragments(unwrap.safe_fragments(grads, phases))


@query(build("SELECT a.point_id AS p, b.point_id AS q, greatest(abs(a.r - b.r), abs(a.c - b.c)) AS chebyshev FROM (SELECT point_id, r, c FROM comp JOIN chosen USING (point_id) WHERE component <> (SELECT main FROM main)) a JOIN (SELECT point_id, r, c FROM comp JOIN chosen USING (point_id) WHERE component = (SELECT main FROM main)) b ON true QUALIFY row_number() OVER (PARTITION BY a.point_id ORDER BY greatest(abs(a.r - b.r), abs(a.c - b.c)), b.point_id) = 1", "comp", "chosen", "main"))
def nearest_in_main(spark, d):
    """The nearest point of the main component for each point outside it."""
    points = settle(registry._some(spark, d), "points")
    return spatial.nearest_in_main(points, spatial.grid_components(points, 1), (32, 32))

