"""Identities and independent rewrites of the numeric operators."""

import math
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from fringeflow.functions import phase
from fringeflow.operators import coherence, components, forests, linking, network, series, support, unwrap
from fringeflow.plans.temporal import sequential_plan


def _one(spark, *columns):
    return spark.range(1).select(*columns).head()


def test_glrt(spark):
    row = _one(spark, phase.glrt_statistic(38, F.lit(2.0), F.lit(2.0)).alias("a"), phase.glrt_statistic(38, F.lit(0.0), F.lit(2.0)).alias("b"))
    assert row.a == 0 and row.b is None
    assert math.isclose(phase.glrt_threshold(0.005), 7.8794, abs_tol=1e-4)


def test_wraps(spark):
    row = _one(spark, phase.wrap(F.lit(3 * math.pi / 2)).alias("a"), phase.wrap_half_open(F.lit(math.pi)).alias("b"), phase.ambiguity(F.lit(5 * math.pi)).alias("c"))
    assert math.isclose(row.a, -math.pi / 2) and math.isclose(row.b, -math.pi) and row.c == 2


def _samples(spark, cube):
    rows = [(p, 0, p, t, float(abs(v)), float(np.angle(v)), float(v.real), float(v.imag)) for p, line in enumerate(cube) for t, v in enumerate(line)]
    return spark.createDataFrame(rows, "point_id long, r int, c int, t int, amp double, phase double, re double, im double")


def test_rank_one_coherence(spark):
    cube = np.array([[(2 + 0.1 * p) * np.exp(1j * a) for a in (0, 0.2, -0.4, 0.7)] for p in range(9)])
    edges = spark.createDataFrame([(0, p) for p in range(9)], "center_id long, neighbor_id long")
    rows = coherence.coherence_wide(edges, coherence.wide(_samples(spark, cube), 4), 4)
    for r in coherence.coherence_long(rows, 4).collect():
        assert math.isclose(math.hypot(r.cre, r.cim), 1, abs_tol=1e-9)
    linked = linking.link_phases(rows, 4).head()
    assert linked.estimator == linking.EMI and np.allclose(linked.phase, [0, 0.2, -0.4, 0.7], atol=1e-4)
    theta = spark.createDataFrame([(0, *linked.phase)], "point_id long, th0 double, th1 double, th2 double, th3 double")
    assert coherence.temporal_coherence(rows, theta, 4).head().tc > 0.999
    assert coherence.median_coherence(rows, 4).head().median_coh == pytest.approx(1)


def test_linking_codes():
    n = 6
    line = np.exp(1j * np.linspace(0, 1, n))
    good = np.outer(line, line.conj()) * (0.6 + 0.4 * np.eye(n))
    flat = np.outer(line, line.conj())
    sick = np.full((n, n), np.nan)
    bent = flat * np.where(np.eye(n), 1, 1.5)
    phases, codes, _ = linking.link(np.array([good, sick, bent]))
    assert codes.tolist() == [linking.EMI, linking.INVALID, linking.EVD]
    assert np.allclose(phases[0], -np.linspace(0, 1, n), atol=1e-6) or np.allclose(phases[0], np.linspace(0, 1, n), atol=1e-6)
    assert np.isnan(phases[1]).all()


def test_linking_recovers_noisy_phase():
    rng = np.random.default_rng(20260820)
    n, looks = 19, 80
    truth = rng.uniform(-1, 1, (128, n))
    z = np.exp(1j * truth)[:, None] * (rng.normal(size=(128, looks, 1)) + 1j * rng.normal(size=(128, looks, 1))) + 0.3 * (rng.normal(size=(128, looks, n)) + 1j * rng.normal(size=(128, looks, n)))
    cov = np.einsum("bki,bkj->bij", z, z.conj())
    power = np.sqrt(np.einsum("bii->bi", cov).real)
    phases, codes, _ = linking.link(cov / power[:, :, None] / power[:, None, :])
    assert (codes == linking.EMI).all()
    assert np.abs(np.angle(np.exp(1j * (phases - (truth - truth[:, :1]))))).mean() < 0.1


def test_estimators_combine(spark):
    codes = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (2, 0), (3, 255), (3, 0)], "p long, estimator short")
    assert sorted(map(tuple, linking.combined_estimator(codes, "p").collect())) == [(1, 1), (2, 0), (3, 255)]


def test_compression(spark):
    rng = np.random.default_rng(1234)
    z = rng.normal(size=(50, 10)) + 1j * rng.normal(size=(50, 10))
    th = rng.uniform(-3, 3, (50, 10))
    theta = spark.createDataFrame([(p, *map(float, row)) for p, row in enumerate(th)], "point_id long, " + ", ".join(f"th{t} double" for t in range(10)))
    got = {r.point_id: r for r in coherence.compress(coherence.wide(_samples(spark, z), 10), theta, 2, 10).collect()}
    for p in range(50):
        want = np.angle((z[p, 2:] * np.exp(-1j * th[p, 2:])).sum())
        assert abs(np.angle(np.exp(1j * (got[p].phase - want)))) < 1e-9 and math.isclose(got[p].amp, np.abs(z[p, 2:]).mean())


def test_bits_round_trip(spark):
    rng = random.Random(20260820)
    cells = {(p, b) for p in range(40) for b in range(25) if rng.random() < 0.35}
    words = support.support_bits(spark.createDataFrame(list(cells), "center_id long, bit int"))
    assert {tuple(r) for r in support.unpack_bits(words, 25).collect()} == cells
    assert all(r.k == sum(p == r.center_id for p, _ in cells) for r in words.collect())


def test_state_core(spark):
    rng = random.Random(3)
    edges = {(a, b) for a in range(60) for b in range(60) if a < b and rng.random() < 0.1}
    edges |= {(b, a) for a, b in edges}
    state = {p for p in range(60) if sum(a == p for a, _ in edges) >= 4}
    while True:
        kept = {p for p in state if sum(a == p and b in state for a, b in edges) >= 4}
        if kept == state:
            break
        state = kept
    frame = spark.createDataFrame(sorted(edges), "center_id long, neighbor_id long")
    counts = frame.groupBy("center_id").agg(F.count("*").alias("k"))
    got = {r.point_id: r.effective_k for r in support.state_core(frame, counts, 4).collect()}
    assert got == {p: sum(a == p and b in state for a, b in edges) for p in state} and 0 < len(state) < 60


@pytest.mark.parametrize("epochs, m, real, compressed, sizes", [(38, 15, [15, 15, 8], [0, 1, 2], [15, 16, 10]), (38, 19, [19, 19], [0, 1], [19, 20]), (10, 12, [10], [0], [10])])
def test_plans(epochs, m, real, compressed, sizes):
    plan = sequential_plan(epochs, m)
    assert [s.real for s in plan] == real and [len(s.compressed) for s in plan] == compressed and [s.solver_size for s in plan] == sizes
    assert sequential_plan(60, 15, most_history=1)[3].compressed == ("c0002",)
    with pytest.raises(ValueError):
        sequential_plan(38, 15, reference=3)


def test_components(spark):
    rng = random.Random(7)
    chain = [(i, i + 1) for i in range(100, 160)]
    edges = chain + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(200, 200), (5, 5)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def _graph(seed):
    rng = random.Random(seed)
    return sorted({(a, b) for a, b in combinations(range(9), 2) if rng.random() < 0.35})


@pytest.mark.parametrize("seed", range(3))
def test_cycles_and_bridges(spark, seed):
    links = _graph(seed)
    frame = spark.createDataFrame(links, "i int, j int")
    near = {x: {b for a, b in [*links, *[(j, i) for i, j in links]] if a == x} for x in range(9)}
    for k in (3, 4, 5):
        want = set()

        def walk(path):
            if len(path) == k:
                if path[0] in near[path[-1]] and path[1] < path[-1]:
                    want.add(tuple(path))
                return
            for n in near[path[-1]]:
                if n > path[0] and n not in path:
                    walk([*path, n])

        for start in range(9):
            walk([start])
        assert sorted(map(tuple, network.cycles(frame, k).collect())) == sorted(want)

    def parts(edges):
        left, n = set(range(9)), 0
        while left:
            n += 1
            stack = [left.pop()]
            while stack:
                x = stack.pop()
                for a, b in edges:
                    for y in ({b} if a == x else {a} if b == x else ()):
                        if y in left:
                            left.discard(y)
                            stack.append(y)
        return n

    want = [e for e in links if parts([x for x in links if x != e]) > parts(links)]
    assert sorted(map(tuple, network.bridges(frame).collect())) == want
    basis = network.cycle_basis(links)
    assert len(basis) == len(links) - 9 + parts(links)
    for cycle in basis:
        flow = np.zeros(9)
        for e, s in cycle:
            flow[links[e][0]] -= s
            flow[links[e][1]] += s
        assert not flow.any()


def test_inversion(spark):
    links = [(0, 1), (1, 2), (0, 2), (2, 3), (1, 3)]
    truth = np.array([[0, 0.3, -0.5, 1.0], [0, 1.0, 2.0, 3.0]])
    rows = [(e, p, float(truth[p][j] - truth[p][i])) for e, (i, j) in enumerate(links) for p in range(2)]
    ifgs = spark.createDataFrame(rows, "pair_id int, point_id long, phase double")
    got = series.invert(ifgs, network.inversion_weights(links, 4))
    for r in got.collect():
        assert math.isclose(r.phase, truth[r.point_id][r.t], abs_tol=1e-9)
    assert all(r.rms < 1e-9 for r in series.residual_rms(got, ifgs, unwrap.pair_table(spark, links)).collect())


def test_unwrapping_a_ramp(spark):
    """A plane steeper than a turn over the grid comes back up to one whole-turn shift for each piece."""
    side, slope = 12, 0.7
    points = [(r * side + c, r, c) for r in range(side) for c in range(side)]
    truth = {p: slope * (r + c) for p, r, c in points}
    wrapped = {p: math.atan2(math.sin(v), math.cos(v)) for p, v in truth.items()}
    frame = spark.createDataFrame(points, "point_id long, r int, c int")
    from fringeflow.operators import spatial

    edges = spatial.nearest(frame, 1, 4, 1.0, 1.0)
    ifgs = spark.createDataFrame([(0, p, v) for p, v in wrapped.items()], "pair_id int, point_id long, phase double")
    grads = unwrap.gradients(ifgs, edges)
    got = unwrap.unwrap_fragments(ifgs, grads, unwrap.safe_fragments(grads, ifgs), frame, tile=(6, 6))
    rows = got.collect()
    assert {r.fragment for r in rows} == {0} and len({r.root for r in rows}) == 4
    for root in {r.root for r in rows}:
        off = {round((r.unwrapped - truth[r.point_id]) / (2 * math.pi), 6) for r in rows if r.root == root}
        assert len(off) == 1 and float(off.pop()).is_integer()
    votes = unwrap.fragment_votes(grads, got.select("pair_id", "point_id", F.col("root").alias("piece"), F.col("unwrapped").alias("value")), edges).collect()
    assert len(votes) == 4 and all(v.exact and v.ratio == 1 for v in votes)
    assert unwrap.strong_votes(unwrap.fragment_votes(grads, got.select("pair_id", "point_id", F.col("root").alias("piece"), F.col("unwrapped").alias("value")), edges)).count() == 4
    by_vote = unwrap.fragment_votes(grads, got.select("pair_id", "point_id", F.col("root").alias("piece"), F.col("unwrapped").alias("value")), edges)
    shifts = {s.piece: (s.root, s["shift"], s.against) for s in unwrap.piece_shifts(by_vote).collect()}
    assert {s[0] for s in shifts.values()} == {0} and all(s[2] == 0 for s in shifts.values())
    assert len({round(r.unwrapped + 2 * math.pi * shifts[r.root][1] - truth[r.point_id], 6) for r in rows}) == 1


def test_pieces_are_tied_whatever_the_tile(spark):
    from fringeflow.operators import spatial

    side = 12
    points = [(r * side + c, r, c) for r in range(side) for c in range(side)]
    frame = spark.createDataFrame(points, "point_id long, r int, c int")
    edges = spatial.nearest(frame, 1, 4, 1.0, 1.0)
    wrapped = [(e, p, math.atan2(math.sin(s * (r + c)), math.cos(s * (r + c)))) for e, s in enumerate((0.7, -0.9)) for p, r, c in points]
    ifgs = spark.createDataFrame(wrapped, "pair_id int, point_id long, phase double")
    grads = unwrap.gradients(ifgs, edges)
    found = []
    for tile in ((4, 5), (128, 256)):
        pieces = unwrap.unwrap_fragments(ifgs, grads, unwrap.safe_fragments(grads, ifgs), frame, tile=tile)
        tied = unwrap.tie_pieces(pieces, unwrap.piece_shifts(unwrap.piece_votes(pieces, grads, edges)))
        found.append({(r.pair_id, r.point_id): (r.root, round(r.unwrapped, 6)) for r in tied.collect()})
    assert found[0] == found[1] and len(found[0]) == 2 * side * side


@pytest.mark.parametrize("one_task", [True, False])
def test_piece_shifts_take_the_surest_forest(spark, monkeypatch, one_task):
    if not one_task:
        monkeypatch.setattr(forests, "ONE_TASK", -1)
    rng = np.random.default_rng(3)
    rows = []
    for pair in range(3):
        for a in range(40):
            for b in range(a + 1, 40):
                if rng.random() < 0.06:
                    rows.append((pair, a, b, int(rng.integers(-2, 3)), float(rng.integers(1, 4)) / 4, int(rng.integers(1, 4)), float(rng.integers(1, 3)), 1.0))
    votes = spark.createDataFrame(rows, "pair_id int, frag_a long, frag_b long, mode_shift long, ratio double, edge_count long, median_abs double, median_dist double")
    got = {(r.pair_id, r.piece): (r.root, r["shift"], r.against) for r in unwrap.piece_shifts(votes).collect()}
    want = {}
    for pair in range(3):
        own = sorted((r[1:] for r in rows if r[0] == pair), key=lambda r: (-r[3], -r[4], r[5], r[6], r[0], r[1]))
        at = {p: (p, 0) for r in own for p in r[:2]}  # component, shift
        for a, b, k, *_ in own:
            (ca, sa), (cb, sb) = at[a], at[b]
            if ca != cb:
                at |= {p: (ca, s + sa - k - sb) for p, (c, s) in at.items() if c == cb}
        for c in {c for c, _ in at.values()}:
            held = sorted(p for p in at if at[p][0] == c)
            for p in held:
                against = sum(at[b][1] + k != at[a][1] for a, b, k, *_ in own if p in (a, b))
                want[pair, p] = (held[0], at[p][1] - at[held[0]][1], against)
    assert got == want


def test_core_numbers_answer_every_threshold(spark):
    rng = np.random.default_rng(21)
    edges = {(int(a), int(b)) for a, b in rng.integers(0, 45, (330, 2)) if a != b}
    edges |= {(b, a) for a, b in edges if (a + b) % 9}  # most ways, not all, go both ways
    frame = spark.createDataFrame(sorted(edges), "center_id long, neighbor_id long")
    degree = {p: sum(a == p for a, _ in edges) for p in range(46)}
    counts = spark.createDataFrame(sorted(degree.items()), "center_id long, k long")
    tiles = spark.createDataFrame([(p, f"{p % 4}") for p in degree], "point_id long, tile string")
    cores = support.core_numbers(frame, counts, tiles)
    got = {r.point_id: r.core for r in cores.collect()}
    for threshold in range(1, max(degree.values()) + 1):
        state = {p for p, k in degree.items() if k >= threshold}
        while True:
            kept = {p for p in state if sum(b in state for a, b in edges if a == p) >= threshold}
            if kept == state:
                break
            state = kept
        assert {p for p, c in got.items() if c >= threshold} == state
    assert {r.point_id for r in support.state_core(frame, counts, 5).collect()} == {p for p, c in got.items() if c >= 5}
    safe = {r.center_id: r.safe_threshold for r in support.safe_thresholds(frame, cores, 4).collect()}
    for p in safe:
        most = max((t for t in range(1, 30) if sum(got[b] >= t for a, b in edges if a == p) >= 4), default=None)
        assert safe[p] == most


def test_distinct_regions_are_the_serial_choice(spark):
    rng = np.random.default_rng(31)
    cells = {(int(r), int(c)): float(v) for r, c, v in zip(rng.integers(-5, 30, 300), rng.integers(0, 40, 300), np.round(rng.uniform(0, 1, 300), 2))}
    frame = spark.createDataFrame([(r, c, v) for (r, c), v in cells.items()], "r int, c int, score double")
    for apart, top in ((1, 500), (4, 500), (7, 6)):
        want = []
        for (r, c), v in sorted(cells.items(), key=lambda x: (x[1], x[0])):
            if all(max(abs(r - a), abs(c - b)) >= apart for a, b, _ in want) and len(want) < top:
                want.append((r, c, v))
        assert [(x.r, x.c, x.score) for x in series.distinct_regions(frame, apart, top).orderBy("rank").collect()] == want


def test_held_out_fits_against_refitting(spark):
    rng = np.random.default_rng(41)
    rows, want = [], {}
    for p in range(12):
        n = int(rng.integers(5, 30))
        x, s = np.sort(rng.uniform(0, 9, n)), rng.normal(3, 2, n)
        if p == 3:
            s = 2 * x + 1  # nothing but the trend
        y = 0.4 * x + (p % 3) * s + rng.normal(0, 0.3, n)
        rows += [(p, float(a), float(b), float(c), i) for i, (a, b, c) in enumerate(zip(x, s, y))]
        errors = np.zeros(2)
        for f in range(4):
            test = np.arange(n) % 4 == f
            for m, cols in enumerate(([np.ones(n), x], [np.ones(n), x, s])):
                a = np.stack(cols, axis=1)
                fit = np.linalg.lstsq(a[~test], y[~test], rcond=None)[0]
                errors[m] += ((y[test] - a[test] @ fit) ** 2).sum()
        rho = np.corrcoef(x, s)[0, 1]
        want[p] = (n, rho, np.sqrt(max(0, 1 - rho**2)), 1 / (1 - rho**2) if p != 3 else None, *np.sqrt(errors / n))
    frame = spark.createDataFrame(rows, "p int, x double, s double, y double, i int")
    for r in series.cross_validated_fit(frame, "p", "x", "s", "y", F.col("i") % 4).collect():
        w = want[r.p]
        assert r.n == w[0] and np.allclose([r["corr"], r.retained], w[1:3], atol=1e-6)
        if r.p == 3:
            assert r.cv_full is None
        else:
            assert np.allclose([r.vif, r.cv_reduced, r.cv_full], w[3:], rtol=1e-6)


def test_reference_window_with_too_few_points(spark):
    rows = [(p, p // 20, p % 20, t, float(p % 7)) for p in range(200) for t in range(3) if t < 2 or p < 50]
    values = spark.createDataFrame(rows, "point_id long, r int, c int, t int, phase double")
    assert sorted(r.t for r in series.reference_window(values, 5, 10, 9, 10).collect()) == [0, 1]
    with pytest.raises(ValueError, match="epoch 2 has 50"):
        series.reference_window(values, 5, 10, 9, 10, strict=True)
