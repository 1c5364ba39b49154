"""Sequential linking, corrections, history distances and streams."""

import math
import random
import time
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from fringeflow.operators import coherence, corrections, network, sequential, series, similarity
from fringeflow.plans.temporal import sequential_plan
from fringeflow.streaming import windows


def test_sequential_linking(spark):
    """Epochs of one phase history come back through the compressed inputs of earlier stages."""
    rng = np.random.default_rng(8)
    truth = np.concatenate([[0], rng.uniform(-1, 1, 8)])
    n, points = 9, 60
    base = rng.normal(size=(points, 1)) + 1j * rng.normal(size=(points, 1))
    z = base * np.exp(1j * truth) + 0.05 * (rng.normal(size=(points, n)) + 1j * rng.normal(size=(points, n)))
    rows = [(p, t, float(z[p, t].real), float(z[p, t].imag)) for p in range(points) for t in range(n)]
    pixels = coherence.wide(spark.createDataFrame(rows, "point_id long, t int, re double, im double"), n)
    edges = spark.createDataFrame([(a, b) for a in range(points) for b in range(points) if a != b and abs(a - b) <= 20], "center_id long, neighbor_id long")
    linked = sequential.run_plan(edges, pixels, sequential_plan(n, 3))
    got = linked.collect()
    assert len(got) == points * n and {r.stage for r in got} == {0, 1, 2}
    for r in got:
        assert abs(np.angle(np.exp(1j * (r.phase - truth[r.t])))) < 0.1
    quality = coherence.temporal_coherence(coherence.coherence_wide(edges, pixels, n), sequential.complete_only(linked, n), n)
    assert quality.count() == points


def test_history_distance(spark):
    def literal(a, b):
        n, i, j, most = len(a), 0, 0, 0
        while i < n and j < n:
            x, y = a[i], b[j]
            i += x <= y
            j += x >= y
            most = max(most, abs(j - i))
        return most

    rng = random.Random(4)
    rows = [(k, sorted(float(rng.randint(0, 9)) for _ in range(7)), sorted(float(rng.randint(0, 9)) for _ in range(7))) for k in range(60)]
    frame = spark.createDataFrame(rows, "k long, a array<double>, b array<double>")
    got = {r.k: (r.gap, r.p) for r in frame.select("k", similarity.ks_gap(F.col("a"), F.col("b"), 7).alias("gap"), similarity.ks_probabilities(similarity.ks_gap(F.col("a"), F.col("b"), 7), 7).alias("p")).collect()}
    for k, a, b in rows:
        assert got[k][0] == literal(a, b) and math.isclose(got[k][1], similarity.ks_probability(literal(a, b) / 7, 7))
    assert similarity.ks_probability(1.0, 50) < 1e-9


@pytest.mark.parametrize("links", [[(0, 1), (1, 2), (0, 2), (2, 3), (1, 3)], [(0, 1), (0, 2), (1, 2), (1, 3), (2, 3), (2, 4), (3, 4), (5, 6), (6, 7), (5, 7)], [(3, 0), (0, 1), (2, 1), (2, 3), (0, 2), (4, 0)]])
def test_network_corrections_are_those_of_the_search(links):
    rng = random.Random(len(links))
    cycles = network.cycle_basis(links)
    for _ in range(60):
        wanted = [rng.randint(-3, 3) for _ in cycles]
        for most in (1, 2, 4):
            best, got = corrections.least_correction(cycles, wanted, most), corrections.least_network_correction(links, wanted, most)
            if best is None:
                assert got is None
                continue
            assert got[1] == sum(map(abs, best)) == sum(map(abs, got[0]))
            edges = sorted({e for c in cycles for e, _ in c})
            assert [got[0][e] for e in edges] == best and not any(v for e, v in enumerate(got[0]) if e not in edges)


def test_network_corrections_of_production_size():
    links = [(i, j) for i in range(38) for j in (i + 1, i + 2, i + 3) if j < 38]
    cycles = network.cycle_basis(links)
    assert len(links) == 108 and len(cycles) == 71
    rng = random.Random(6)
    began = time.perf_counter()
    for n in range(20):
        planted = [rng.choice([-2, -1, 1, 2]) if rng.random() < (n + 1) / 60 else 0 for _ in links]
        wanted = [sum(s * planted[e] for e, s in c) for c in cycles]
        x, total = corrections.least_network_correction(links, wanted)
        assert [sum(s * x[e] for e, s in c) for c in cycles] == wanted
        assert total == sum(map(abs, x)) <= sum(map(abs, planted))
    assert time.perf_counter() - began < 20


def test_least_corrections():
    cycles = [[(0, 1), (1, 1), (2, -1)], [(2, 1), (3, 1), (4, -1)], [(1, 1), (3, 1), (5, -1)]]
    for wanted in product((-1, 0, 1), repeat=3):
        best = min((x for x in product(range(-1, 2), repeat=6) if all(sum(s * x[e] for e, s in c) == w for c, w in zip(cycles, wanted))), key=lambda x: sum(map(abs, x)))
        found = corrections.least_correction(cycles, list(wanted))
        assert all(sum(s * found[e] for e, s in c) == w for c, w in zip(cycles, wanted)) and sum(map(abs, found)) == sum(map(abs, best))


def test_patterns_are_solved_once(spark):
    cycles = [[(0, 1), (1, 1), (2, -1)]]
    patterns = spark.createDataFrame([("1",), ("0",), ("-1",), ("1",)], "pattern string")
    got = sorted((r.pattern, r.correction) for r in corrections.sparse_corrections(patterns, cycles).collect())
    assert [g[0] for g in got] == ["-1", "1"] and all(abs(g[1]) == 1 for g in got)


def test_gauge(spark):
    links = [(0, 1), (1, 2), (0, 2), (2, 3), (1, 3)]
    cycles = network.cycle_basis(links)
    modes = spark.createDataFrame([(k, k + 1) for k in range(len(cycles))], "triangle_id int, modal_k int")
    delta = {r.pair_id: r.delta for r in corrections.gauge(modes, cycles, len(links)).collect()}
    assert all(sum(s * delta[e] for e, s in c) == -(k + 1) for k, c in enumerate(cycles))


def test_trees():
    rng = random.Random(2)
    edges = [(i, j, rng.random()) for i in range(8) for j in range(i + 1, 8)]
    tree = network.degree_capped_tree(edges, 8, 2)
    more = network.add_redundancy(tree, edges, 4)
    degree = lambda links: max(sum(x in e for e in links) for x in range(8))
    assert len(tree) == 7 == len(network.spanning_tree(tree)) and degree(tree) <= 2 and degree(more) <= 4 and set(tree) < set(more)
    w = network.tree_weights([(0, 1), (1, 2), (0, 2), (2, 3)], 4)
    truth = np.array([0, 0.5, -1.0, 2.0])
    assert np.allclose(w @ np.array([0.5, -1.5, -1.0, 3.0]), truth)
    assert len(network.connected_network(edges, [(0, 1), (2, 3)])) == 7


def test_partial_fit(spark):
    rng = np.random.default_rng(6)
    t = np.arange(12.0)
    s = rng.normal(size=12)
    y = 1 + 0.3 * t - 2.5 * s + 0.1 * rng.normal(size=12)
    got = series.partial_fit(spark.createDataFrame([(1, float(a), float(b), float(c)) for a, b, c in zip(t, s, y)], "k int, t double, s double, y double"), "k", "t", "s", "y").collect()[0]
    a = np.column_stack([np.ones(12), t, s])
    fit, left, *_ = np.linalg.lstsq(a, y, rcond=None)
    assert math.isclose(got[2], fit[2], rel_tol=1e-9) and math.isclose(got.rms_after, math.sqrt(left[0] / 12), rel_tol=1e-9)
    assert math.isclose(got.k_se, math.sqrt(left[0] / 9 * np.linalg.inv(a.T @ a)[2, 2]), rel_tol=1e-9)


def test_stream_of_files(spark, tmp_path):
    rows = [(f"2024-01-01 0{h}:30:00", "ab"[h % 2], float(h)) for h in range(8)]
    frame = spark.createDataFrame(rows, "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    frame.coalesce(1).write.parquet(f"file://{tmp_path}/in")
    stream = windows.window_sums(windows.read_events(spark, f"file://{tmp_path}/in", "*.parquet"), "2 hours", "1 day")
    got = windows.run_available(stream, "test-windows").collect()
    assert len(got) == 8 and sum(r.total for r in got) == 28 and all(r.n == 1 for r in got)
