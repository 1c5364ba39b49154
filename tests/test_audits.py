"""Gates and audits, wide windows and many epochs against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fringeflow.operators import audits, coherence, corrections, support, unwrap
from fringeflow.plans.registry import QUERIES
from fringeflow.streaming import windows

DATA = "/root/testdata/sf0.001"


def _frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_wide_bits(spark):
    rng = random.Random(20260820)
    cells = {(p, b) for p in range(60) for b in range(253) if b != 126 and rng.random() < 0.35} | {(99, b) for b in range(253)}
    words = support.support_bits(_frame(spark, list(cells), "center_id long, bit int"), 253)
    assert words.columns == ["center_id", "word_0", "word_1", "word_2", "word_3", "k"]
    got = {r.center_id: r for r in words.collect()}
    for p in got:
        own = {b for q, b in cells if q == p}
        held = sum((got[p][f"word_{w}"] % (1 << 64)) << (64 * w) for w in range(4))
        assert held == sum(1 << b for b in own) and got[p].k == len(own)
    assert {tuple(r) for r in support.unpack_bits(words, 253).collect()} == cells
    with pytest.raises(Exception, match="past the window"):
        support.support_bits(_frame(spark, [(1, 64)], "center_id long, bit int")).collect()


@pytest.mark.parametrize("half", [(5, 11), (2, 2), (0, 13), (13, 0)])
def test_neighbour_pairs_of_any_window(spark, half):
    rng = random.Random(2)
    points = [(k, r, c) for k, (r, c) in enumerate(sorted({(rng.randint(-20, 20), rng.randint(-30, 30)) for _ in range(300)}))]
    got = {(x.a_point_id, x.b_point_id, x.dr, x.dc) for x in support.neighbour_pairs(_frame(spark, points, "point_id long, r int, c int"), support.half_window(*half), ["point_id"]).collect()}
    want = {(p, q, b - a, d - c) for p, a, c in points for q, b, d in points if abs(a - b) <= half[0] and abs(c - d) <= half[1] and (b, d) > (a, c)}
    assert got == want and want


def test_coherence_in_tiles(spark):
    rng = np.random.default_rng(5)
    n, points = 6, [(r * 9 + c, r, c) for r in range(9) for c in range(9)]
    z = rng.normal(size=(81, n)) + 1j * rng.normal(size=(81, n))
    samples = _frame(spark, [(p, t, float(z[p, t].real), float(z[p, t].imag)) for p in range(81) for t in range(n) if (p, t) != (7, 3)], "point_id long, t int, re double, im double")
    edges = _frame(spark, [(a, b) for a, r, c in points for b, r2, c2 in points if a != b and abs(r - r2) <= 2 and abs(c - c2) <= 3], "center_id long, neighbor_id long")
    arrays = coherence.coherence_arrays(edges, coherence.sample_arrays(samples, n), _frame(spark, points, "point_id long, r int, c int"), n, (4, 5))
    key = lambda rows: {(r.center_id, r.i, r.j): (round(r.cre, 9), round(r.cim, 9)) for r in rows.collect()}
    want = key(coherence.coherence_long(coherence.coherence_wide(edges, coherence.wide(samples, n), n), n))
    assert key(coherence.pairs_of_arrays(arrays, n)) == want and len(want) == 81 * 15


def test_integration_follows_the_flattest_forest():
    import pandas as pd

    rng = np.random.default_rng(11)
    for _ in range(20):
        n = 40
        phase = rng.uniform(-3, 3, n)
        links = [(int(u), int(v), float(g)) for u, v, g in zip(rng.integers(0, n, 60), rng.integers(0, n, 60), rng.uniform(-1.5, 1.5, 60)) if u != v]
        rows = pd.DataFrame({"pair_id": 0, "tile": "t", "u": [*range(n), *[u for u, _, _ in links]], "v": [*[np.nan] * n, *[v for _, v, _ in links]], "g": [*phase, *[g for _, _, g in links]]})
        got = unwrap._integrate(rows)
        near = {p: [] for p in range(n)}
        comp = list(range(n))
        for u, v, g in sorted(links, key=lambda x: (abs(x[2]), x[0], x[1])):
            if comp[u] != comp[v]:
                old = comp[v]
                comp = [comp[u] if c == old else c for c in comp]
                near[u].append((v, g))
                near[v].append((u, -g))
        found = {}
        for p in range(n):
            if p not in found:
                found[p], stack = (p, phase[p]), [p]
                while stack:
                    a = stack.pop()
                    for b, g in near[a]:
                        if b not in found:
                            found[b] = (p, found[a][1] + g)
                            stack.append(b)
        assert [found[p][0] for p in range(n)] == got["root"].tolist()
        assert np.allclose([found[p][1] for p in range(n)], got["unwrapped"])


def test_unsolved_patterns_are_told(spark):
    cycles = [[(0, 1), (1, 1)], [(0, 1), (1, 1)]]  # the same sum cannot be two numbers
    rows = corrections.sparse_corrections(_frame(spark, [("1,2",), ("-3,-3",), ("0,0",)], "pattern string"), cycles).collect()
    assert [(r.pattern, r.pair_id, r.correction) for r in rows if r.pattern == "1,2"] == [("1,2", None, None)]
    assert sum(r.correction for r in rows if r.pattern == "-3,-3") == 3 and not [r for r in rows if r.pattern == "0,0"]


def test_final_scatterers(spark):
    points = _frame(spark, [(1, 0, 0, 7), (2, 0, 1, 6), (3, 0, 2, 7), (4, 0, 3, 5), (5, 0, 4, 7), (6, 0, 5, 7)], "point_id long, r int, c int, n long")
    heights = _frame(spark, [(1, 10.0), (2, 3.0), (3, 0.0), (4, float("nan")), (5, None)], "point_id long, height double")
    rows = audits.final_scatterers(points, heights, 7)
    assert {r.point_id: r.status for r in rows.collect()} == {1: "kept", 2: "incomplete", 3: "no_geometry", 4: "no_geometry", 5: "no_geometry", 6: "no_geometry"}
    with pytest.raises(Exception, match="point 2 has geometry"):
        audits.require_complete(rows).collect()
    assert [r.point_id for r in audits.require_complete(rows.where("point_id <> 2")).collect()] == [1]


def test_state_codes(spark):
    rows = [(1, False, False, 0, None, None), (2, True, False, 99, True, True), (3, True, True, 23, True, True), (4, True, True, None, True, True), (5, True, True, 24, None, True), (6, True, True, 24, True, False), (7, True, True, 24, True, True)]
    got = audits.state_codes(_frame(spark, rows, "point_id long, inside boolean, centre_ok boolean, k long, linked boolean, compressed boolean"), 24)
    assert {r.point_id: r.code for r in got.collect()} == {1: 0, 2: 5, 3: 2, 4: 2, 5: 3, 6: 4, 7: 1}


def test_full_span_centres(spark):
    counts = _frame(spark, [(1, 50), (2, 48), (3, 12)], "center_id long, k long")
    pick = lambda *ids: _frame(spark, [(i,) for i in ids], "center_id long")
    assert sorted(map(tuple, audits.full_scm_centres(pick(1, 2), counts, counts).collect())) == [(1, 50), (2, 48)]
    with pytest.raises(Exception, match="fewer than 48"):
        audits.full_scm_centres(pick(1, 3), counts, counts).collect()
    with pytest.raises(Exception, match="expected 49"):
        audits.full_scm_centres(pick(1), counts, _frame(spark, [(1, 49)], "center_id long, k long")).collect()
    with pytest.raises(Exception, match="unknown center_id 9"):
        audits.known_only(pick(1, 9), counts, "center_id").collect()


def test_spread_sample(spark):
    for total, wanted in ((10, 3), (10, 10), (7, 20), (1000, 37), (5, 1), (5, 0), (3, 2)):
        rows = audits.spread_sample(spark.range(total).withColumnRenamed("id", "no"), "no", total, wanted)
        assert sorted(r.no for r in rows.collect()) == (list(range(total)) if wanted >= total else sorted({k * (total - 1) // max(wanted - 1, 1) for k in range(wanted)}))


def test_masks_and_partitions(spark):
    ids = lambda *x: _frame(spark, [(i,) for i in x], "point_id long")
    assert tuple(audits.mask_agreement(ids(1, 2, 3, 3), ids(2, 3, 4), "point_id").collect()[0]) == (2, 1, 1, 0.5)
    assert tuple(audits.mask_agreement(ids(), ids(), "point_id").collect()[0]) == (0, 0, 0, None)
    alike = audits.same_partition(_frame(spark, [(1, "x"), (1, "x"), (2, "y")], "a int, b string"), "a", "b").collect()[0]
    assert (alike.split_a, alike.split_b, alike.equal) == (0, 0, True)
    other = audits.same_partition(_frame(spark, [(1, "x"), (1, "y"), (2, "y")], "a int, b string"), "a", "b").collect()[0]
    assert (other.labels_a, other.split_a, other.labels_b, other.split_b, other.equal) == (2, 1, 2, 1, False)


def _sides(edges):
    """Nodes on either side of each edge whose loss parts its ends."""
    out = []
    for i, j in edges:
        near = {}
        for a, b in edges:
            if (a, b) != (i, j):
                near.setdefault(a, []).append(b)
                near.setdefault(b, []).append(a)
        reach = lambda s: _walk(near, s)
        if j not in reach(i):
            out.append((i, j, len(reach(i)), len(reach(j))))
    return sorted(out)


def _walk(near, start):
    seen, stack = {start}, [start]
    while stack:
        for b in near.get(stack.pop(), []):
            if b not in seen:
                seen.add(b)
                stack.append(b)
    return seen


def test_bridges_and_gate(spark):
    rng = random.Random(1)
    edges = sorted({tuple(sorted(rng.sample(range(26), 2))) for _ in range(30)} | {(30, 31), (31, 32)})
    frame = _frame(spark, edges, "i int, j int")
    got = sorted((r.i, r.j, r.side_i, r.side_j) for r in audits.bridge_sides(frame).collect())
    assert got == _sides(edges) and len(got) > 3
    ring = _frame(spark, [(0, 1, 1, 0.0, 0.1), (1, 2, 1, 0.0, 0.1), (0, 2, 2, 0.0, 0.2)], "i int, j int, dt_days int, dbperp double, score double")
    good = audits.network_gate(ring, ring, 3).collect()[0]
    assert (good.verdict, good.reasons, good.components, good.bridges, good.edges) == ("PASS", "", 1, 0, 3)
    bad = audits.network_gate(ring, ring.where("j - i = 1"), 3).collect()[0]
    assert bad.verdict == "REVIEW" and bad.reasons == "bridges+edges+links+uncovered"
    with pytest.raises(ValueError):
        audits.bridge_sides(_frame(spark, [(0, 1 << 20)], "i int, j int"))


def test_epoch_fragments(spark):
    from fringeflow.plans import registry

    phases = {(r.t, r.point_id): r.phase for r in registry._full(spark, DATA).collect()}
    edges = [(r.u, r.v) for r in registry._knn(spark, DATA).select("u", "v").collect()]
    for r in QUERIES["epoch_fragments"](spark, DATA).collect():
        points = sorted(p for t, p in phases if t == r.t)
        near = {}
        for u, v in edges:
            if (r.t, u) in phases and (r.t, v) in phases:
                d = phases[r.t, v] - phases[r.t, u]
                if abs(math.atan2(math.sin(d), math.cos(d))) <= unwrap.SAFE:
                    near.setdefault(u, []).append(v)
                    near.setdefault(v, []).append(u)
        comps = {frozenset(_walk(near, p)) for p in points}
        assert (r.points, r.fragments, r.largest) == (len(points), len(comps), max(map(len, comps)))


def test_wide_linking_against_numpy(spark):
    """Every centre of the production scene has the phases that its own matrix gives, solved here in full."""
    from fringeflow.operators import linking
    from fringeflow.plans import checks
    from fringeflow.plans import scene as S

    d = "/root/testdata/sf0.01"
    linked = {r.center_id: r for r in QUERIES["wide_phase_linking"](spark, d).collect()}
    coh = {}
    near = checks._wide_support(spark, d)
    z = {}
    for r in S.wide_samples(spark, d).collect():
        z.setdefault(r.point_id, {})[r.t] = complex(r.re, r.im)
    for r in near.collect():
        coh.setdefault(r.center_id, []).append(r.neighbor_id)
    assert set(linked) == {c for c, own in coh.items() if len(own) >= S.WIDE_K} and linked
    for c in sorted(linked)[:10]:
        own = np.array([[z[p][t] for t in range(S.WIDE_EPOCHS)] for p in coh[c]])
        power = np.sqrt((np.abs(own) ** 2).sum(axis=0))
        matrix = own.T @ own.conj() / np.outer(power, power)
        phases, codes, _ = linking.link(matrix[None])
        assert codes[0] == linked[c].estimator and linked[c].k == len(own)
        assert np.abs(np.angle(np.exp(1j * (phases[0] - np.array(linked[c].phase))))).max() < 1e-6


def test_late_events_are_left_out(spark, tmp_path):
    import os

    make = lambda name, rows: _frame(spark, rows, "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(f"file://{tmp_path}/{name}")
    make("a", [("2024-01-01 00:30:00", "x", 1.0)])
    make("b", [("2024-01-03 00:30:00", "x", 2.0)])
    make("c", [("2024-01-03 00:40:00", "x", 8.0)])
    make("d", [("2024-01-01 00:40:00", "x", 4.0)])
    os.makedirs(tmp_path / "in")
    for k, name in enumerate("abcd"):
        for f in os.listdir(tmp_path / name):
            if f.endswith(".parquet"):
                os.rename(tmp_path / name / f, tmp_path / "in" / f"{name}.parquet")
                os.utime(tmp_path / "in" / f"{name}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    schema = spark.read.parquet(f"file://{tmp_path}/in").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
    got = windows.run_available(windows.window_sums(stream, "1 hour", "1 hour"), "late").collect()
    assert sorted((str(r.window_start), r.total) for r in got) == [("2024-01-01 00:00:00", 1.0), ("2024-01-03 00:00:00", 10.0)]


def test_cluster_sessions_need_a_shared_folder():
    from fringeflow.plans import lineage

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        conf = {}
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        lineage.shared_dir(Session())
