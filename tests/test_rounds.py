"""How many rounds graph operators take, and that they give the same with few rows at a time."""

import random

import pytest

from fringeflow.operators import components, consistency, forests, spatial
from fringeflow.plans import lineage


@pytest.fixture
def settled(monkeypatch):
    """Labels of all tables that an operator writes to the shared folder."""
    seen = []

    def told(df, label):
        seen.append(label)
        return lineage.settle(df, label)

    for module in (components, consistency, forests, spatial):
        monkeypatch.setattr(module, "settle", told)
    return seen


def test_near_numbers_are_joined_without_rounds(spark, settled):
    edges = [(k, k + 1) for k in range(3000) if k % 500] + [(9000, 9000)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: n - (n - 1) % 500 if n else 0 for e in edges for n in e if n < 9000} | {9000: 9000}
    assert len(settled) <= 8


@pytest.mark.parametrize("chunk", [1, 4, 60])
def test_components_of_small_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(components, "CHUNK", chunk)
    rng = random.Random(chunk)
    names = rng.sample(range(10**6), 160)
    edges = [(names[k], names[k + 1]) for k in range(60)] + [(rng.choice(names[70:]), rng.choice(names[70:])) for _ in range(70)] + [(names[65], names[65])]
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = components.connected_components(spark.createDataFrame(edges, "u long, v long").repartition(3)).collect()
    assert len(got) == len(label) and {r.node: r.component for r in got} == label


@pytest.mark.parametrize("bits", [(1,), (5, 3), ()])
def test_conflicts_of_long_paths(spark, settled, monkeypatch, bits):
    """Ranges that hardly help, that help in two steps, and none, which is for rounds."""
    monkeypatch.setattr(forests, "ONE_TASK", 6)
    monkeypatch.setattr(forests, "RANGES", bits or (1,))
    if not bits:
        monkeypatch.setattr(forests, "IN_RANGE", 0)
    long = 130 if len(bits) == 2 else 14
    rows = [(k, k + 1, 1, 0) for k in range(long)] + [(0, long, long - 2, 9), (3, long - 4, long - 7, 9), (5, 9, 5, 9), (500, 501, 0, 0), (500, 502, 1, 0), (501, 502, 3, 1)]
    got = {(r.u, r.v): (r.off, r.cycle) for r in consistency.shift_conflicts(spark.createDataFrame(rows, "u long, v long, shift long, order long")).collect()}
    assert got == {(0, long): (-2, list(range(long + 1))), (5, 9): (1, list(range(5, 10))), (501, 502): (2, [501, 500, 502])}
    if len(bits) == 2:
        assert len(settled) < 60  # fewer than the nodes of a path


@pytest.mark.parametrize("bits", [(2,), (9, 4)])
def test_forests_of_small_ranges(spark, monkeypatch, bits):
    from pyspark.sql import functions as F

    monkeypatch.setattr(forests, "ONE_TASK", 10)
    monkeypatch.setattr(forests, "RANGES", bits)
    rng = random.Random(len(bits))
    edges = {tuple(sorted((a, (a + rng.choice([1, 1, 2, 3, 7, 31])) % 300))): rng.randint(0, 30) for a in range(300) for _ in range(2)}
    trees = forests.Potentials()
    want = {e for e, _ in sorted(edges.items(), key=lambda x: (x[1], x[0])) if trees.link(*e)}
    frame = spark.createDataFrame([(u, v, s) for (u, v), s in edges.items()], "u long, v long, s int")
    assert {tuple(r) for r in forests.spanning_forest(frame, F.col("s")).collect()} == want


@pytest.mark.parametrize("tile", [(1, 3), (6, 4)])
def test_far_points_take_few_rounds(spark, settled, tile):
    """The nearest point a thousand tiles away, where a border would have been passed on a thousand times."""
    rng = random.Random(tile[0])
    cells = rng.sample([(r, c) for r in range(-20, 20) for c in range(-9, 9)], 150)
    cells += rng.sample([(r, c) for r in range(3000, 3020) for c in range(30)], 40) + [(-900, 40), (1500, -700)]
    points = [(k * 37 % 1009, r, c) for k, (r, c) in enumerate(cells)]
    main = {p for p, r, c in points if -6 < r < 9 and -6 < c < 5}
    labels = [(p, 7 if p in main else 2000 + p) for p, _, _ in points]
    found = spatial.nearest_in_main(spark.createDataFrame(points, "point_id long, r int, c int"), spark.createDataFrame(labels, "point_id long, component long"), tile)
    want = {p: min((max(abs(r - a), abs(c - b)), q) for q, a, b in points if q in main) for p, r, c in points if p not in main}
    assert {r.p: (r.chebyshev, r.q) for r in found.collect()} == want
    assert len(settled) < 14


def test_nearest_across_tiles(spark, monkeypatch):
    """Edges near borders of tiles are told once, and two points of a cell are both neighbours."""
    monkeypatch.setattr(spatial, "_TILE", 7)
    rng = random.Random(5)
    cells = rng.sample([(r, c) for r in range(-6, 25) for c in range(-4, 20)], 330)
    points = [(k * 13 % 1009, r, c) for k, (r, c) in enumerate([*cells, cells[0], cells[9]])]
    want = {}
    for p, r, c in points:
        near = [((2.0 * (a - r)) ** 2 + (1.5 * (b - c)) ** 2, max(abs(a - r), abs(b - c)), a - r, b - c, q) for q, a, b in points if (a, b) != (r, c) and max(abs(a - r), abs(b - c)) <= 3]
        want |= {(min(p, q), max(p, q)): d**0.5 for d, *_, q in sorted(near)[:5]}
    rows = spatial.nearest(spark.createDataFrame(points, "point_id long, r int, c int"), 3, 5, 2.0, 1.5).collect()
    assert len(rows) == len(want) and {(r.u, r.v): r.dist for r in rows} == pytest.approx(want)


def test_piece_shifts_by_ranges(spark, settled, monkeypatch):
    """A chain of pieces whose last ones are numbered lowest, as in one task."""
    from fringeflow.operators import unwrap

    names = [*range(400, 0, -1)]
    rows = [(1, min(a, b), max(a, b), 3, (k % 5) - 2, 2, 0.5 + (k * 7 % 11) / 30, 0.1, 1.0) for k, (a, b) in enumerate(zip(names, names[1:]))]
    rows += [(1, 3, 300, 1, 1, 1, 0.1, 0.1, 1.0), (2, 7, 9, 1, 1, 1, 0.9, 0.1, 1.0)]
    votes = spark.createDataFrame(rows, "pair_id int, frag_a long, frag_b long, edge_count long, mode_shift long, mode_count long, ratio double, median_abs double, median_dist double")
    want = sorted(map(tuple, unwrap.piece_shifts(votes).collect()))
    monkeypatch.setattr(forests, "ONE_TASK", 20)
    monkeypatch.setattr(forests, "RANGES", (7, 5))
    assert sorted(map(tuple, unwrap.piece_shifts(votes).collect())) == want and len(want) == 402
    assert len(settled) < 30


def test_votes_need_no_gradients_inside_pieces(spark):
    """Votes by the phases that pieces carry, blocks carried by edges, and the general form give the same."""
    from fringeflow.operators import unwrap

    rng = random.Random(31)
    points = spark.createDataFrame([(r * 9 + c, r, c) for r in range(11) for c in range(9)], "point_id long, r int, c int")
    ifgs = spark.createDataFrame([(k, p, rng.uniform(-3, 3)) for k in range(3) for p in range(99) if rng.random() < 0.95], "pair_id int, point_id long, phase double")
    edges = unwrap.inner_blocks(spatial.nearest(points, 1, 4, 1.0, 1.0), points, (4, 3)).localCheckpoint()
    grads = unwrap.gradients(ifgs, edges, ("block",)).localCheckpoint()
    fragments = unwrap.safe_fragments(grads, ifgs)
    carried = unwrap.unwrap_fragments(ifgs, grads, None, points, (4, 3)).localCheckpoint()
    plain = unwrap.unwrap_fragments(ifgs, grads.drop("block"), fragments, points, (4, 3)).localCheckpoint()
    assert sorted(map(tuple, plain.select(carried.columns).collect())) == sorted(map(tuple, carried.collect()))
    votes = unwrap.phase_votes(carried, edges)
    want = unwrap.piece_votes(plain, grads, edges).select(votes.columns).collect()
    assert want and sorted(map(tuple, votes.collect())) == sorted(map(tuple, want))
