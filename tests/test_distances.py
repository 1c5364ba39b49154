"""The nearest point without a limit, tile by tile, against all pairs."""

import random

import pytest

from fringeflow.operators import spatial


@pytest.mark.parametrize("tile", [(4, 5), (128, 128)])
def test_nearest_point_however_far(spark, tile):
    rng = random.Random(sum(tile))
    cells = rng.sample([(r, c) for r in range(-3, 40) for c in range(45)], 60) + [(90, 2), (20, 130)]
    points = [(k * 7 % 997, r, c) for k, (r, c) in enumerate(cells)]
    inside = {p for p, r, c in points if r < 9 and c < 20}
    labels = [(p, 0 if p in inside else 1000 + p) for p, _, _ in points]
    got = {r.p: (r.q, r.chebyshev) for r in spatial.nearest_in_main(spark.createDataFrame(points, "point_id long, r int, c int"), spark.createDataFrame(labels, "point_id long, component long"), tile).collect()}
    want = {}
    for p, r, c in points:
        if p not in inside:
            far, q = min((max(abs(r - a), abs(c - b)), q) for q, a, b in points if q in inside)
            want[p] = (q, far)
    assert len(inside) > 1 and got == want
    none = spatial.nearest_in_main(spark.createDataFrame([], "point_id long, r int, c int"), spark.createDataFrame([], "point_id long, component long"), tile)
    assert none.count() == 0
