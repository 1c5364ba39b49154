"""Spanning forests and bottlenecks against walks over small graphs: paths, hubs, several trees."""

import random

import pytest

from fringeflow.operators import forests


@pytest.fixture(params=["one task", "rounds"], autouse=True)
def size(request, monkeypatch):
    """Every test twice: with graphs that fit one task, and as if they did not."""
    if request.param == "rounds":
        monkeypatch.setattr(forests, "ONE_TASK", -1)
    return request.param


def _sides(edges, weights):
    """For each edge the lighter side, by removing it and walking."""
    near = {}
    for u, v in edges:
        near.setdefault(u, set()).add(v)
        near.setdefault(v, set()).add(u)

    def reach(start, without):
        seen, todo = {start}, [start]
        while todo:
            x = todo.pop()
            for y in near[x]:
                if {x, y} != without and y not in seen:
                    seen.add(y)
                    todo.append(y)
        return sum(weights.get(x, 0) for x in seen)

    return {(u, v): (min(reach(u, {u, v}), reach(v, {u, v})), reach(u, set())) for u, v in edges}


def _random_forest(rng, n):
    names = rng.sample(range(1000), n)
    edges = []
    for k in range(1, n):
        if rng.random() < 0.93:
            edges.append((names[rng.randrange(max(0, k - rng.choice([1, 3, k])), k)], names[k]))
    return [(min(e), max(e)) for e in edges]


@pytest.mark.parametrize("seed", range(4))
def test_bottlenecks(spark, seed):
    rng = random.Random(seed)
    shapes = [[(k, k + 1) for k in range(2000, 2040)], [(3000, 3000 + k) for k in range(1, 30)], [(5, 1500)]]
    edges = _random_forest(rng, 70) + [e for s in shapes[seed % 3 :] for e in s if seed]
    edges = [e for e in edges if e != (5, 1500) or not any(x in (5, 1500) for y in edges if y != e for x in y)]
    weights = {x: rng.randint(0, 9) for e in edges for x in e if rng.random() < 0.9}
    frame = spark.createDataFrame(edges, "u long, v long").repartition(5)
    got = {(r.u, r.v): (r.smaller, r.total) for r in forests.bottlenecks(frame, spark.createDataFrame(list(weights.items()), "node long, w long")).collect()}
    assert got == _sides(edges, weights)


def test_cycles_are_errors(spark):
    with pytest.raises(ValueError, match="cycle"):
        forests.bottlenecks(spark.createDataFrame([(1, 2), (2, 3), (1, 3)], "u long, v long"), spark.createDataFrame([(1, 1)], "node long, w long"))


def test_spanning_forest(spark):
    from pyspark.sql import functions as F

    rng = random.Random(9)
    edges = {(u, v): rng.randint(0, 20) for u, v in (sorted(rng.sample(range(40), 2)) for _ in range(90))} | {(100, 101): 1, (101, 102): 1, (100, 102): 1}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    want = set()
    for (u, v), _ in sorted(edges.items(), key=lambda e: (e[1], e[0])):
        if root(u) != root(v):
            parent[root(u)] = root(v)
            want.add((u, v))
    frame = spark.createDataFrame([(u, v, s) for (u, v), s in edges.items()], "u long, v long, s int")
    assert {tuple(r) for r in forests.spanning_forest(frame, F.col("s")).collect()} == want
    assert forests.spanning_forest(frame.where("false"), F.col("s")).count() == 0


def test_conflicts_and_the_cycles_that_show_them(spark):
    from fringeflow.operators import consistency

    rng = random.Random(17)
    nodes = {n: rng.randint(-3, 3) for n in range(40)}
    links = {}
    while len(links) < 75:
        u, v = sorted(rng.sample(range(30), 2)) if rng.random() < 0.8 else sorted(rng.sample(range(30, 40), 2))
        links[u, v] = (nodes[u] - nodes[v] + rng.choice([0, 0, 0, 0, 1, -1, 2]), rng.randint(0, 5))
    rows = [(u, v, k, o) for (u, v), (k, o) in links.items()]
    got = {(r.u, r.v): (r.off, r.cycle) for r in consistency.shift_conflicts(spark.createDataFrame(rows, "u long, v long, shift int, order int")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    tree = set()
    for u, v, k, o in sorted(rows, key=lambda r: (r[3], r[0], r[1])):
        if root(u) != root(v):
            parent[root(u)] = root(v)
            tree.add((u, v))
    add = lambda x, y: -links[x, y][0] if (x, y) in tree else links[y, x][0]
    wrong = set()
    for u, v, k, _ in rows:
        todo, came = [u], {u: None}
        for x in todo:
            for a, b in tree:
                y = b if a == x else a if b == x else None
                if y is not None and y not in came:
                    came[y] = x
                    todo.append(y)
        path = [v]
        while path[-1] != u:
            path.append(came[path[-1]])
        path.reverse()
        total = sum(add(x, y) for x, y in zip(path, path[1:]))
        if total + k:
            wrong.add((u, v))
            assert got[u, v] == (total + k, path)
    assert got.keys() == wrong and wrong


def _cuts(edges):
    """The bridges of small networks, by leaving each edge out."""
    nodes = {n for e in edges for n in e}

    def parts(links):
        label = {n: n for n in nodes}
        for _ in nodes:
            for a, b in links:
                label[a] = label[b] = min(label[a], label[b])
        return label

    whole = len(set(parts(edges).values()))
    return {e for e in edges if len(set(parts(edges - {e}).values())) > whole}, parts


def test_bridges_are_doubled_where_candidates_allow(spark):
    from fringeflow.operators import bridges

    rng = random.Random(23)
    chosen = {tuple(sorted(rng.sample(range(14), 2))) for _ in range(13)} | {(k, k + 1) for k in range(20, 26)} | {(26, 27), (27, 28), (26, 28), (25, 26)}
    candidates = {tuple(sorted(rng.sample(range(14), 2))): rng.random() for _ in range(12)} | {(21, 24): 0.5, (20, 24): 0.7, (22, 25): 0.6} | dict.fromkeys(sorted(chosen)[:4], 0.1)
    frame = spark.createDataFrame([(i, j) for i, j in chosen], "i int, j int")
    cuts, parts = _cuts(chosen)
    found, labels = bridges.bridges_and_parts(frame.select(frame.i.alias("u"), frame.j.alias("v")))
    assert {tuple(r) for r in found.collect()} == cuts
    assert {r.node: r.part for r in labels.collect()} == parts(chosen - cuts)
    rows = bridges.doubled_network(spark.createDataFrame([(i, j, s) for (i, j), s in candidates.items()], "i int, j int, score double"), frame).collect()
    whole, want, still = parts(chosen), set(), set()
    for e in cuts:
        side = parts(chosen - {e})
        across = [(s, *c) for c, s in candidates.items() if c not in chosen and c[0] in side and c[1] in side and whole.get(c[0]) == whole.get(c[1]) == whole[e[0]] and {side[c[0]], side[c[1]]} == {side[e[0]], side[e[1]]}]
        if across:
            want.add(min(across)[1:])
        else:
            still.add(e)
    assert {(r.i, r.j) for r in rows if r.why == "chosen"} == chosen and {(r.i, r.j) for r in rows if r.why == "doubles"} == want
    assert {(r.i, r.j) for r in rows if r.bridge} == still == _cuts(chosen | want)[0] and want and still


def test_what_is_apart_is_joined(spark):
    from fringeflow.operators import bridges

    chosen = spark.createDataFrame([(0, 1), (2, 3), (4, 5)], "i int, j int")
    candidates = spark.createDataFrame([(0, 2, 0.9), (1, 3, 0.2), (1, 2, 0.2), (3, 4, 0.5), (0, 5, 0.4), (0, 1, 0.0)], "i int, j int, score double")
    got = {(r.i, r.j, r.why) for r in bridges.joined_network(candidates, chosen).collect()}
    assert got == {(0, 1, "chosen"), (2, 3, "chosen"), (4, 5, "chosen"), (1, 2, "joins"), (0, 5, "joins")}
