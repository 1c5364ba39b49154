"""The network of acquisition pairs.

Candidate pairs, ranking and cycles are joins and windows. Bridges and spanning trees need a walk; they
run on the driver over the edges of the epoch network, whose number is bounded by epochs times
links a side, never by data.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fringeflow.functions.phase import edge_score

MOST_EDGES = 100_000


def candidates(epochs: DataFrame, most_days: float, most_metres: float) -> DataFrame:
    """``i, j, dt_days, dbperp, score`` for epochs ``idx, day, bperp`` close in time and baseline.

    Days are cut into buckets as long as the limit, so the range join is an equi-join on a
    bucket and its neighbour.
    """
    day = F.datediff("day", F.lit("1970-01-01"))
    own = epochs.select(F.col("idx"), day.alias("d"), "bperp").withColumn("bucket", F.floor(F.col("d") / F.lit(most_days)))
    a = own.select(F.col("idx").alias("i"), F.col("d").alias("di"), F.col("bperp").alias("bi"), F.explode(F.array("bucket", F.col("bucket") + 1)).alias("bucket"))
    b = own.select(F.col("idx").alias("j"), F.col("d").alias("dj"), F.col("bperp").alias("bj"), "bucket")
    dt, db = F.col("dj") - F.col("di"), F.col("bj") - F.col("bi")
    near = a.join(b, "bucket").where((F.col("i") < F.col("j")) & dt.between(0, most_days) & (F.abs(db) <= most_metres))
    return near.select("i", "j", dt.alias("dt_days"), db.alias("dbperp"), edge_score(dt, db, most_days, most_metres).alias("score"))


def directional(edges: DataFrame, per_side: int) -> DataFrame:
    """The edges that are among the best ``per_side`` of either end on its side of time."""
    ends = edges.select("*", F.inline(F.array(F.struct(F.col("i").alias("own"), F.col("j").alias("other"), F.lit("right").alias("side")), F.struct(F.col("j").alias("own"), F.col("i").alias("other"), F.lit("left").alias("side")))))
    order = Window.partitionBy("own", "side").orderBy("score", "dt_days", F.abs("dbperp"), "other")
    best = ends.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_side)
    return best.select("i", "j", "dt_days", "dbperp", "score").distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """``node, degree, left, right``: links to earlier and to later epochs."""
    ends = edges.select(F.inline(F.array(F.struct(F.col("i").alias("node"), F.lit(0).alias("to_left"), F.lit(1).alias("to_right")), F.struct(F.col("j").alias("node"), F.lit(1).alias("to_left"), F.lit(0).alias("to_right")))))
    return ends.groupBy("node").agg(F.count("*").alias("degree"), F.sum("to_left").alias("left"), F.sum("to_right").alias("right"))


def triangles(edges: DataFrame) -> DataFrame:
    """``a, b, c`` with a < b < c and all three edges."""
    ab = edges.select(F.col("i").alias("a"), F.col("j").alias("b"))
    bc = edges.select(F.col("i").alias("b"), F.col("j").alias("c"))
    ac = edges.select(F.col("i").alias("a"), F.col("j").alias("c"))
    return ab.join(bc, "b").join(ac, ["a", "c"]).select("a", "b", "c")


def cycles(edges: DataFrame, k: int) -> DataFrame:
    """``n0 .. n{k-1}``: simple cycles of k nodes, from the smallest node, its second node below its last."""
    both = edges.select("i", "j").union(edges.select(F.col("j").alias("i"), F.col("i").alias("j")))
    path = edges.select(F.col("i").alias("n0"), F.col("j").alias("n1"))
    for s in range(1, k - 1):
        step = both.select(F.col("i").alias(f"n{s}"), F.col("j").alias(f"n{s + 1}"))
        new = F.col(f"n{s + 1}")
        fresh = new > F.col("n0")
        for q in range(1, s):
            fresh = fresh & (new != F.col(f"n{q}"))
        path = path.join(step, f"n{s}").where(fresh)
    close = edges.select(F.col("i").alias("n0"), F.col("j").alias(f"n{k - 1}"))
    return path.where(F.col("n1") < F.col(f"n{k - 1}")).join(close, ["n0", f"n{k - 1}"]).select(*[f"n{q}" for q in range(k)])


def cycle_counts(edges: DataFrame, sizes: Iterable[int] = (3, 4, 5)) -> DataFrame:
    """``i, j, c3, c4, c5, shortest``: cycles of each size through each edge, and the least size."""
    sizes = list(sizes)
    told = None
    for k in sizes:
        found = cycles(edges, k)
        steps = F.array(*[F.struct(F.least(f"n{q}", f"n{(q + 1) % k}").alias("i"), F.greatest(f"n{q}", f"n{(q + 1) % k}").alias("j")) for q in range(k)])
        one = found.select(F.lit(k).alias("k"), F.inline(steps))
        told = one if told is None else told.union(one)
    counts = told.groupBy("i", "j").agg(*[F.count_if(F.col("k") == k).alias(f"c{k}") for k in sizes], F.min("k").alias("shortest"))
    return edges.select("i", "j").join(counts, ["i", "j"], "left").select("i", "j", *[F.coalesce(f"c{k}", F.lit(0)).alias(f"c{k}") for k in sizes], "shortest")


def _edge_list(edges: DataFrame) -> list[tuple[int, int]]:
    found = [(r["i"], r["j"]) for r in edges.select("i", "j").orderBy("i", "j").limit(MOST_EDGES + 1).collect()]
    if len(found) > MOST_EDGES:
        raise ValueError("an epoch network has at most that many edges; use connected_components for larger graphs")
    return found


def bridges(edges: DataFrame) -> DataFrame:
    """``i, j`` of the edges whose loss would split the network."""
    links = _edge_list(edges)
    near: dict[int, list[tuple[int, int]]] = {}
    for e, (i, j) in enumerate(links):
        near.setdefault(i, []).append((j, e))
        near.setdefault(j, []).append((i, e))
    order: dict[int, int] = {}
    low: dict[int, int] = {}
    cut = []
    for root in near:
        if root in order:
            continue
        order[root] = low[root] = len(order)
        stack = [(root, -1, iter(near[root]))]
        while stack:
            node, came, rest = stack[-1]
            for other, e in rest:
                if e == came:
                    continue
                if other in order:
                    low[node] = min(low[node], order[other])
                else:
                    order[other] = low[other] = len(order)
                    stack.append((other, e, iter(near[other])))
                    break
            else:
                stack.pop()
                if stack:
                    above = stack[-1][0]
                    low[above] = min(low[above], low[node])
                    if low[node] > order[above]:
                        cut.append(links[came])
    return edges.sparkSession.createDataFrame(sorted(cut), edges.select("i", "j").schema)


def spanning_tree(links: list[tuple[int, int]], most_degree: int | None = None) -> list[int]:
    """Numbers of the edges, in the order given, that join two trees; a cap on degrees may leave several trees."""
    parent: dict[int, int] = {}
    degree: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for e, (i, j) in enumerate(links):
        if root(i) == root(j) or most_degree and max(degree.get(i, 0), degree.get(j, 0)) >= most_degree:
            continue
        parent[root(i)] = root(j)
        degree[i], degree[j] = degree.get(i, 0) + 1, degree.get(j, 0) + 1
        kept.append(e)
    return kept


def cycle_basis(links: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """For each edge outside the spanning tree its cycle as ``(edge, sign)``, the edge itself first with +1."""
    tree = set(spanning_tree(links))
    near: dict[int, list[tuple[int, int, int]]] = {}
    for e in tree:
        i, j = links[e]
        near.setdefault(i, []).append((j, e, 1))
        near.setdefault(j, []).append((i, e, -1))
    found = []
    for e, (i, j) in enumerate(links):
        if e in tree:
            continue
        came: dict[int, tuple[int, int, int] | None] = {j: None}
        queue = [j]
        for node in queue:
            for other, edge, sign in near.get(node, []):
                if other not in came:
                    came[other] = (node, edge, sign)
                    queue.append(other)
        path, node = [], i
        while came[node] is not None:
            node, edge, sign = came[node]
            path.append((edge, sign))
        found.append([(e, 1), *path[::-1]])
    return found


def inversion_weights(links: list[tuple[int, int]], epochs: int) -> np.ndarray:
    """Weights ``[epoch, edge]`` that turn edge phases into a series with epoch 0 at zero, by least squares."""
    a = np.zeros((len(links), epochs))
    for e, (i, j) in enumerate(links):
        a[e, j] += 1
        a[e, i] -= 1
    return np.vstack([np.zeros(len(links)), np.linalg.pinv(a[:, 1:], rcond=1e-12)])


def connected_network(edges: list[tuple[int, int, float]], start: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``start`` with the best edges of ``(i, j, score)`` that join what is apart."""
    links = list(start)
    rest = [(i, j) for i, j, _ in sorted(edges, key=lambda e: (e[2], e[0], e[1])) if (i, j) not in set(start)]
    kept = spanning_tree(links + rest)
    return links + [rest[e - len(links)] for e in kept if e >= len(links)]


def tree_weights(links: list[tuple[int, int]], epochs: int) -> np.ndarray:
    """Weights ``[epoch, edge]`` that integrate a spanning tree of the edges from epoch 0."""
    tree = spanning_tree(links)
    out = np.zeros((epochs, len(links)))
    known, grown = {0}, True
    while grown:
        grown = False
        for e in tree:
            i, j = links[e]
            if (i in known) != (j in known):
                new, old, sign = (j, i, 1) if i in known else (i, j, -1)
                out[new] = out[old]
                out[new, e] += sign
                known.add(new)
                grown = True
    return out


def degree_capped_tree(edges: list[tuple[int, int, float]], nodes: int, cap: int) -> list[tuple[int, int]]:
    """A cheap spanning tree within a cap on degrees: Kruskal, then single swaps that lower the cost.

    A heuristic in place of an exact integer program; it fails loudly where it finds no tree.
    """
    ranked = sorted(edges, key=lambda e: (e[2], e[0], e[1]))
    links = [(i, j) for i, j, _ in ranked]
    kept = spanning_tree(links, cap)
    if len(kept) < nodes - 1:
        raise ValueError("no spanning tree within the cap was found")
    tree, cost = {links[e] for e in kept}, {(i, j): s for i, j, s in ranked}
    improved = True
    while improved:
        improved = False
        for new in links:
            if new in tree:
                continue
            for old in sorted(tree, key=lambda e: -cost[e]):
                if cost[old] <= cost[new]:
                    break
                trial = sorted((tree - {old}) | {new})
                if len(spanning_tree(trial, cap)) == nodes - 1:
                    tree, improved = set(trial), True
                    break
    return sorted(tree)


def add_redundancy(tree: list[tuple[int, int]], edges: list[tuple[int, int, float]], cap: int) -> list[tuple[int, int]]:
    """The tree with the best further edges that keep every degree within the cap; a greedy stand-in for an integer program."""
    kept = list(tree)
    degree: dict[int, int] = {}
    for i, j in kept:
        degree[i], degree[j] = degree.get(i, 0) + 1, degree.get(j, 0) + 1
    for i, j, _ in sorted(edges, key=lambda e: (e[2], e[0], e[1])):
        if (i, j) not in tree and degree.get(i, 0) < cap and degree.get(j, 0) < cap:
            kept.append((i, j))
            degree[i], degree[j] = degree.get(i, 0) + 1, degree.get(j, 0) + 1
    return sorted(kept)


def acceptance(edges: DataFrame) -> DataFrame:
    """One row on a network: nodes, edges, edges in no 3- or 4-cycle, and the longest of the edges' shortest cycles."""
    counts = cycle_counts(edges)
    nodes = edges.select(F.explode(F.array("i", "j")).alias("node")).agg(F.count_distinct("node").alias("nodes"))
    rows = counts.agg(F.count("*").alias("edges"), F.count_if((F.col("c3") == 0) & (F.col("c4") == 0)).alias("uncovered"), F.max("shortest").alias("longest_shortest"))
    return nodes.crossJoin(rows)  # one row each


def requirements(candidate_edges: DataFrame, chosen: DataFrame, per_side: int) -> DataFrame:
    """``node, left, right, need_left, need_right, met``: links a side against the lesser of its candidates and the target."""
    have, could = degrees(chosen), degrees(candidate_edges).select("node", F.col("left").alias("l"), F.col("right").alias("r"))
    rows = could.join(have, "node", "left").select("node", F.coalesce("left", F.lit(0)).alias("left"), F.coalesce("right", F.lit(0)).alias("right"), F.least("l", F.lit(per_side)).alias("need_left"), F.least("r", F.lit(per_side)).alias("need_right"))
    return rows.withColumn("met", (F.col("left") >= F.col("need_left")) & (F.col("right") >= F.col("need_right")))


def epoch_baselines(pairs: list[tuple[int, int]], values: list[float], epochs: int) -> np.ndarray:
    """Baselines of epochs from those of pairs by least squares, with epoch 0 at zero."""
    return inversion_weights(pairs, epochs) @ np.asarray(values, float)
