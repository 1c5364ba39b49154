"""Integer gauges and sparse corrections from cycle closures, and what they would change."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fringeflow.functions.phase import ambiguity
from fringeflow.operators.network import cycle_basis


def cycle_closures(ifgs: DataFrame, cycles: list[list[tuple[int, int]]]) -> DataFrame:
    """``triangle_id, point_id, closure`` around cycles of ``(pair, sign)``; the cycles of the epoch network are broadcast."""
    rows = [(k, e, float(s)) for k, cycle in enumerate(cycles) for e, s in cycle]
    table = ifgs.sparkSession.createDataFrame(rows, "triangle_id int, pair_id int, sign double")
    return ifgs.join(F.broadcast(table), "pair_id").groupBy("triangle_id", "point_id").agg(F.sum(F.col("sign") * F.col("phase")).alias("closure"))


def gauge(modes: DataFrame, cycles: list[list[tuple[int, int]]], pairs: int) -> DataFrame:
    """``pair_id, delta``: whole turns to add to each pair so that every cycle's mode becomes zero.

    The first edge of a fundamental cycle is in no other cycle, so it takes the whole correction; the
    rest stay. One row a cycle comes to the driver. A correction that fails its check is an error.
    """
    modal = {r["triangle_id"]: r["modal_k"] for r in modes.select("triangle_id", "modal_k").collect()}
    delta = [0] * pairs
    for k, cycle in enumerate(cycles):
        delta[cycle[0][0]] = -modal.get(k, 0)
    for k, cycle in enumerate(cycles):
        if sum(s * delta[e] for e, s in cycle) != -modal.get(k, 0):
            raise ValueError(f"the gauge does not settle cycle {k}")
    return modes.sparkSession.createDataFrame(list(enumerate(delta)), "pair_id int, delta int")


def least_correction(cycles: list[list[tuple[int, int]]], wanted: list[int], most: int = 2) -> list[int] | None:
    """Whole numbers up to ``most`` in size for each edge whose cycle sums are ``wanted``, with the least total size.

    Branch and bound, cycle by cycle: the fewest edges and the smallest numbers of equals in edge order.
    """
    edges = sorted({e for cycle in cycles for e, _ in cycle})
    place = {e: k for k, e in enumerate(edges)}
    sums = [{place[e]: s for e, s in cycle} for cycle in cycles]
    last = [max(c) for c in sums]
    open_at = [[k for k in range(len(sums)) if last[k] == i] for i in range(len(edges))]
    best: list[int] | None = None
    best_cost = math.inf
    x = [0] * len(edges)
    order = sorted(range(-most, most + 1), key=lambda v: (abs(v), v))

    def walk(i: int, cost: int) -> None:
        nonlocal best, best_cost
        if cost >= best_cost:
            return
        if i == len(edges):
            best, best_cost = list(x), cost
            return
        for v in order:
            x[i] = v
            if all(sum(s * x[j] for j, s in sums[k].items()) == wanted[k] for k in open_at[i]):
                walk(i + 1, cost + abs(v))
        x[i] = 0

    walk(0, 0)
    return best


def least_network_correction(links: list[tuple[int, int]], wanted: list[int], most: int = 2) -> tuple[list[int], int] | None:
    """``least_correction`` for all fundamental cycles of a network, and its total size, proven least by a flow of the same value.

    Numbers whose cycle sums are given differ by what node potentials add, so the smallest total is a network program:
    its dual is a circulation of at most one unit an edge, and more where an edge is at ``most``. Units are sent along
    negative cycles until there is none; the flow then says of each edge whether its number is zero, positive or
    negative in every best answer, and shortest paths give the range that is left to each, which edges take in order, the
    smallest size first. No search is needed, whatever the number of edges.
    """
    basis = cycle_basis(links)
    nodes = sorted({n for link in links for n in link})
    place = {n: k for k, n in enumerate(nodes)}
    tail, head = (np.array([place[link[k]] for link in links]) for k in (0, 1))
    base = np.zeros(len(links), np.int64)
    for cycle, w in zip(basis, wanted):
        base[cycle[0][0]] = w  # a cycle's first edge is in no other cycle
    flow, value = np.zeros(len(links), np.int64), 0
    edges = np.arange(len(links))
    source, target = np.concatenate([tail, head]), np.concatenate([head, tail])
    while True:
        # x - base = p[head] - p[tail]; what the flow allows x to be at most and at least.
        upper = np.where(flow >= 1, most, np.where(flow <= -2, -most, 0))
        lower = np.where(flow <= -1, -most, np.where(flow >= 2, most, 0))
        length = np.concatenate([upper - base, base - lower])
        cycle = _negative_cycle(len(nodes), source, target, length)
        if cycle is None:
            break
        value -= int(length[cycle].sum())
        if value > most * len(links):
            return None  # no answer within the bound costs as much
        np.add.at(flow, cycle % len(edges), np.where(cycle < len(edges), 1, -1))
    far = np.full((len(nodes), len(nodes)), np.inf)
    np.fill_diagonal(far, 0)
    np.minimum.at(far, (source, target), length)
    for k in range(len(nodes)):
        far = np.minimum(far, far[:, k, None] + far[k])
    out = []
    for e in edges:
        i, j = tail[e], head[e]
        low, high = base[e] - far[j, i], base[e] + far[i, j]
        x = int(min(max(0, low), high))
        out.append(x)
        step = x - base[e]
        far = np.minimum(far, np.minimum(far[:, i, None] + step + far[j], far[:, j, None] - step + far[i]))
    if sum(map(abs, out)) != value:
        raise ValueError("the correction is not proven least")
    return out, value


def _negative_cycle(nodes: int, source: np.ndarray, target: np.ndarray, length: np.ndarray) -> np.ndarray | None:
    """Numbers of the arcs of a cycle of negative length, or none (Bellman and Ford, all arcs at once)."""
    dist, came = np.zeros(nodes, np.int64), np.full(nodes, -1)
    for _ in range(nodes + 1):
        through = dist[source] + length
        best = dist.copy()
        np.minimum.at(best, target, through)
        moved = best < dist
        if not moved.any():
            return None
        arcs = np.flatnonzero((through == best[target]) & moved[target])
        came[target[arcs]] = arcs
        dist = best
    # Walking back from a node that still moved ends in a cycle of arcs that shortened each other.
    at = int(np.flatnonzero(moved)[0])
    for _ in range(nodes):
        at = int(source[came[at]])
    cycle, node = [], at
    while not cycle or node != at:
        cycle.append(int(came[node]))
        node = int(source[came[node]])
    return np.array(cycle)


def sparse_corrections(patterns: DataFrame, cycles: list[list[tuple[int, int]]], links: list[tuple[int, int]] | None = None) -> DataFrame:
    """``pattern, pair_id, correction`` for each distinct pattern of cycle sums that is not all zero.

    Each pattern is solved once, in whichever task it falls to and however many points share it, within two turns or, where that
    fails, within the larger of four and twice its largest sum and two. A pattern that stays unsolved is a row with nulls.
    Where ``cycles`` are the ``cycle_basis`` of ``links``, any number of edges is solved as a network program; other
    cycles, a few edges, are searched.
    """
    if links is not None and cycles != cycle_basis(links):
        raise ValueError("the cycles are not the basis of these links")

    def least(wanted: list[int], most: int) -> list[tuple[int, int]] | None:
        if links is None:
            found = least_correction(cycles, wanted, most)
            return None if found is None else list(zip(sorted({e for cycle in cycles for e, _ in cycle}), found))
        solved = least_network_correction(links, wanted, most)
        return None if solved is None else list(enumerate(solved[0]))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for pattern in batch["pattern"]:
                wanted = [-int(v) for v in pattern.split(",")]
                found = least(wanted, 2)
                if found is None:
                    found = least(wanted, max(4, 2 * max(map(abs, wanted)) + 2))
                rows += [(pattern, e, v) for e, v in found if v] if found is not None else [(pattern, None, None)]
            yield pd.DataFrame(rows, columns=["pattern", "pair_id", "correction"]).astype({"pattern": object, "pair_id": "Int32", "correction": "Int32"})

    return patterns.select("pattern").distinct().mapInPandas(solve, "pattern string, pair_id int, correction int")


def boundary_effect(grads: DataFrame, values: DataFrame, corrections: DataFrame) -> DataFrame:
    """``pair_id, edges, before, after, resolved, created``: edges with a whole-turn jump without and with the points' corrections.

    ``values`` has ``pair_id, point_id, value``; ``corrections`` has ``pair_id, point_id, correction`` where it is not zero.
    """
    fixed = values.join(corrections, ["pair_id", "point_id"], "left").select("pair_id", "point_id", "value", F.coalesce("correction", F.lit(0)).alias("add"))
    at = lambda name: fixed.select("pair_id", F.col("point_id").alias(name), F.col("value").alias(f"value_{name}"), F.col("add").alias(f"add_{name}"))
    met = grads.join(at("u"), ["pair_id", "u"]).join(at("v"), ["pair_id", "v"])
    jump = ambiguity(F.col("value_v") - F.col("value_u") - F.col("g"))
    rows = met.select("pair_id", (jump != 0).alias("was"), (jump + F.col("add_v") - F.col("add_u") != 0).alias("now"))
    return rows.groupBy("pair_id").agg(F.count("*").alias("edges"), F.count_if("was").alias("before"), F.count_if("now").alias("after"), F.count_if(F.col("was") & ~F.col("now")).alias("resolved"), F.count_if(~F.col("was") & F.col("now")).alias("created"))


def piece_coverage(labelled: DataFrame, marked: DataFrame) -> DataFrame:
    """``pair_id, piece, size, hit, status``: whether all, some or none of a piece's points carry one correction.

    ``labelled`` has ``pair_id, point_id, piece``; ``marked`` has ``pair_id, point_id, correction`` where it is not zero.
    """
    rows = labelled.join(marked, ["pair_id", "point_id"], "left").groupBy("pair_id", "piece")
    sums = rows.agg(F.count("*").alias("size"), F.count("correction").alias("hit"), F.count_distinct("correction").alias("kinds"))
    status = F.when(F.col("hit") == 0, "none").when((F.col("hit") == F.col("size")) & (F.col("kinds") == 1), "full").when(F.col("kinds") > 1, "mixed").otherwise("partial")
    return sums.select("pair_id", "piece", "size", "hit", status.alias("status"))


def strict_points(points: DataFrame, ifgs: DataFrame, pairs: int, integers: DataFrame, modes: DataFrame, conflicts: DataFrame, most_bad: int) -> DataFrame:
    """Points registered in every pair, off at most ``most_bad`` cycle modes, and in no conflict."""
    whole = ifgs.groupBy("point_id").agg(F.count("*").alias("n")).where(F.col("n") == pairs).select("point_id")
    bad = integers.join(F.broadcast(modes), "triangle_id").where("k <> modal_k").groupBy("point_id").agg(F.count("*").alias("off")).where(F.col("off") > most_bad)  # modes: a row a cycle
    return points.join(whole, "point_id", "left_semi").join(bad, "point_id", "left_anti").join(conflicts, "point_id", "left_anti")
