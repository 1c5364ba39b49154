"""Connected components of large edge tables: chunks of near nodes are contracted first, alternating stars join what is left."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fringeflow.plans.lineage import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")).head()
    return row["n"], row["x"]


#: Edges that are contracted at once, inside a task.
CHUNK = 1 << 19


def _lowest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the edges and the smallest node that these edges join it to."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    up = np.arange(len(nodes))
    while True:
        a, b = up[a], up[b]
        apart = a != b
        a, b = a[apart], b[apart]
        if not len(a):
            return nodes, nodes[up]
        np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
        while (up != (over := up[up])).any():
            up = over


def _contract_by(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``node, root`` of ``size`` edges at a time."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= size:
                yield _roots(held)
                held, count = [], 0
        if count:
            yield _roots(held)

    return contract


def _roots(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    u, v = (np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in batches]) for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in _lowest(u, v)], names=["node", "root"])


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; component is the smallest reachable node.

    Edges are sorted and contracted by chunks, a bounded number at a time, so that where near nodes have near numbers only
    links between chunks are left, and those are contracted again while that halves them. The rest takes
    rounds of two joins and aggregations with map-side combine, each cut
    off through the shared folder, so neither lineage nor a hub's neighbour list
    grows in one task. An empty edge table gives an empty result. Self links
    give a node of its own.
    """
    end = lambda one, other: F.coalesce(one, other).cast("long").alias(one)
    edges = settle(edges.select(end("u", "v"), end("v", "u")).where("u IS NOT NULL"), "edges")
    near = settle(edges.repartitionByRange("u", "v").sortWithinPartitions("u", "v").mapInArrow(_contract_by(CHUNK), "node long, root long"), "near")
    low = settle(near.groupBy("node").agg(F.min("root").alias("root"), (F.min("root") != F.max("root")).alias("shared")), "low")
    shared = low.where("shared").select("node", F.col("root").alias("v"))
    links = settle(near.join(shared, "node").where("root <> v").select(F.col("root").alias("u"), "v").distinct(), "star")
    left = links.count()
    if not left:
        return low.select("node", F.col("root").alias("component"))
    stars = connected_components(links, max_rounds) if 2 * left <= edges.count() else _stars(links, max_rounds)
    stars = stars.select(F.col("node").alias("root"), "component")
    return low.join(stars, "root", "left").select("node", F.coalesce("component", "root").alias("component"))


def _stars(links: DataFrame, max_rounds: int) -> DataFrame:
    """``connected_components`` of links without repeats, except that a component's smallest node is left out."""
    before = None
    for _ in range(max_rounds):
        links = settle(_small_star(_large_star(links)), "star")
        now = _state(links)
        if now == before or now[0] == 0:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
