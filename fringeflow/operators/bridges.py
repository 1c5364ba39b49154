"""Two-edge-connected networks: the bridge tree, and the best edges that join what is apart and double what hangs on one edge.

Edges outside a spanning forest each take a number, drawn from their ends by a hash, and put it on one end and its negative on the other. A tree
edge with such an edge around it has a sum other than zero on either side, unless numbers of 40 bits happen to
cancel; one without is a bridge. So all bridges come from one run of sums over the forest, and what the bridges leave are
the parts that no single loss can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fringeflow.operators.components import connected_components
from fringeflow.operators.consistency import potentials
from fringeflow.operators.forests import side_sums, spanning_forest
from fringeflow.plans.lineage import settle

_BITS = (1 << 40) - 1


def bridges_and_parts(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``u, v`` of the bridges of ``edges(u, v)`` and ``node, part`` of the two-edge-connected parts, named by their smallest node."""
    edges = settle(edges.where("u <> v").select(F.least("u", "v").cast("long").alias("u"), F.greatest("u", "v").cast("long").alias("v")).distinct(), "bridge-edge")
    forest = settle(spanning_forest(edges, F.lit(0)), "bridge-forest")
    rest = edges.join(forest, ["u", "v"], "left_anti").select("u", "v", (F.xxhash64("u", "v").bitwiseAND(F.lit(_BITS)) + 1).alias("h"))
    weights = rest.select(F.col("u").alias("node"), F.col("h").alias("w")).union(rest.select(F.col("v").alias("node"), (-F.col("h")).alias("w"))).groupBy("node").agg(F.sum("w").alias("w"))
    found = settle(side_sums(forest, weights).where("side = 0").select("u", "v"), "bridge")
    nodes = edges.select(F.col("u").alias("node")).union(edges.select(F.col("v").alias("node"))).distinct()
    left = edges.join(found, ["u", "v"], "left_anti").union(nodes.select(F.col("node").alias("u"), F.col("node").alias("v")))
    return found, connected_components(left).select("node", F.col("component").alias("part"))


def joined_network(candidates: DataFrame, chosen: DataFrame) -> DataFrame:
    """``i, j, why``: the ``chosen`` edges, and the best ``candidates(i, j, score)`` that join what they leave apart."""
    own = chosen.select("i", "j", F.lit(0).alias("rank"), F.lit(0.0).alias("score"))
    rest = candidates.join(chosen.select("i", "j"), ["i", "j"], "left_anti").select("i", "j", F.lit(1).alias("rank"), F.col("score").cast("double").alias("score"))
    links = own.unionByName(rest).select(F.col("i").alias("u"), F.col("j").alias("v"), F.struct("rank", "score").alias("order"))
    tree = spanning_forest(links, F.col("order")).select(F.col("u").alias("i"), F.col("v").alias("j"))
    return chosen.select("i", "j", F.lit("chosen").alias("why")).union(tree.join(chosen.select("i", "j"), ["i", "j"], "left_anti").select("i", "j", F.lit("joins").alias("why")))


def doubled_network(candidates: DataFrame, chosen: DataFrame) -> DataFrame:
    """``i, j, why, bridge``: the ``chosen`` edges, and for each bridge the best of ``candidates(i, j, score)`` across its cut.

    ``bridge`` marks the chosen edges whose loss would still split the network, as no candidate crosses them. A candidate
    crosses the bridges on its way through the bridge tree, which is climbed one bridge a round from both ends.
    """
    links = chosen.select(F.col("i").alias("u"), F.col("j").alias("v"))
    bridges, parts = bridges_and_parts(links)
    parts = settle(parts, "bridge-part")
    part = lambda name: parts.select(F.col("node").alias(name), F.col("part").alias(f"part_{name}"))
    tree = settle(bridges.join(part("u"), "u").join(part("v"), "v"), "bridge-tree")
    at = settle(potentials(tree.select(F.col("part_u").alias("u"), F.col("part_v").alias("v"), F.lit(0).cast("long").alias("shift"))), "bridge-depth")
    rest = candidates.join(chosen.select("i", "j"), ["i", "j"], "left_anti").select("i", "j", "score", F.col("i").cast("long").alias("u"), F.col("j").cast("long").alias("v"))
    end = lambda part_, root, depth: at.select(F.col("node").alias(part_), F.col("root").alias(root), F.col("depth").alias(depth))
    met = rest.join(part("u"), "u").join(part("v"), "v").where("part_u <> part_v").join(end("part_u", "ru", "dx"), "part_u").join(end("part_v", "rv", "dy"), "part_v").where("ru = rv")
    going = met.select("i", "j", "score", F.col("part_u").alias("x"), F.col("part_v").alias("y"), "dx", "dy")
    over = None
    while True:
        going = settle(going, "bridge-climb")
        if going.isEmpty():
            break
        first = F.col("dx") >= F.col("dy")
        up = settle(going.withColumn("node", F.when(first, F.col("x")).otherwise(F.col("y"))).join(at.select("node", "parent"), "node"), "bridge-step")
        step = up.select("i", "j", "score", F.col("node").alias("below"))
        over = step if over is None else over.union(step)
        going = up.select("i", "j", "score", F.when(first, F.col("parent")).otherwise(F.col("x")).alias("x"), F.when(first, F.col("y")).otherwise(F.col("parent")).alias("y"), (F.col("dx") - first.cast("int")).alias("dx"), (F.col("dy") - (~first).cast("int")).alias("dy")).where("x <> y")
    kinds = {f.name: f.dataType for f in chosen.schema.fields}
    own = chosen.select("i", "j", F.lit("chosen").alias("why"))
    if over is None:
        best = own.where("false").select("i", "j")
        covered = at.select(F.col("node").alias("below")).where("false")
    else:
        best = over.groupBy("below").agg(F.min(F.struct("score", "i", "j")).alias("best")).select(F.col("best.i").cast(kinds["i"]).alias("i"), F.col("best.j").cast(kinds["j"]).alias("j")).distinct()
        covered = over.select("below").distinct()
    # A bridge is named by the part below it.
    below = at.where("parent IS NOT NULL").select("node", "parent").join(covered, F.col("node") == F.col("below"), "left_anti")
    named = tree.select("u", "v", F.col("part_u").alias("node"), F.col("part_v").alias("parent")).union(tree.select("u", "v", F.col("part_v").alias("node"), F.col("part_u").alias("parent")))
    left = below.join(named, ["node", "parent"]).select("u", "v", F.lit(True).alias("open"))
    out = own.union(best.select("i", "j", F.lit("doubles").alias("why")))
    same = (F.least("i", "j") == F.col("u")) & (F.greatest("i", "j") == F.col("v"))
    return out.join(left, same & (F.col("why") == "chosen"), "left").select("i", "j", "why", F.coalesce("open", F.lit(False)).alias("bridge"))
