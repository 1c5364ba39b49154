"""Sequential ministacks: each stage links its real epochs together with compressed summaries of earlier ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fringeflow.operators import coherence, linking
from fringeflow.plans.lineage import settle
from fringeflow.plans.temporal import Stage


def link_stage(support: DataFrame, table: DataFrame, n: int) -> DataFrame:
    """``center_id, phase, estimator`` of the points of ``table(point_id, re0, im0, ...)`` whose ``n`` inputs could be linked."""
    linked = settle(linking.link_phases(coherence.coherence_wide(support, table, n), n), "stage-linked")
    return linked.where((F.col("estimator") != linking.INVALID) & F.forall("phase", lambda x: x.isNotNull() & ~F.isnan(x)))


def real_phases(good: DataFrame, stage: Stage) -> DataFrame:
    """``point_id, t, phase, estimator, stage`` of the real epochs of a linked stage."""
    real = good.select(F.col("center_id").alias("point_id"), "estimator", F.posexplode(F.slice("phase", len(stage.compressed) + 1, stage.real)).alias("k", "phase"))
    return real.select("point_id", (F.col("k") + stage.start).alias("t"), "phase", "estimator", F.lit(stage.number).alias("stage"))


def run_plan(support: DataFrame, pixels: DataFrame, plan: list[Stage]) -> DataFrame:
    """``point_id, t, phase, estimator, stage`` of every epoch, referenced to epoch 0.

    ``pixels`` has one row a point with all epochs. A stage's matrix takes the compressed inputs first;
    the whole stage is referenced to its first column before the inputs are left out, so later stages stay
    tied to epoch 0 through their oldest input. Points that a stage can't link leave the following stages.
    Each stage is written to the shared folder, so a lost executor costs a reread.
    """
    support = settle(support.select("center_id", "neighbor_id"), "support")
    inputs: dict[str, DataFrame] = {}
    out = None
    for stage in plan:
        names = [*stage.compressed, *(str(t) for t in range(stage.start, stage.stop))]
        table = pixels.select("point_id", *[F.col(f"{p}{t}").alias(f"{p}{len(stage.compressed) + k}") for k, t in enumerate(range(stage.start, stage.stop)) for p in ("re", "im")])
        for k, name in enumerate(stage.compressed):
            one = inputs[name].select("point_id", (F.col("amp") * F.cos("phase")).alias(f"re{k}"), (F.col("amp") * F.sin("phase")).alias(f"im{k}"))
            table = table.join(one, "point_id")
        table = settle(table, "stage-input")
        n = len(names)
        good = link_stage(support, table, n)
        theta = good.select(F.col("center_id").alias("point_id"), *[F.col("phase")[k].alias(f"th{k}") for k in range(n)])
        if stage.output:
            inputs[stage.output] = settle(coherence.compress(table, theta, len(stage.compressed), n), "compressed")
        real = real_phases(good, stage)
        out = real if out is None else out.union(real)
    return out


def complete_only(linked: DataFrame, epochs: int) -> DataFrame:
    """``point_id, th0, ...`` of points that every stage linked."""
    at = [F.max(F.when(F.col("t") == t, F.col("phase"))).alias(f"th{t}") for t in range(epochs)]
    return linked.groupBy("point_id").agg(F.count("*").alias("n"), *at).where(F.col("n") == epochs).drop("n")
