"""Sequential ministacks as epochs arrive: a stream that links each stage once its epochs are there.

A stream of samples and a stream of what earlier batches linked meet in one operator with state, keyed by tiles of the
grid. A tile's state holds, of each of its points, the compressed summary of every finished stage and the
samples that no finished stage has used; so an epoch is read once and dropped from the state when its stage is
compressed, and what stays is one number a stage and point. When a point has all epochs of its stage, its input goes
out; the batch joins the inputs to their neighbours, links them, and writes the phases. The linked
phases come back as the second stream, by which the next batch compresses the stage and begins the next.

State and offsets are in the checkpoint, and each batch replaces the folders of its own number, so a run that was stopped
goes on where it was. An epoch is dropped into the folder whole, in one write. Samples that come twice count once, and
those of a finished stage are late and left out. A point that a stage can't link waits in its stage for good.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from fringeflow.operators.sequential import link_stage, real_phases
from fringeflow.plans.temporal import Stage

TILE_ROWS, TILE_COLS = 16, 32
SAMPLE = "point_id long, r int, c int, t int, re double, im double"
LINKED = "point_id long, tile string, stage int, theta array<double>"
INPUT = "point_id long, tile string, stage int, re array<double>, im array<double>"
STATE = "points array<long>, stage array<int>, waiting array<boolean>, sums_re array<double>, sums_im array<double>, own array<int>, t array<int>, re array<double>, im array<double>"


def _tile(r: Column, c: Column) -> Column:
    return F.concat_ws("/", F.floor(r / TILE_ROWS).cast("string"), F.floor(c / TILE_COLS).cast("string"))


class _Tile:
    """The state of one tile, as arrays over its points and over the samples held."""

    def __init__(self, stages: int, held: tuple | None) -> None:
        points, stage, waiting, sums_re, sums_im, own, t, re, im = held or ([],) * 9
        self.points, self.stage, self.waiting = np.array(points, np.int64), np.array(stage, np.int32), np.array(waiting, bool)
        self.sums = (np.array(sums_re, float) + 1j * np.array(sums_im, float)).reshape(-1, stages)
        self.own, self.t, self.z = np.array(own, np.int64), np.array(t, np.int32), np.array(re, float) + 1j * np.array(im, float)

    def stored(self) -> tuple:
        lists = (self.points, self.stage, self.waiting, self.sums.real.ravel(), self.sums.imag.ravel(), self.own, self.t, self.z.real, self.z.imag)
        return tuple(x.tolist() for x in lists)

    def at(self, points: np.ndarray) -> np.ndarray:
        """Where these points are; points that are new get a place."""
        new = np.setdiff1d(points, self.points)
        self.points = np.append(self.points, new)
        self.stage, self.waiting = np.append(self.stage, np.zeros(len(new), np.int32)), np.append(self.waiting, np.zeros(len(new), bool))
        self.sums = np.vstack([self.sums, np.full((len(new), self.sums.shape[1]), np.nan + 0j)])
        order = np.argsort(self.points)
        return order[np.searchsorted(self.points, points, sorter=order)]

    def add(self, points: np.ndarray, t: np.ndarray, z: np.ndarray, plan: list[Stage]) -> None:
        own = self.at(points)
        begin = np.array([s.start for s in plan] + [plan[-1].stop])
        late = t < begin[self.stage[own]]
        own, t, z = np.append(self.own, own[~late]), np.append(self.t, t[~late]), np.append(self.z, z[~late])
        _, first = np.unique(own * (plan[-1].stop + 1) + t, return_index=True)
        self.own, self.t, self.z = own[first], t[first], z[first]

    def samples(self, at: np.ndarray, stage: Stage) -> np.ndarray:
        """Samples of these points in the stage's epochs, NaN where there is none."""
        out = np.full((len(self.points), stage.real), np.nan + 0j)
        inside = (self.t >= stage.start) & (self.t < stage.stop)
        out[self.own[inside], self.t[inside] - stage.start] = self.z[inside]
        return out[at]

    def compress(self, points: np.ndarray, theta: np.ndarray, stage: Stage) -> None:
        """Keeps the mean amplitude and the phase that is left once the linked phase is taken off, and lets the samples go."""
        at = self.at(points)
        theta, at = theta[self.waiting[at] & (self.stage[at] == stage.number)], at[self.waiting[at] & (self.stage[at] == stage.number)]
        z = self.samples(at, stage)
        left = (z * np.exp(-1j * theta[:, len(stage.compressed) :])).sum(axis=1)
        some = np.abs(left) > 0
        at, left, size = at[some], left[some], np.abs(z[some]).mean(axis=1)
        self.sums[at, stage.number] = size * np.exp(1j * np.angle(left))
        self.stage[at] += 1
        self.waiting[at] = False
        keep = ~(np.isin(self.own, at) & (self.t < stage.stop))
        self.own, self.t, self.z = self.own[keep], self.t[keep], self.z[keep]

    def ready(self, plan: list[Stage]) -> Iterator[tuple[Stage, np.ndarray, np.ndarray]]:
        """For each stage the points that have all of its epochs, with their inputs, compressed ones first."""
        for stage in plan:
            at = np.flatnonzero(~self.waiting & (self.stage == stage.number))
            if not len(at):
                continue
            real = self.samples(at, stage)
            old = self.sums[at][:, [int(name[1:]) for name in stage.compressed]]
            full = ~np.isnan(real.real).any(axis=1)
            self.waiting[at[full]] = True
            if full.any():
                yield stage, self.points[at[full]], np.hstack([old, real])[full]


def _stepped(plan: list[Stage]):
    """The state's step over one batch of samples and linked phases."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tile = _Tile(len(plan), state.get if state.exists else None)
        rows = pd.concat(list(batches))
        linked = rows[rows["stage"].notna()]
        for number, part in linked.drop_duplicates(["point_id", "stage"]).groupby("stage"):
            tile.compress(part["point_id"].to_numpy(np.int64), np.stack(part["theta"].to_numpy()), plan[int(number)])
        new = rows[rows["stage"].isna()]
        if len(new):
            tile.add(new["point_id"].to_numpy(np.int64), new["t"].to_numpy(np.int32), new["re"].to_numpy(float) + 1j * new["im"].to_numpy(float), plan)
        for stage, points, z in tile.ready(plan):
            yield pd.DataFrame({"point_id": points, "tile": key[0], "stage": np.int32(stage.number), "re": list(z.real), "im": list(z.imag)})
        state.update(tile.stored())

    return step


def _linked_batch(support: DataFrame, plan: list[Stage], work: str):
    """What is done with the inputs of a batch: linked stage by stage and written under the batch's number."""

    def put(rows: DataFrame, number: int) -> None:
        rows = rows.persist()
        for k in sorted(r["stage"] for r in rows.select("stage").distinct().collect()):  # a row a stage
            stage = plan[k]
            n = stage.solver_size
            own = rows.where(F.col("stage") == k)
            table = own.select("point_id", *[F.col(p)[i].alias(f"{p}{i}") for i in range(n) for p in ("re", "im")])
            good = link_stage(support, table, n)
            real_phases(good, stage).write.mode("overwrite").parquet(f"{work}/phases/batch={number}/part={k}")
            back = good.join(own.select(F.col("point_id").alias("center_id"), "tile"), "center_id")
            back.select(F.col("center_id").alias("point_id"), "tile", F.lit(k).alias("stage"), F.col("phase").alias("theta")).write.mode("overwrite").parquet(f"{work}/linked/batch={number}-{k}")
        rows.unpersist()

    return put


def advance(spark: SparkSession, samples: str, support: DataFrame, plan: list[Stage], work: str) -> int:
    """Takes in all epochs that the folder ``samples`` holds now and links every stage they complete; how many batches that took.

    ``work`` holds the checkpoint, the phases and the linked phases, and is given again to go on. Each pass of the loop is a
    stream of its own that ends when the present input is read, so what a pass links is input of the next.
    """
    spark.createDataFrame([], LINKED).write.mode("append").parquet(f"{work}/linked/none")
    read = lambda folder, schema: spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 100_000).parquet(folder)
    batches = 0
    while True:
        nothing = {"stage": F.lit(None).cast("int"), "theta": F.lit(None).cast("array<double>")}
        fresh = read(samples, SAMPLE).withColumn("tile", _tile(F.col("r"), F.col("c"))).withColumns(nothing).drop("r", "c")
        back = read(f"{work}/linked", LINKED).withColumns({"t": F.lit(None).cast("int"), "re": F.lit(None).cast("double"), "im": F.lit(None).cast("double")})
        inputs = fresh.unionByName(back).groupBy("tile").applyInPandasWithState(_stepped(plan), INPUT, STATE, "append", "NoTimeout")
        stream = inputs.writeStream.outputMode("append").option("checkpointLocation", f"{work}/state").trigger(availableNow=True).foreachBatch(_linked_batch(support, plan, work)).start()
        stream.awaitTermination()
        done = sum(p["numInputRows"] > 0 for p in stream.recentProgress)
        batches += done
        if not done:
            return batches


def phases(spark: SparkSession, work: str) -> DataFrame:
    """``point_id, t, phase, estimator, stage`` of all stages linked so far."""
    return spark.read.schema("point_id long, t int, phase double, estimator short, stage int").option("recursiveFileLookup", "true").parquet(f"{work}/phases")
