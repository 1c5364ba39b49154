"""The stream of ministacks against the batch plan: several tiles, late and repeated samples, a failure on the way."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fringeflow.operators import coherence, sequential
from fringeflow.plans.temporal import sequential_plan
from fringeflow.streaming import ministacks

EPOCHS, ROWS, COLS = 8, 20, 40
SCHEMA = "point_id long, r int, c int, t int, re double, im double"


@pytest.fixture(scope="module")
def scene(spark):
    rng = np.random.default_rng(12)
    z = np.exp(1j * np.linspace(0, 2, EPOCHS)) * (rng.normal(size=(ROWS * COLS, 1)) + 1j) + 0.3 * (rng.normal(size=(ROWS * COLS, EPOCHS)) + 1j * rng.normal(size=(ROWS * COLS, EPOCHS)))
    rows = [(p, p // COLS, p % COLS, t, float(z[p, t].real), float(z[p, t].imag)) for p in range(ROWS * COLS) for t in range(EPOCHS) if p % 97 or t < 6]
    near = [(p, q) for p in range(ROWS * COLS) if p % 97 for q in (p - COLS, p - 1, p + 1, p + COLS, p + 2, p - 2) if 0 <= q < ROWS * COLS and q % 97]
    return spark.createDataFrame(rows, SCHEMA).persist(), spark.createDataFrame(near, "center_id long, neighbor_id long").persist()


def _rows(df):
    return {(r["point_id"], r["t"]): (r["phase"], r["estimator"], r["stage"]) for r in df.collect()}


def _equal(got, want):
    assert got.keys() == want.keys()
    for k, (phase, *rest) in got.items():
        assert abs(math.remainder(phase - want[k][0], 2 * math.pi)) < 1e-8 and tuple(rest) == want[k][1:]


@pytest.mark.parametrize("history", [None, 1])
def test_equal_to_the_batch_plan(spark, scene, tmp_path, monkeypatch, history):
    samples, near = scene
    plan = sequential_plan(EPOCHS, 3, history)
    whole = samples.groupBy("point_id").count().where(F.col("count") == EPOCHS).select("point_id")
    want = _rows(sequential.run_plan(near, coherence.wide(samples.join(whole, "point_id", "left_semi"), EPOCHS), plan))
    epochs, work = f"file://{tmp_path}/epochs", f"file://{tmp_path}/work"
    put = lambda where: samples.where(where).coalesce(2).write.mode("append").parquet(epochs)
    put("t < 2")
    ministacks.advance(spark, epochs, near, plan, work)
    assert not (tmp_path / "work" / "phases").exists()  # the first stage waits for its third epoch
    put("t BETWEEN 2 AND 4")
    real, failures = ministacks.link_stage, []

    def broken(*args):
        failures.append(1)
        raise RuntimeError("an executor is gone")

    monkeypatch.setattr(ministacks, "link_stage", broken)
    with pytest.raises(Exception, match="executor is gone"):
        ministacks.advance(spark, epochs, near, plan, work)
    assert failures
    monkeypatch.setattr(ministacks, "link_stage", real)
    ministacks.advance(spark, epochs, near, plan, work)  # goes on from the checkpoint
    assert {k[1] for k in _rows(ministacks.phases(spark, work))} == {0, 1, 2}
    put("t = 1")  # late and known: left out
    put("t >= 5")
    ministacks.advance(spark, epochs, near, plan, work)
    _equal({k: v for k, v in _rows(ministacks.phases(spark, work)).items() if k[0] % 97}, want)


def test_all_epochs_at_once(spark, scene, tmp_path):
    samples, near = scene
    plan = sequential_plan(EPOCHS, 4)
    whole = samples.where("point_id % 97 > 0")
    whole.write.parquet(f"file://{tmp_path}/epochs")
    ministacks.advance(spark, f"file://{tmp_path}/epochs", near, plan, f"file://{tmp_path}/work")
    _equal(_rows(ministacks.phases(spark, f"file://{tmp_path}/work")), _rows(sequential.run_plan(near, coherence.wide(whole, EPOCHS), plan)))


def test_state_lets_go_of_finished_epochs():
    plan = sequential_plan(6, 3)
    tile = ministacks._Tile(len(plan), None)
    points = np.repeat(np.array([7, 5]), 4)
    t = np.tile(np.arange(4), 2)
    tile.add(points, t, np.exp(1j * t) * (points + 1), plan)
    ((stage, ready, z),) = tile.ready(plan)
    assert stage.number == 0 and sorted(ready) == [5, 7] and z.shape == (2, 3)
    tile.compress(np.array([5, 7]), np.tile(np.arange(3.0), (2, 1)), stage)
    again = ministacks._Tile(len(plan), tile.stored())
    assert sorted(again.t) == [3, 3]
    assert np.allclose(np.abs(again.sums[again.at(np.array([5, 7])), 0]), [6, 8]) and np.allclose(np.angle(again.sums[:, 0]), 0)
    again.add(np.array([5]), np.array([1]), np.array([9 + 0j]), plan)  # of a finished stage
    assert sorted(again.t) == [3, 3]
