"""Readers and writers on small files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fringeflow.sources import rasters, sinks, text


def test_parameters(spark, tmp_path):
    (tmp_path / "a.par").write_text("# note\ntitle: two words\nwidth:  10  samples\nheading 12.5 deg\nlonely\n% x\nwidth: 11\n")
    row = text.parameters(spark, f"file://{tmp_path}/a.par").head()
    assert row.params == {"title": ["two", "words"], "width": ["11"], "heading": ["12.5", "deg"]}
    got = text.parameters(spark, f"file://{tmp_path}/a.par").select(text.first_number(F.col("params"), ["title", "heading"]).alias("h"), text.first_positive_int(F.col("params"), ["width"]).alias("w")).head()
    assert (got.h, got.w) == (12.5, 11)


def test_manifest(spark, tmp_path):
    (tmp_path / "tab").write_text("x/20200102.rslc x/20200102.par # first\n\n; none\n20190101/r_20200114.rslc p.par\n")
    rows = text.manifest(spark, f"file://{tmp_path}/tab").orderBy("idx").collect()
    assert [(r.idx, str(r.date)) for r in rows] == [(0, "2020-01-02"), (1, "2020-01-14")]
    (tmp_path / "bad").write_text("20200102.rslc a.par\n20200102_b.rslc b.par\n")
    with pytest.raises(ValueError):
        text.manifest(spark, f"file://{tmp_path}/bad")


def test_pair_list(spark, tmp_path):
    edges = spark.createDataFrame([(1, 2), (0, 1), (0, 3)], "i int, j int")
    text.write_pair_list(edges, f"file://{tmp_path}/itab")
    assert sorted((r.i, r.j) for r in text.pair_list(spark, f"file://{tmp_path}/itab", 4).collect()) == [(0, 1), (0, 3), (1, 2)]
    with pytest.raises(ValueError):
        text.pair_list(spark, f"file://{tmp_path}/itab", 3)
    (tmp_path / "base").write_text("0 1.0\n0 3.0\n1 -5\nnote\n0 2.5\n")
    assert {r.idx: r.bperp for r in text.baselines(spark, f"file://{tmp_path}/base").collect()} == {0: 2.5, 1: -5.0}


@pytest.mark.parametrize("kind, order", [("fcomplex", "big"), ("scomplex", "little")])
def test_raster_windows(spark, tmp_path, kind, order):
    x = np.arange(7 * 5 * 2).reshape(7, 5, 2)
    x.astype(rasters.ORDERS[order] + rasters.KINDS[kind][0]).tofile(tmp_path / "a.slc")
    df = rasters.read_raster(spark, f"file://{tmp_path}/a.slc", 5, 7, order=order, rows_a_partition=2)
    assert {(r.r, r.c): (r.re, r.im) for r in df.collect()} == {(i, j): tuple(x[i, j]) for i in range(7) for j in range(5)}
    part = df.where("r >= 2 AND r < 4 AND c = 3")
    assert sorted((r.r, r.c, r.re) for r in part.collect()) == [(2, 3, 26.0), (3, 3, 36.0)]
    assert part.rdd.getNumPartitions() == 1
    stack = rasters.read_stack(spark, [f"file://{tmp_path}/a.slc"] * 3, 5, 7, dates=[0, 2], order=order, row0=1, rows=2)
    assert stack.groupBy("t").count().orderBy("t").collect() == [(0, 10), (2, 10)]
    with pytest.raises(ValueError):
        rasters.raster_kind(11, 5, 7)


def _planned(df):
    return df.rdd.getNumPartitions()


@pytest.mark.parametrize("kind, order, tile", [("fcomplex", "big", 4), ("scomplex", "little", 4), ("fcomplex", "little", 11)])
def test_stack_round_trip(spark, tmp_path, kind, order, tile):
    rng = np.random.default_rng(4)
    x = rng.integers(-300, 300, (5, 11, 6, 2))
    rows = [(t, r, c, float(x[t, r, c, 0]), float(x[t, r, c, 1])) for t in range(5) for r in range(11) for c in range(6) if (t + r + c) % 5]
    folder = f"file://{tmp_path}/stack"
    rasters.write_stack(spark.createDataFrame(rows, "t int, r int, c int, re double, im double").repartition(7), folder, 6, 11, rows_a_tile=tile, kind=kind, order=order)
    stack = rasters.read_written_stack(spark, folder, rows_a_partition=4)
    got = {(r.t, r.r, r.c): (r.re, r.im) for r in stack.collect()}
    assert len(got) == 5 * 11 * 6
    assert {k: v for k, v in got.items() if sum(k) % 5} == {(t, r, c): (a, b) for t, r, c, a, b in rows} and all(v == (0, 0) for k, v in got.items() if not sum(k) % 5)
    # Three row ranges for each date; predicates on dates and rows rule partitions out, columns leave them.
    assert _planned(stack) == 15
    for where, n in (("t IN (1, 3, 4)", 9), ("t = 2 AND r < 4", 1), ("t > 2 AND r BETWEEN 4 AND 9", 4 if tile == 4 else 4), ("c = 2", 15), ("t > 7", 1)):
        part = stack.where(where)
        assert _planned(part) == n, where
        want = spark.createDataFrame([(*k, *v) for k, v in got.items()], "t int, r int, c int, re float, im float").where(where)
        assert sorted(map(tuple, part.collect())) == sorted(map(tuple, want.collect()))
    if tile == 11:  # a tile of all rows is a plain raster of the date
        plain = rasters.read_stack(spark, [f"{folder}/t={t}/000000000.slc" for t in range(5)], 6, 11, order=order)
        assert sorted(map(tuple, plain.collect())) == sorted((*k, *v) for k, v in got.items())


def test_stacks_that_do_not_fit_are_errors(spark, tmp_path):
    np.zeros((4, 6, 2), ">f4").tofile(tmp_path / "a.slc")
    np.zeros((4, 5, 2), ">f4").tofile(tmp_path / "b.slc")
    np.zeros((4, 6, 2), ">i2").tofile(tmp_path / "c.slc")
    paths = [f"file://{tmp_path}/{x}.slc" for x in "abc"]
    assert rasters.read_stack(spark, paths, 6, 4, dates=[0]).count() == 24
    for other in (1, 2):
        with pytest.raises(Exception, match=f"{'abc'[other]}.slc"):
            rasters.read_stack(spark, paths, 6, 4, dates=[0, other]).count()
    twice = spark.createDataFrame([(0, 1, 1, 1.0, 1.0)] * 2 + [(0, 0, 0, 1.0, 1.0)], "t int, r int, c int, re double, im double")
    with pytest.raises(Exception, match="written twice"):
        rasters.write_stack(twice, f"file://{tmp_path}/twice", 6, 4)
    with pytest.raises(Exception, match="outside"):
        rasters.write_stack(twice.limit(1).withColumn("c", F.lit(6)), f"file://{tmp_path}/out", 6, 4)
    assert not (tmp_path / "twice" / "stack.json").exists()


def test_phases_are_written_once(spark, tmp_path):
    path = f"file://{tmp_path}/phases"
    stage = spark.createDataFrame([(p, t, 0.5) for p in range(3) for t in range(2)], "point_id long, t int, phase double")
    sinks.write_phases(stage, path, 0)
    with pytest.raises(ValueError):
        sinks.write_phases(stage, path, 0)
    with pytest.raises(ValueError):
        sinks.write_phases(stage, path, 1)
    with pytest.raises(ValueError):
        sinks.write_phases(stage.withColumn("phase", F.lit(float("nan"))), path, 1)
    with pytest.raises(ValueError):
        sinks.write_phases(stage.union(stage).withColumn("t", F.col("t") + 5), path, 1)
    sinks.write_phases(stage, path, 0, resume=True)
    sinks.write_phases(stage.withColumn("t", F.col("t") + 2), path, 1)
    assert {r.t: r.n for r in sinks.finite_counts(spark, path).collect()} == {0: 3, 1: 3, 2: 3, 3: 3}


def test_manifests(spark, tmp_path):
    path = f"file://{tmp_path}/m"
    first = sinks.write_manifest(spark, path, "linking", {"b": 1, "a": [2]})
    assert sinks.is_current(spark, path, "linking", {"a": [2], "b": 1}) and not sinks.is_current(spark, path, "linking", {"a": [2], "b": 2})
    assert not sinks.is_current(spark, path, "linking", {"a": [2], "b": 1}, parent=first) and not sinks.is_current(spark, f"{path}x", "linking", {})
