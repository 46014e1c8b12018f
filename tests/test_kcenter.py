import numpy as np
import pytest
from pyspark.sql import functions as F

from meridian.operators import kcenter as KC
from meridian.plans.iterate import cut


def noisy(spark, n, z, dim=3, seed=4):
    """Five clusters and z far points; the points, and the radius of the plain solution."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(5, dim)) * 50
    x = centre[rng.integers(0, 5, n)] + rng.uniform(-1, 1, (n, dim))
    x[rng.choice(n, z, replace=False)] = rng.uniform(-5000, 5000, (z, dim))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "id long, features array<double>")
    return x, cut(df), np.sqrt(dim)


def test_many_points_many_outliers(spark, monkeypatch):
    x, df, radius = noisy(spark, 30_000, 100)
    core, levels = KC.merged_coreset(df, 5, 100, small=500)
    assert levels >= 2 and core.agg(F.sum("weight")).first()[0] == len(x) and core.count() <= 500
    centers, rep = KC.mr_kcenter_outliers(df, 5, 100, small=500)
    assert KC.kcenter_objective(df, centers, 100) <= (3 + 8 * levels) * 2 * radius + 2 * levels * radius
    assert rep["n"] <= 500


def test_distributed_steps_equal_local_ones(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(150, 2)) * 2)
    x[-40:] = x[0]
    df = cut(spark.createDataFrame([(i, v, float(1 + i % 3)) for i, v in enumerate(x.tolist())], "id long, features array<double>, weight double"))
    near, a = KC.weighted_kcenter_outliers(df, 2, 5, 1.0)
    far, b = KC.weighted_kcenter_outliers(df, 2, 5, 1.0, small=50)
    assert a == b and near.orderBy("rank").collect() == far.orderBy("rank").collect()


def test_first_points_that_coincide(spark):
    rows = [(i, [0.0, 0.0], 1.0) for i in range(20)] + [(20 + i, [float(i + 4), 0.0], 1.0) for i in range(6)]
    df = cut(spark.createDataFrame(rows, "id long, features array<double>, weight double"))
    _, rep = KC.weighted_kcenter_outliers(df, 2, 1, 0.0)
    assert rep["initial_guess"] == 2.0 and rep["n_guesses"] <= 2


def test_few_points(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id long, features array<double>")
    centers, rep = KC.mr_kcenter_outliers(df, 3, 2)
    assert rep["n"] == 2 and centers.count() <= 2
    centers, rep = KC.mr_kcenter_outliers(df.limit(0), 3, 2)
    assert rep["n"] == 0 and centers.count() == 0
    assert KC.kcenter_objective(df, df.limit(1).withColumn("rank", F.lit(0)), 0) == pytest.approx(1.0)
