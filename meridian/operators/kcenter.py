"""K-center clustering with z outliers, sequential and two-round.

* Farthest-first traversal over the whole table keeps one ``min_d2`` column
  and adds a centre per round (argmax = a distributed top-1).
* The coreset round buckets points by a stable hash of the id (a recomputed bucket
  holds the same points) and runs farthest-first plus the weight count per bucket in
  ``applyInPandas``; each bucket returns at most k+z+1 weighted points.  Coresets are
  mergeable: ``merged_coreset`` puts the weighted points into buckets again and
  again, until few enough are left, so neither the input nor its coreset is ever one group.
* The weighted greedy with radius doubling runs in numpy on a small set, and otherwise as
  distributed steps: ball weights come from pivot blocks (``pivots.weight_within``).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions.draws import hash_int
from meridian.functions.vectors import squared_euclidean
from meridian.operators.pivots import PivotBlocks, distances, weight_within
from meridian.operators.vectors import collect_small, ids_literal, vectors_literal
from meridian.plans.iterate import Steps, cut

#: Points of a bucket, on the average (one task holds a bucket), and how often k+z+1 it is at least.
BUCKET_POINTS, REDUCTION = 4096, 16
#: Weighted points on which the greedy steps run in one process.
SMALL = 4096


def _lit_vec(v) -> F.Column:
    return vectors_literal([v])[0]


def farthest_first(points: DataFrame, k: int, id_col: str = "id", feat_col: str = "features") -> DataFrame:
    """G1 (global): k centres; the first is the lowest id, then repeatedly the
    point farthest from the chosen ones (ties: lowest id).  Stops early when
    every point coincides with a centre.  Returns rank, id, features."""
    state = cut(points.select(F.col(id_col).alias("id"), F.col(feat_col).alias("features"))
                .withColumn("min_d2", F.lit(float("inf"))))
    first = state.orderBy("id").limit(1).first()
    if first is None:
        return points.sparkSession.createDataFrame([], "rank int, id long, features array<double>")
    centers = [(0, first.id, list(first.features))]
    for r in range(1, k + 1):
        c = _lit_vec(centers[-1][2])
        state = state.withColumn("min_d2", F.least("min_d2", squared_euclidean(F.col("features"), c)))
        if r % 4 == 0:
            state = cut(state)
        if r == k:
            break
        far = state.orderBy(F.desc("min_d2"), F.asc("id")).limit(1).first()
        if far is None or far.min_d2 <= 0:
            break
        centers.append((r, far.id, list(far.features)))
    return points.sparkSession.createDataFrame(centers, "rank int, id long, features array<double>")


def assign_nearest_center(points: DataFrame, centers: DataFrame, id_col: str = "id",
                          feat_col: str = "features") -> DataFrame:
    """Id, center_id, distance to the nearest centre (first centre in rank
    order on ties).  The centre list is size-checked and inlined."""
    rows = collect_small(centers.orderBy("rank") if "rank" in centers.columns else centers.orderBy("id"))
    cs, ids = vectors_literal([r["features"] for r in rows]), ids_literal([r["id"] for r in rows])
    d2 = F.transform(cs, lambda c: squared_euclidean(F.col(feat_col), c))
    best = F.array_position(d2, F.array_min(d2))
    return points.select(F.col(id_col).alias("id"), F.element_at(ids, best.cast("int")).alias("center_id"),
                         F.sqrt(F.array_min(d2)).alias("distance"))


def coreset_weights(assign: DataFrame) -> DataFrame:
    """Number of points represented by each centre."""
    return assign.groupBy("center_id").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def _fft_bucket(m: int):
    """Farthest-first representatives of a bucket; each gets the weight of the points nearest to it."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        X = np.stack(pdf["features"].to_numpy()) if len(pdf) else np.zeros((0, 0))
        n = X.shape[0]
        if n == 0:
            return pd.DataFrame({"id": [], "features": [], "weight": [], "bucket": []})
        chosen = [0]
        d = ((X - X[0]) ** 2).sum(axis=1)
        while len(chosen) < m:
            j = int(np.argmax(d))           # first index on ties = lowest id
            if d[j] <= 0:
                break
            chosen.append(j)
            d = np.minimum(d, ((X - X[j]) ** 2).sum(axis=1))
        C = X[chosen]
        best = np.zeros(n, dtype=np.int64)
        bestd = ((X - C[0]) ** 2).sum(axis=1)
        for i in range(1, len(chosen)):
            di = ((X - C[i]) ** 2).sum(axis=1)
            upd = di < bestd                  # strict: first centre wins ties
            best[upd] = i
            bestd[upd] = di[upd]
        w = np.bincount(best, pdf["weight"].to_numpy(float), minlength=len(chosen))
        return pd.DataFrame({"id": pdf["id"].to_numpy()[chosen], "features": list(C),
                             "weight": w, "bucket": pdf["bucket"].to_numpy()[:len(chosen)]})
    return run


def coreset_buckets(points: DataFrame, m: int, least: int = 4) -> int:
    """Buckets of about ``BUCKET_POINTS`` points (or REDUCTION * m), so no task holds more of a larger input."""
    return max(least, math.ceil(points.count() / max(BUCKET_POINTS, REDUCTION * m)))


def extract_coreset(points: DataFrame, k: int, z: int, buckets: int | None = None, id_col: str = "id",
                    feat_col: str = "features", weight_col: str | None = None, seed: int = 21) -> DataFrame:
    """Per hash bucket, k+z+1 farthest-first representatives and their
    weights.  Σ weight = number of points (or the sum of ``weight_col``)."""
    m = k + z + 1
    n = buckets or coreset_buckets(points, m)
    weight = F.lit(1.0) if weight_col is None else F.col(weight_col).cast("double")
    pts = points.select(F.col(id_col).alias("id"), F.col(feat_col).alias("features"), weight.alias("weight"),
                        F.pmod(hash_int(id_col, seed), F.lit(n)).cast("int").alias("bucket"))
    return pts.groupBy("bucket").applyInPandas(
        _fft_bucket(m), "id long, features array<double>, weight double, bucket int")


def merged_coreset(points: DataFrame, k: int, z: int, buckets: int | None = None, id_col: str = "id",
                   feat_col: str = "features", small: int = SMALL) -> tuple[DataFrame, int]:
    """Coresets of coresets, until at most ``small`` weighted points are left or buckets no longer
    become fewer; and the number of levels.

    A bucket's k+z+1 farthest-first points cover it within twice the optimal radius for k
    centres and z outliers (the outliers could be centres of their own), so after t levels every
    point lies within 2 t times that radius of the point that bears its weight."""
    state, levels = cut(extract_coreset(points, k, z, buckets, id_col, feat_col)), 1
    size = state.count()
    while size > small:
        buckets = coreset_buckets(state, k + z + 1, 1)
        state, levels = cut(extract_coreset(state, k, z, buckets, weight_col="weight", seed=21 + levels)), levels + 1
        before, size = size, state.count()
        if size >= before or buckets == 1:
            break
    return state, levels


def initial_radius(points: DataFrame, m: int, id_col: str = "id", feat_col: str = "features") -> float:
    """G5 (Q6): half the least positive distance among the first m points by id
    (m = k+z+1 is a small parameter; those rows are collected)."""
    rows = points.select(id_col, feat_col).orderBy(id_col).limit(m).collect()
    X = np.array([r[feat_col] for r in rows], dtype=float)
    if len(X) < 2:
        return 0.0
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(axis=2))
    pos = D[D > 0]
    return float(pos.min()) / 2.0 if pos.size else 0.0


def _nearest_other(w: DataFrame) -> float:
    """The least positive distance of any point to the first by id (0 if there is none)."""
    first = w.orderBy("id").select("features").first()
    if first is None:
        return 0.0
    d = w.select(F.sqrt(squared_euclidean(F.col("features"), _lit_vec(list(first.features)))).alias("d")).where("d > 0")
    return float(d.agg(F.min("d")).first()[0] or 0.0)


def weighted_kcenter_outliers(wpoints: DataFrame, k: int, z: float, alpha: float,
                              id_col: str = "id", feat_col: str = "features", weight_col: str = "weight",
                              small: int = SMALL):
    """Greedy k-center with outliers on weighted points.

    Returns (centers DataFrame [rank, id, features], report dict).  For a radius
    guess r every greedy step takes the point whose ball of radius (1+2a)r holds the
    most uncovered weight (lowest id on ties) and drops the points within (3+4a)r of
    it.  If more than z weight stays uncovered, r doubles; it ends at the latest when
    r covers all points.

    Up to ``small`` points one process takes the steps; beyond, every step is a distributed
    pass over pivot blocks, with the same result."""
    spark = wpoints.sparkSession
    w = wpoints.select(F.col(id_col).alias("id"), F.col(feat_col).cast("array<double>").alias("features"),
                       F.col(weight_col).cast("double").alias("weight"))
    rows = w.limit(small + 1).collect()                       # at most small + 1 rows
    n = len(rows) if len(rows) <= small else w.count()
    # Half the least positive distance among the first k+z+1 points by id or, if these coincide, from them to any.
    r = r_min = initial_radius(w, k + int(z) + 1) or _nearest_other(w) / 2 or 1e-12
    steps = _LocalSteps(rows) if n == len(rows) else _DistributedSteps(w)
    guesses = 1
    while True:
        steps.uncover()
        chosen = []
        while len(chosen) < k:
            best = steps.heaviest((1 + 2 * alpha) * r)
            if best is None:
                break
            chosen.append(best)
            steps.cover(best[1], (3 + 4 * alpha) * r)
        if steps.left() <= z:
            break
        r *= 2
        guesses += 1
    centers = [(j, i, x) for j, (i, x) in enumerate(chosen)]
    report = {"initial_guess": r_min, "final_guess": r, "n_guesses": guesses, "n": n, "k": k, "z": z}
    return spark.createDataFrame(centers, "rank int, id long, features array<double>"), report


class _LocalSteps:
    """Greedy steps over a small set, in one process."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: (r.id, r.weight))
        self.ids = [r.id for r in rows]
        self.x = np.array([r.features for r in rows], float) if rows else np.zeros((0, 1))
        self.w = np.array([r.weight for r in rows], float)
        self.d = distances(self.x, self.x)                     # at most SMALL x SMALL

    def uncover(self) -> None:
        self.open = np.ones(len(self.x), bool)

    def heaviest(self, radius: float):
        if self.left() <= 0:
            return None
        best = int(np.argmax((self.d[:, self.open] <= radius) @ self.w[self.open]))   # the first of equals has the lowest id
        return self.ids[best], self.x[best].tolist()

    def cover(self, center: list[float], radius: float) -> None:
        self.open &= distances(self.x, np.array([center]))[:, 0] > radius

    def left(self) -> float:
        return float(self.w[self.open].sum())


class _DistributedSteps:
    """Greedy steps over any number of points: the state is (id, features, weight, open)."""

    def __init__(self, w: DataFrame):
        self.points = cut(w)
        self.index = PivotBlocks(self.points.select(F.col("id").alias("nid"), F.col("features").alias("nf")))
        self.steps = Steps(w.sparkSession)

    def uncover(self) -> None:
        self.state = self.points

    def heaviest(self, radius: float):
        if self.left() <= 0:
            return None
        weights = self.state.where("weight > 0").select(F.col("id").alias("nid"), "weight")
        found = weight_within(self.index, self.points.select(F.col("id").alias("qid"), F.col("features").alias("qf")), radius, weights)
        best = found.orderBy(F.desc("weight"), "qid").first()
        return best.qid, list(self.points.where(F.col("id") == best.qid).first().features)

    def cover(self, center: list[float], radius: float) -> None:
        d = F.sqrt(squared_euclidean(F.col("features"), _lit_vec(center)))
        self.state = self.steps.cut(self.state.where(d > radius))

    def left(self) -> float:
        return float(self.state.agg(F.sum("weight")).first()[0] or 0.0)


def mr_kcenter_outliers(points: DataFrame, k: int, z: int, buckets: int | None = None, alpha: float | None = None,
                        id_col: str = "id", feat_col: str = "features", small: int = SMALL):
    """Coresets per bucket and of buckets (round 1), weighted greedy on what is left (round 2).

    ``alpha`` is by default twice the levels of the merge tree, 2 for one level: the bound of how
    far a point lies from the one that bears its weight, in optimal radii."""
    core, levels = merged_coreset(points, k, z, buckets, id_col, feat_col, small)
    return weighted_kcenter_outliers(core, k, z, 2.0 * levels if alpha is None else alpha, small=small)


def kcenter_objective(points: DataFrame, centers: DataFrame, z: int, id_col: str = "id",
                      feat_col: str = "features") -> float | None:
    """Largest distance to the nearest centre after discarding the z
    farthest points (a distributed top-(z+1))."""
    d = assign_nearest_center(points, centers, id_col, feat_col)
    top = d.select("distance").orderBy(F.desc("distance")).limit(z + 1)
    return top.agg(F.min("distance")).first()[0]


def radius_report(points: DataFrame, k: int, z: int, alpha: float = 0.0, id_col: str = "id",
                  feat_col: str = "features") -> DataFrame:
    """Initial and final guess, number of guesses, n, k, z and objective
    of the sequential algorithm on unit weights."""
    w = points.select(F.col(id_col).alias("id"), F.col(feat_col).alias("features"), F.lit(1.0).alias("weight"))
    centers, rep = weighted_kcenter_outliers(w, k, z, alpha)
    obj = kcenter_objective(points, centers, z, id_col, feat_col)
    row = (rep["initial_guess"], rep["final_guess"], rep["n_guesses"], rep["n"], k, z, obj)
    return points.sparkSession.createDataFrame(
        [row], "initial_guess double, final_guess double, n_guesses int, n long, k int, z int, objective double")
