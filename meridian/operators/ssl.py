"""Graph-based semi-supervised labelling with gradient methods.

Loss (labels ȳ_i on the labelled set L, unknowns y_j on U):
    f(y) = Σ_{i∈L, j∈U} w_ij (y_j - ȳ_i)^2 + ½ Σ_{i,j∈U} w̄_ij (y_i - y_j)^2
    ∂_j f = 2 [ y_j (S_j + S̄_j) - Σ_i ȳ_i w_ij - Σ_i w̄_ji y_i ]
with S_j = Σ_{i∈L} w_ij and S̄_j = Σ_{i∈U} w̄_ij.

A single sum over W or W̄ is a blocked kernel pass (``kernel_sums``): both point sets
are hashed into blocks, each (block, block) pair is one ``cogroup`` task computing its
kernel with numpy, a tile at a time, and emitting one partial sum per query row; the partials are
summed per row.  Up to ``SPLITS`` blocks a side are small ones; beyond, blocks grow to ``LARGE``
rows first, so that a vector is shuffled at most ``SPLITS`` times up to SPLITS * LARGE rows.  What needs many products with W̄ stores its tiles once
(``kernel.KernelTiles``): the solvers are programs over them, in which every method
and start is one column of a product, so all of them run in one go, each round
costs one product, and a block step multiplies only its block's tiles.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions.draws import hash_int, hash_uniform
from meridian.operators import relational as R
from meridian.operators.kernel import KernelTiles, Span, kernel, largest_eigenvalue
from meridian.operators.vectors import knn_join
from meridian.plans.iterate import cut

TILE = 2048
#: Blocks of a side before they grow, and rows to which they grow.
SPLITS, LARGE = 8, 65_536
#: Rows and columns of a kernel tile that a task computes at a time.
STEP = 512
#: Shares of a gradient's norm, and of the tolerance, that may wait to be multiplied.
SLACK, SLACK_OF_TOL = 1e-10, 0.02
#: Draw of the coordinate blocks (Q20).
BLOCK_SEED = 51


def prepare_census(df: DataFrame, cat_cols: list[str], num_cols: list[str], target: str,
                   positive, order_col: str, first_n: int | None = None) -> DataFrame:
    """(first n rows ->) drop missing -> recode target -> one-hot -> vector.
    Returns id, features (numeric columns, then one-hot columns by sorted
    category value), y."""
    t = R.drop_null_rows(df if first_n is None else R.first_n_rows(df, first_n, order_col))
    t = R.recode_labels(t, target, positive, "y")
    before = set(t.columns)
    t = R.one_hot(t, cat_cols)
    hot = [c for c in t.columns if c not in before]
    hot_sorted = []
    for c in cat_cols:
        hot_sorted += sorted([h for h in hot if h.startswith(c + "_")])
    t = R.feature_vector(t, num_cols + hot_sorted)
    return t.select(F.col(order_col).alias("id"), "features", "y")


def kernel_sums(queries: DataFrame, base: DataFrame, weights: list[str], sigma: float = 1.0,
                squared: bool = False, tile: int = TILE) -> DataFrame:
    """id, s_<w> = Σ_b k(q, b) * b.<w> for every query row (``'one'`` = 1).

    k = exp(-0.5 * d / sigma^2), d the Euclidean distance (or its square with
    ``squared=True``).  ``queries``: id, features; ``base``: id, features and
    the weight columns."""
    nq, nb = queries.count(), base.count()
    bq, bb = (max(1, min(math.ceil(x / tile), SPLITS), math.ceil(x / LARGE)) for x in (nq, nb))
    wcols = [w for w in weights if w != "one"]
    q = (queries.select(F.col("id").alias("qid"), F.col("features").alias("qf"),
                        F.pmod(hash_int("id", 41), F.lit(bq)).cast("int").alias("qb"))
         .withColumn("nb", F.explode(F.sequence(F.lit(0), F.lit(bb - 1)))))
    b = (base.select(F.col("id").alias("nid"), F.col("features").alias("nf"),
                     *[F.col(w).cast("double").alias(w) for w in wcols],
                     F.pmod(hash_int("id", 42), F.lit(bb)).cast("int").alias("nb"))
         .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(bq - 1)))))
    out_cols = [f"s_{w}" for w in weights]

    def tile_sums(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            return pd.DataFrame({"qid": [], **{c: [] for c in out_cols}})
        A = np.stack(left["qf"].to_numpy())
        res = {c: np.zeros(len(left)) for c in out_cols}
        if not right.empty:
            B = np.stack(right["nf"].to_numpy())
            W = np.stack([np.ones(len(right)) if w == "one" else right[w].to_numpy(dtype=float)
                          for w in weights], axis=1)
            S = np.zeros((len(A), len(weights)))
            for at in range(0, len(A), STEP):
                for to in range(0, len(B), STEP):
                    S[at:at + STEP] += kernel(A[at:at + STEP], B[to:to + STEP], sigma, squared) @ W[to:to + STEP]
            for k, c in enumerate(out_cols):
                res[c] = S[:, k]
        return pd.DataFrame({"qid": left["qid"].to_numpy(), **res})

    schema = "qid long, " + ", ".join(f"{c} double" for c in out_cols)
    part = (q.groupBy("qb", "nb").cogroup(b.groupBy("qb", "nb")).applyInPandas(tile_sums, schema))
    return part.groupBy(F.col("qid").alias("id")).agg(*[F.sum(c).alias(c) for c in out_cols])


def similarity_totals(lp: DataFrame, sigma: float = 1.0, squared: bool = False) -> DataFrame:
    """K3 (+ the label term): id, S, S_bar, B = Σ_i ȳ_i w_ij over unlabelled rows."""
    lab = lp.filter("is_labeled").select("id", "features", F.col("label").alias("ybar"))
    unl = lp.filter(~F.col("is_labeled")).select("id", "features")
    a = kernel_sums(unl, lab, ["one", "ybar"], sigma, squared).select(
        "id", F.col("s_one").alias("S"), F.col("s_ybar").alias("B"))
    b = kernel_sums(unl, unl, ["one"], sigma, squared).select("id", F.col("s_one").alias("S_bar"))
    return unl.select("id").join(a, "id", "left").join(b, "id", "left").select(
        "id", F.coalesce("S", F.lit(0.0)).alias("S"), F.coalesce("S_bar", F.lit(0.0)).alias("S_bar"),
        F.coalesce("B", F.lit(0.0)).alias("B"))


def lipschitz_coordinates(totals: DataFrame) -> DataFrame:
    """K4: L_j = 2 (S_j + S̄_j - w̄_jj) with w̄_jj = 1; step 1/L_j."""
    return totals.select("id", (F.lit(2.0) * (F.col("S") + F.col("S_bar") - F.lit(1.0))).alias("L_j")) \
        .withColumn("step", F.when(F.col("L_j") > 0, F.lit(1.0) / F.col("L_j")))


def gradient(lp: DataFrame, totals: DataFrame, y: DataFrame, sigma: float = 1.0, squared: bool = False,
             rows: DataFrame | None = None, tiles: KernelTiles | None = None) -> DataFrame:
    """K5: id, grad for every unlabelled row (or only ``rows``: id).  With the stored
    ``tiles`` of the unlabelled rows no kernel is computed again."""
    unl = lp.filter(~F.col("is_labeled")).select("id", "features")
    qs = unl if rows is None else unl.join(rows.select("id"), "id", "left_semi")
    if tiles is None:
        c = kernel_sums(qs, unl.join(y, "id"), ["y"], sigma, squared).select("id", F.col("s_y").alias("C"))
    else:
        value = {r.id: r.y for r in y.collect()}              # at most kernel.MOST_POINTS rows
        sums = tiles.product(np.array([[value[i]] for i in tiles.ids.tolist()]))
        c = lp.sparkSession.createDataFrame(list(zip(tiles.ids.tolist(), sums[:, 0].tolist(), strict=True)), "id long, C double")
    return (qs.select("id").join(totals, "id").join(y, "id").join(c, "id", "left")
            .select("id", (F.lit(2.0) * (F.col("y") * (F.col("S") + F.col("S_bar")) - F.col("B")
                                         - F.coalesce("C", F.lit(0.0)))).alias("grad")))


def knn_start(lp: DataFrame, k: int = 4) -> DataFrame:
    """K6: majority label among the k nearest labelled rows; ties -> lower label."""
    lab = lp.filter("is_labeled").select("id", "features")
    unl = lp.filter(~F.col("is_labeled")).select("id", "features")
    nn = knn_join(unl, lab, k).join(lp.select(F.col("id").alias("nid"), "label"), "nid")
    votes = nn.groupBy("qid", "label").agg(F.count(F.lit(1)).alias("n"))
    best = R.topk_per_key(votes.withColumn("_neg", -F.col("label")), "qid", "n", 1, item="label")
    return best.select(F.col("qid").alias("id"), F.col("label").cast("double").alias("y"))


def random_start(lp: DataFrame, seed: int = 7) -> DataFrame:
    """K7: uniform in [-1, 1] from a hash of the id."""
    return lp.filter(~F.col("is_labeled")).select("id", (F.lit(2.0) * hash_uniform("id", seed) - 1).alias("y"))


def label_accuracy(y: DataFrame, lp: DataFrame) -> DataFrame:
    """Share of unlabelled rows whose sign (y >= 0 -> +1) equals the truth."""
    pred = F.when(F.col("y") >= 0, 1).otherwise(-1)
    return (y.join(lp.select("id", "y_true"), "id")
            .agg(F.avg(F.when(pred == F.col("y_true"), 1.0).otherwise(0.0)).alias("accuracy")))


def lipschitz_bound(totals: DataFrame) -> float:
    """K4: an upper bound of L = 2 ‖diag(S + S̄) - W̄‖₂ from the row sums alone
    (S_j + 2 (S̄_j - 1) bounds every eigenvalue), so that 1/L is a safe step."""
    return 2.0 * float(totals.agg(F.max(F.col("S") + 2 * (F.col("S_bar") - 1))).first()[0] or 0.0)


METHODS = ("gd", "gd_nesterov", "bcgd_cyclic", "bcgd_random_uniform", "bcgd_random_lipschitz", "bcgd_gauss_southwell")
STARTS = ("random", "knn")
SOLVED = "method string, start string, iteration int, grad_norm double, accuracy double, id long, y double"


@dataclass
class Problem:
    """The unlabelled rows in the order of their tiles: one number a row and column."""

    tiles: KernelTiles
    S: np.ndarray
    B: np.ndarray
    truth: np.ndarray
    start: dict[str, np.ndarray]


def problem(lp: DataFrame, n_blocks: int = 4, k: int = 4, sigma: float = 1.0, squared: bool = False,
            starts: tuple[str, ...] = STARTS) -> Problem:
    """K1-K7 put together: stored tiles of W̄ by coordinate block (Q20), label sums, starts."""
    unl = lp.filter(~F.col("is_labeled")).select("id", "features")
    block = F.pmod(hash_int("id", BLOCK_SEED), F.lit(n_blocks)).cast("int")
    tiles = KernelTiles(unl, sigma, squared, block, n_blocks)
    lab = lp.filter("is_labeled").select("id", "features", F.col("label").alias("ybar"))
    rows = lp.filter(~F.col("is_labeled")).select("id", "y_true").join(
        kernel_sums(unl, lab, ["one", "ybar"], sigma, squared), "id", "left")
    for s in starts:
        rows = rows.join((random_start(lp) if s == "random" else knn_start(lp, k)).select("id", F.col("y").alias(f"y_{s}")), "id", "left")
    found = {r.id: r for r in rows.collect()}                 # as many rows as the tiles allow
    column = lambda c: np.array([found[i][c] or 0.0 for i in tiles.ids.tolist()], float)
    return Problem(tiles, column("s_one"), column("s_ybar"), column("y_true"), {s: column(f"y_{s}") for s in starts})


def descent(S, B, truth, group, group_first, columns: list[tuple[str, str]], start: dict, rounds: int, tol: float, seed: int = 3):
    """K8-K13 as one program: every (method, start) is a column, with a step a round.

    gd (Q18): y <- y - ∇f / L.  gd_nesterov (Q19): the same from the extrapolated point, with the
    momentum λ_{k+1} = (1 + sqrt(1 + 4 λ_k^2)) / 2.  bcgd_*: only one block's coordinates move, by the
    block's own step; the block is the next in turn, drawn uniformly or with probability ∝ its L, or the one with
    the largest gradient norm.  A column ends when ‖∇f‖ <= tol, or after ``rounds``.

    The steps soon lie in few directions of each block, whose products a ``Span`` knows.  What it leaves
    waiting changes no gradient by more than ``SLACK`` of its norm (or of ``tol``, if that is more);
    before a column ends nothing waits."""
    n, m = len(S), len(columns)
    blocks = len(group_first) - 1
    sums = yield (group[:, None] == np.arange(blocks)).astype(float)
    total = S + sums.sum(axis=1)
    L = 2 * (yield from largest_eigenvalue(total))
    bound = 2 * (total - 1) + 2 * (sums[np.arange(n), group] - 1)
    own = [slice(group_first[b], group_first[b + 1]) for b in range(blocks)]
    steps = [float(bound[o].max()) if o.stop > o.start else 0.0 for o in own]

    def pick(rule: str, r: int, g: np.ndarray) -> int:
        if rule == "bcgd_cyclic":
            return r % blocks
        if rule == "bcgd_random_uniform":
            return int(_u(r, seed) * blocks) % blocks
        if rule == "bcgd_random_lipschitz":
            return min(int(np.searchsorted(np.cumsum(steps), _u(r, seed) * sum(steps), side="right")), blocks - 1)
        return int(np.argmax([(g[o] ** 2).sum() for o in own]))

    y = np.stack([start[s] for _, s in columns])                  # a row for each column of the program
    c = (yield y.T).T
    before, momentum, live, rows = y.copy(), np.ones(m), list(range(m)), []
    span = Span(n, m, own, float(sums.sum(axis=1).max(initial=0.0)))
    for r in range(rounds + 1):
        g = 2 * (y[live] * total - B - c[live])
        norm = np.sqrt((g * g).sum(axis=1))
        last = [k for k, size in zip(live, norm, strict=True) if size <= tol and span.size[k].any()]
        if last:
            c = c + (yield from span.product(np.zeros_like(y), np.where(np.isin(np.arange(m), last), 0.0, math.inf)))
            g = 2 * (y[live] * total - B - c[live])
            norm = np.sqrt((g * g).sum(axis=1))
        right = (np.where(y[live] >= 0, 1, -1) == truth).mean(axis=1) if n else np.ones(len(live))
        rows += [(*columns[k], r, float(norm[at]), float(right[at]), None, None) for at, k in enumerate(live)]
        down = {k: (g[at], norm[at]) for at, k in enumerate(live) if norm[at] > tol}
        live = list(down)
        if not live or r == rounds:
            break
        step, allowed = np.zeros_like(y), np.zeros(m)
        for k, (of, size) in down.items():
            method, allowed[k] = columns[k][0], max(SLACK * size, SLACK_OF_TOL * tol) / 2
            if method == "gd":
                step[k] = -of / L
            elif method == "gd_nesterov":
                x = y[k] - of / L
                then = (1 + math.sqrt(1 + 4 * momentum[k] ** 2)) / 2
                step[k] = x + (momentum[k] - 1) / then * (x - before[k]) - y[k]
                before[k], momentum[k] = x, then
            else:
                b = pick(method, r, of)
                if steps[b] > 0:
                    step[k, own[b]] = -of[own[b]] / steps[b]
        y = y + step
        c = c + (yield from span.product(step, allowed))
    return rows, y.T


def solve(p: Problem, columns: list[tuple[str, str]], rounds: int = 10_000, tol: float = 1e-8, tasks: int | None = None) -> DataFrame:
    """Histories and solutions of all ``columns`` (method, start) in one table: rows with an
    iteration have its grad_norm and accuracy, rows with an id the column's last y."""
    group, first, ids = p.tiles.group, p.tiles.group_first, p.tiles.ids
    S, B, truth, start = p.S, p.B, p.truth, p.start

    def program():
        rows, y = yield from descent(S, B, truth, group, first, columns, start, rounds, tol)
        return rows + [(*columns[k], None, None, None, int(i), float(v)) for k in range(len(columns)) for i, v in zip(ids, y[:, k], strict=True)]

    return p.tiles.run(program, SOLVED, tasks)


def solution(lp: DataFrame, method: str, start: str, n_blocks: int = 4, k: int = 4, sigma: float = 1.0, rounds: int = 10_000,
             tol: float = 1e-8) -> DataFrame:
    """Id, y where the method ends."""
    found = solve(problem(lp, n_blocks, k, sigma, starts=(start,)), [(method, start)], rounds, tol)
    return found.where("id is not null").select("id", "y")


def training_history(lp: DataFrame, columns: list[tuple[str, str]] | None = None, n_blocks: int = 4, k: int = 4, sigma: float = 1.0,
                     rounds: int = 10_000, tol: float = 1e-8) -> DataFrame:
    """Method, start, iteration, grad_norm, accuracy of every round, by default of all
    six methods from both starts."""
    columns = columns or [(m, s) for s in STARTS for m in METHODS]
    found = solve(problem(lp, n_blocks, k, sigma, starts=tuple(sorted({s for _, s in columns}))), columns, rounds, tol)
    return found.where("iteration is not null").select("method", "start", "iteration", "grad_norm", "accuracy")


def method_comparison_ssl(lp: DataFrame, n_blocks: int = 4, k: int = 4, sigma: float = 1.0, rounds: int = 10_000,
                          tol: float = 1e-8) -> DataFrame:
    """All six methods from both starts: method, start, rounds, grad_norm, accuracy, converged."""
    h = training_history(lp, None, n_blocks, k, sigma, rounds, tol)
    last = F.max(F.struct("iteration", "grad_norm", "accuracy"))
    return h.groupBy("method", "start").agg(last.alias("z")).select(
        "method", "start", F.col("z.iteration").alias("rounds"), "z.grad_norm", "z.accuracy", (F.col("z.grad_norm") <= tol).alias("converged"))


def lipschitz_constant(lp: DataFrame, sigma: float = 1.0, squared: bool = False, tol: float = 1e-9) -> DataFrame:
    """K4: L = 2 ‖diag(S + S̄) - W̄‖₂ (the matrix is diagonally dominant, so its norm is its
    largest eigenvalue), by Lanczos steps over the stored tiles."""
    p = problem(lp, 1, 1, sigma, squared, starts=())
    S = p.S

    def program():
        sums = yield np.ones((len(S), 1))
        value = yield from largest_eigenvalue(S + sums[:, 0], tol)
        return [(2 * value,)]

    return p.tiles.run(program, "L double")


def _u(r: int, seed: int) -> float:
    """Deterministic uniform draw for round r (same integer hash as the columns)."""
    h = ((r + seed * 7919) * 1103515245 + 12345) % 2147483648
    h ^= h >> 13
    h = (h * 1103515245 + 12345) % 2147483648
    h ^= h >> 16
    return h / 2147483648.0


def similarity_edges_knn(lp: DataFrame, k: int, sigma: float = 1.0, squared: bool = False) -> DataFrame:
    """K2 (sparsified): for every unlabelled row its k most similar unlabelled
    rows (itself included, w̄_jj = 1) with the kernel value - n k rows instead
    of the dense n^2 matrix."""
    unl = lp.filter(~F.col("is_labeled")).select("id", "features")
    nn = knn_join(unl, unl, k)
    d = F.col("distance") * F.col("distance") if squared else F.col("distance")
    return nn.select(F.col("qid").alias("i"), F.col("nid").alias("j"),
                     F.exp(F.lit(-0.5) * d / F.lit(sigma * sigma)).alias("w"))
