"""Sparse linear algebra on coordinate tables.

matrix: i, j, v (absent = 0); vector: i, v; basis: step, i, v.
Products are joins on the inner index followed by a grouped sum, combined
map-side before the shuffle on (i, j); see ``matmul`` for hub keys and dense
matrices.

Krylov methods keep the basis as a table and only the small projected matrix
(m x m, m = number of steps) on the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions.draws import hash_int, hash_keys
from meridian.plans.iterate import Steps, cut, cut_at, cut_by, delete, keep, release

CHUNK = 2048


def matvec(a: DataFrame, x: DataFrame) -> DataFrame:
    """(A x)_i = Σ_j a_ij x_j; rows of A with no matching x give 0."""
    xv = x.select(F.col("i").alias("j"), F.col("v").alias("_x"))
    return (a.join(xv, "j").groupBy("i").agg(F.sum(F.col("v") * F.col("_x")).alias("v")))


def dot(x: DataFrame, y: DataFrame) -> float:
    """X · y."""
    r = x.join(y.select("i", F.col("v").alias("_y")), "i").agg(F.sum(F.col("v") * F.col("_y"))).first()[0]
    return float(r or 0.0)


def norm(x: DataFrame) -> float:
    """‖x‖₂."""
    r = x.agg(F.sum(F.col("v") * F.col("v"))).first()[0]
    return math.sqrt(float(r or 0.0))


#: Above this share of filled entries a product is done in dense tiles.
DENSE_SHARE = 0.05
TILE = 1024


def matmul(a: DataFrame, b: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(A B)_ij = Σ_k a_ik b_kj.

    Sparse matrices are joined on k; only if some k has more than ``chunk`` entries
    on a side are such keys split, so that no task holds more than chunk² products.
    Dense ones (by their measured share of filled entries) are multiplied in tiles
    of ``TILE`` rows and columns with numpy, and the tiles summed."""
    a, b = cut(a.select("i", "j", "v")), cut(b.select("i", "j", "v"))
    left = a.select("i", F.col("j").alias("k"), F.col("v").alias("_a"))
    right = b.select(F.col("i").alias("k"), "j", F.col("v").alias("_b"))
    s = left.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("i").alias("i"), F.approx_count_distinct("k").alias("k")).first()
    t = right.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("j").alias("j")).first()
    if min(s.n, t.n) > chunk and s.n > DENSE_SHARE * s.i * s.k and t.n > DENSE_SHARE * s.k * t.j:
        return _dense_matmul(left, right, *(max(1, math.ceil(1.05 * x / TILE)) for x in (s.i, s.k, t.j)))
    sizes = left.select("k", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select("k", F.lit(0).alias("l"), F.lit(1).alias("r"))).groupBy("k").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    hubs = sizes.where((F.col("l") > chunk) | (F.col("r") > chunk))
    keys = ["k"]
    if hubs.limit(1).count():
        hubs = cut(hubs.select("k", F.ceil(F.col("l") / F.lit(chunk)).cast("int").alias("_sl"),
                               F.ceil(F.col("r") / F.lit(chunk)).cast("int").alias("_sr")))
        one = F.lit(1)
        left = (left.join(hubs, "k", "left").withColumn("p", F.pmod(hash_int("i", 7), F.coalesce("_sl", one)).cast("int"))
                .withColumn("q", F.explode(F.sequence(F.lit(0), F.coalesce("_sr", one) - 1))).drop("_sl", "_sr"))
        right = (right.join(hubs, "k", "left").withColumn("q", F.pmod(hash_int("j", 8), F.coalesce("_sr", one)).cast("int"))
                 .withColumn("p", F.explode(F.sequence(F.lit(0), F.coalesce("_sl", one) - 1))).drop("_sl", "_sr"))
        keys = ["k", "p", "q"]
    return left.join(right, keys).groupBy("i", "j").agg(F.sum(F.col("_a") * F.col("_b")).alias("v"))


def _dense_matmul(left: DataFrame, right: DataFrame, ni: int, nk: int, nj: int) -> DataFrame:
    def tile(col: str, n: int, seed: int):
        return F.pmod(hash_int(col, seed), F.lit(n)).cast("int")

    left = (left.withColumn("ib", tile("i", ni, 71)).withColumn("kb", tile("k", nk, 72))
            .withColumn("jb", F.explode(F.sequence(F.lit(0), F.lit(nj - 1)))))
    right = (right.withColumn("kb", tile("k", nk, 72)).withColumn("jb", tile("j", nj, 73))
             .withColumn("ib", F.explode(F.sequence(F.lit(0), F.lit(ni - 1)))))

    def product(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if x.empty or y.empty:
            return pd.DataFrame({"i": [], "j": [], "v": []})
        rows, r = np.unique(x["i"], return_inverse=True)
        cols, c = np.unique(y["j"], return_inverse=True)
        mid = np.union1d(x["k"], y["k"])
        m, n = np.zeros((len(rows), len(mid))), np.zeros((len(mid), len(cols)))
        np.add.at(m, (r, np.searchsorted(mid, x["k"])), x["_a"])
        np.add.at(n, (np.searchsorted(mid, y["k"]), c), y["_b"])
        reached = (m != 0).astype(np.float32) @ (n != 0).astype(np.float32)       # a sum of products may be 0 and still an entry
        p = m @ n
        at = np.nonzero(reached)
        return pd.DataFrame({"i": rows[at[0]], "j": cols[at[1]], "v": p[at]})

    parts = (left.groupBy("ib", "jb", "kb").cogroup(right.groupBy("ib", "jb", "kb"))
             .applyInPandas(product, "i long, j long, v double"))
    return parts.groupBy("i", "j").agg(F.sum("v").alias("v"))


def laplacian(adj: DataFrame) -> DataFrame:
    """L = D - A as a COO table (degree on the diagonal)."""
    deg = adj.groupBy("i").agg(F.sum("v").alias("_d"))
    off = adj.select("i", "j", (-F.col("v")).alias("v"))
    diag = deg.select("i", F.col("i").alias("j"), F.col("_d").alias("v"))
    return off.unionByName(diag).groupBy("i", "j").agg(F.sum("v").alias("v"))


def degree_matrix(adj: DataFrame) -> DataFrame:
    """D as a COO table."""
    return adj.groupBy("i").agg(F.sum("v").alias("v")).select("i", F.col("i").alias("j"), "v")


def transpose(a: DataFrame) -> DataFrame:
    return a.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def same_matrix(a: DataFrame, b: DataFrame, tol: float = 0.0) -> bool:
    """A == B entrywise (absent = 0), via a full outer join on (i, j)."""
    d = (a.select("i", "j", F.col("v").alias("_a")).join(b.select("i", "j", F.col("v").alias("_b")), ["i", "j"], "full")
         .filter(F.abs(F.coalesce("_a", F.lit(0.0)) - F.coalesce("_b", F.lit(0.0))) > F.lit(tol)))
    return d.limit(1).count() == 0


def is_symmetric(a: DataFrame, tol: float = 0.0) -> bool:
    """A == A^T."""
    return same_matrix(a, transpose(a), tol)


def _scale(x: DataFrame, s: float) -> DataFrame:
    return x.select("i", (F.col("v") * F.lit(s)).alias("v"))


def arnoldi(a: DataFrame, x: DataFrame, m: int, tol: float = 1e-13, reorthogonalize: bool = False):
    """J7 (Q16): orthonormal Krylov basis Q (step 0..k) and Hessenberg H.

    Classical Gram-Schmidt: h_ij = q_i · (A q_j) for all i <= j in one grouped
    aggregation, then w = A q_j - Σ h_ij q_i.  Stops when h_{j+1,j} < tol
    (keeping the columns built so far).  Returns (basis DataFrame, H numpy)."""
    bag: list = []
    nx0 = norm(x)
    q0 = cut(_scale(x, 1.0 / nx0).withColumn("step", F.lit(0)))
    basis = q0
    H = np.zeros((m + 1, m))
    steps = 0
    for j in range(m):
        qj = basis.filter(F.col("step") == j).select("i", "v")
        w = keep(matvec(a, qj), bag)
        passes = 2 if reorthogonalize else 1
        for _ in range(passes):
            hs = (basis.join(w.select("i", F.col("v").alias("_w")), "i")
                  .groupBy("step").agg(F.sum(F.col("v") * F.col("_w")).alias("h")).collect())
            hcol = {r.step: float(r.h) for r in hs}
            for i, h in hcol.items():
                H[i, j] += h
            coef = basis.sparkSession.createDataFrame([(int(i), h) for i, h in hcol.items()], "step int, h double")
            proj = (basis.join(F.broadcast(coef), "step").groupBy("i")
                    .agg(F.sum(F.col("v") * F.col("h")).alias("_p")))
            w = keep(w.join(proj, "i", "full").select(
                "i", (F.coalesce("v", F.lit(0.0)) - F.coalesce("_p", F.lit(0.0))).alias("v")), bag)
        hn = norm(w)
        H[j + 1, j] = hn
        steps = j + 1
        if hn < tol:
            break
        basis = basis.unionByName(cut(_scale(w, 1.0 / hn).withColumn("step", F.lit(j + 1))))   # only the new step
        release(bag)
    release(bag)
    return basis, H[:steps + 1, :steps]


def ritz_values(H: np.ndarray, spark) -> DataFrame:
    """Eigenvalues of the leading m x m block of H for every m."""
    rows = []
    for mm in range(1, H.shape[1] + 1):
        ev = np.linalg.eigvals(H[:mm, :mm])
        for e in sorted(ev, key=lambda z: (z.real, z.imag)):
            rows.append((mm, float(e.real), float(e.imag)))
    return spark.createDataFrame(rows, "m int, re double, im double")


def lanczos(a: DataFrame, x: DataFrame, m: int, tol: float = 1e-13):
    """Three-term recurrence for symmetric A.  Returns (basis, alpha, beta)."""
    bag: list = []
    nx0 = norm(x)
    q = cut(_scale(x, 1.0 / nx0))
    basis = q.withColumn("step", F.lit(0))
    q_prev = None
    alphas, betas = [], []
    beta = 0.0
    for j in range(m):
        w = matvec(a, q)
        al = dot(w, q)
        alphas.append(al)
        w = w.join(q.select("i", F.col("v").alias("_q")), "i", "full").select(
            "i", (F.coalesce("v", F.lit(0.0)) - F.lit(al) * F.coalesce("_q", F.lit(0.0))).alias("v"))
        if q_prev is not None:
            w = w.join(q_prev.select("i", F.col("v").alias("_qp")), "i", "full").select(
                "i", (F.coalesce("v", F.lit(0.0)) - F.lit(beta) * F.coalesce("_qp", F.lit(0.0))).alias("v"))
        w = keep(w, bag)
        beta = norm(w)
        if j == m - 1 or beta < tol:
            break
        betas.append(beta)
        q_prev, q = q, cut(_scale(w, 1.0 / beta))
        basis = basis.unionByName(q.withColumn("step", F.lit(j + 1)))
    release(bag)
    return basis, np.array(alphas), np.array(betas)


def tridiagonal(alphas: np.ndarray, betas: np.ndarray) -> np.ndarray:
    k = len(alphas)
    T = np.diag(alphas)
    for i in range(min(k - 1, len(betas))):
        T[i, i + 1] = T[i + 1, i] = betas[i]
    return T


def ritz_convergence(ritz: DataFrame, target: float) -> DataFrame:
    """|rightmost Ritz value - target| per m."""
    return (ritz.groupBy("m").agg(F.max("re").alias("rightmost"))
            .withColumn("error", F.abs(F.col("rightmost") - F.lit(float(target)))))


def orthogonality_loss(basis: DataFrame) -> DataFrame:
    """For every m, ‖Q_m^T Q_m - I‖∞ (largest absolute row sum).

    Gram entries come from one self-join of the basis on the row index i; the
    number of basis vectors is the (small) number of steps."""
    a = basis.select(F.col("step").alias("s1"), "i", F.col("v").alias("_a"))
    b = basis.select(F.col("step").alias("s2"), "i", F.col("v").alias("_b"))
    g = a.join(b, "i").groupBy("s1", "s2").agg(F.sum(F.col("_a") * F.col("_b")).alias("g"))
    g = g.withColumn("e", F.abs(F.col("g") - F.when(F.col("s1") == F.col("s2"), 1.0).otherwise(0.0)))
    steps = [r[0] for r in basis.select("step").distinct().orderBy("step").collect()]
    spark = basis.sparkSession
    ms = spark.createDataFrame([(int(s) + 1,) for s in steps], "m int")
    rows = (g.join(F.broadcast(ms), (F.col("s1") < F.col("m")) & (F.col("s2") < F.col("m")))
            .groupBy("m", "s1").agg(F.sum("e").alias("row_sum")))
    return rows.groupBy("m").agg(F.max("row_sum").alias("loss"))


def spectral_norm(a: DataFrame, tol: float = 1e-6) -> float:
    """‖A‖₂ = |λ|max of a symmetric matrix: the Ritz value of largest magnitude,
    converged to a residual (its own error is of the order of the residual squared)."""
    vals, _, _ = block_krylov_eigs(a, 1, block=3, which="magnitude", tol=tol)
    return abs(vals[0]) if vals else 0.0


#: Numbers of a block of vectors that a broadcast may hold; larger blocks meet the matrix bucketed by column.
SENT = 1 << 21
#: Blocks of one Krylov space, unless the caller wants another number.
STEPS = 24


def _numbers(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    """A column of arrays as a matrix (rows x width)."""
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)


def _arrays(m: np.ndarray) -> pa.ListArray:
    ends = pa.array(np.arange(0, m.size + 1, max(1, m.shape[1]), dtype=np.int32)[:len(m) + 1] if m.shape[1] else np.zeros(len(m) + 1, np.int32))
    return pa.ListArray.from_arrays(ends, pa.array(m.ravel()))


def _less(q: np.ndarray, w: np.ndarray, passes: list) -> np.ndarray:
    """w without its parts along q, by the passes so far: (coefficients, what the columns are multiplied by)."""
    for c, t in passes:
        w = (w - q @ c) @ t
    return w


def _grams(state: DataFrame, nq: int, nw: int, passes: list) -> np.ndarray | None:
    """[Q W]^T W over all rows of (i, q, w), W after ``passes``; None without rows.  Each task sends one small matrix."""
    def part(batches):
        g = None
        for batch in batches:
            q = _numbers(batch, "q", nq)
            w = _less(q, _numbers(batch, "w", nw), passes)
            own = np.concatenate((q, w), axis=1).T @ w
            g = own if g is None else g + own
        if g is not None:
            yield pa.RecordBatch.from_pydict({"cols": pa.array([g.shape[1]], pa.int32()), "g": _arrays(g.reshape(1, -1))})

    parts = state.mapInArrow(part, "cols int, g array<double>").collect()
    return sum(np.array(r.g).reshape(-1, r.cols) for r in parts) if parts else None


def _orthonormal(state: DataFrame, nq: int, nw: int):
    """Passes that make W orthonormal and orthogonal to Q, with C = Q^T W and B: W = Q C + (new columns) B."""
    c = np.zeros((nq, nw))
    g = _grams(state, nq, nw, [])
    if g is None:
        return None
    scale = max(np.trace(g[nq:]), 1e-300)
    c, passes = g[:nq], [(g[:nq], np.eye(nw))]
    left = np.eye(nw)
    for _ in range(2):                           # twice is enough (Giraud et al.)
        g = _grams(state, nq, nw, passes)
        d, own = g[:nq], g[nq:] - g[:nq].T @ g[:nq]
        vals, vecs = np.linalg.eigh((own + own.T) / 2)
        good = vals > max(1e-24 * scale, 1e-14 * vals.max(initial=0.0))
        if not good.any():
            return passes, c, np.zeros((0, nw))
        c = c + d @ left
        passes.append((d, vecs[:, good] / np.sqrt(vals[good])))
        left = (np.sqrt(vals[good])[:, None] * vecs[:, good].T) @ left
        scale = 1.0
    return passes, c, left


def _rows(state: DataFrame, nq: int, nw: int, passes: list, turn: np.ndarray | None = None) -> DataFrame:
    """(i, q): the columns of Q (times ``turn``, if given) and behind them those of W after ``passes``."""
    def rows(batches):
        for batch in batches:
            q = _numbers(batch, "q", nq)
            w = _less(q, _numbers(batch, "w", nw), passes)
            yield pa.RecordBatch.from_arrays([batch.column("i"), _arrays(np.concatenate((q if turn is None else q @ turn, w), axis=1))], ["i", "q"])

    return state.mapInArrow(rows, "i long, q array<double>")


def _multiplied(a: DataFrame, x: DataFrame, first: int, last: int, small: bool) -> DataFrame:
    """(i, q, w) with w = A times the columns ``first`` to ``last`` of q, in one join and one grouped sum."""
    at = range(first, last)
    xv = x.select(F.col("i").alias("j"), *[F.col("q")[c].alias(f"x{c}") for c in at])
    y = (a.join(F.broadcast(xv) if small else xv, "j").groupBy("i")
         .agg(*[F.sum(F.col("v") * F.col(f"x{c}")).alias(f"y{c}") for c in at]))
    return x.join(y, "i", "left").select("i", "q", F.array(*[F.coalesce(f"y{c}", F.lit(0.0)) for c in at]).alias("w"))


def block_krylov_eigs(a: DataFrame, k: int, block: int | None = None, steps: int = STEPS, seed: int = 31,
                      which: str = "smallest", tol: float = 1e-6, restarts: int = 40):
    """Eigenpairs of a symmetric matrix from the block Krylov space
    span{X, AX, ..., A^s X} (X: ``block`` hash-random columns), with each new
    block orthogonalised against the basis and within itself.  A block
    of at least the eigenvalue multiplicity resolves repeated eigenvalues,
    which a single-vector Lanczos run cannot.

    The basis is one row a matrix row (i, all columns), so a block costs one product, written
    with the basis, and three sums of small matrices; the projected matrix comes from the same sums, and
    with it the residual of every pair.  A space of ``steps`` blocks is restarted from the best half of its
    vectors and the newest block (thick restart), until every wanted pair's residual
    ‖A v - λ v‖ is at most ``tol`` (times |λ| above one), which is then measured; an error is raised if that takes more than
    ``restarts`` restarts.  Returns (values list, vectors DataFrame [pos, i, v],
    residual); only the small projected matrices live on the driver."""
    spark = a.sparkSession
    b = block or max(2, k + 2)
    a, whole = cut_at(a.select("i", "j", "v"))
    rows_i = a.select("i").union(a.select(F.col("j").alias("i"))).where("i is not null").distinct()
    states = Steps(spark)
    state = states.cut(rows_i.select("i", F.array().cast("array<double>").alias("q"), F.array(
        *[hash_keys(["i", F.lit(c)], seed) / F.lit(2147483648.0) - 0.5 for c in range(b)]).alias("w")))
    small = state.count() * b <= SENT
    # a broadcast block meets whole rows of the matrix, whose sums are not shuffled
    a = cut_by(a, "i" if small else "j")
    delete(spark, whole)
    H, nq, nw, fresh, began = np.zeros((0, 0)), 0, b, 0, 0
    residual = math.inf
    while True:
        found = _orthonormal(state, nq, nw)
        if found is None:
            return [], spark.createDataFrame([], "pos int, i long, v double"), 0.0
        passes, c, left = found
        turn = None
        if nq:                                   # the newest columns of Q^T A Q
            H[:, fresh:], H[fresh:] = c, c.T
            vals, vecs = np.linalg.eigh((H + H.T) / 2)
            order = np.argsort({"smallest": vals, "largest": -vals, "magnitude": -np.abs(vals)}[which], kind="stable")
            best = order[:k]
            bound = tol * max(1.0, *np.abs(vals[best]))
            guess = np.sqrt(((left @ vecs[fresh:, best]) ** 2).sum(axis=0)).max() if len(left) else 0.0
            if guess <= bound / 2 or not len(left):
                vec = _multiplied(a, cut(_rows(state, nq, nw, [(np.zeros((nq, nw)), np.zeros((nw, 0)))], vecs[:, best])), 0, len(best), small)
                vec = cut(vec)
                lam = F.array(*[F.lit(float(x)) for x in vals[best]])
                off = F.zip_with("w", F.zip_with("q", lam, lambda x, y: x * y), lambda x, y: (x - y) * (x - y))
                squares = vec.select(off.alias("d")).agg(*[F.sum(F.col("d")[p]) for p in range(len(best))]).first()
                residual = math.sqrt(max(squares))
                if residual <= bound:
                    return [float(x) for x in vals[best]], vec.select(F.posexplode("q").alias("pos", "v"), "i").select("pos", "i", "v"), residual
            if not len(left) or began >= restarts:
                raise RuntimeError(f"residual {residual if residual < math.inf else guess:.2e} above {tol:.0e} after {began} restarts")
            if nq + len(left) > b * (steps + 1):
                kept = order[:max(k + b, b * (steps + 1) // 2)]
                turn, H, began = vecs[:, kept], np.diag(vals[kept]), began + 1
        elif not len(left):
            return [], spark.createDataFrame([], "pos int, i long, v double"), 0.0
        x = _rows(state, nq, nw, passes, turn)
        fresh = nq if turn is None else turn.shape[1]
        nq, nw = fresh + len(left), len(left)
        H = np.pad(H, (0, nw))
        state = states.cut(_multiplied(a, x, fresh, nq, small))


def smallest_eigenpairs(lap: DataFrame, k: int, steps: int | None = None, block: int | None = None, tol: float = 1e-6):
    """The k smallest eigenpairs of a symmetric matrix (e.g. a Laplacian).
    Returns (values, vectors DataFrame [pos, i, v], residual)."""
    return block_krylov_eigs(lap, k, block=block, steps=steps or STEPS, tol=tol)
