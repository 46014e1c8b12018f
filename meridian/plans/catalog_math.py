"""Registered sparse linear algebra and semi-supervised learning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.functions.draws import hash_uniform, sql_hash_uniform
from meridian.operators import linalg as LA
from meridian.operators import ssl as S
from meridian.operators.graph import build as GB
from meridian.plans import oracle as O
from meridian.plans.catalog import query, rnd
from meridian.plans.iterate import cut
from meridian.sources import testdata as T

KRYLOV_STEPS = 8
EIGENPAIRS = 6           # the reference's first six (SPEC:108-111)
SIGMA = 1.0
KNN_START_K = 4
N_BLOCKS = 4
CG_STEPS = 30            # of the SQL

# ------------------------------------------------------------ matrices from the dense supplier graph

O.cte("mat_a", "SELECT src AS i, dst AS j, CAST(weight AS DOUBLE) AS v FROM sym_supp", ["sym_supp"])
O.cte("mat_l", """
SELECT i, j, sum(v) AS v FROM (
  SELECT i, j, -v AS v FROM mat_a
  UNION ALL SELECT i, i AS j, sum(v) AS v FROM mat_a GROUP BY i) GROUP BY i, j""", ["mat_a"])
O.cte("vec_x", f"SELECT DISTINCT i, {sql_hash_uniform('i', 5)} AS v FROM mat_a", ["mat_a"])


def _a(spark, d):
    e = GB.build_graph(T.links(spark, d, "supp"))
    return GB.symmetric(e).select(F.col("src").alias("i"), F.col("dst").alias("j"),
                                  F.col("weight").cast("double").alias("v"))


def _x(a):
    return a.select("i").distinct().select("i", hash_uniform("i", 5).alias("v"))


@query("laplacian", "SELECT i, j, round(v, 6) AS v FROM mat_l", ("mat_l",))
def q_laplacian(spark, d):
    return LA.laplacian(_a(spark, d)).withColumn("v", rnd("v"))


@query("degree_matrix", "SELECT i, i AS j, sum(v) AS v FROM mat_a GROUP BY i", ("mat_a",))
def q_degree_matrix(spark, d):
    return LA.degree_matrix(_a(spark, d))


@query("matvec", """
SELECT l.i, round(sum(l.v * x.v), 6) AS v FROM mat_l l JOIN vec_x x ON l.j = x.i GROUP BY l.i""",
       ("mat_l", "vec_x"))
def q_matvec(spark, d):
    a = cut(_a(spark, d))
    return LA.matvec(LA.laplacian(a), _x(a)).withColumn("v", rnd("v"))


@query("dot_norm", """
WITH lx AS (SELECT l.i, sum(l.v * x.v) AS v FROM mat_l l JOIN vec_x x ON l.j = x.i GROUP BY l.i)
SELECT round((SELECT sum(lx.v * x.v) FROM lx JOIN vec_x x ON lx.i = x.i), 6) AS dot,
       round((SELECT sqrt(sum(v * v)) FROM vec_x), 6) AS norm""", ("mat_l", "vec_x"))
def q_dot_norm(spark, d):
    a = _a(spark, d)
    x = cut(_x(a))
    lx = LA.matvec(LA.laplacian(a), x)
    return spark.createDataFrame([(round(LA.dot(lx, x), 6), round(LA.norm(x), 6))], "dot double, norm double")


@query("matmul", """
SELECT a.i, b.j, round(sum(a.v * b.v), 6) AS v FROM mat_a a JOIN mat_a b ON a.j = b.i GROUP BY a.i, b.j""",
       ("mat_a",))
def q_matmul(spark, d):
    a = _a(spark, d)
    return LA.matmul(a, a).withColumn("v", rnd("v"))


@query("is_symmetric", """
SELECT NOT EXISTS (SELECT i, j, v FROM mat_l EXCEPT SELECT j, i, v FROM mat_l) AS is_symmetric,
       NOT EXISTS (SELECT i, j, v FROM mat_a EXCEPT SELECT j, i, v FROM mat_a) AS adjacency_symmetric""",
       ("mat_l", "mat_a"))
def q_symmetric(spark, d):
    a = _a(spark, d)
    return spark.createDataFrame([(LA.is_symmetric(LA.laplacian(a)), LA.is_symmetric(a))],
                                 "is_symmetric boolean, adjacency_symmetric boolean")


def _krylov_inputs(spark, d):
    a = cut(_a(spark, d))
    lap = cut(LA.laplacian(a))
    return lap, cut(_x(a))


def _arnoldi_sql(steps: int) -> str:
    """Classical Gram-Schmidt, unrolled; ends in hs(row, col, h)."""
    parts = ["q0 AS MATERIALIZED (SELECT i, v / (SELECT sqrt(sum(v * v)) FROM vec_x) AS v, 0 AS step FROM vec_x)",
             "b0 AS MATERIALIZED (SELECT * FROM q0)"]
    hs = []
    for j in range(steps):
        parts += [
            f"w{j} AS MATERIALIZED (SELECT l.i, sum(l.v * q.v) AS v FROM mat_l l JOIN q{j} q ON l.j = q.i GROUP BY l.i)",
            f"h{j} AS MATERIALIZED (SELECT b.step, sum(b.v * w.v) AS h FROM b{j} b JOIN w{j} w ON b.i = w.i GROUP BY b.step)",
            f"r{j} AS MATERIALIZED (SELECT w.i, w.v - p.v AS v FROM w{j} w JOIN (SELECT b.i, sum(b.v * h.h) AS v "
            f"FROM b{j} b JOIN h{j} h ON b.step = h.step GROUP BY b.i) p ON w.i = p.i)",
            f"n{j} AS MATERIALIZED (SELECT sqrt(sum(v * v)) AS h FROM r{j})",
            f"q{j + 1} AS MATERIALIZED (SELECT i, v / (SELECT h FROM n{j}) AS v, {j + 1} AS step FROM r{j})",
            f"b{j + 1} AS MATERIALIZED (SELECT * FROM b{j} UNION ALL SELECT * FROM q{j + 1})"]
        hs += [f"SELECT step AS row, {j} AS col, h FROM h{j}", f"SELECT {j + 1}, {j}, h FROM n{j}"]
    return ",\n".join(parts) + ",\nhs AS (" + " UNION ALL ".join(hs) + ")"


def _lanczos_sql(steps: int) -> str:
    """Three-term recurrence, unrolled; ends in ab(step, alpha, beta)."""
    parts = ["q0 AS MATERIALIZED (SELECT i, v / (SELECT sqrt(sum(v * v)) FROM vec_x) AS v FROM vec_x)"]
    rows = []
    for j in range(steps):
        before = (f" - (SELECT beta FROM s{j - 1}) * p.v" if j else "")
        join = f" JOIN q{j - 1} p ON w.i = p.i" if j else ""
        parts += [
            f"w{j} AS MATERIALIZED (SELECT l.i, sum(l.v * q.v) AS v FROM mat_l l JOIN q{j} q ON l.j = q.i GROUP BY l.i)",
            f"a{j} AS MATERIALIZED (SELECT sum(w.v * q.v) AS alpha FROM w{j} w JOIN q{j} q ON w.i = q.i)",
            f"r{j} AS MATERIALIZED (SELECT w.i, w.v - (SELECT alpha FROM a{j}) * q.v{before} AS v "
            f"FROM w{j} w JOIN q{j} q ON w.i = q.i{join})",
            f"s{j} AS MATERIALIZED (SELECT sqrt(sum(v * v)) AS beta FROM r{j})",
            f"q{j + 1} AS MATERIALIZED (SELECT i, v / (SELECT beta FROM s{j}) AS v FROM r{j})"]
        rows.append(f"SELECT {j} AS step, (SELECT alpha FROM a{j}) AS alpha, "
                    + (f"(SELECT beta FROM s{j}) AS beta" if j < steps - 1 else "CAST(NULL AS DOUBLE) AS beta"))
    return ",\n".join(parts) + ",\nab AS (" + " UNION ALL ".join(rows) + ")"


O.register_chain("arnoldi", _arnoldi_sql(KRYLOV_STEPS),
                 "SELECT row, col, round(h, 4) AS h FROM hs WHERE abs(h) > 1e-4", "mat_l", "vec_x")
O.register_chain("lanczos", _lanczos_sql(KRYLOV_STEPS),
                 "SELECT step, round(alpha, 4) AS alpha, round(beta, 4) AS beta FROM ab", "mat_l", "vec_x")


@query("arnoldi")
def q_arnoldi(spark, d):
    lap, x = _krylov_inputs(spark, d)
    _, H = LA.arnoldi(lap, x, KRYLOV_STEPS)
    rows = [(int(i), int(j), round(float(H[i, j]), 4)) for i in range(H.shape[0]) for j in range(H.shape[1])
            if abs(H[i, j]) > 1e-4]
    return spark.createDataFrame(rows, "row int, col int, h double")


@query("ritz_values")
def q_ritz(spark, d):
    lap, x = _krylov_inputs(spark, d)
    _, H = LA.arnoldi(lap, x, KRYLOV_STEPS)
    return LA.ritz_values(H, spark)


@query("lanczos")
def q_lanczos(spark, d):
    lap, x = _krylov_inputs(spark, d)
    _, al, be = LA.lanczos(lap, x, KRYLOV_STEPS)
    rows = [(i, round(float(al[i]), 4), round(float(be[i]), 4) if i < len(be) else None) for i in range(len(al))]
    return spark.createDataFrame(rows, "step int, alpha double, beta double")


@query("ritz_convergence")
def q_ritz_conv(spark, d):
    lap, x = _krylov_inputs(spark, d)
    _, H = LA.arnoldi(lap, x, KRYLOV_STEPS)
    ritz = LA.ritz_values(H, spark)
    return LA.ritz_convergence(ritz, LA.spectral_norm(lap))   # a Laplacian's largest eigenvalue is its norm


@query("orthogonality_loss")
def q_orth(spark, d):
    lap, x = _krylov_inputs(spark, d)
    qa, _ = LA.arnoldi(lap, x, KRYLOV_STEPS)
    ql, _, _ = LA.lanczos(lap, x, KRYLOV_STEPS)
    return (LA.orthogonality_loss(qa).withColumn("method", F.lit("arnoldi"))
            .unionByName(LA.orthogonality_loss(ql).withColumn("method", F.lit("lanczos"))))


@query("spectral_norm")
def q_spectral_norm(spark, d):
    lap, _ = _krylov_inputs(spark, d)
    return spark.createDataFrame([(LA.spectral_norm(lap),)], "spectral_norm double")


@query("smallest_eigenpairs")
def q_eigen(spark, d):
    lap, _ = _krylov_inputs(spark, d)
    vals, vec, residual = LA.smallest_eigenpairs(lap, EIGENPAIRS)
    vdf = spark.createDataFrame([(p, v, residual) for p, v in enumerate(vals)], "pos int, eigenvalue double, residual double")
    return vec.join(vdf, "pos")


# ------------------------------------------------------------ semi-supervised learning

def _sq(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda x: (x[1] - x[2]) ^ 2))"


O.cte("ssl_totals", f"""
SELECT u.id,
  coalesce(sum(CASE WHEN l.is_labeled THEN exp(-0.5 * sqrt({_sq('u.features', 'l.features')}) / {SIGMA * SIGMA})
               END), 0.0) AS S,
  coalesce(sum(CASE WHEN NOT l.is_labeled THEN exp(-0.5 * sqrt({_sq('u.features', 'l.features')}) / {SIGMA * SIGMA})
               END), 0.0) AS S_bar,
  coalesce(sum(CASE WHEN l.is_labeled THEN l.label * exp(-0.5 * sqrt({_sq('u.features', 'l.features')})
               / {SIGMA * SIGMA}) END), 0.0) AS B
FROM labeled_points u, labeled_points l WHERE NOT u.is_labeled GROUP BY u.id""", ["labeled_points"])
O.cte("ssl_y0", f"SELECT id, 2.0 * {sql_hash_uniform('id', 7)} - 1 AS y FROM labeled_points WHERE NOT is_labeled",
      ["labeled_points"])


def _lp(spark, d):
    return cut(T.labeled_points(spark, d))


@query("similarity_totals", "SELECT id, round(S, 6) AS S, round(S_bar, 6) AS S_bar, round(B, 6) AS B "
       "FROM ssl_totals", ("ssl_totals",))
def q_totals(spark, d):
    t = S.similarity_totals(_lp(spark, d), SIGMA)
    return t.select("id", *[rnd(c).alias(c) for c in ("S", "S_bar", "B")])


@query("lipschitz_steps", "SELECT id, round(2 * (S + S_bar - 1), 6) AS L_j FROM ssl_totals", ("ssl_totals",))
def q_lipschitz(spark, d):
    return S.lipschitz_coordinates(S.similarity_totals(_lp(spark, d), SIGMA)).select("id", rnd("L_j").alias("L_j"))


@query("random_start", "SELECT id, round(y, 6) AS y FROM ssl_y0", ("ssl_y0",))
def q_random_start(spark, d):
    return S.random_start(_lp(spark, d)).withColumn("y", rnd("y"))


@query("gradient", f"""
SELECT t.id, round(2 * (y.y * (t.S + t.S_bar) - t.B - c.C), 6) AS grad
FROM ssl_totals t JOIN ssl_y0 y ON t.id = y.id JOIN (
  SELECT u.id, sum(exp(-0.5 * sqrt({_sq('u.features', 'v.features')}) / {SIGMA * SIGMA}) * y.y) AS C
  FROM labeled_points u, labeled_points v JOIN ssl_y0 y ON v.id = y.id
  WHERE NOT u.is_labeled GROUP BY u.id) c ON t.id = c.id""", ("ssl_totals", "ssl_y0", "labeled_points"))
def q_gradient(spark, d):
    lp = _lp(spark, d)
    g = S.gradient(lp, cut(S.similarity_totals(lp, SIGMA)), cut(S.random_start(lp)), SIGMA)
    return g.withColumn("grad", rnd("grad"))


_KNN_START_SQL = f"""
SELECT id, CAST(label AS DOUBLE) AS y FROM (
  SELECT qid AS id, label, row_number() OVER (PARTITION BY qid ORDER BY n DESC, label) AS r FROM (
    SELECT qid, label, count(*) AS n FROM (
      SELECT u.id AS qid, l.label,
             row_number() OVER (PARTITION BY u.id ORDER BY {_sq('u.features', 'l.features')}, l.id) AS rk
      FROM labeled_points u, labeled_points l WHERE NOT u.is_labeled AND l.is_labeled)
    WHERE rk <= {KNN_START_K} GROUP BY qid, label))
WHERE r = 1"""


@query("knn_start", _KNN_START_SQL, ("labeled_points",))
def q_knn_start(spark, d):
    return S.knn_start(_lp(spark, d), KNN_START_K)


@query("label_accuracy", f"""
SELECT avg(CASE WHEN (CASE WHEN k.y >= 0 THEN 1 ELSE -1 END) = p.y_true THEN 1.0 ELSE 0.0 END) AS accuracy
FROM ({_KNN_START_SQL}) k JOIN labeled_points p ON k.id = p.id""", ("labeled_points",))
def q_accuracy(spark, d):
    lp = _lp(spark, d)
    return S.label_accuracy(S.knn_start(lp, KNN_START_K), lp)


@query("similarity_edges", f"""
SELECT i, j, round(exp(-0.5 * distance / {SIGMA * SIGMA}), 6) AS w FROM (
  SELECT a.id AS i, b.id AS j, sqrt({_sq('a.features', 'b.features')}) AS distance,
         row_number() OVER (PARTITION BY a.id ORDER BY {_sq('a.features', 'b.features')}, b.id) AS rk
  FROM labeled_points a, labeled_points b WHERE NOT a.is_labeled AND NOT b.is_labeled) WHERE rk <= 5""",
       ("labeled_points",))
def q_sim_edges(spark, d):
    return S.similarity_edges_knn(_lp(spark, d), 5, SIGMA).withColumn("w", rnd("w"))


# The loss has one minimum, where (diag(S + S_bar) - W_bar) y = B.  SQL finds it by conjugate gradients,
# unrolled; every solver must end there.
O.cte("ssl_w", f"""
SELECT u.id AS i, v.id AS j, exp(-0.5 * sqrt({_sq('u.features', 'v.features')}) / {SIGMA * SIGMA}) AS w
FROM labeled_points u, labeled_points v WHERE NOT u.is_labeled AND NOT v.is_labeled""", ["labeled_points"])
O.cte("ssl_bound", "SELECT 2 * max(S + 2 * (S_bar - 1)) AS L FROM ssl_totals", ["ssl_totals"])


def _minimum_sql(steps: int = CG_STEPS) -> str:
    """CTEs that end in ssl_minimum(id, y)."""
    parts = ["c0 AS MATERIALIZED (SELECT id, 0.0 AS y, B AS r, B AS p FROM ssl_totals)"]
    for k in range(steps):
        parts += [
            f"a{k} AS MATERIALIZED (SELECT t.id, (t.S + t.S_bar) * c.p - m.s AS ap FROM ssl_totals t JOIN c{k} c ON t.id = c.id "
            f"JOIN (SELECT w.i, sum(w.w * c.p) AS s FROM ssl_w w JOIN c{k} c ON w.j = c.id GROUP BY w.i) m ON t.id = m.i)",
            f"s{k} AS MATERIALIZED (SELECT coalesce(sum(c.r * c.r) / nullif(sum(c.p * a.ap), 0), 0) AS alpha, sum(c.r * c.r) AS rr "
            f"FROM c{k} c JOIN a{k} a ON c.id = a.id)",
            f"n{k} AS MATERIALIZED (SELECT c.id, c.y + s.alpha * c.p AS y, c.r - s.alpha * a.ap AS r, c.p "
            f"FROM c{k} c JOIN a{k} a ON c.id = a.id, s{k} s)",
            f"c{k + 1} AS MATERIALIZED (SELECT n.id, n.y, n.r, n.r + coalesce((SELECT sum(r * r) FROM n{k}) / nullif(s.rr, 0), 0) * n.p AS p "
            f"FROM n{k} n, s{k} s)"]
    return ",\n".join(parts) + f",\nssl_minimum AS MATERIALIZED (SELECT id, y FROM c{steps})"


HISTORIES = {"gd": "random", "gd_nesterov": "random", "bcgd_cyclic": "knn", "bcgd_random_uniform": "knn",
             "bcgd_random_lipschitz": "knn", "bcgd_gauss_southwell": "knn"}


def _solver_query(method, start):
    def run(spark, d):
        return S.solution(_lp(spark, d), method, start, N_BLOCKS, KNN_START_K, SIGMA).withColumn("y", rnd("y"))
    return run


for _m, _s in HISTORIES.items():
    query(_m)(_solver_query(_m, _s))
    O.register_chain(_m, _minimum_sql(), "SELECT id, round(y, 6) AS y FROM ssl_minimum", "ssl_totals", "ssl_w")


@query("training_history")
def q_history(spark, d):
    """Every round of all six methods from both starts, to the tolerance."""
    h = S.training_history(_lp(spark, d), None, N_BLOCKS, KNN_START_K, SIGMA)
    return h.withColumn("accuracy", rnd("accuracy"))


O.register_chain("method_comparison_ssl", _minimum_sql(), """
SELECT m.method, s.start, true AS converged, (SELECT round(avg(CASE WHEN (CASE WHEN y.y >= 0 THEN 1 ELSE -1 END) = p.y_true
  THEN 1.0 ELSE 0.0 END), 6) FROM ssl_minimum y JOIN labeled_points p ON y.id = p.id) AS accuracy
FROM (SELECT unnest([{}]) AS method) m, (SELECT unnest(['random', 'knn']) AS start) s""".format(
    ", ".join(f"'{m}'" for m in S.METHODS)), "ssl_totals", "ssl_w", "labeled_points")


@query("method_comparison_ssl")
def q_comparison_ssl(spark, d):
    c = S.method_comparison_ssl(_lp(spark, d), N_BLOCKS, KNN_START_K, SIGMA)
    return c.select("method", "start", "converged", rnd("accuracy").alias("accuracy"))


@query("lipschitz_constant")
def q_constant(spark, d):
    return S.lipschitz_constant(_lp(spark, d), SIGMA).select(rnd("L").alias("L"))


@query("lipschitz_bound", "SELECT round(L, 6) AS L FROM ssl_bound", ("ssl_bound",))
def q_bound(spark, d):
    return spark.createDataFrame([(round(S.lipschitz_bound(S.similarity_totals(_lp(spark, d), SIGMA)), 6),)], "L double")
