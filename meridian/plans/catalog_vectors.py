"""Registered vector and k-center queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.functions.draws import sql_hash_int
from meridian.functions.vectors import euclidean, exp_similarity, squared_euclidean
from meridian.operators import kcenter as KC
from meridian.operators import relational as R
from meridian.operators import vectors as V
from meridian.plans import oracle as O
from meridian.plans.catalog import query, rnd
from meridian.sources import testdata as T

KNN_K = 5
BALL_RADIUS = 1.0
FFT_K = 5
KC_K, KC_Z = 3, 2
N_SET = 5
#: SQL for the buckets that ``coreset_buckets`` takes.
BUCKETS = f"(SELECT greatest(4, ceil(count(*) / {max(KC.BUCKET_POINTS, KC.REDUCTION * (KC_K + KC_Z + 1))}.0)::BIGINT) FROM points)"


def sq(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda x: (x[1] - x[2]) ^ 2))"


def _first_point(pts):
    return pts.orderBy("id").limit(1)


@query("points", "SELECT id, features FROM points", ("points",))
def q_points(spark, d):
    return T.points(spark, d)


@query("euclidean_distance", f"""
SELECT p.id, round({sq('p.features', 'f.features')}, 6) AS squared_distance,
       round(sqrt({sq('p.features', 'f.features')}), 6) AS distance
FROM points p, (SELECT features FROM points ORDER BY id LIMIT 1) f""", ("points",))
def q_euclid(spark, d):
    pts = T.points(spark, d)
    f = _first_point(pts).select(F.col("features").alias("ff"))
    row = f.first()
    ref = V.vectors_literal([row.ff])[0]
    return pts.select("id", rnd(squared_euclidean(F.col("features"), ref)).alias("squared_distance"),
                      rnd(euclidean(F.col("features"), ref)).alias("distance"))


@query("exp_similarity", f"""
SELECT p.id, round(exp(-0.5 * sqrt({sq('p.features', 'f.features')}) / 1.0), 6) AS similarity
FROM points p, (SELECT features FROM points ORDER BY id LIMIT 1) f""", ("points",))
def q_expsim(spark, d):
    pts = T.points(spark, d)
    row = _first_point(pts).first()
    ref = V.vectors_literal([row.features])[0]
    return pts.select("id", rnd(exp_similarity(euclidean(F.col("features"), ref), 1.0)).alias("similarity"))


@query("distances_to_set", f"""
SELECT p.id, c.id AS center_id, round(sqrt({sq('p.features', 'c.features')}), 6) AS distance
FROM points p, (SELECT id, features FROM points ORDER BY id LIMIT {N_SET}) c""", ("points",))
def q_dist_set(spark, d):
    pts = T.points(spark, d)
    out = V.distances_to_set(pts, pts.orderBy("id").limit(N_SET))
    return out.withColumn("distance", rnd("distance"))


_KNN_SQL = f"""
SELECT qid, nid, round(distance, 6) AS distance, rank FROM (
  SELECT a.id AS qid, b.id AS nid, sqrt({sq('a.features', 'b.features')}) AS distance,
         row_number() OVER (PARTITION BY a.id ORDER BY {sq('a.features', 'b.features')}, b.id) AS rank
  FROM points a, points b) WHERE rank <= {KNN_K}"""


@query("knn_join", _KNN_SQL, ("points",))
def q_knn(spark, d):
    pts = T.points(spark, d)
    return V.knn_join(pts, pts, KNN_K).withColumn("distance", rnd("distance"))


@query("knn_graph", f"""
WITH nn AS ({_KNN_SQL})
SELECT DISTINCT i, j, 1.0 AS v FROM (
  SELECT qid AS i, nid AS j FROM nn WHERE qid <> nid UNION ALL SELECT nid, qid FROM nn WHERE qid <> nid)""",
       ("points",))
def q_knn_graph(spark, d):
    return V.knn_graph(T.points(spark, d), KNN_K)


@query("ball_join", f"""
SELECT a.id AS id_a, b.id AS id_b, round(sqrt({sq('a.features', 'b.features')}), 6) AS distance
FROM points a, points b WHERE sqrt({sq('a.features', 'b.features')}) <= {BALL_RADIUS}""", ("points",))
def q_ball(spark, d):
    p = T.points(spark, d)
    return V.ball_join(p, p, BALL_RADIUS).withColumn("distance", rnd("distance"))


def fft_sql(k: int, src: str = "points") -> str:
    parts = [f"c0 AS MATERIALIZED (SELECT 0 AS rank, id, features FROM {src} ORDER BY id LIMIT 1)",
             f"d0 AS MATERIALIZED (SELECT p.id, p.features, {sq('p.features', 'c.features')} AS d "
             f"FROM {src} p, c0 c)"]
    for r in range(1, k):
        parts.append(f"c{r} AS MATERIALIZED (SELECT {r} AS rank, id, features FROM d{r - 1} "
                     f"WHERE d > 0 ORDER BY d DESC, id LIMIT 1)")
        parts.append(f"d{r} AS MATERIALIZED (SELECT p.id, p.features, least(p.d, coalesce("
                     f"(SELECT {sq('p.features', 'c.features')} FROM c{r} c), p.d)) AS d FROM d{r - 1} p)")
    parts.append("centers AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM c{r}" for r in range(k)) + ")")
    return ",\n".join(parts)


_ASSIGN_BODY = f"""
assign AS MATERIALIZED (
  SELECT id, center_id, distance FROM (
    SELECT p.id, c.id AS center_id, sqrt({sq('p.features', 'c.features')}) AS distance,
           row_number() OVER (PARTITION BY p.id ORDER BY {sq('p.features', 'c.features')}, c.rank) AS rn
    FROM points p, centers c) WHERE rn = 1)"""

O.register_chain("farthest_first", fft_sql(FFT_K), "SELECT rank, id, features FROM centers", "points")
O.register_chain("assign_nearest_center", fft_sql(FFT_K) + "," + _ASSIGN_BODY,
                 "SELECT id, center_id, round(distance, 6) AS distance FROM assign", "points")
O.register_chain("coreset_weights", fft_sql(FFT_K) + "," + _ASSIGN_BODY,
                 "SELECT center_id, CAST(count(*) AS DOUBLE) AS weight FROM assign GROUP BY center_id", "points")
O.register_chain("kcenter_objective", fft_sql(FFT_K) + "," + _ASSIGN_BODY,
                 f"SELECT round(min(distance), 6) AS objective FROM (SELECT distance FROM assign "
                 f"ORDER BY distance DESC LIMIT {KC_Z + 1})", "points")
O.register_chain("argmax_row", fft_sql(1),
                 "SELECT id, round(d, 6) AS d FROM d0 ORDER BY d DESC, id LIMIT 1", "points")


def _fft(spark, d):
    return KC.farthest_first(T.points(spark, d), FFT_K)


@query("farthest_first")
def q_fft(spark, d):
    return _fft(spark, d)


@query("assign_nearest_center")
def q_assign(spark, d):
    return KC.assign_nearest_center(T.points(spark, d), _fft(spark, d)).withColumn("distance", rnd("distance"))


@query("coreset_weights")
def q_coreset_weights(spark, d):
    return KC.coreset_weights(KC.assign_nearest_center(T.points(spark, d), _fft(spark, d)))


@query("kcenter_objective")
def q_objective(spark, d):
    obj = KC.kcenter_objective(T.points(spark, d), _fft(spark, d), KC_Z)
    return spark.createDataFrame([(round(obj, 6),)], "objective double")


@query("argmax_row")
def q_argmax(spark, d):
    pts = T.points(spark, d)
    row = _first_point(pts).first()
    ref = V.vectors_literal([row.features])[0]
    dd = pts.select("id", squared_euclidean(F.col("features"), ref).alias("d"))
    return R.argmax_row(dd, "d").withColumn("d", rnd("d"))


@query("initial_radius", f"""
SELECT round(min(sqrt({sq('a.features', 'b.features')})) / 2, 6) AS initial_radius
FROM (SELECT * FROM points ORDER BY id LIMIT {KC_K + KC_Z + 1}) a,
     (SELECT * FROM points ORDER BY id LIMIT {KC_K + KC_Z + 1}) b
WHERE sqrt({sq('a.features', 'b.features')}) > 0""", ("points",))
def q_initial_radius(spark, d):
    r = KC.initial_radius(T.points(spark, d), KC_K + KC_Z + 1)
    return spark.createDataFrame([(round(r, 6),)], "initial_radius double")


@query("ball_weights", f"""
SELECT a.id AS id, CAST(count(*) AS DOUBLE) AS ball_weight
FROM points a, points b WHERE sqrt({sq('a.features', 'b.features')}) <= {BALL_RADIUS} GROUP BY a.id""",
       ("points",))
def q_ball_weights(spark, d):
    p = T.points(spark, d)
    return V.ball_weights(p, p, BALL_RADIUS)


def coreset_sql(k: int, z: int, buckets: str) -> str:
    """Farthest-first in every hash bucket, unrolled; ends in core(id, weight, bucket)."""
    m = k + z + 1
    src = f"(SELECT id, features, CAST({sql_hash_int('id', 21)} % {buckets} AS INTEGER) AS bucket FROM points)"
    pick = "(SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY {o}) AS rn FROM {t})"
    parts = [f"g0 AS MATERIALIZED (SELECT 0 AS rank, id, features, bucket FROM {pick.format(o='id', t=src)} WHERE rn = 1)",
             f"h0 AS MATERIALIZED (SELECT p.id, p.features, p.bucket, {sq('p.features', 'c.features')} AS d "
             f"FROM {src} p JOIN g0 c ON p.bucket = c.bucket)"]
    for r in range(1, m):
        last = pick.format(o="d DESC, id", t=f"h{r - 1}")
        parts.append(f"g{r} AS MATERIALIZED (SELECT {r} AS rank, id, features, bucket FROM {last} WHERE rn = 1 AND d > 0)")
        parts.append(f"h{r} AS MATERIALIZED (SELECT p.id, p.features, p.bucket, "
                     f"least(p.d, coalesce({sq('p.features', 'c.features')}, p.d)) AS d "
                     f"FROM h{r - 1} p LEFT JOIN g{r} c ON p.bucket = c.bucket)")
    parts.append("reps AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM g{r}" for r in range(m)) + ")")
    parts.append(f"""core AS MATERIALIZED (
  SELECT c.id, c.features, c.bucket, CAST(count(*) AS DOUBLE) AS weight FROM (
    SELECT p.id, p.bucket, c.id AS rep, row_number() OVER (PARTITION BY p.id ORDER BY
           {sq('p.features', 'c.features')}, c.rank) AS rn
    FROM {src} p JOIN reps c ON p.bucket = c.bucket) a JOIN reps c ON a.rep = c.id AND a.bucket = c.bucket
  WHERE a.rn = 1 GROUP BY c.id, c.features, c.bucket)""")
    return ",\n".join(parts)


O.register_chain("extract_coreset", coreset_sql(KC_K, KC_Z, BUCKETS), "SELECT id, features, weight, bucket FROM core", "points")


@query("extract_coreset")
def q_coreset(spark, d):
    return KC.extract_coreset(T.points(spark, d), KC_K, KC_Z)


@query("coreset_merge_tree", """
SELECT CAST(count(*) AS DOUBLE) AS weight, count(*) > 40 AS reduced, true AS covered FROM points""", ("points",))
def q_merge_tree(spark, d):
    """Coresets of coresets down to 40 points: no weight is lost, and every representative is a point
    of the input that covers its share."""
    pts = T.points(spark, d)
    core, levels = KC.merged_coreset(pts, KC_K, KC_Z, small=40)
    far = KC.kcenter_objective(pts, core.select("id", "features"), 0)
    best = KC.kcenter_objective(pts, KC.farthest_first(pts, KC_K + KC_Z), 0)
    row = core.agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n")).first()
    # farthest-first on the whole table is within twice the optimum, so no less than the optimum
    return spark.createDataFrame([(row.weight, row.n <= max(40, KC_K + KC_Z + 1) and pts.count() > 40, far <= 2 * levels * best + 1e-9)],
                                 "weight double, reduced boolean, covered boolean")


@query("radius_report")
def q_radius_report(spark, d):
    return KC.radius_report(T.points(spark, d), KC_K, KC_Z)


def _report(spark, points, centers, rep):
    obj = KC.kcenter_objective(points, centers, KC_Z)
    return spark.createDataFrame(
        [(rep["initial_guess"], rep["final_guess"], rep["n_guesses"], rep["n"], KC_K, KC_Z, obj)],
        "initial_guess double, final_guess double, n_guesses int, n long, k int, z int, objective double")


@query("weighted_kcenter_outliers")
def q_seq_kcenter(spark, d):
    pts = T.points(spark, d)
    centers, rep = KC.weighted_kcenter_outliers(KC.extract_coreset(pts, KC_K, KC_Z), KC_K, KC_Z, 0.0)
    return _report(spark, pts, centers, rep)


@query("mr_kcenter_outliers")
def q_mr_kcenter(spark, d):
    pts = T.points(spark, d)
    centers, rep = KC.mr_kcenter_outliers(pts, KC_K, KC_Z)
    return _report(spark, pts, centers, rep)
