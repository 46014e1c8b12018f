"""Random-walk Laplacian, spectral embedding, X-means, spectral clusters.

The embedding uses the symmetric normalised Laplacian L_sym = I - D^-1/2 A D^-1/2,
which has the eigenvalues of L_rw = I - D^-1 A; an eigenvector x of L_sym gives
D^-1/2 x for L_rw.  L_sym has one block per connected component, and the
eigenvalues of the graph are those of all blocks together (0 once per component).
Components of at most ``DENSE_NODES`` nodes are solved whole, each in a task of its
own, with all their eigenpairs; of a larger one the ``n_eigen`` smallest come from the
restarted block Krylov method, to a residual.  Either way every pair's residual
is known, and one above ``tol`` is an error.

X-means (Pelleg & Moore 2000) is run as a distributed Lloyd iteration: the
centres (at most ``kmax``, size-checked) are one array literal, and the split test
of every cluster runs at once, keyed by the cluster.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.vectors import squared_euclidean
from meridian.operators.graph.build import symmetric
from meridian.operators.graph.components import component_sizes, connected_components
from meridian.operators.linalg import block_krylov_eigs
from meridian.operators.vectors import vectors_literal
from meridian.plans.iterate import cut

DENSE_NODES = 1500
MAX_EIGEN = 10
KMAX = 1000
TOL = 1e-6
#: Eigenvalues that differ by less are one value where gaps are searched.
DIGITS = 9


def _adjacency(edges: DataFrame) -> DataFrame:
    return symmetric(edges).select(F.col("src").alias("i"), F.col("dst").alias("j"),
                                   F.col("weight").cast("double").alias("v"))


def random_walk_laplacian(edges: DataFrame) -> DataFrame:
    """L_rw = I - D^-1 A as COO (i, j, v); D = adjacency row sums."""
    a = _adjacency(edges)
    d = a.groupBy("i").agg(F.sum("v").alias("_d"))
    off = a.join(d, "i").select("i", "j", (-F.col("v") / F.col("_d")).alias("v"))
    ident = d.select("i", F.col("i").alias("j"), F.lit(1.0).alias("v"))
    return off.unionByName(ident).groupBy("i", "j").agg(F.sum("v").alias("v"))


def _sym_laplacian(edges: DataFrame) -> DataFrame:
    a = _adjacency(edges)
    d = a.groupBy("i").agg(F.sum("v").alias("_d"))
    di = d.select("i", F.col("_d").alias("_di"))
    dj = d.select(F.col("i").alias("j"), F.col("_d").alias("_dj"))
    off = a.join(di, "i").join(dj, "j").select("i", "j", (-F.col("v") / F.sqrt(F.col("_di") * F.col("_dj"))).alias("v"))
    ident = d.select("i", F.col("i").alias("j"), F.lit(1.0).alias("v"))
    return off.unionByName(ident).groupBy("i", "j").agg(F.sum("v").alias("v"))


def _dense(pdf: pd.DataFrame):
    """Nodes, eigenvalues and eigenvectors (columns) of one block of L_sym."""
    nodes, at = np.unique(np.concatenate((pdf["i"], pdf["j"])), return_inverse=True)
    m = np.zeros((len(nodes), len(nodes)))
    m[at[:len(pdf)], at[len(pdf):]] = pdf["v"]
    vals, vecs = np.linalg.eigh((m + m.T) / 2)
    worst = float(np.abs(m @ vecs - vecs * vals).max()) if len(nodes) else 0.0
    return nodes, vals, vecs, worst


def _dense_values(pdf: pd.DataFrame) -> pd.DataFrame:
    _, vals, _, worst = _dense(pdf)
    return pd.DataFrame({"component": pdf["component"].iloc[0], "idx": np.arange(len(vals)), "value": vals, "residual": worst})


def _dense_vectors(pdf: pd.DataFrame) -> pd.DataFrame:
    nodes, _, vecs, _ = _dense(pdf)
    last = int(pdf["last"].iloc[0]) + 1
    return pd.DataFrame({"component": pdf["component"].iloc[0], "idx": np.tile(np.arange(last), len(nodes)),
                         "i": np.repeat(nodes, last), "v": vecs[:, :last].ravel()})


def _blocks(edges: DataFrame) -> tuple[DataFrame, DataFrame, list]:
    """L_sym by component (component, i, j, v), components (node, component), and the
    components above ``DENSE_NODES`` nodes, of which there are few."""
    comp = cut(connected_components(edges))
    lap = cut(_sym_laplacian(edges).join(comp.withColumnRenamed("node", "i"), "i"))
    large = [r.component for r in component_sizes(comp).where(F.col("size") > DENSE_NODES).collect()]
    return lap, comp, large


def spectrum(edges: DataFrame, n_eigen: int = MAX_EIGEN, tol: float = TOL, blocks=None):
    """Eigenvalues (component, idx, value, residual) of L_sym, and the eigenvectors
    (component, idx, i, v) of the large components."""
    lap, _, large = blocks or _blocks(edges)
    small = lap.where(~F.col("component").isin(large)) if large else lap
    values = cut(small.groupBy("component").applyInPandas(
        _dense_values, "component long, idx int, value double, residual double"))
    vectors = None
    for c in large:
        vals, vec, res = block_krylov_eigs(lap.where(F.col("component") == c).select("i", "j", "v"), n_eigen, tol=tol)
        values = values.unionByName(edges.sparkSession.createDataFrame(
            [(c, p, v, res) for p, v in enumerate(vals)], "component long, idx int, value double, residual double"))
        v = vec.select(F.lit(c).alias("component"), F.col("pos").alias("idx"), "i", "v")
        vectors = v if vectors is None else vectors.unionByName(v)
    worst = values.agg(F.max("residual")).first()[0] or 0.0
    if worst > tol:
        raise RuntimeError(f"residual {worst:.2e} above {tol:.0e}")
    return values, vectors


def _gap(values: DataFrame) -> int:
    """Position of the last eigenvalue before the largest gap (the last one on ties).
    Equal values are grouped first, so the window is over distinct values."""
    distinct = values.groupBy(F.round("value", DIGITS).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("value")
    at = distinct.select("value", (F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).alias("pos"),
                         (F.lead("value").over(w) - F.col("value")).alias("gap"))
    row = at.where("gap is not null").orderBy(F.desc("gap"), F.desc("pos")).first()
    return int(row.pos) if row else 0


def spectral_embedding(edges: DataFrame, n_eigen: int = MAX_EIGEN, tol: float = TOL):
    """H23 (Q12): node, component, coords (values of the eigenvectors of L_rw at
    positions 1..k-1, at least position 1, where k is the position of the largest
    eigen-gap).  An eigenvector lives on one component, so a node's coordinates are
    those of its own component's vectors; all others are 0 there and left out.
    Returns (embedding DataFrame, eigenvalue DataFrame, k)."""
    blocks = _blocks(edges)
    lap, comp, large = blocks
    values, vectors = spectrum(edges, n_eigen, tol, blocks)
    k = _gap(values)
    # Position of every eigenpair in the order of (value, component, idx).
    kept = values.orderBy(F.round("value", DIGITS), "component", "idx").limit(max(k, 2))
    order = Window.orderBy(F.round("value", DIGITS), "component", "idx")
    kept = cut(kept.select("component", "idx", (F.row_number().over(order) - 1).alias("pos")).where("pos >= 1"))
    last = kept.groupBy("component").agg(F.max("idx").alias("last"))
    small = (lap.where(~F.col("component").isin(large)) if large else lap).join(last, "component")
    found = small.groupBy("component").applyInPandas(_dense_vectors, "component long, idx int, i long, v double")
    if vectors is not None:
        found = found.unionByName(vectors)
    d = _adjacency(edges).groupBy("i").agg(F.sum("v").alias("_d"))
    x = found.join(kept, ["component", "idx"]).join(d, "i").select("i", "pos", (F.col("v") / F.sqrt("_d")).alias("x"))
    coords = (x.groupBy(F.col("i").alias("node")).agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("_c"))
              .select("node", F.transform("_c", lambda s: s["x"]).alias("coords")))
    emb = comp.join(coords, "node", "left").select(
        "node", "component", F.coalesce("coords", F.array().cast("array<double>")).alias("coords"))
    return emb, values, k


def _assign(points: DataFrame, centers: list, feat: str = "coords") -> DataFrame:
    if len(centers) > KMAX:
        raise ValueError("too many centres")
    cs = vectors_literal(centers)
    d2 = F.transform(cs, lambda c: squared_euclidean(F.col(feat), c))
    return points.withColumn("_d2", d2).withColumn("cluster", (F.array_position("_d2", F.array_min("_d2")) - 1)
                                                   .cast("int")).withColumn("dist2", F.array_min("_d2")).drop("_d2")


def _means(assigned: DataFrame, key: str, dims: int, feat: str = "coords"):
    agg = assigned.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.sum("dist2").alias("sse"),
        *[F.avg(F.col(feat)[i]).alias(f"m{i}") for i in range(dims)])
    return {r[key]: (r.n, r.sse, [r[f"m{i}"] for i in range(dims)]) for r in agg.collect()}


def _lloyd(points: DataFrame, centers: list, dims: int, rounds: int = 10, feat: str = "coords"):
    for _ in range(rounds):
        st = _means(_assign(points, centers, feat), "cluster", dims, feat)
        new = [st[c][2] if c in st else centers[c] for c in range(len(centers))]
        if new == centers:
            break
        centers = new
    return centers


def _bic(stats: list[tuple[int, float]], dims: int) -> float:
    """Pelleg-Moore BIC of a set of clusters given (n_i, sse_i)."""
    R = sum(n for n, _ in stats)
    K = len(stats)
    if R <= K:
        return -math.inf
    var = sum(s for _, s in stats) / max(1e-300, (R - K))
    if var <= 0:
        return math.inf
    ll = 0.0
    for n, _ in stats:
        if n <= 0:
            continue
        ll += n * math.log(n) - n * math.log(R) - n / 2 * math.log(2 * math.pi * var) - dims * (n - 1) / 2
    p = (K - 1) + dims * K + 1
    return ll - p / 2 * math.log(R)


def xmeans(points: DataFrame, kmin: int = 2, kmax: int = KMAX, rounds: int = 10, feat: str = "coords",
           id_col: str = "node") -> DataFrame:
    """Id, cluster.  Start from ``kmin`` centres (farthest-first from the
    lowest id), Lloyd, then split every cluster in two where the children's
    BIC beats the parent's; repeat while clusters split and k < kmax."""
    pts = cut(points.select(F.col(id_col).alias("id"), F.col(feat).cast("array<double>").alias(feat)))
    first = pts.orderBy("id").first()
    if first is None:
        return pts.select("id", F.lit(0).alias("cluster"))
    dims = len(first[feat])
    centers = [list(first[feat])]
    while len(centers) < kmin:
        far = _assign(pts, centers, feat).orderBy(F.desc("dist2"), "id").first()
        if far.dist2 <= 0:
            break
        centers.append(list(far[feat]))
    centers = _lloyd(pts, centers, dims, rounds, feat)
    while len(centers) < kmax:
        a = cut(_assign(pts, centers, feat))
        parent = _means(a, "cluster", dims, feat)
        # two children per cluster: the cluster's farthest point from its
        # centre and the centre's mirror image of it, then Lloyd within clusters
        far = (a.groupBy("cluster").agg(F.max(F.struct("dist2", (-F.col("id")).alias("nid"), feat)).alias("b"))
               .collect())
        kids = {}
        for r in far:
            c = centers[r.cluster]
            f = list(r.b[feat])
            kids[r.cluster] = [f, [2 * ci - fi for ci, fi in zip(c, f)]]
        order = sorted(kids)
        flat = [kids[c][j] for c in order for j in (0, 1)]
        pos = {c: i for i, c in enumerate(order)}
        for _ in range(rounds):
            cs = vectors_literal(flat)
            idx = F.element_at(F.create_map(*[x for c in order for x in (F.lit(c), F.lit(pos[c]))]), F.col("cluster"))
            c0 = F.element_at(cs, (idx * 2 + 1).cast("int"))
            c1 = F.element_at(cs, (idx * 2 + 2).cast("int"))
            d0, d1 = squared_euclidean(F.col(feat), c0), squared_euclidean(F.col(feat), c1)
            sub = a.withColumn("child", F.when(d1 < d0, 1).otherwise(0)).withColumn("dist2", F.least(d0, d1))
            st = _means(sub.withColumn("key", F.col("cluster") * 2 + F.col("child")), "key", dims, feat)
            new = [st[c * 2 + j][2] if (c * 2 + j) in st else flat[pos[c] * 2 + j] for c in order for j in (0, 1)]
            if new == flat:
                break
            flat = new
        split, gains = [], []
        for c in order:
            ch = [st.get(c * 2 + j) for j in (0, 1)]
            if any(x is None for x in ch):
                split.append([centers[c]])
                continue
            parent_bic = _bic([(parent[c][0], parent[c][1])], dims)
            child_bic = _bic([(ch[0][0], ch[0][1]), (ch[1][0], ch[1][1])], dims)
            gain = child_bic - parent_bic
            split.append([ch[0][2], ch[1][2]] if gain > 0 else [centers[c]])
            if gain > 0:
                gains.append((gain, c))
        for _, c in sorted(gains)[:max(0, sum(map(len, split)) - kmax)]:     # no room: the least gains wait
            split[pos[c]] = [centers[c]]
        new_centers = [v for grp in split for v in grp]
        if len(new_centers) == len(centers):
            break
        centers = _lloyd(pts, new_centers, dims, rounds, feat)
    return _assign(pts, centers, feat).select("id", "cluster")


def spectral_clusters(edges: DataFrame, n_eigen: int = MAX_EIGEN):
    """Node, community from H23 + H24, and the modularity of the result.

    Nodes of different components differ in the component vectors, so clusters are
    sought inside each component: one without coordinates of its own is a cluster."""
    from meridian.operators.graph.community import modularity
    emb, _, _ = spectral_embedding(edges, n_eigen)
    emb = cut(emb.withColumn("dims", F.size("coords")))
    parts = [emb.where("dims = 0").select("node", F.col("component").alias("community"))]
    split = emb.where("dims > 0").groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    for r in split.where(F.col("n") > DENSE_NODES).collect():           # few: each has more than DENSE_NODES nodes
        own = xmeans(emb.where(F.col("component") == r.component))
        least = own.groupBy("cluster").agg(F.min("id").alias("community"))
        parts.append(own.join(least, "cluster").select(F.col("id").alias("node"), "community"))
    small = emb.join(split.where(F.col("n") <= DENSE_NODES).select("component"), "component", "left_semi")
    parts.append(small.groupBy("component").applyInPandas(_local_xmeans, "node long, community long"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = cut(out)
    return out, modularity(edges, out)


def _local_xmeans(pdf: pd.DataFrame) -> pd.DataFrame:
    """X-means of one small component in memory; a cluster is named by its lowest node."""
    pdf = pdf.sort_values("node")
    node, x = pdf["node"].to_numpy(), np.stack(pdf["coords"].to_numpy())

    def lloyd(pts, centers):
        for _ in range(50):
            d = ((pts[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
            of = d.argmin(axis=1)
            new = np.array([pts[of == c].mean(axis=0) if (of == c).any() else centers[c] for c in range(len(centers))])
            if np.array_equal(new, centers):
                break
            centers = new
        return of, d[np.arange(len(pts)), of]

    def halves(pts):
        center = pts.mean(axis=0)
        far = pts[((pts - center) ** 2).sum(axis=1).argmax()]
        return lloyd(pts, np.stack([far, 2 * center - far]))

    of, _ = halves(x) if len(x) > 1 else (np.zeros(len(x), int), None)
    changed = True
    while changed and of.max(initial=0) + 1 < KMAX:
        changed = False
        for c in range(of.max(initial=0) + 1):
            own = np.flatnonzero(of == c)
            if len(own) < 3:
                continue
            pts = x[own]
            child, dist = halves(pts)
            if len(set(child.tolist())) < 2:
                continue
            whole = ((pts - pts.mean(axis=0)) ** 2).sum()
            stats = [(int((child == j).sum()), float(dist[child == j].sum())) for j in (0, 1)]
            if _bic(stats, x.shape[1]) > _bic([(len(own), float(whole))], x.shape[1]):
                of[own[child == 1]] = of.max() + 1
                changed = True
    least = {c: int(node[of == c].min()) for c in set(of.tolist())}
    return pd.DataFrame({"node": node, "community": [least[c] for c in of.tolist()]})
