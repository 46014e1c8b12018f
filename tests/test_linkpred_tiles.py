import numpy as np
import pytest

from conftest import edges_df
from meridian.operators import linkpred as LP


@pytest.mark.parametrize(("n", "share", "tile"), [(60, 0.4, 25), (90, 0.08, 25), (60, 0.4, 1024)])
def test_tiles_equal_wedges(spark, monkeypatch, n, share, tile):
    monkeypatch.setattr(LP, "TILE", tile)
    rng = np.random.default_rng(n)
    pairs = [(i * 7, j * 7) for i in range(n) for j in range(i, n) if rng.random() < (share if i != j else 0.1)]
    e = edges_df(spark, pairs)
    found = []
    for dense in (False, True):
        got = {(r.u, r.v): (r.cn, r.ra, r.aa, r.jaccard) for r in LP._neighbour_scores(e, dense).collect()}
        found.append(got)
    assert found[0].keys() == found[1].keys() and len(found[0]) > 100
    assert all(found[0][p] == pytest.approx(found[1][p]) for p in found[0])
