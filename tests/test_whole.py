"""Queries of whole tables against other ways to the same figures."""

import numpy as np

from gridfold.functions.radiometry import EARTH_SUN
from gridfold.operators import footprints
from gridfold.plans import fixtures as fx
from gridfold.plans.catalog import QUERIES
from gridfold.plans.spectra import _assigned

SF = "/root/testdata/sf0.01"


def test_footprints_of_all_scenes(spark):
    rows = footprints.polygons(fx.scenes(spark, SF)).select("scene_id", "polygon").collect()
    assert len(rows) == 15000
    ids = np.array([r.scene_id for r in rows])
    lon, lat = (np.array([[p[k] for p in r.polygon] for r in rows]) for k in (0, 1))
    lon = np.where(lon - lon[:, :1] > 180, lon - 360, np.where(lon - lon[:, :1] < -180, lon + 360, lon))
    west, east, south, north = lon.min(1), lon.max(1), lat.min(1), lat.max(1)
    want = set()
    for i in range(len(ids)):
        x = ((west >= west[i]) & (west < east[i])) | ((east >= west[i]) & (east < east[i]))
        y = ((south >= south[i]) & (south < north[i])) | ((north >= south[i]) & (north < north[i]))
        want |= {(ids[i], j) for j in ids[x & y] if j != ids[i]}
    got = QUERIES["footprints_overlapping"](spark, SF).collect()
    assert len(got) == len(want) > 10000 and {tuple(r) for r in got} == want


def test_zero_suppression_of_all_order_lines(spark):
    cells = fx.table(spark, SF, "lineitem").select("l_discount").toPandas()["l_discount"].to_numpy()
    lit = cells[cells >= 0.03]
    got = QUERIES["zero_suppressed"](spark, SF).toPandas()
    assert got["length"].sum() == len(lit) and abs(got["total"].sum() - lit.sum()) < 1e-2
    dense = QUERIES["zeros_restored"](spark, SF).toPandas()["v"].to_numpy()
    assert len(dense) == len(cells) and np.array_equal(np.sort(dense), np.sort(np.where(cells < 0.03, 0.0, cells)))


def test_covariance_of_all_bands(spark):
    assigned = _assigned(spark, SF)[0].select("cluster", "spectrum").collect()
    got = {(r.cluster, r.i, r.j): r.covariance for r in QUERIES["cluster_covariance"](spark, SF).collect()}
    several = 0
    for cluster in {r.cluster for r in assigned}:
        x = np.array([r.spectrum for r in assigned if r.cluster == cluster])
        if len(x) > 1:
            several += 1
            want = np.cov(x.T)
            assert all(abs(got[cluster, i, j] - want[i, j]) < 2e-6 for i in range(64) for j in range(i, 64))
    assert len(got) == several * 2080 > 0


def test_sun_correction_of_every_day(spark):
    got = QUERIES["sun_correction"](spark, SF).toPandas()
    assert len(got) == fx.table(spark, SF, "orders").count() and got["corrected"].notna().all()
    last = got[got["day"] == 366]
    assert len(last) > 0 and np.allclose(last["distance"], dict(EARTH_SUN)[366], atol=1e-8)
