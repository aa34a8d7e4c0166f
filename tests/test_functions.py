"""Hand-computed values of the functions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridfold.functions import geodesy, png, radiometry, tiling
from gridfold.operators import explorer, raster, topology
from gridfold.sources import files


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(("lon", "lat", "x", "y"), [(0.0, 0.0, 1024, 1024), (180.0, 90.0, 2048, 2047), (-180.0, -90.0, 2048, 0), (179.999, 89.9, 2047, 2046), (540.0, 0.0, 2048, 1024)])
def test_tile_index(spark, lon, lat, x, y):
    assert one(spark, tiling.long_index(10, F.lit(lon))) == x
    assert one(spark, tiling.lat_index(10, F.lit(lat))) == y
    assert one(spark, tiling.long_index(10, F.lit(lon), clamp=True)) == min(x, 2047)


def test_latitudes_beyond_the_poles_are_errors(spark):
    with pytest.raises(Exception, match="latitude out of range"):
        one(spark, tiling.lat_index(10, F.lit(90.5)))


def test_names(spark):
    assert one(spark, tiling.tile_name(10, F.lit(5), F.lit(77))) == "T10-00005-00077"
    assert one(spark, tiling.parse_name(F.lit("T10-00005-00077"))) == (10, 5, 77)
    assert one(spark, tiling.parse_name(F.lit("T10-5-77"))) is None
    assert one(spark, tiling.hex16(F.lit(-1))) == "f" * 16
    assert one(spark, tiling.key_parts(F.lit("T10-00005-00077-0000001234-00000000000000ff"))) == ("T10-00005-00077", 1234, "00000000000000ff")


def test_utm_central_meridian_and_known_place(spark):
    lon, lat = geodesy.from_utm(F.lit(500000.0), F.lit(0.0), 31)
    assert one(spark, lon) == pytest.approx(3.0) and one(spark, lat) == pytest.approx(0.0)
    # a meridian arc of one degree at the equator is 110574.3886 m
    assert one(spark, geodesy.from_utm(F.lit(500000.0), F.lit(110574.3886 * 0.9996), 31)[1]) == pytest.approx(1.0, abs=1e-7)
    assert geodesy.utm_zone('PROJCS["WGS 84 / UTM zone 33S",...]') == (33, False) and geodesy.utm_zone('GEOGCS["WGS 84"]') is None
    with pytest.raises(ValueError):
        geodesy.utm_zone('PROJCS["Lambert"]')


def test_radiometry(spark):
    assert one(spark, radiometry.earth_sun_distance(F.lit(8))) == pytest.approx(0.9832 + 7 / 14 * 0.0004)
    assert one(spark, radiometry.earth_sun_distance(F.lit(366))) == pytest.approx(0.9832375)
    with pytest.raises(Exception, match="no irradiance for band 1"):
        one(spark, radiometry.irradiance(F.lit(1)))
    assert one(spark, radiometry.angle_change(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0)))) == pytest.approx(0.5)
    assert one(spark, radiometry.angle_change(F.array(F.lit(0.0)), F.array(F.lit(0.0)))) == 0.0
    # a straight line in log radiance has no excess
    line = lambda n: F.lit(math.exp(0.01 * n) - radiometry.LOG_OFFSET)
    assert one(spark, radiometry.co2_index(line)) == pytest.approx(1.0)
    assert one(spark, radiometry.parse_time(F.lit("1970 002 00:00:01"))) == 86401
    assert one(spark, radiometry.sound_range(F.lit(2.0), F.lit(2.0), F.lit(1.0), F.lit(1.0))) == (0.0, 1.0)


def test_expressions_are_checked():
    assert explorer.bands_in("log(B01) + B02 * 2e3", ["B01", "B02", "B03"]) == ["B01", "B02"]
    for bad in ("reflect('java')", "B01; drop", "B09 + secret"):
        with pytest.raises(ValueError):
            explorer.bands_in(bad, ["B01"])


def test_spline_reproduces_cubics_and_edges():
    y, x = np.mgrid[0:30, 0:40].astype(float)
    a = 2 + 0.3 * x + 0.1 * y
    at_y, at_x = np.random.default_rng(1).uniform(8, 20, (2, 50))
    for order in (1, 3):
        assert np.allclose(raster.resample(a, at_y, at_x, order), 2 + 0.3 * at_x + 0.1 * at_y, atol=1e-4)
    assert np.allclose(raster.resample(a, y, x, 3), a)
    assert raster.resample(a, np.array([-1.0]), np.array([3.0])).tolist() == [0.0]


def test_png_round_trip():
    for channels in (1, 3, 4):
        a = np.random.default_rng(2).integers(0, 256, (7, 9, channels), dtype=np.uint8)
        assert (png.decode(png.encode(a)) == a).all()


def test_layers():
    bands = {n: np.arange(16.0).reshape(4, 4) * k for k, n in enumerate(("B01", "B02", "B03"), 1)} | {"MASK": np.eye(4)}
    made = raster.make_image(bands, raster.Layer("l", ("B03", "B02", "B01"), low=0.0, high=45.0))
    assert made[3, 3].tolist() == [255, 170, 85, 255] and made[0, 1, 3] == 0
    assert raster.make_image(bands, raster.Layer("l", ("B09",))) is None
    assert raster.radiance_range([np.zeros((2, 2))], "5%", "95%") == (0.0, 1.0)
    with pytest.raises(NotImplementedError):
        raster.make_image(bands, raster.Layer("l", ("B01",), "purple"))


def test_zoom_out_places_quadrants(spark):
    rows = []
    for x in (0, 1):
        for y in (0, 1):
            if (x, y) != (1, 1):
                a = np.zeros((4, 8, 4), np.uint8)
                a[...] = [10 * (1 + x), 10 * (1 + y), 0, 255]
                rows.append((3, 4 + x, 2 + y, "l", 1, {"tileName": "t", "kept": "1"}, png.encode(a)))
    up = raster.zoom_out(spark.createDataFrame(rows, raster.IMAGE)).collect()
    assert [(r.depth, r.long_index, r.lat_index, r.metadata) for r in up] == [(2, 2, 1, {"kept": "1"})]
    a = png.decode(up[0].png)
    assert a[0, 0].tolist() == [10, 20, 0, 255]  # north-west: x = 0, y = 1
    assert a[3, 0].tolist() == [10, 10, 0, 255] and a[3, 7].tolist() == [20, 10, 0, 255]
    assert a[0, 7].tolist() == [0, 0, 0, 0]  # the missing child


def test_basins_find_the_pits():
    y, x = np.mgrid[0:40, 0:40]
    h = np.minimum(np.hypot(y - 10, x - 10), np.hypot(y - 30, x - 28) + 3)
    label, found = topology.basin_regions(h, regions=3)
    assert found >= 1 and label[10, 10] == 1


@pytest.mark.parametrize("order", [2, 3, 4, 5])
@pytest.mark.parametrize("n", [2, 3, 7, 90])
def test_splines_of_all_orders(order, n):
    """Against the system of equations that makes the spline pass through all samples, with mirrored ends."""
    rng = np.random.default_rng(order * n)
    values = rng.normal(size=n)

    def row(at):
        out = np.zeros(n)
        for k in range(int(at) - 8, int(at) + 9):
            m = abs(k) % (2 * n - 2)
            out[2 * n - 2 - m if m >= n else m] += raster.basis(order, np.array([at - k]))[0]
        return out

    c = np.linalg.solve(np.array([row(i) for i in range(n)]), values)
    assert np.allclose(raster.spline_coefficients(values[:, None], order)[:, 0], c)
    at = np.r_[np.arange(n), rng.uniform(0, n - 1, 20)]
    got = raster.resample(values[:, None], at[:, None], np.zeros((len(at), 1)), order)[:, 0]
    assert np.allclose(got, [row(a) @ c for a in at])
    assert np.allclose(got[:n], values)


@pytest.mark.parametrize("kind", ["<u1", "<i2", "<u2", "<f4", "<f8"])
def test_tiffs_come_back(kind):
    a = np.arange(15).reshape(3, 5).astype(kind)
    back = files.decode_tiff(files.encode_tiff(a))
    assert back.dtype == a.dtype and (back == a).all()
