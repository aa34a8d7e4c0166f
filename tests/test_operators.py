"""Operators on small inputs whose results are known."""

import numpy as np
from pyspark.sql import functions as F

from gridfold.functions import geodesy
from gridfold.operators import bands, clusters, explorer, footprints, raster, rollup, runs, serving, spectral, topology, training


def test_k_means_and_growth(spark):
    rng = np.random.default_rng(1)
    centers = np.array([[0.0, 0.0], [5.0, 0.0], [0.0, 5.0]])
    v = np.concatenate([c + 0.2 * rng.normal(size=(40, 2)) for c in centers])
    pixels = spark.createDataFrame([(i, a.tolist()) for i, a in enumerate(v)], "id long, spectrum array<double>")
    start = spark.createDataFrame([(0, [1.0, 1.0]), (1, [4.0, 1.0]), (2, [1.0, 4.0]), (3, [99.0, 99.0])], "cluster int, center array<double>")
    found = {r.cluster: r.center for r in spectral.k_means(pixels, start, ["id"]).collect()}
    for k in range(3):
        assert np.allclose(found[k], v[40 * k : 40 * k + 40].mean(0))
    assert found[3] == [99.0, 99.0]  # without pixels a centre stays
    best = spectral.best_start(pixels, 3, ["id"], trials=3, of=60)
    assert best.count() == 3
    labels = spark.createDataFrame([(0, x, [float(x)], 7 if x == 0 else -1) for x in range(6)], "y int, x int, spectrum array<double>, cluster int")
    grown = {r.x: r.cluster for r in spectral.region_growth(labels, 6, 1, steps=2).collect()}
    assert grown == {0: 7, 1: 7, 2: 7, 3: -1, 4: 7, 5: 7}  # around the ends


def test_blended(spark):
    rows = [(1, 1, 200, 0, 0, 255), (1, 2, 0, 200, 0, 128), (2, 1, 10, 20, 30, 0)]
    got = {r.k: r for r in serving.blended(spark.createDataFrame(rows, "k int, ts long, r int, g int, b int, a int"), ["k"]).collect()}
    assert (got[1].r, got[1].g, got[1].a) == (100, 100, 255) and (got[2].r, got[2].a) == (0, 0)


def test_requests(spark):
    points = spark.createDataFrame([(1, 1, 5, "a"), (2, 2, 7, "b")], "long_index long, lat_index long, ts long, identifier string")
    box = {"longmin": "0", "longmax": "9", "latmin": "0", "latmax": "9"}
    assert serving.features_of_request(points, box).count() == 2
    assert serving.features_of_request(points, box | {"latmax": "x"}).count() == 0
    assert serving.features_of_request(points, box | {"groupdepth": "4"}).count() == 1
    assert serving.features_of_request(points, {"timemax": "6"}).count() == 1
    assert serving.one(points, "identifier", "a").count() == 1
    try:
        serving.one(points, "identifier", "z")
        raise AssertionError("a missing key is an error")
    except KeyError:
        pass


def test_json(spark):
    import json

    pixels = spark.createDataFrame([(0, 0, [1.0, 2.0]), (1, 0, [3.0, 4.0]), (0, 1, [5.0, 6.0]), (1, 1, [7.0, 8.0])], "y int, x int, spectrum array<double>")
    got = json.loads(explorer.rectangle_json(pixels, ["B1", "B2"], 'quo"te').first().json)
    assert got == {"bands": ["B1", "B2"], "metadata": 'quo"te', "picture": [[[1, 2], [3, 4]], [[5, 6], [7, 8]]], "shape": [2, 2, 2]}
    rows = spark.createDataFrame([("t2", 1, "b", 1.0), ("t1", 2, "a", 2.0)], "tile string, ts long, identifier string, lon double")
    assert [x["tile"] for x in json.loads(serving.features_json(rows, ["lon"]).first().json)["data"]] == ["t1", "t2"]
    scene = spark.createDataFrame([("s", 2, 3, 4, ["B1"])], "scene_id string, height int, width int, depth int, bands array<string>")
    assert json.loads(explorer.dimensions_json(scene).first().dimensions) == {"height": 2, "width": 3, "depth": 4}


def test_registry(spark):
    registry = bands.Registry()

    @registry.register("doubled")
    def doubled(df):
        return bands.with_band(df, "TWICE", F.col("spectrum")[0] * 2)

    df = spark.createDataFrame([(["B1"], [2.0])], "bands array<string>, spectrum array<double>")
    got = registry.apply(df, ["doubled", "doubled"]).first()
    assert got.bands == ["B1", "TWICE", "TWICE"] and got.spectrum == [2.0, 4.0, 4.0]
    try:
        registry.apply(df, ["nothing"])
        raise AssertionError("an unknown function is an error")
    except KeyError:
        pass


def test_footprint_across_the_antimeridian(spark):
    corners = F.array(*[F.struct(F.lit(lon).alias("lon"), F.lit(lat).alias("lat")) for lon, lat in ((179.5, 1.0), (-179.5, 1.0), (-179.5, 0.0), (179.5, 0.0))])
    scenes = spark.range(1).select(F.lit("s").alias("scene_id"), corners.alias("corners"), F.lit(5).cast("long").alias("ts"))
    r = footprints.polygons(scenes).first()
    assert abs(r.lon) == 180.0 and r.lat == 0.5 and len(r.polygon) == 5 and r.polygon[0] == r.polygon[4]
    assert {t.long_index for t in footprints.tiles_of(scenes, 5).collect()} == {0, 63}


def test_overlaps_come_from_one_tile(spark):
    """Small, wide and repeated boxes, on tile edges, at the poles and across the antimeridian, against brute force; pairs aren't shuffled."""
    rng = np.random.default_rng(5)
    wests, souths = rng.integers(-1800, 1800, 120) / 10, rng.integers(-900, 860, 120) / 10
    wests[:60], souths[:60] = rng.integers(-40, 40, 60) / 8, rng.integers(-20, 20, 60) * 1.40625
    sizes = rng.choice([0.5, 1.0, 2.8125, 40.0], (120, 2))
    turn = lambda v: float(v - 360 if v > 180 else v)
    rows = [(i, [(turn(x), float(y)), (turn(x + w), float(y)), (turn(x + w), float(min(y + h, 90))), (turn(x), float(min(y + h, 90)))]) for i, (x, y, (w, h)) in enumerate(zip(wests, souths, sizes, strict=True))]
    scenes = spark.createDataFrame(rows + rows[::7], "scene_id long, corners array<struct<lon: double, lat: double>>")
    made = footprints.overlapping(scenes)
    box = {r.scene_id: (r.west, r.east, r.south, r.north) for r in footprints.boxes(scenes).collect()}
    want = set()
    for i, (w, e, s, n) in box.items():
        want |= {(i, j) for j, b in box.items() if i != j and any(w <= v < e for v in b[:2]) and any(s <= v < n for v in b[2:])}
    assert sorted(map(tuple, made.collect())) == sorted(want) and len(want) > 100
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan[: plan.index("Join")]


def test_composite_of_equal_times(spark, tmp_path):
    import duckdb

    from gridfold.plans.catalog import ORACLES, QUERIES
    from gridfold.plans.maps import _images

    # at the last second of each place come several images, of any order of intensity; some have no intensity
    path = str(tmp_path / "events.parquet")
    duckdb.sql(f"""copy (select i event_id, timestamp '2024-01-01 10:00:00' + to_microseconds(((i // 40) * 1000000 + i % 40)::bigint) ts, (i % 3)::bigint user_id, 'view' event_type,
      case when i % 11 <> 1 then (i * 37 % 101)::double end "value", '{{"k": 1}}' props from range(1, 400) t(i)) to '{path}' (format parquet)""")
    duck = duckdb.connect()
    duck.sql(f"create view events as select * from '{path}'")
    names = ["long_index", "lat_index", "r", "g", "b", "a"]
    want = duck.sql(f"select {', '.join(names)} from ({ORACLES['composite']})").fetchall()
    got = lambda df: sorted(tuple(r[n] for n in names) for r in df.collect())
    assert got(QUERIES["composite"](spark, str(tmp_path))) == sorted(want) and len(want) > 2
    backwards = _images(spark, str(tmp_path)).orderBy(F.desc("id"))
    assert got(serving.composite(backwards, ["long_index", "lat_index"], ("id",))) == sorted(want)


def test_parents_take_the_first_child(spark):
    tiles = spark.createDataFrame([(3, 4, 2, {"tileName": "a", "k": "first"}), (3, 5, 3, {"k": "second"})], "depth int, long_index long, lat_index long, metadata map<string,string>")
    r = rollup.parents(tiles, []).first()
    assert (r.depth, r.long_index, r.lat_index, r.children, r.quadrants, r.metadata) == (2, 2, 1, 2, [0, 3], {"k": "first"})


def test_runs_round_trip(spark):
    rng = np.random.default_rng(2)
    cells = [(k, i, float(v)) for k in range(3) for i, v in enumerate(rng.integers(0, 2, 30) * rng.integers(1, 9, 30))] + [(9, i, 0.0) for i in range(4)]
    df = spark.createDataFrame(cells, "k long, i long, v double")
    back = runs.dense(runs.runs(df, ["k"]), df.groupBy("k").agg(F.count(F.lit(1)).alias("size")), ["k"])
    assert sorted(map(tuple, back.collect())) == sorted(cells)


def test_wrapped_neighbours_against_numpy(spark):
    rng = np.random.default_rng(3)
    h = rng.integers(0, 50, (9, 11)).astype(float)
    grid = spark.createDataFrame([("g", y, x, float(h[y, x])) for y in range(9) for x in range(11)], "granule string, y int, x int, h double")
    got = topology.curvature(grid, arm=3).collect()
    up, left = np.roll(h, 1, 0), np.roll(h, 1, 1)
    gy = ((up - h).astype(int) + (h - np.roll(h, -1, 0)).astype(int)) / 2
    mean5 = (h + up + np.roll(h, -1, 0) + left + np.roll(h, -1, 1)) / 5
    cx = ((np.roll(mean5, 3, 1) - mean5).astype(int) - (mean5 - np.roll(mean5, -3, 1)).astype(int)) / 2
    for r in got:
        assert r.gy == gy[r.y, r.x] and abs(r.mean5 - mean5[r.y, r.x]) < 1e-9 and r.cx == cx[r.y, r.x]


def test_long_arms_carry_no_lines(spark):
    """Neighbours beyond the first, with and without a height, on lines shorter than the arm too; nothing gathers a line."""
    rng = np.random.default_rng(4)
    h = rng.integers(0, 50, (4, 7)).astype(float)
    h[1, 2] = h[3, 6] = h[0, 0] = np.nan
    cells = [("g", y, x, None if np.isnan(h[y, x]) else float(h[y, x])) for y in range(4) for x in range(7)]
    grid = spark.createDataFrame(cells, "granule string, y int, x int, h double")
    for by in (1, -1, 2, -2, 5, -5, 9):
        for axis, keys, k in (("y", ["granule", "x"], 0), ("x", ["granule", "y"], 1)):
            made = grid.withColumn("r", topology.rolled(F.col("h"), by, keys, axis))
            assert "collect_list" not in made._jdf.queryExecution().optimizedPlan().toString()
            want = np.roll(h, by, k)
            for r in made.collect():
                assert r.r == want[r.y, r.x] or (r.r is None and np.isnan(want[r.y, r.x])), (by, axis, r)
    for df in (topology.classified(grid, arm=5), topology.report(grid, arm=5)):
        assert "collect_list" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_report_shuffles_a_pixel_once(spark):
    """Granules of several blocks and of less than an arm: report and classes as by NumPy, with one shuffle of pixels."""
    import re

    sizes = {"a": (150, 140), "b": (3, 131)}
    heights = {g: (np.arange(h * w).reshape(h, w) * 7919 % 1009 % 83).astype(float) for g, (h, w) in sizes.items()}
    grid = None
    for g, (h, w) in sizes.items():
        cells = spark.range(h * w).select(F.lit(g).alias("granule"), F.floor(F.col("id") / w).cast("int").alias("y"), (F.col("id") % w).cast("int").alias("x"), (F.col("id") * 7919 % 1009 % 83).cast("double").alias("h"))
        grid = cells if grid is None else grid.union(cells)
    made = topology.report(grid, arm=2)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(block_#", plan)) == 1 and not re.search(r"Exchange hashpartitioning\([^)]*\b[xy]#", plan)
    rows = {r.granule: r for r in made.collect()}
    assert sorted(rows) == sorted(sizes)
    classes = {(r.granule, r.y, r.x): (r.cy, r.cx, r.flat, r.bowl, r.hill) for r in topology.classified(grid, arm=2).collect()}
    assert len(classes) == sum(h * w for h, w in sizes.values())
    for g, h in heights.items():
        falls = lambda v, by, k: (np.trunc(np.roll(v, by, k) - v), np.trunc(v - np.roll(v, -by, k)))
        m = (sum(falls(h, 1, 0)) / 2) ** 2 + (sum(falls(h, 1, 1)) / 2) ** 2
        mean5 = (h + np.roll(h, 1, 0) + np.roll(h, -1, 0) + np.roll(h, 1, 1) + np.roll(h, -1, 1)) / 5
        cy, cx = (np.subtract(*falls(mean5, 2, k)) / 2 for k in (0, 1))
        flat, bowl, hill = m < np.percentile(m, 60), np.minimum(cy, cx) >= 0, np.maximum(cy, cx) <= 0
        for (y, x), _ in np.ndenumerate(h):
            assert classes[g, y, x] == (cy[y, x], cx[y, x], flat[y, x], bowl[y, x], hill[y, x]), (g, y, x)
        want = [h.size, m.min(), m.max(), np.median(m), np.percentile(m, 90), *(100 * c.mean() for c in (flat, bowl, hill, flat & bowl)), len(np.unique(h)), h.min(), h.max()]
        assert np.allclose(list(rows[g])[1:], want, rtol=1e-12), (g, rows[g], want)


def test_terrain_with_pixels_missing(spark, tmp_path):
    """A last row that ends early, places without a pixel, and pixels without a height, as by the SQL."""
    import duckdb

    from gridfold.plans.catalog import ORACLES, QUERIES

    path = str(tmp_path / "part.parquet")
    duckdb.sql(f"copy (select i::bigint p_partkey, (case when i % 97 <> 3 then 1 + i * 37 % 101 % 50 end)::int p_size from range(627) t(i) where i % 113 <> 5) to '{path}' (format parquet)")
    duck = duckdb.connect()
    duck.sql(f"create view part as select * from '{path}'")
    for name in ("terrain_report", "terrain_classes"):
        got = QUERIES[name](spark, str(tmp_path))
        want = duck.sql(f"select {', '.join(got.columns)} from ({ORACLES[name]})").fetchall()
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want)), name


def test_utm_scene_in_tiles(spark):
    zone, northern = 33, True
    lon, lat = np.meshgrid(np.linspace(12.2, 17.8, 7), np.linspace(-60, 70, 9))
    there = geodesy.to_utm(lon, lat, zone, False)
    assert np.allclose(geodesy.from_utm(*there, zone, False, f=np), (lon, lat), atol=1e-8)
    # a scene whose two bands are its own longitudes and latitudes
    height, width, left, top, step = 90, 120, 470_000.0, 5_250_000.0, 1000.0
    east, north = np.meshgrid(left + (np.arange(width) + 0.5) * step, top - (np.arange(height) + 0.5) * step)
    planes = geodesy.from_utm(east, north, zone, northern, f=np)
    wkt = 'PROJCS["WGS 84 / UTM zone 33N",GEOGCS["WGS 84"]]'
    rows = [("u", ["LON", "LAT"], height, width, [left, step, 0.0, top, 0.0, -step], [p.astype("<f8").tobytes() for p in planes], {"k": "v"}, wkt), ("none", [], 0, 0, [0.0] * 6, [], None, None)]
    scenes = spark.createDataFrame(rows, "scene_id string, bands array<string>, height int, width int, transform array<double>, data array<binary>, metadata map<string,string>, projection string")
    tiles = raster.make_tiles(scenes, depth=9, width=32, height=16, order=1).collect()
    assert len(tiles) > 3 and len({(t.long_index, t.lat_index) for t in tiles}) == len(tiles)
    seen = 0
    for t in tiles:
        a, b, mask = (np.frombuffer(d, "<f8").reshape(16, 32) for d in t.data)
        want_lon = (t.long_index + (np.arange(32) + 0.5) / 32) / 1024 * 360 - 180
        want_lat = (t.lat_index + 1 - (np.arange(16) + 0.5) / 16) / 1024 * 180 - 90
        inside = mask > 0.999
        seen += inside.sum()
        assert t.bands == ["LON", "LAT", "MASK"] and t.metadata["k"] == "v"
        assert np.allclose(a[inside], np.broadcast_to(want_lon, a.shape)[inside], atol=1e-4) and np.allclose(b[inside], np.broadcast_to(want_lat[:, None], b.shape)[inside], atol=1e-4)
    assert seen > 1000


def test_bright_and_training(spark):
    rows = spark.createDataFrame([("a", float(i)) for i in range(11)] + [("b", 100.0 + i) for i in range(11)], "scene_id string, intensity double")
    assert clusters.bright(rows, "90%").count() == 2 and clusters.bright(rows, 5.0).count() == 16
    sets = {"water": rows.limit(3), "cloud": rows.limit(2)}
    assert {(r["class"], r.label) for r in training.labelled(sets).collect()} == {("cloud", 0), ("water", 1)}
    lines = training.text_lines(spark.createDataFrame([([1.5, -2.0], 3)], "features array<double>, label int"))
    assert lines.first().value == "1.50000      -2.00000     3"
    back = training.from_lines(lines).first()
    assert list(back.features) == [1.5, -2.0] and back.label == 3


def test_kernel_machine():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 2))
    y = (np.hypot(*x.T) > 1.1).astype(int)
    machine = training.KernelMachine(cost=100.0, gamma=1.0).fit(x[:200], y[:200])
    assert (machine.predict(x[200:]) == y[200:]).mean() > 0.9
