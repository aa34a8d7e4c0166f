"""Queries that write their tables in the library's formats and read them back, with what readers hand on."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridfold.functions import radiometry as rad
from gridfold.operators import bands, clusters, explorer, footprints, raster, serving, topology, training
from gridfold.plans import fixtures as fx
from gridfold.plans.maps import _placed
from gridfold.plans.registry import ORACLES, query, r6
from gridfold.plans.spectra import _WIDE, NAMES, _wide
from gridfold.session import shared_folder
from gridfold.sources import codec, files
from gridfold.sources.store import Store

#: Rows of a scene that is cut from the elevation grid.
TALL = 20
BANDS = ["B01", "B70", "B71"]


def _folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _pixels(spark, sf_dir):
    """The elevation grid as scenes of three bands: the height, the height where it is 20 or more, and less the height."""
    h = F.col("h")
    return fx.elevation(spark, sf_dir).select(F.format_string("S%04d", F.floor(F.col("y") / TALL)).alias("scene_id"), (F.col("y") % TALL).alias("y"), "x", F.array(h, F.when(h >= 20, h).otherwise(0.0), -h).alias("spectrum"))


_SCENES = f"{fx.ELEVATION}, px AS (SELECT printf('S%04d', y // {TALL}) scene_id, y // {TALL} place, y % {TALL} y, x, h, CASE WHEN h >= 20 THEN h ELSE 0 END high FROM dem)"


def _unpacked(rows):
    """Pixels of one-band rows."""
    return codec.pixels(rows.select("scene_id", F.create_map().cast("map<string,string>").alias("metadata"), F.array("band").alias("bands"), "height", "width", F.array("data").alias("data")))


@query(f"WITH {_SCENES} SELECT scene_id scene, y, x, 'B01,B71' bands, h, -h negative FROM px")
def scenes_from_lines(spark, sf_dir):
    """Scenes as records of one line each, read with some of their bands, in name order; absent ones aren't missed."""
    where = _folder(spark, "lines")
    codec.write_scenes(codec.gathered(_pixels(spark, sf_dir), BANDS), where)
    p = codec.pixels(codec.read_scenes(spark, where, ["B71", "B01", "B99"])).where(F.col("spectrum")[0] > 0)
    return p.select(F.col("metadata")["scene"].alias("scene"), "y", "x", F.array_join("bands", ",").alias("bands"), F.col("spectrum")[0].alias("h"), F.col("spectrum")[1].alias("negative"))


@query(f"WITH {_SCENES} SELECT scene_id, 'B70' band, y, x, high FROM px WHERE high > 0")
def scenes_by_band(spark, sf_dir):
    """Scenes laid out by band, one band of them read."""
    where = _folder(spark, "bands")
    codec.write_by_band(codec.gathered(_pixels(spark, sf_dir), BANDS), where)
    p = _unpacked(codec.read_by_band(spark, where, ["B70"])).where(F.col("spectrum")[0] > 0)
    return p.select("scene_id", F.col("bands")[0].alias("band"), "y", "x", F.col("spectrum")[0].alias("high"))


@query("SELECT c_mktsegment AS \"key\", c_name AS \"value\" FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def pairs_of_keys(spark, sf_dir):
    """Pairs of a sequence file whose keys are wanted."""
    where = _folder(spark, "pairs")
    files.write_pairs(fx.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("key"), F.col("c_name").alias("value")), where)
    return files.read_pairs(spark, where, ["BUILDING", "MACHINERY"])


@query("SELECT n_nationkey::VARCHAR AS \"key\", n_name AS name, n_regionkey::VARCHAR region FROM nation")
def header_groups(spark, sf_dir):
    """Groups of header files, a nested one beside its parent."""
    where = _folder(spark, "headers")
    text = F.format_string('GROUP = OUTER\n REGION = %s\n GROUP = PRODUCT\n  NAME = "%s"\n  KEY = %s\n END_GROUP = PRODUCT\nEND_GROUP = OUTER\nEND\nKEY = 0', "n_regionkey", "n_name", "n_nationkey")
    fx.table(spark, sf_dir, "nation").select("n_nationkey", text.alias("value")).write.partitionBy("n_nationkey").text(where)
    g = files.read_headers(spark, where)
    return g.select(F.col("groups")["PRODUCT"]["KEY"].alias("key"), F.col("groups")["PRODUCT"]["NAME"].alias("name"), F.col("groups")["OUTER"]["REGION"].alias("region"))


@query("SELECT n_nationkey AS \"key\", n_name AS name, n_regionkey region FROM nation")
def xml_elements(spark, sf_dir):
    """Elements of XML files; of repeated names the last."""
    where = _folder(spark, "xml")
    text = F.format_string("<granule><name>x</name><name>%s</name><place><key>%s</key><region>%s</region></place></granule>", "n_name", "n_nationkey", "n_regionkey")
    fx.table(spark, sf_dir, "nation").select("n_nationkey", text.alias("value")).write.partitionBy("n_nationkey").text(where)
    at = lambda p: F.get_json_object("json", f"$.granule.{p}")
    return files.read_xml(spark, where).select(at("place.key").cast("int").alias("key"), at("name").alias("name"), at("place.region").cast("int").alias("region"))


def _rasters(spark, sf_dir, where):
    """Band files of the scenes in a folder."""
    rows = codec.gathered(_pixels(spark, sf_dir), BANDS).select("scene_id", "height", "width", F.explode(F.arrays_zip("bands", "data")).alias("p"))
    encode = F.udf(lambda data, height, width: files.encode_tiff(codec.np.frombuffer(data, "<f8").reshape(height, width)), "binary")
    files.write_files(rows.select(F.concat("scene_id", F.lit("_"), "p.bands", F.lit("_L1T.TIF")).alias("name"), encode("p.data", "height", "width").alias("content")), where)


@query(f"WITH {_SCENES} SELECT scene_id, 'B01' band, y, x, round(h / 40, 6) radiance FROM px UNION ALL SELECT scene_id, 'B71', y, x, round(-h / 80, 6) FROM px")
def band_rasters(spark, sf_dir):
    """Wanted bands of raster files, calibrated as they are read."""
    where = _folder(spark, "rasters")
    _rasters(spark, sf_dir, where)
    p = _unpacked(files.read_bands(spark, where, ["B01", "B71"], require_all=True))
    band, value = F.col("bands")[0], F.col("spectrum")[0]
    factor = rad.calibration(rad.band_number(band), F.lit(40.0), F.lit(80.0), F.lit(True))
    return p.where(value != 0).select("scene_id", band.alias("band"), "y", "x", r6(value * factor, "radiance"))


@query(f"WITH {_SCENES} SELECT scene_id, y - 2 y, x - 5 x, h FROM px WHERE y BETWEEN 2 AND 9 AND x BETWEEN 5 AND 24")
def raster_windows(spark, sf_dir):
    """A window of raster files' rows and columns."""
    where = _folder(spark, "windows")
    _rasters(spark, sf_dir, where)
    p = _unpacked(files.read_bands(spark, where, ["B01"], window=(slice(2, 10), slice(5, 25))))
    return p.where(F.col("spectrum")[0] > 0).select("scene_id", "y", "x", F.col("spectrum")[0].alias("h"))


@query(f"WITH {_SCENES} SELECT scene_id granule, (y // 10)::INT qy, (x // 10)::INT qx, (y % 10)::INT y, (x % 10)::INT x, h FROM px")
def granule_quadrants(spark, sf_dir):
    """Elevation files read and cut into parts of 10 x 10."""
    where = _folder(spark, "granules")
    rows = codec.gathered(_pixels(spark, sf_dir), BANDS)
    encode = F.udf(lambda data, height, width: files.encode_tiff(codec.np.frombuffer(data, "<f8").reshape(height, width).astype("<i2")), "binary")
    files.write_files(rows.select(F.concat("scene_id", F.lit("_dem.tif")).alias("name"), encode(F.col("data")[0], "height", "width").alias("content")), where)
    return topology.quadrants(files.read_granules(spark, where).where("h > 0"), 10)


@query(f"WITH {fx.POINTS} SELECT lon, lat, ts, intensity FROM points WHERE intensity IS NOT NULL")
def spots_from_lines(spark, sf_dir):
    """Bright points written as lines and read again."""
    where = _folder(spark, "spots")
    files.write_spots(fx.points(spark, sf_dir).where("intensity is not null"), where)
    return files.read_spots(spark, where)


@query(f"WITH {fx.ELEVATION} SELECT CASE WHEN h < 20 THEN 'water' ELSE 'land' END AS \"class\", (h < 20)::INT label, round(h / 8, 5) f0, x::DOUBLE f1 FROM dem")
def training_from_lines(spark, sf_dir):
    """Labelled rows of two classes as aligned text below folders named by class, and back."""
    where = _folder(spark, "training")
    dem = fx.elevation(spark, sf_dir).select("h", F.array(F.col("h") / 8, F.col("x").cast("double")).alias("features"))
    rows = training.labelled({"water": dem.where("h < 20"), "land": dem.where("h >= 20")})
    for name in ("land", "water"):  # a folder a class
        training.text_lines(rows.where(F.col("class") == name)).write.text(f"{where}/{name}")
    lines = files.read_training(spark, where)
    back = [training.from_lines(lines.where(F.col("class") == name)).withColumn("class", F.lit(name)) for name in ("land", "water")]
    return back[0].unionByName(back[1]).select("class", "label", F.round(F.col("features")[0], 5).alias("f0"), F.col("features")[1].alias("f1"))


@query("SELECT printf('%08d', c_custkey) row_key, CASE WHEN c_custkey % 10 = 0 THEN 0e0 ELSE c_acctbal END balance FROM customer WHERE c_custkey NOT BETWEEN 30 AND 99")
def store_ranges(spark, sf_dir):
    """A stored table: dropped, made anew, written to by key, and a range of keys deleted."""
    store = Store(spark, _folder(spark, "store"), ["row_key"])
    rows = fx.table(spark, sf_dir, "customer").select(F.format_string("%08d", "c_custkey").alias("row_key"), F.col("c_acctbal").alias("balance"))
    store.upsert(rows.withColumn("balance", F.lit(-1.0)))
    store.drop()
    store.upsert(rows)
    store.upsert(rows.where("row_key like '%0'").withColumn("balance", F.lit(0.0)))
    store.delete("row_key", "00000030", "00000099")
    return store.read()


@query("SELECT n_name directory, n_nationkey * 100 acquisition_start, n_regionkey + 0.5e0 radiance, 2 corners, n_nationkey::DOUBLE lon FROM nation")
def catalog_scenes(spark, sf_dir):
    """Scenes of a catalogue file."""
    where = _folder(spark, "catalog")
    k = F.col("n_nationkey").cast("double")
    scene = F.struct(F.col("n_name").alias("directory"), (F.col("n_nationkey") * 100).alias("acquisition_start"), (F.col("n_regionkey") + 0.5).alias("radiance"), F.array(F.array(k, -k), F.array(k + 1, k)).alias("corners"))
    # the nations are a fixed 25
    fx.table(spark, sf_dir, "nation").agg(F.to_json(F.struct(F.collect_list(scene).alias("data"))).alias("value")).write.text(where)
    c = files.read_catalog(spark, where)
    return c.select("directory", "acquisition_start", "radiance", F.size("corners").alias("corners"), F.col("corners")[0]["lon"].alias("lon"))


@query(f"""WITH {_SCENES} SELECT scene_id, '{{"height":' || max(y) + 1 || ',"width":' || max(x) + 1 || ',"depth":3}}' dimensions, '["B01","B70","B71"]' band_names FROM px GROUP BY scene_id""")
def scene_dimensions(spark, sf_dir):
    """Dimensions and band names of scenes as JSON."""
    rows = codec.gathered(_pixels(spark, sf_dir), BANDS).withColumn("depth", F.size("bands"))
    return explorer.dimensions_json(rows)


@query(f"""WITH {fx.ELEVATION}, c AS (SELECT x, '[' || string_agg('[' || h || ',' || -h || ']', ',' ORDER BY y) || ']' col FROM dem WHERE x BETWEEN 3 AND 6 AND y BETWEEN 1 AND 3 GROUP BY x)
SELECT '{{"bands":["B01","B71"],"metadata":"{{}}","picture":[' || string_agg(col, ',' ORDER BY x) || '],"shape":[4,3,2]}}' AS "json" FROM c""")
def rectangle_as_json(spark, sf_dir):
    """A rectangle of four by three pixels, corners given in either order, as JSON."""
    p = fx.elevation(spark, sf_dir).where(explorer.in_rectangle(7, 4, 3, 1, fx.DEM_WIDE, 1 << 20)).select("y", "x", F.array(F.col("h"), -F.col("h")).alias("spectrum"))
    return explorer.rectangle_json(p, ["B01", "B71"])


@query(f"""WITH {fx.POINTS}, k AS (SELECT printf('T10-%05d-%05d', long_index, lat_index) tile, ts, printf('%016x', id) identifier, id FROM placed WHERE long_index BETWEEN 500 AND 700 AND lat_index BETWEEN 300 AND 500)
SELECT '{{"data":[' || coalesce(string_agg('{{"tile":"' || tile || '","ts":' || ts || ',"identifier":"' || identifier || '","id":' || id || '}}', ',' ORDER BY tile, ts, identifier), '') || ']}}' AS "json" FROM k""")
def points_as_json(spark, sf_dir):
    """Points of a box as the JSON of a response."""
    from gridfold.functions import tiling

    rows = serving.features(_placed(spark, sf_dir), (500, 700, 300, 500)).withColumn("tile", tiling.tile_name(tiling.DEEPEST, "long_index", "lat_index"))
    return serving.features_json(rows, ["id"])


@query(f"""WITH {fx.POINTS}, box AS (SELECT id, ts FROM placed WHERE long_index BETWEEN 100 AND 900 AND lat_index BETWEEN 200 AND 1500)
SELECT 'points' command, id FROM box WHERE ts >= 1704500000 UNION ALL SELECT 'polygons', id FROM placed WHERE id % 2 = 0""")
def answered_requests(spark, sf_dir):
    """Answers to requests by command: a bound that isn't a number takes no rows, a time or depth that isn't one counts as absent."""
    rows = _placed(spark, sf_dir)
    images = spark.createDataFrame([], "depth int, long_index long, lat_index long, layer string, ts long, rgba string, metadata string")
    box = {"longmin": "100", "longmax": "900", "latmin": "200", "latmax": "1500"}
    asked = [box | {"command": "points", "timemin": "1704500000", "timemax": "soon", "groupdepth": "deep"}, box | {"command": "points", "latmin": "south"}, {"command": "polygons", "longmin": "7"}]
    parts = [serving.respond(r, images, rows, rows.where("id % 2 = 0")).select(F.lit(r["command"]).alias("command"), "id") for r in asked]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query(f"""WITH {fx.ELEVATION} SELECT y, x, CASE WHEN x % 3 = 0 THEN 0 ELSE h END b1, CASE WHEN x % 3 = 0 THEN 0 ELSE -h END b2, h * h superintensity, floor((x / 50e0) / 1 * 3600)::INT py, floor((y / 1000e0) / 1 * 3600)::INT px,
printf('lat=%.3f&lng=%.3f&z=10', y / 8e0, x / 4e0) place FROM dem""")
def pixel_views(spark, sf_dir):
    """Bands cut by a mask, squared intensities, places in a granule and on a map."""
    y, x, h = F.col("y"), F.col("x"), F.col("h")
    s, at = bands.masked(F.array(h, -h), (x % 3) / 100.0), topology.degrees_to_pixel(y / 1000.0, x / 50.0, 0.0, 0.0)
    return fx.elevation(spark, sf_dir).select("y", "x", s[0].alias("b1"), s[1].alias("b2"), rad.superintensity(h).alias("superintensity"), at["y"].alias("py"), at["x"].alias("px"), footprints.geo_center(y / 8.0, x / 4.0, 10).alias("place"))


@query("""SELECT l_orderkey, l_linenumber AS number, round(l_extendedprice / (100 + l_linenumber * 10e0), 9) reflected, round(l_extendedprice / (100 + (l_linenumber + 1) * 10e0), 9) legacy FROM lineitem""")
def irradiance_rows(spark, sf_dir):
    """Radiances over a table of irradiances, by the band's own row and by the next one."""
    table = spark.range(1, 10).select(F.col("id").cast("int").alias("number"), (100 + F.col("id") * 10.0).alias("irradiance"))
    rows = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("number"), F.col("l_extendedprice").alias("radiance"))
    own = rad.with_irradiance(rows, table).withColumnRenamed("reflected", "own")
    return rad.with_irradiance(own, table, legacy_index=True).select("l_orderkey", "number", F.round("own", 9).alias("reflected"), F.round("reflected", 9).alias("legacy"))


_SUN = ", ".join(f"({a}, {x})" for a, x in rad.EARTH_SUN)
_E = ", ".join(f"({k}, {v}e0)" for k, v in rad.IRRADIANCE.items())


@query(f"""WITH t AS (SELECT a::INT a, x::DOUBLE x FROM (VALUES {_SUN}) v(a, x)), s AS (SELECT a, x, lead(a) OVER (ORDER BY a) b, lead(x) OVER (ORDER BY a) y FROM t),
e AS (SELECT * FROM (VALUES {_E}) v(n, e)), l AS (SELECT l_orderkey, l_linenumber + 1 n, l_quantity v, l_orderkey % 2 = 0 hyper, dayofyear(l_shipdate) d, 20 + l_orderkey % 60 el FROM lineitem),
r AS (SELECT l.*, CASE WHEN hyper THEN v / (1000 + n) ELSE (v * 30 * 0.02e0 - 3.4e0) / e END r FROM l LEFT JOIN e USING (n))
SELECT l_orderkey, n AS number, round(pi() * pow(x + (d - a) * ((y - x) / (b - a)), 2) * r / sin(radians(el)), 6) corrected FROM r JOIN s ON d >= a AND (d < b OR (d = 366 AND b = 366))""")
def corrected_radiance(spark, sf_dir):
    """The whole correction: counts to radiance, irradiance by instrument, and the sun's distance and height."""
    table = spark.createDataFrame([(False, k, v) for k, v in rad.IRRADIANCE.items()] + [(True, k, 1000.0 + k) for k in range(1, 10)], "hyperspectral boolean, number int, irradiance double")
    k = F.col("l_orderkey")
    rows = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", (k % 2 == 0).alias("hyperspectral"), (F.col("l_linenumber") + 1).alias("number"), F.col("l_quantity").cast("double").alias("value"),
        F.lit(0.02).alias("factor"), F.lit(-3.4).alias("offset"), F.dayofyear("l_shipdate").alias("day"), (20 + k % 60).alias("elevation"))
    return rad.corrected(rows, table).select("l_orderkey", "number", r6("corrected", "corrected"))


@query(f"WITH {_SCENES} SELECT scene_id, y, x, 'B01,B70,B71,SUM,TWICE' bands, h + high - h \"sum\", 2 * (h + high - h) twice FROM px")
def registered_functions(spark, sf_dir):
    """Scene functions by name, one after the other, each adding a band that the next one reads."""
    known = bands.Registry()

    @known.register("sum")
    def _(p):
        return bands.with_band(p, "SUM", F.aggregate("spectrum", F.lit(0.0), lambda s, v: s + v))

    @known.register("twice")
    def _(p):
        return bands.with_band(p, "TWICE", F.element_at("spectrum", -1) * 2)

    p = _pixels(spark, sf_dir).withColumn("bands", F.array(*[F.lit(b) for b in BANDS]))
    s = F.col("spectrum")
    return known.apply(p, ["sum", "twice"]).select("scene_id", "y", "x", F.array_join("bands", ",").alias("bands"), F.element_at(s, -2).alias("sum"), F.element_at(s, -1).alias("twice"))


_BYTE = "trunc(least(greatest(({v} - {lo}) / ({hi} - {lo}) * 255, 0), 255))::INT"


@query(f"""WITH {_SCENES}, p AS (SELECT place, quantile_cont(h, 0.05) FILTER (h > 10) h5, quantile_cont(h, 0.95) FILTER (h > 10) h95, quantile_cont(high, 0.05) FILTER (high > 10) g5, quantile_cont(high, 0.95) FILTER (high > 10) g95 FROM px GROUP BY place),
q AS (SELECT px.*, least(h5, g5) lo, greatest(h95, g95) hi, h5, h95, CASE WHEN h > 10 THEN 255 ELSE 0 END a, greatest(400 * sin(radians(5)), 10) sun FROM px JOIN p USING (place)),
v AS (SELECT *, {_BYTE.format(v="h", lo="lo", hi="hi")} hv, {_BYTE.format(v="high", lo="lo", hi="hi")} gv, {_BYTE.format(v="h", lo="h5", hi="h95")} grey, {_BYTE.format(v="h", lo="0", hi="sun")} yellow FROM q)
SELECT 'T06-' || printf('%05d', place) || '-00000-RGB-0000001000' AS "key", y, x, 0 r, gv g, hv b, a FROM v UNION ALL
SELECT 'T06-' || printf('%05d', place) || '-00000-GREY-0000001000', y, x, grey, grey, grey, a FROM v UNION ALL SELECT 'T06-' || printf('%05d', place) || '-00000-YELLOW-0000001000', y, x, yellow, yellow, 0, CASE WHEN a > 0 THEN yellow ELSE 0 END FROM v""")
def rendered_pixels(spark, sf_dir):
    """Tiles rendered to three layers between percentiles or up to the sun's range, written as PNG files, and their pixels read back."""
    where = _folder(spark, "png")
    p = _pixels(spark, sf_dir).withColumn("spectrum", F.concat("spectrum", F.array(F.when(F.col("spectrum")[0] > 10, 1.0).otherwise(0.0))))
    scenes = codec.gathered(p, [*BANDS, "MASK"], (TALL, fx.DEM_WIDE))
    meta = F.create_map(F.lit("timestamp"), F.lit("1000"), F.lit("SUN_ELEVATION"), F.lit("5"))
    tiles = scenes.select("scene_id", F.lit(6).alias("depth"), F.substring("scene_id", 2, 9).cast("long").alias("long_index"), F.lit(0).cast("long").alias("lat_index"), "bands", "data", meta.alias("metadata"))
    layers = [raster.Layer("RGB", ("B71", "B70", "B01")), raster.Layer("GREY", ("B01",), "grey"), raster.Layer("YELLOW", ("B01",), "yellow", 0.0, "sun")]
    files.write_files(raster.image_files(raster.render(tiles, layers, fx.DEM_WIDE, TALL)), where)
    read = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").load(where)
    pixels = raster.image_pixels(read.select(F.regexp_extract("path", r"([^/]+)\.png$", 1).alias("key"), F.col("content").alias("png")), ["key"])
    # cells without a part have no row in the SQL
    return pixels.withColumn("place", F.substring("key", 5, 5)).join(p.select(F.concat(F.lit("0"), F.substring("scene_id", 2, 4)).alias("place"), "y", "x"), ["place", "y", "x"], "left_semi").drop("place")


@query("SELECT n_name AS name, (n_nationkey * 100)::BIGINT bytes FROM nation WHERE n_nationkey > 10")
def listed_files(spark, sf_dir):
    """Files of more than a thousand bytes, by name, unread."""
    where = _folder(spark, "listed")
    nations = fx.table(spark, sf_dir, "nation")
    files.write_files(nations.select(F.concat("n_name", F.lit(".serialized")).alias("name"), F.repeat(F.lit("x"), (F.col("n_nationkey") * 100).cast("int")).cast("binary").alias("content")), where)
    return files.listed(spark, where, 1000)


@query(ORACLES["cluster_statistics"])
def model_statistics(spark, sf_dir):
    """Statistics of points by the centres of a clustering model's file."""
    listed = "".join(f'<Cluster id="{c}"><Array n="2" type="real">{-150 + c * 33} {c * 37 % 120 - 60}</Array></Cluster>' for c in range(10))
    text = f'<PMML xmlns="http://www.dmg.org/PMML-4_1"><ClusteringModel numberOfClusters="10"><ClusteringField field="lon"/><ClusteringField field="lat"/>{listed}</ClusteringModel></PMML>'
    model = files.parse_cluster_model(text)
    centers = spark.createDataFrame([(int(i), *c) for i, c in zip(model["ids"], model["centers"], strict=True)], "cluster int, clon double, clat double")
    weight = rad.superintensity(F.col("intensity"))
    stats = clusters.statistics(clusters.assign(fx.clustered(spark, sf_dir).withColumn("weight", weight), centers))
    return stats.select("cluster", "n", F.round("total", 4).alias("total"), "highest", r6("rms", "rms"), r6("weighted_rms", "weighted_rms"), "ts")


@query(f"WITH {fx.ELEVATION} SELECT CASE WHEN h < 20 THEN 'water' ELSE 'land' END AS \"class\", (h < 20)::INT label, y, x::DOUBLE f0, h f1 FROM dem WHERE y % 4 <> 1")
def training_rows(spark, sf_dir):
    """A training set of two classes: lit pixels, two of their bands, no class with more than the first has."""
    dem = fx.elevation(spark, sf_dir)
    value = lambda c: F.when(F.col("y") % 4 == 1, 0.0).otherwise(c)
    p = dem.select((F.col("y") * 1000 + F.col("x")).alias("id"), "h", F.array(value(F.col("h")), value(F.lit(1.0)), value(F.col("x").cast("double"))).alias("spectrum"))
    rows = training.training_set({"water": p.where("h < 20"), "land": p.where("h >= 20")}, [2, 0], most=1 << 40)
    return rows.select("class", "label", F.floor(F.col("id") / 1000).cast("int").alias("y"), F.col("features")[0].alias("f0"), F.col("features")[1].alias("f1"))


@query(f"""WITH {_WIDE}, part AS (SELECT * FROM wide WHERE x BETWEEN 3 AND 9 AND y BETWEEN 1 AND 6)
SELECT 'scatter' command, round(B01 - B02, 6) a, round(B03 / 2, 6) b, NULL message FROM part WHERE B01 <> 0 AND B02 <> 0 AND B03 <> 0
UNION ALL SELECT 'image', r, CASE WHEN B03 <> 0 THEN 255 ELSE 0 END, NULL FROM (SELECT *, least(greatest(floor(B01 / 200 * 256), 0), 255) r FROM part)
UNION ALL SELECT NULL, NULL, NULL, 'Missing command.' UNION ALL SELECT 'paint', NULL, NULL, 'Unrecognized command "paint".'""")
def explored_requests(spark, sf_dir):
    """Answers of one scene to requests by command, with messages for a missing and an unknown one."""
    wide = _wide(spark, sf_dir)
    scenes = spark.createDataFrame([("s", 1 << 20, fx.PIXELS_WIDE, 12, NAMES[:12])], "scene_id string, height int, width int, depth int, bands array<string>")
    box = {"x1": "10", "y1": "7", "x2": "3", "y2": "1"}
    ask = lambda r: explorer.respond(r, wide, scenes, NAMES[:12], (1 << 20, fx.PIXELS_WIDE))
    row = lambda df, command, a=None, b=None, message=None: df.select(F.lit(command).alias("command"), *[(F.lit(None) if c is None else c).cast(k).alias(n) for n, k, c in (("a", "double", a), ("b", "double", b), ("message", "string", message))])
    parts = [
        row(ask(box | {"command": "scatter", "horizontal": "B01 - B02", "vertical": "B03 / 2"}), "scatter", F.round("horizontal", 6), F.round("vertical", 6)),
        row(ask(box | {"command": "image", "red": "B01", "green": "B03", "blue": "B01", "low": "0", "high": "200"}), "image", F.col("r"), F.col("a")),
        row(ask(box), None, message=F.col("message")),
        row(ask({"command": "paint"}), "paint", message=F.col("message")),
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey = 7")
def one_row(spark, sf_dir):
    """The row of a key, whose absence is an error."""
    return serving.one(fx.table(spark, sf_dir, "customer"), "c_name", "Customer#000000007").select("c_custkey", "c_name")
