"""Queries of tiles, points, footprints and the catalogue."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridfold.functions import geodesy, tiling
from gridfold.operators import clusters, footprints, rollup, serving
from gridfold.plans import fixtures as fx
from gridfold.plans.registry import query, r6
from gridfold.session import shared_folder
from gridfold.sources.store import Store
from gridfold.streaming import ingest


def _placed(spark, sf_dir, clustered=False):
    rows = fx.clustered(spark, sf_dir) if clustered else fx.points(spark, sf_dir)
    return tiling.with_tile(rows).withColumn("identifier", tiling.hex16("id"))


def _images(spark, sf_dir, depth=6):
    """One-pixel tile images of clustered points."""
    up = F.lit(tiling.DEEPEST - depth)
    rows = _placed(spark, sf_dir, True).withColumns({"long_index": tiling.ancestor("long_index", up), "lat_index": tiling.ancestor("lat_index", up), "depth": F.lit(depth)})
    byte = lambda k: (F.floor(F.col("intensity") * k) % 256).cast("int")
    return rows.withColumns({"r": byte(1), "g": byte(2), "b": byte(3), "a": F.when(F.col("id") % 4 == 0, 0).otherwise(255), "rgba": F.when(F.col("id") % 4 != 0, F.col("id"))})


_IMAGES = fx.CLUSTERED + """,
images AS (SELECT *, 6 AS "depth", long_index >> 4 x, lat_index >> 4 y, floor(intensity)::BIGINT % 256 r, floor(intensity * 2)::BIGINT % 256 g, floor(intensity * 3)::BIGINT % 256 b,
  CASE WHEN id % 4 = 0 THEN 0 ELSE 255 END a FROM placed)"""


@query(f"""WITH {fx.CLUSTERED}, deep AS (SELECT *, unnest(range(0, 11)) d FROM placed)
SELECT d::INT "depth", printf('T%02d-%05d-%05d', d, long_index >> (10 - d)::INT, lat_index >> (10 - d)::INT) tile, layer, count(*) n, round(sum(intensity), 6) total, max(intensity) highest FROM deep GROUP BY ALL""")
def flagship_rollup(spark, sf_dir):
    """Count, sum and maximum of point intensities by tile and layer, at every depth of the quad-tree."""
    out = rollup.rolled_up(_placed(spark, sf_dir, True), ["layer"], "intensity")
    return out.withColumn("total", F.round("total", 6))


@query(f"""WITH {fx.POINTS} SELECT id, long_index, lat_index, printf('T%02d-%05d-%05d', 10, long_index, lat_index) tile,
printf('T%02d-%05d-%05d', 10, long_index, lat_index) || printf('-%010d-%016x', ts, id) row_key FROM placed""")
def point_tiles(spark, sf_dir):
    name = tiling.tile_name(10, "long_index", "lat_index")
    return _placed(spark, sf_dir).select("id", "long_index", "lat_index", name.alias("tile"), tiling.point_key(name, "ts", "identifier").alias("row_key"))


@query(f"""WITH {fx.POINTS} SELECT DISTINCT long_index, lat_index, long_index / 2048e0 * 360 - 180 lon_min, (long_index + 1) / 2048e0 * 360 - 180 lon_max,
lat_index / 2048e0 * 180 - 90 lat_min, (lat_index + 1) / 2048e0 * 180 - 90 lat_max, (long_index % 2)::INT dx, (lat_index % 2)::INT dy FROM placed""")
def tile_corners(spark, sf_dir):
    tiles = _placed(spark, sf_dir).select("long_index", "lat_index").distinct()
    return tiles.withColumn("c", tiling.corners(10, "long_index", "lat_index")).withColumn("q", tiling.quadrant("long_index", "lat_index")).select("long_index", "lat_index", "c.*", "q.*")


@query(f"""WITH {fx.POINTS}, named AS (SELECT printf('T%02d-%05d-%05d', 10, long_index, lat_index) tile, ts, printf('%016x', id) identifier FROM placed)
SELECT tile, ts, identifier, substr(tile, 2, 2)::INT "depth", substr(tile, 5, 5)::BIGINT x, substr(tile, 11, 5)::BIGINT y FROM named""")
def parsed_keys(spark, sf_dir):
    name = tiling.tile_name(10, "long_index", "lat_index")
    keys = _placed(spark, sf_dir).select(tiling.key_parts(tiling.point_key(name, "ts", "identifier")).alias("k")).select("k.*")
    at = keys.withColumn("p", tiling.parse_name("tile"))
    return at.select("tile", "ts", "identifier", F.col("p.depth").alias("depth"), F.col("p.long_index").alias("x"), F.col("p.lat_index").alias("y"))


@query(f"""WITH {_IMAGES}, t AS (SELECT DISTINCT x, y, layer, '{{}}' m FROM images)
SELECT 5 AS "depth", x >> 1 long_index, y >> 1 lat_index, layer, count(*) children, list_sort(list(DISTINCT (x % 2 + y % 2 * 2)::INT))::VARCHAR quadrants FROM t GROUP BY ALL""")
def tile_parents(spark, sf_dir):
    tiles = _images(spark, sf_dir).select("depth", "long_index", "lat_index", "layer").distinct().withColumn("metadata", F.create_map(F.lit("tileName"), F.lit("-"), F.lit("kept"), F.lit("1")))
    return rollup.parents(tiles, ["layer"]).select("depth", "long_index", "lat_index", "layer", "children", F.concat(F.lit("["), F.array_join("quadrants", ", "), F.lit("]")).alias("quadrants"))


@query(f"""WITH {_IMAGES} SELECT DISTINCT printf('T%02d-%05d-%05d', 2, x >> 4, y >> 4) ancestor, printf('T%02d-%05d-%05d', 6, x, y) tile FROM images""")
def nested_keys(spark, sf_dir):
    return rollup.nested_keys(_images(spark, sf_dir).select("depth", "long_index", "lat_index").distinct(), 2)


@query(f"""WITH {fx.POINTS} SELECT id, lon, lat, ts FROM placed WHERE long_index BETWEEN 500 AND 1500 AND lat_index BETWEEN 300 AND 1700 AND ts BETWEEN 1704500000 AND 1705500000""")
def points_in_box(spark, sf_dir):
    return serving.features(_placed(spark, sf_dir), (500, 1500, 300, 1700), (1704500000, 1705500000)).select("id", "lon", "lat", "ts")


@query(f"""WITH {fx.POINTS} SELECT id, long_index, lat_index, ts FROM placed WHERE long_index BETWEEN 0 AND 2048 AND lat_index BETWEEN 0 AND 2047 AND ts BETWEEN 1704500000 AND 1705500000
QUALIFY row_number() OVER (PARTITION BY long_index >> 6, lat_index >> 6 ORDER BY printf('T10-%05d-%05d-%010d-%016x', long_index, lat_index, ts, id)) = 1""")
def points_thinned(spark, sf_dir):
    """The first point by row key of each tile at depth 4, within a time range."""
    return serving.features_of_request(_placed(spark, sf_dir), {"longmin": "0", "longmax": "2048", "latmin": "0", "latmax": "2047", "timemin": "1704500000", "timemax": "1705500000", "groupdepth": "4"}).select("id", "long_index", "lat_index", "ts")


@query(f"""WITH {fx.POINTS} SELECT id, ts FROM placed WHERE ts BETWEEN 1704500000 AND 9999999999""")
def points_without_box(spark, sf_dir):
    """A missing bound takes the whole map and thins nothing; a depth that isn't a number counts as absent."""
    return serving.features_of_request(_placed(spark, sf_dir), {"longmin": "3", "timemin": "1704500000", "groupdepth": "x"}).select("id", "ts")


@query(f"""WITH {fx.CLUSTERED}, busy AS (SELECT long_index, lat_index FROM placed GROUP BY ALL ORDER BY count(*) DESC, long_index, lat_index LIMIT 1)
SELECT id, ts, coalesce(lon, -1000) lon FROM placed JOIN busy USING (long_index, lat_index) WHERE ts >= 1704500000 AND ts < 1706000000""")
def points_of_tile(spark, sf_dir):
    """Points of the tile with the most of them, in a half-open time range."""
    placed = _placed(spark, sf_dir, True).withColumn("metadata", F.lit(None).cast("string"))
    busy = placed.groupBy("long_index", "lat_index").count().orderBy(F.desc("count"), "long_index", "lat_index").first()
    tile = f"T10-{busy.long_index:05d}-{busy.lat_index:05d}" if busy else "T10-00000-00000"
    return serving.tile_points(placed, tile, 1704500000, 1706000000).select("id", "ts", "lon")


@query(f"""WITH {fx.POINTS} SELECT printf('%016x', id) row_key, CASE WHEN id % 3 = 0 THEN -1000 ELSE lon END lon, CASE WHEN id % 5 = 0 THEN -1000 ELSE lat END lat,
CASE WHEN id % 7 = 0 THEN '{{}}' ELSE props END metadata FROM points WHERE id % 105 <> 0""")
def rows_of_cells(spark, sf_dir):
    """Cells of a key/value store as rows, with defaults for absent ones."""
    p = fx.points(spark, sf_dir).withColumn("row_key", tiling.hex16("id"))
    cells = [("longitude", F.col("lon").cast("string"), 3), ("latitude", F.col("lat").cast("string"), 5), ("metadata", F.col("props"), 7)]
    parts = [p.where(F.col("id") % k != 0).select("row_key", F.lit(q).alias("qualifier"), v.alias("value")) for q, v, k in cells]
    return serving.rows_of_cells(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query(f"""WITH {_IMAGES} SELECT DISTINCT printf('T%02d-%05d-%05d', 6, x, y) tile FROM images WHERE printf('T%02d-%05d-%05d', 6, x, y) BETWEEN 'T06-00010' AND 'T06-00090'""")
def keys_between(spark, sf_dir):
    named = _images(spark, sf_dir).withColumn("tile", tiling.tile_name("depth", "long_index", "lat_index"))
    return serving.keys_between(named, "tile", "T06-00010", "T06-00090")


@query(f"""WITH {_IMAGES} SELECT DISTINCT printf('T%02d-%05d-%05d', 6, x, y) tile FROM images""")
def keys_at_depth(spark, sf_dir):
    return serving.keys_at_depth(_images(spark, sf_dir), 6)


_BUSY = """busy AS (SELECT x, y, layer FROM images GROUP BY ALL ORDER BY count(*) DESC, x, y, layer LIMIT 1), mine AS (SELECT i.* FROM images i JOIN busy USING (x, y, layer))"""


def _busy(images):
    r = images.groupBy("long_index", "lat_index", "layer").count().orderBy(F.desc("count"), "long_index", "lat_index", "layer").first()
    return ((6, r.long_index, r.lat_index), r.layer) if r else ((6, 0, 0), "")


@query(f"""WITH {_IMAGES}, {_BUSY} SELECT printf('T%02d-%05d-%05d', 6, x, y) || '-' || layer || printf('-%010d', ts) "key" FROM mine WHERE id % 4 <> 0 AND ts BETWEEN 1704100000 AND 1706000000""")
def image_list(spark, sf_dir):
    images = _images(spark, sf_dir)
    return serving.image_list(images, *_busy(images), (1704100000, 1706000000))


@query(f"""WITH {_IMAGES}, {_BUSY} SELECT ts, props metadata FROM mine""")
def image_metadata(spark, sf_dir):
    images = _images(spark, sf_dir).withColumn("metadata", F.col("props"))
    return serving.image_metadata(images, *_busy(images))


@query(f"""WITH {_IMAGES}, {_BUSY} SELECT id, ts FROM mine WHERE id % 4 <> 0 ORDER BY ts LIMIT 1""")
def first_image(spark, sf_dir):
    images = _images(spark, sf_dir)
    return serving.latest_image(images, *_busy(images)).select("id", "ts")


@query(f"""WITH {_IMAGES} SELECT x long_index, y lat_index, max_by(r, ts)::INT r, max_by(g, ts)::INT g, max_by(b, ts)::INT b, max_by(a, ts)::INT a FROM images WHERE a > 0 GROUP BY ALL""")
def composite(spark, sf_dir):
    """Images of a tile painted over each other in time order; at equal times the first of the table stays, as in the SQL read in that order."""
    return serving.composite(_images(spark, sf_dir), ["long_index", "lat_index"], ("id",))


@query(f"""WITH {fx.POINTS} SELECT id, intensity FROM points WHERE intensity > 20 AND intensity < 60 AND id % 3 <> 0""")
def scored_points(spark, sf_dir):
    rows = fx.points(spark, sf_dir).withColumn("score", F.when(F.col("id") % 3 != 0, F.col("intensity")))
    return serving.scored(rows, 20.0, 60.0).select("id", "intensity")


@query(f"""WITH {fx.POINTS} SELECT id FROM points WHERE id % 3 <> 1""")
def points_not_loaded(spark, sf_dir):
    rows = fx.points(spark, sf_dir).withColumn("identifier", F.col("id"))
    return serving.not_loaded(rows, rows.where("id % 3 = 1")).select("id")


@query("""WITH cells AS (SELECT 'k' field, json_extract_string(props, '$.k') v FROM events UNION ALL SELECT 'kind', event_type FROM events)
SELECT field, bool_and(try_cast(v AS DOUBLE) IS NOT NULL) numeric FROM cells WHERE v IS NOT NULL GROUP BY field""")
def metadata_fields(spark, sf_dir):
    """All fields of the points' metadata and whether each is numeric."""
    rows = fx.table(spark, sf_dir, "events").select(F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.lit("kind"), F.col("event_type"), F.lit("secret"), F.lit("x")).alias("m"))
    return serving.field_names(rows.select(F.map_filter("m", lambda _, v: v.isNotNull()).alias("m")), "m", ("secret",))


@query("""SELECT event_id id, row_number() OVER (ORDER BY try_cast(json_extract_string(props, '$.k') AS DOUBLE) DESC NULLS LAST, event_id) place FROM events""")
def sorted_by_field(spark, sf_dir):
    from pyspark.sql import Window as W

    rows = fx.points(spark, sf_dir).withColumn("m", F.create_map(F.lit("k"), F.get_json_object("props", "$.k")))
    ordered = serving.sorted_by_field(rows, "m", "k", numeric=True, descending=True)
    return ordered.select("id", F.row_number().over(W.orderBy(F.col("m")["k"].try_cast("double").desc_nulls_last(), "id")).cast("long").alias("place"))


@query(f"""WITH {fx.POINTS} SELECT count(*) n, count(*) FILTER (WHERE intensity > 50) bright, count(DISTINCT layer) layers FROM points""")
def status_counters(spark, sf_dir):
    return fx.points(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("intensity") > 50).alias("bright"), F.count_distinct("layer").alias("layers"))


@query("""WITH s AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'EO1H' ELSE 'EO1A' END || printf('%06d', o_orderkey % 1000000) || strftime(o_orderdate, '%Y%j') || '11010' scene FROM orders)
SELECT DISTINCT '/archive/' || CASE WHEN scene LIKE 'EO1H%' THEN 'hyperion' ELSE 'ali' END || '_l1g/' || substr(scene, 11, 4) || '/' || substr(scene, 15, 3) || '/' || scene || '_' || CASE WHEN scene LIKE 'EO1H%' THEN 'HYP' ELSE 'ALI' END || '_L1G' path FROM s""")
def scene_paths(spark, sf_dir):
    sensor = F.when(F.col("o_orderkey") % 2 == 0, "EO1H").otherwise("EO1A")
    scene = F.concat(sensor, F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0"), F.date_format("o_orderdate", "yyyyDDD"), F.lit("11010"))
    return fx.table(spark, sf_dir, "orders").select(serving.scene_path(scene, "/archive", "l1g").alias("path")).distinct()


_CENTER = fx.SCENES + """,
turned AS (SELECT *, CASE WHEN lon - first_value(lon) OVER w > 180 THEN lon - 360e0 WHEN lon - first_value(lon) OVER w < -180 THEN lon + 360e0 ELSE lon END u FROM corners WINDOW w AS (PARTITION BY scene_id ORDER BY k)),
centers AS (SELECT scene_id, ts, radiance, sum(u ORDER BY k) / 4 cu, sum(lat ORDER BY k) / 4 clat, min(u) west, max(u) east, min(lat) south, max(lat) north FROM turned GROUP BY ALL),
center AS (SELECT *, CASE WHEN cu > 180 THEN cu - 360e0 WHEN cu < -180 THEN cu + 360e0 ELSE cu END clon FROM centers)"""


@query(f"""WITH {_CENTER} SELECT scene_id, round(clon, 6) lon, round(clat, 6) lat, floor((CASE WHEN clon + 180 = 0 THEN 360e0 ELSE clon + 180 END) / 360e0 * 2048)::BIGINT long_index,
least(floor((clat + 90) / 180e0 * 2048), 2047)::BIGINT lat_index, 5::INT points FROM center""")
def footprints_placed(spark, sf_dir):
    """Centre, tile and closed polygon of footprints, across the antimeridian too."""
    made = footprints.polygons(fx.scenes(spark, sf_dir))
    return made.select("scene_id", r6("lon", "lon"), r6("lat", "lat"), "long_index", "lat_index", F.size("polygon").alias("points"))


@query(f"""WITH {_CENTER}, banded AS (SELECT *, unnest(range(floor(south)::BIGINT, floor(north)::BIGINT + 1)) band FROM center)
SELECT DISTINCT a.scene_id "first", b.scene_id "second" FROM banded a JOIN banded b ON a.band = b.band AND a.scene_id <> b.scene_id
AND ((b.west >= a.west AND b.west < a.east) OR (b.east >= a.west AND b.east < a.east)) AND ((b.south >= a.south AND b.south < a.north) OR (b.north >= a.south AND b.north < a.north))""")
def footprints_overlapping(spark, sf_dir):
    """Pairs of footprints of all scenes, one with a corner in the other."""
    return footprints.overlapping(fx.scenes(spark, sf_dir))


@query(f"""WITH {_CENTER}, spans AS (SELECT scene_id, floor((west + 180) / 360e0 * 64)::BIGINT x1, floor((east + 180) / 360e0 * 64)::BIGINT x2,
greatest(floor((south + 90) / 180e0 * 64), 0)::BIGINT y1, least(floor((north + 90) / 180e0 * 64), 63)::BIGINT y2 FROM center),
xs AS (SELECT scene_id, y1, y2, unnest(range(x1, x2 + 1)) x FROM spans)
SELECT scene_id, ((x % 64) + 64) % 64 long_index, unnest(range(y1, y2 + 1)) lat_index FROM xs""")
def footprint_tiles(spark, sf_dir):
    return footprints.tiles_of(fx.scenes(spark, sf_dir), 5).select("scene_id", "long_index", "lat_index")


@query(f"""WITH {fx.SCENES}, m AS (SELECT scene_id, ts, radiance, sum(lon ORDER BY k) / 4 clon, sum(lat ORDER BY k) / 4 clat FROM corners GROUP BY ALL)
SELECT scene_id, round(clon, 6) center_lon, round(clat, 6) center_lat FROM m WHERE radiance BETWEEN 1000 AND 300000 AND sqrt(pow(clat - 10, 2) + pow(clon - 20, 2)) < 60""")
def catalog_search(spark, sf_dir):
    found = footprints.search(fx.scenes(spark, sf_dir), (1000.0, 300000.0), (0, 9_999_999_999), 10.0, 20.0, 60.0)
    return found.select("scene_id", r6("center_lon", "center_lon"), r6("center_lat", "center_lat"))


@query("""SELECT least(min(o_totalprice), 0) radiance_min, max(o_totalprice) radiance_max, min(floor(epoch(o_orderdate))::BIGINT) time_min, max(floor(epoch(o_orderdate))::BIGINT) time_max FROM orders""")
def slider_bounds(spark, sf_dir):
    return footprints.slider_bounds(fx.scenes(spark, sf_dir))


@query("""SELECT c_custkey id, round(coalesce(CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END, 0) + coalesce(CASE WHEN c_custkey % 5 > 0 THEN c_nationkey::DOUBLE END, 0), 6) radiance FROM customer""")
def nullable_sums(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_acctbal")).alias("b1"), F.when(F.col("c_custkey") % 5 > 0, F.col("c_nationkey").cast("double")).alias("b2"))
    return rows.select("id", r6(footprints.total_radiance(["b1", "b2"]), "radiance"))


@query(f"""WITH {fx.PIXELS}, v AS (SELECT 0 AS s, y, x FROM pixels WHERE label > 2), e AS (SELECT min(y) t, max(y) b, min(x) l, max(x) r FROM v)
SELECT t top, b bottom, l "left", r "right", round(avg(x) FILTER (WHERE y = t), 6) top_x, round(avg(x) FILTER (WHERE y = b), 6) bottom_x, round(avg(y) FILTER (WHERE x = l), 6) left_y, round(avg(y) FILTER (WHERE x = r), 6) right_y FROM v, e GROUP BY ALL""")
def picture_corners(spark, sf_dir):
    made = footprints.picture_corners(fx.pixels(spark, sf_dir).where("label > 2").withColumn("scene_id", F.lit(0)))
    return made.select("top", "bottom", "left", "right", *[r6(c, c) for c in ("top_x", "bottom_x", "left_y", "right_y")])


@query(f"""WITH {fx.POINTS}, t AS (SELECT layer, quantile_cont(intensity, 0.95) q FROM points GROUP BY layer) SELECT id, intensity FROM points JOIN t USING (layer) WHERE intensity > q""")
def bright_points(spark, sf_dir):
    """Points above the 95th percentile of their layer."""
    return clusters.bright(fx.points(spark, sf_dir), "95%", "layer").select("id", "intensity")


_NEAREST = f"""{fx.CLUSTERED}, centers AS (SELECT c, -150 + c * 33e0 clon, (c * 37) % 120 - 60e0 clat FROM range(10) t(c)),
best AS (SELECT p.id, p.ts, p.intensity, min({{'d': sqrt(pow(lon - clon, 2) + pow(lat - clat, 2)), 'c': c}}) m FROM clustered p, centers GROUP BY ALL),
rows_ AS (SELECT m.c cluster, m.d dist, intensity * intensity w, ts FROM best)"""


def _centers(spark):
    return spark.range(10).select(F.col("id").cast("int").alias("cluster"), (F.lit(-150.0) + F.col("id") * 33.0).alias("clon"), ((F.col("id") * 37) % 120 - 60.0).alias("clat"))


@query(f"""WITH {_NEAREST} SELECT cluster::INT cluster, count(*) n, round(sum(w), 4) total, greatest(max(w), 0) highest, round(sqrt(sum(dist * dist) / count(*)), 6) rms, round(sqrt(sum(w * dist * dist) / sum(w)), 6) weighted_rms, max(ts) ts FROM rows_ GROUP BY cluster""")
def cluster_statistics(spark, sf_dir):
    """Statistics of points by the nearest of ten fixed centres; a point weighs its squared intensity."""
    stats = clusters.statistics(clusters.assign(fx.clustered(spark, sf_dir).withColumn("weight", F.col("intensity") * F.col("intensity")), _centers(spark)))
    return stats.select("cluster", "n", F.round("total", 4).alias("total"), "highest", r6("rms", "rms"), r6("weighted_rms", "weighted_rms"), "ts")


@query()
def bright_spots(spark, sf_dir):
    """Weighted clusters of bright points as points of the map."""
    bright = clusters.bright(fx.clustered(spark, sf_dir), "90%", "layer")
    return clusters.spots(bright, clusters.fit(bright, k=8))


@query(f"""WITH {fx.POINTS} SELECT id, round(500000 + lon * 1000, 6) east, round(lat * 100000, 6) north FROM points""")
def projected_places(spark, sf_dir):
    east, north = geodesy.projected(F.col("lon") * 100, F.col("lat") * 100, [500000.0, 10.0, 0.0, 0.0, 0.0, 1000.0])
    return fx.points(spark, sf_dir).select("id", r6(east, "east"), r6(north, "north"))


@query(f"""WITH {fx.POINTS} SELECT id, least(id % 20 - 2, 10)::INT "depth", pow(2, least(id % 20 - 2, 10) - 10) marker, CASE WHEN least(id % 20 - 2, 10) <= 4 THEN 4 ELSE 10 END::INT grouped FROM points""")
def zoom_levels(spark, sf_dir):
    rows = fx.points(spark, sf_dir).select("id", tiling.depth_of_zoom(F.col("id") % 20).alias("depth"))
    return rows.select("id", "depth", tiling.marker_size("depth").alias("marker"), tiling.group_depth("depth").alias("grouped"))


@query(f"""WITH {_IMAGES}, seen AS (SELECT DISTINCT 'EO1' || CASE WHEN id % 2 = 0 THEN 'H' ELSE 'A' END || printf('%06d', x) || '2012' || printf('%03d', y) || '11010' scene FROM images WHERE x BETWEEN 10 AND 60 AND y BETWEEN 10 AND 90)
SELECT '/archive/' || CASE WHEN scene LIKE 'EO1H%' THEN 'hyperion' ELSE 'ali' END || '_l1g/' || substr(scene, 11, 4) || '/' || substr(scene, 15, 3) || '/' || scene || '_' || CASE WHEN scene LIKE 'EO1H%' THEN 'HYP' ELSE 'ALI' END || '_L1G' path FROM seen""")
def visible_scenes(spark, sf_dir):
    """Archive paths of the scenes behind the tiles in view."""
    images = _images(spark, sf_dir)
    scene = F.concat(F.lit("EO1"), F.when(F.col("id") % 2 == 0, "H").otherwise("A"), F.format_string("%06d", "long_index"), F.lit("2012"), F.format_string("%03d", "lat_index"), F.lit("11010"))
    images = images.withColumn("metadata", F.create_map(F.lit("BAND1_FILE_NAME"), F.concat(scene, F.lit("_B01.TIF")), F.lit("OTHER"), F.lit("x")))
    view = images.where("long_index between 10 and 60 and lat_index between 10 and 90").select("depth", "long_index", "lat_index")
    return serving.visible_scenes(images, view, "/archive", "l1g")


@query("""SELECT event_id id, 'a: ' || event_type || chr(10) || 'k: ' || coalesce(json_extract_string(props, '$.k'), 'null') dump, strftime(ts, '%Y-%m-%d %H:%M') shown, month(ts) || '/' || strftime(ts, '%y') "month",
CASE WHEN value > 80 THEN 'bright' WHEN event_type = 'click' THEN 'click' WHEN value > 20 THEN 'middle' END segment FROM events""")
def metadata_dump(spark, sf_dir):
    """Metadata as sorted lines, times as shown, and the first segment that a point falls into."""
    p = fx.points(spark, sf_dir)
    m = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.lit("a"), F.col("layer"))
    segment = serving.first_segment([("bright", F.col("intensity") > 80), ("click", F.col("layer") == "click"), ("middle", F.col("intensity") > 20)])
    return p.select("id", serving.dumped(m).alias("dump"), serving.shown_time(F.col("ts")).alias("shown"), serving.shown_month(F.col("ts")).alias("month"), segment.alias("segment"))


@query(f"""WITH {fx.POINTS} SELECT id, intensity, long_index, lat_index FROM placed WHERE intensity > 60""")
def streamed_bright_points(spark, sf_dir):
    """Bright points taken as a stream of files and upserted into a store, which is then read."""
    path, folder = f"{sf_dir}/events.parquet", f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    # a pattern, since the table may be a file or a folder of files
    stream = fx.points_of(ingest.arriving(spark, f"{path[:-1]}[t]", spark.read.parquet(path).schema))
    store = Store(spark, f"{folder}/points", ["row_key"])
    ingest.upsert_into(ingest.bright_stream(stream, 60.0), store, f"{folder}/checkpoint").awaitTermination()
    taken = store.read()
    if taken is None:  # nothing was bright
        taken = ingest.bright_stream(fx.points(spark, sf_dir).limit(0), 60.0)
    return taken.select("id", "intensity", "long_index", "lat_index")
