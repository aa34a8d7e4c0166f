"""Queries of elevation grids, zero suppression and rendered tiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridfold.operators import raster, rollup, runs, topology
from gridfold.plans import fixtures as fx
from gridfold.plans.registry import query, r6
from gridfold.session import cut
from gridfold.sources import codec

_NEIGHBOURS = f"""{fx.ELEVATION}, size_ AS (SELECT max(y) + 1 hh FROM dem),
n AS (SELECT d.*, u.h up, b.h down, l.h "left", r.h "right" FROM dem d, size_ s JOIN dem u ON u.x = d.x AND u.y = (d.y + hh - 1) % hh JOIN dem b ON b.x = d.x AND b.y = (d.y + 1) % hh
JOIN dem l ON l.y = d.y AND l.x = (d.x + 49) % 50 JOIN dem r ON r.y = d.y AND r.x = (d.x + 1) % 50),
grad AS (SELECT granule, y, x, h, (trunc(up - h)::BIGINT + trunc(h - down)::BIGINT) / 2 gy, (trunc("left" - h)::BIGINT + trunc(h - "right")::BIGINT) / 2 gx, (h + up + down + "left" + "right") / 5 mean5 FROM n),
mag AS (SELECT *, gy * gy + gx * gx magnitude FROM grad)"""
_CURVED = f"""{_NEIGHBOURS}, bend AS (SELECT m.*, (trunc(u.mean5 - m.mean5)::BIGINT - trunc(m.mean5 - d.mean5)::BIGINT) / 2 cy, (trunc(l.mean5 - m.mean5)::BIGINT - trunc(m.mean5 - r.mean5)::BIGINT) / 2 cx FROM mag m, size_ s
JOIN mag u ON u.x = m.x AND u.y = (m.y - 2 + hh) % hh JOIN mag d ON d.x = m.x AND d.y = (m.y + 2) % hh JOIN mag l ON l.y = m.y AND l.x = (m.x + 48) % 50 JOIN mag r ON r.y = m.y AND r.x = (m.x + 2) % 50),
cut AS (SELECT quantile_cont(magnitude, 0.6) c FROM bend),
cls AS (SELECT bend.*, magnitude < c flat, least(cy, cx) >= 0 bowl, greatest(cy, cx) <= 0 hill FROM bend, cut)"""


@query(f"WITH {_NEIGHBOURS} SELECT y, x, gy, gx, magnitude, round(mean5, 6) mean5 FROM mag")
def terrain_gradient(spark, sf_dir):
    """Gradients over neighbours that wrap around the grid's ends."""
    return topology.gradients(fx.elevation(spark, sf_dir)).select("y", "x", "gy", "gx", "magnitude", r6("mean5", "mean5"))


@query(f"WITH {_CURVED} SELECT y, x, cy, cx, flat, bowl, hill FROM cls")
def terrain_classes(spark, sf_dir):
    return topology.classified(fx.elevation(spark, sf_dir), arm=2).select("y", "x", "cy", "cx", "flat", "bowl", "hill")


@query(f"""WITH {_CURVED} SELECT count(*) n, min(magnitude) least_, max(magnitude) greatest_, median(magnitude) median, round(quantile_cont(magnitude, 0.9), 6) p90, round(100e0 * count_if(flat) / count(*), 6) flat_pct,
round(100e0 * count_if(bowl) / count(*), 6) bowl_pct, round(100e0 * count_if(hill) / count(*), 6) hill_pct, count(DISTINCT h::INT) heights, min(h::INT) lowest, max(h::INT) highest FROM cls""")
def terrain_report(spark, sf_dir):
    r = topology.report(fx.elevation(spark, sf_dir), arm=2)
    return r.select("n", F.col("least").alias("least_"), F.col("greatest").alias("greatest_"), "median", r6("p90", "p90"), r6("flat_pct", "flat_pct"), r6("bowl_pct", "bowl_pct"), r6("hill_pct", "hill_pct"), "heights", "lowest", "highest")


@query(f"WITH {fx.ELEVATION} SELECT h::INT bin, count(*) n FROM dem GROUP BY ALL")
def height_histogram(spark, sf_dir):
    return topology.histogram(fx.elevation(spark, sf_dir)).select("bin", "n")


@query(f"""WITH {fx.ELEVATION} SELECT (SELECT y FROM dem ORDER BY h, y, x LIMIT 1) min_y, (SELECT x FROM dem ORDER BY h, y, x LIMIT 1) min_x, (SELECT y FROM dem ORDER BY h DESC, y, x LIMIT 1) max_y, (SELECT x FROM dem ORDER BY h DESC, y, x LIMIT 1) max_x""")
def height_extremes(spark, sf_dir):
    return topology.lowest(fx.elevation(spark, sf_dir)).drop("granule")


@query(f"""WITH {fx.ELEVATION} SELECT a.y, a.x, round(avg(b.h), 6) box_mean FROM dem a JOIN dem b ON b.y BETWEEN a.y AND a.y + 3 AND b.x BETWEEN a.x AND a.x + 3 GROUP BY ALL HAVING count(*) = 16""")
def box_means(spark, sf_dir):
    return topology.box_means(fx.elevation(spark, sf_dir), 4).select("y", "x", r6("box_mean", "box_mean"))


@query(f"""WITH {fx.ELEVATION}, m AS (SELECT y, x, CASE WHEN h > 25 THEN 1 ELSE 0 END m FROM dem) SELECT a.y, a.x FROM m a JOIN m b ON b.y BETWEEN a.y - 1 AND a.y + 1 AND b.x BETWEEN a.x - 1 AND a.x + 1 GROUP BY ALL HAVING count(*) = 9 AND sum(b.m) BETWEEN 1 AND 8""")
def mask_outline(spark, sf_dir):
    return topology.outline(fx.elevation(spark, sf_dir).withColumn("m", F.when(F.col("h") > 25, 1).otherwise(0))).select("y", "x")


@query(f"WITH {_NEIGHBOURS} SELECT y, x, CASE WHEN least(up, down, \"left\", \"right\") >= 20 THEN 20 ELSE h END::DOUBLE h FROM n")
def holes_filled(spark, sf_dir):
    return topology.holes_filled(fx.elevation(spark, sf_dir), 20.0).select("y", "x", "h")


@query(f"WITH {fx.ELEVATION} SELECT y, x, (floor(h / 7) * 7)::DOUBLE h, (y // 2)::INT qy, (x // 25)::INT qx FROM dem")
def decimated_heights(spark, sf_dir):
    return fx.elevation(spark, sf_dir).select("y", "x", topology.decimated(F.col("h"), 7.0).cast("double").alias("h"), F.floor(F.col("y") / 2).cast("int").alias("qy"), F.floor(F.col("x") / 25).cast("int").alias("qx"))


@query()
def terrain_basins(spark, sf_dir):
    return topology.basins(fx.elevation(spark, sf_dir))


_CELLS = "cells AS (SELECT l_orderkey // 100 k, row_number() OVER (PARTITION BY l_orderkey // 100 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount) - 1 i, CASE WHEN l_discount < 0.03e0 THEN 0 ELSE l_discount END v FROM lineitem)"


def _cells(spark, sf_dir):
    from pyspark.sql import Window as W

    rows = fx.table(spark, sf_dir, "lineitem").withColumn("k", F.floor(F.col("l_orderkey") / 100))
    order = W.partitionBy("k").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount")
    return rows.select("k", (F.row_number().over(order) - 1).cast("long").alias("i"), F.when(F.col("l_discount") < 0.03, 0.0).otherwise(F.col("l_discount")).alias("v"))


@query(f"WITH {_CELLS}, z AS (SELECT k, i, v, i - row_number() OVER (PARTITION BY k ORDER BY i) g FROM cells WHERE v <> 0) SELECT k, min(i) \"start\", count(*) length, round(sum(v), 6) total FROM z GROUP BY k, g")
def zero_suppressed(spark, sf_dir):
    """Runs of cells that aren't 0, over all order lines, a hundred orders to a row of cells."""
    made = runs.runs(_cells(spark, sf_dir), ["k"])
    return made.select("k", "start", "length", r6(F.aggregate("strip", F.lit(0.0), lambda s, v: s + v), "total"))


@query(f"WITH {_CELLS} SELECT k, i, v::DOUBLE v FROM cells")
def zeros_restored(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    return runs.dense(runs.runs(cells, ["k"]), cells.groupBy("k").agg(F.count(F.lit(1)).alias("size")), ["k"])


@query(f"""WITH {fx.CLUSTERED}, px AS (SELECT long_index x0, lat_index y0, id, (id % 4)::INT x, (id // 4 % 4)::INT y, floor(intensity)::INT % 256 v FROM placed WHERE id % 4 % 2 = 0 AND id // 4 % 4 % 2 = 0)
SELECT id, 9 AS "depth", x0 >> 1 long_index, y0 >> 1 lat_index, (x / 2 + x0 % 2 * 2)::INT x, (y // 2 + (1 - y0 % 2) * 2)::INT y, v r FROM px""")
def quarter_pixels(spark, sf_dir):
    """Pixels of parent tiles by taking every other one of their children's, 4 x 4 to a tile."""
    from gridfold.functions import tiling

    p = tiling.with_tile(fx.clustered(spark, sf_dir)).withColumns({"depth": F.lit(10), "x": (F.col("id") % 4).cast("int"), "y": (F.floor(F.col("id") / 4) % 4).cast("int"), "r": (F.floor("intensity") % 256).cast("int")})
    p = p.withColumns({"g": F.lit(0), "b": F.lit(0), "a": F.lit(255)})
    return rollup.quarter_sampled(p, ["id"], 4, 4).select("id", "depth", "long_index", "lat_index", "x", "y", "r")


#: Rows of a scene that is cut from the elevation grid.
TALL = 20


def _scenes(spark, sf_dir):
    """Strips of the elevation grid as scenes in degrees, three bands each, in places of their own."""
    dem = fx.elevation(spark, sf_dir).withColumn("k", F.floor(F.col("y") / TALL))
    p = dem.select(F.concat(F.lit("s"), "k").alias("scene_id"), (F.col("y") % TALL).alias("y"), "x", F.array("h", F.col("h") * 2, F.col("h") * 3).alias("spectrum"))
    k = F.substring("scene_id", 2, 9).cast("int")
    transform = F.array((k * 17) % 300 - 150.0, F.lit(0.1), F.lit(0.0), (k * 11) % 120 - 50.0, F.lit(0.0), F.lit(-0.1))
    meta = F.create_map(F.lit("timestamp"), (k + 1000).cast("string"), F.lit("SUN_ELEVATION"), F.lit("45"))
    return codec.gathered(p, ["B01", "B02", "B03"]).withColumns({"transform": transform, "metadata": meta})


_PLACED = f"""{fx.ELEVATION}, px AS (SELECT y // {TALL} k, y % {TALL} y, x, h FROM dem), sc AS (SELECT k, max(y) + 1 hh, max(x) + 1 ww, (k * 17) % 300 - 150e0 lon0, (k * 11) % 120 - 50e0 lat0 FROM px GROUP BY k),
tl AS (SELECT sc.*, floor((lon0 + 180) / 360e0 * 128)::INT + dc c, floor((lat0 + 90) / 180e0 * 128)::INT - dr r FROM sc, range(0, 4) a(dc), range(0, 4) b(dr)),
at_ AS (SELECT k, c, r, i, j, hh, ww, (c / 128e0 * 360e0 - 180e0 + (i + 0.5e0) / 32e0 * (360e0 / 128e0) - lon0) / 0.1e0 - 0.5e0 u, (r / 128e0 * 180e0 - 90e0 + (1 - (j + 0.5e0) / 16e0) * (180e0 / 128e0) - lat0) / -0.1e0 - 0.5e0 v FROM tl, range(0, 32) a(i), range(0, 16) b(j)),
near AS (SELECT *, floor(u)::INT x0, floor(v)::INT y0, u - floor(u) tx, v - floor(v) ty FROM at_ WHERE u BETWEEN 0 AND ww - 1 AND v BETWEEN 0 AND hh - 1),
w AS (SELECT k, c, r, i, j, dy, dx, CASE dy WHEN 0 THEN 1 - ty ELSE ty END * CASE dx WHEN 0 THEN 1 - tx ELSE tx END w, x0 + dx x, y0 + dy y FROM near, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(dy, dx)),
made AS (SELECT k, c, r, i, j, sum(w * coalesce(h, 0)) b1, sum(w * CASE WHEN h > 0 THEN 1e0 ELSE 0e0 END) mask FROM w LEFT JOIN px USING (k, x, y) GROUP BY ALL)"""


@query(f"""WITH {_PLACED}, kept AS (SELECT k, c, r FROM made GROUP BY ALL HAVING max(mask) > 0.5e0)
SELECT 's' || k scene_id, c long_index, r lat_index, j::INT y, i::INT x, round(CASE WHEN mask < 0.01e0 THEN 0 ELSE b1 END, 6) b1, round(mask, 6) mask FROM made JOIN kept USING (k, c, r) WHERE mask > 1e-9""")
def linear_tiles(spark, sf_dir):
    """Pixels of scenes cut into tiles of depth 6 by linear interpolation; tiles without a half valid pixel aren't there."""
    tiles = raster.make_tiles(_scenes(spark, sf_dir), depth=6, width=32, height=16, order=1)
    b1, mask = F.col("spectrum")[0], F.col("spectrum")[3]
    p = codec.pixels(tiles.select(F.concat_ws(" ", "scene_id", "long_index", "lat_index").alias("scene_id"), "metadata", "bands", F.lit(16).alias("height"), F.lit(32).alias("width"), "data"))
    at = F.split("scene_id", " ")
    return p.where(mask > 1e-9).select(at[0].alias("scene_id"), at[1].cast("long").alias("long_index"), at[2].cast("long").alias("lat_index"), "y", "x", r6(b1, "b1"), r6(mask, "mask"))


_OPAQUE = f"{fx.ELEVATION}, px AS (SELECT y // {TALL} k, y % {TALL} y, x, trunc(h / 50 * 255)::INT v, CASE WHEN h > 10 THEN 255 ELSE 0 END a FROM dem)"


@query(f"""WITH {_OPAQUE}, up AS (SELECT k // 2 k, y // 2 + {TALL // 2} y, x // 2 + k % 2 * 25 x, sum(v * a) / greatest(sum(a), 1e-9) v, sum(a) / 4 a FROM px GROUP BY ALL)
SELECT 6 AS "depth", k::BIGINT long_index, y::INT y, x::INT x, v r, v b, a FROM px WHERE a > 0 UNION ALL SELECT 5, k::BIGINT, y::INT, x::INT, round_even(v, 0)::INT, round_even(v, 0)::INT, round_even(a, 0)::INT FROM up WHERE round_even(a, 0) > 0""")
def smooth_pyramid(spark, sf_dir):
    """Pictures of tiles and of their parents, which hold them at half size by means of four, weighted by opacity."""
    return _pyramid(spark, sf_dir, smooth=True)


@query(f"""WITH {_OPAQUE} SELECT 6 AS "depth", k::BIGINT long_index, y::INT y, x::INT x, v r, v b, a FROM px WHERE a > 0
UNION ALL SELECT 5, k // 2, (y // 2 + {TALL // 2})::INT, (x // 2 + k % 2 * 25)::INT, v, v, a FROM px WHERE a > 0 AND y % 2 = 0 AND x % 2 = 0""")
def sampled_pyramid(spark, sf_dir):
    """Pictures of tiles and of their parents, which hold the even rows and columns of theirs."""
    return _pyramid(spark, sf_dir, smooth=False)


def _pyramid(spark, sf_dir, smooth):
    dem, h = fx.elevation(spark, sf_dir), F.col("h")
    p = dem.select(F.floor(F.col("y") / TALL).cast("string").alias("scene_id"), (F.col("y") % TALL).alias("y"), "x", F.array(h, F.when(h > 10, 1.0).otherwise(0.0)).alias("spectrum"))
    scenes = codec.gathered(p, ["B01", "MASK"], (TALL, fx.DEM_WIDE))
    tiles = scenes.select("scene_id", F.lit(6).alias("depth"), F.col("scene_id").cast("long").alias("long_index"), F.lit(0).cast("long").alias("lat_index"), "bands", "data", "metadata")
    images = cut(raster.render(tiles, [raster.Layer("HEIGHT", ("B01",), "grey", 0.0, 50.0)], fx.DEM_WIDE, TALL))
    return raster.image_pixels(raster.pyramid(images, 5, smooth), ["depth", "long_index"]).where("a > 0").drop("g")


@query()
def rendered_tiles(spark, sf_dir):
    """Scenes cut into tiles of depth 6 and rendered to two layers, with their pyramid up to the globe."""
    tiles = raster.make_tiles(_scenes(spark, sf_dir), depth=6, width=32, height=16)
    layers = [raster.Layer("RGB", ("B03", "B02", "B01")), raster.Layer("HEIGHT", ("B01",), "grey", "5%", "sun")]
    images = cut(raster.render(tiles, layers, 32, 16))
    return raster.pyramid(images).select("depth", "long_index", "lat_index", "layer", "ts", F.sha2("png", 256).alias("png_sha256"))
