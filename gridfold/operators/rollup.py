"""Quad-tree roll-up of point statistics and of tile rows, from the deepest level to the whole globe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfold.functions import tiling

#: What belongs to a tile and not to its parent.
TILE_FIELDS = ("depth", "longIndex", "latIndex", "tileName", "geoCenter")


def rolled_up(points: DataFrame, keys: list[str], value: str, deepest: int = tiling.DEEPEST) -> DataFrame:
    """Count, sum and maximum by tile and keys at every depth. Points are summed by deepest tile first, so the expansion to
    all depths starts from tiles, not points, and each further level shuffles partial sums only."""
    base = points.groupBy("long_index", "lat_index", *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.max(value).alias("highest"))
    deep = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(deepest))).alias("depth"))
    up = F.lit(deepest) - F.col("depth")
    grouped = deep.withColumns({"x": tiling.ancestor("long_index", up), "y": tiling.ancestor("lat_index", up)}).groupBy("depth", "x", "y", *keys)
    sums = grouped.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("highest").alias("highest"))
    return sums.select("depth", tiling.tile_name("depth", "x", "y").alias("tile"), *keys, "n", "total", "highest")


def parents(tiles: DataFrame, keys: list[str]) -> DataFrame:
    """Each parent tile with its children: how many there are, the quadrants present, and the first child's metadata
    without what belongs to a tile."""
    up = tiles.withColumns({"px": tiling.ancestor("long_index", F.lit(1)), "py": tiling.ancestor("lat_index", F.lit(1))})
    name = tiling.tile_name("depth", "long_index", "lat_index")
    quarter = (F.col("long_index") % 2 + F.col("lat_index") % 2 * 2).cast("int")
    grouped = up.groupBy("depth", "px", "py", *keys).agg(F.count(F.lit(1)).alias("children"), F.array_sort(F.collect_set(quarter)).alias("quadrants"), F.min_by("metadata", name).alias("metadata"))
    kept = F.map_filter("metadata", lambda k, _: ~k.isin(*TILE_FIELDS))
    return grouped.select((F.col("depth") - 1).alias("depth"), F.col("px").alias("long_index"), F.col("py").alias("lat_index"), *keys, "children", "quadrants", kept.alias("metadata"))


def nested_keys(tiles: DataFrame, shallow: int) -> DataFrame:
    """(ancestor, tile): the name of each tile's ancestor at a depth, which a shuffle deals by."""
    up = F.col("depth") - shallow
    return tiles.select(tiling.tile_name(F.lit(shallow), tiling.ancestor("long_index", up), tiling.ancestor("lat_index", up)).alias("ancestor"), tiling.tile_name("depth", "long_index", "lat_index").alias("tile"))


def quarter_sampled(pixels: DataFrame, keys: list[str], width: int, height: int) -> DataFrame:
    """Parent tiles' pixels from their children's, by taking every other pixel: child (x, y) of a quadrant goes to half its
    place plus the quadrant's half tile. Row 0 is north, so the southern children fill the lower half."""
    kept = pixels.where("x % 2 = 0 and y % 2 = 0")
    return kept.select(
        (F.col("depth") - 1).alias("depth"), tiling.ancestor("long_index", F.lit(1)).alias("long_index"), tiling.ancestor("lat_index", F.lit(1)).alias("lat_index"), *keys,
        (F.col("x") / 2 + F.col("long_index") % 2 * (width // 2)).cast("int").alias("x"), (F.col("y") / 2 + (1 - F.col("lat_index") % 2) * (height // 2)).cast("int").alias("y"), "r", "g", "b", "a",
    )
