"""Quad-tree tiles of the longitude/latitude plane as column expressions.

Depth d has 2^(d+1) columns of longitude from -180 and as many rows of latitude from -90, so a tile is twice as wide as high.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEEPEST = 10
# The texts of tile names and row keys.
TILE_FORMAT = "T%02d-%05d-%05d"
IMAGE_KEY_FORMAT = "%s-%s-%010d"
POINT_KEY_FORMAT = "%s-%010d-%s"


def wrapped(lon: Column) -> Column:
    """Longitude counted from -180: in (0, 360], so -180 itself is at the far end."""
    east = F.pmod(lon + 180.0, F.lit(360.0))
    return F.when(east == 0, F.lit(360.0)).otherwise(east)


def long_index(depth, lon: Column, clamp: bool = False) -> Column:
    """Column of a longitude. +-180 is one past the grid, 2^(d+1), unless clamped."""
    d = F.lit(depth) if isinstance(depth, int) else depth
    tiles = F.shiftleft(F.lit(1).cast("long"), (d + 1).cast("int")) if not isinstance(depth, int) else F.lit(2 << depth).cast("long")
    index = F.floor(wrapped(lon) / 360.0 * tiles)
    return F.least(index, tiles - 1) if clamp else index


def lat_index(depth: int, lat: Column) -> Column:
    """Row of a latitude; the north pole belongs to the last row. Latitudes beyond 90 degrees are errors."""
    tiles = 2 << depth
    index = F.least(F.floor((lat + 90.0) / 180.0 * tiles), F.lit(tiles - 1))
    return F.when(F.abs(lat) > 90.0, F.raise_error(F.concat(F.lit("latitude out of range: "), lat.cast("string")))).otherwise(index).cast("long")


def tile_name(depth, x, y) -> Column:
    return F.format_string(TILE_FORMAT, F.lit(depth).cast("int") if isinstance(depth, int) else depth, _col(x), _col(y))


def parse_name(name) -> Column:
    """struct(depth, long_index, lat_index) of a tile's name, null for other texts."""
    part = lambda i: F.regexp_extract(_col(name), r"^T(\d{2})-(\d{5})-(\d{5})$", i)
    good = _col(name).rlike(r"^T\d{2}-\d{5}-\d{5}$")
    return F.when(good, F.struct(part(1).cast("int").alias("depth"), part(2).cast("long").alias("long_index"), part(3).cast("long").alias("lat_index")))


def corners(depth, x, y) -> Column:
    """struct(lon_min, lon_max, lat_min, lat_max)."""
    tiles = F.pow(F.lit(2.0), _col(depth) + 1 if not isinstance(depth, int) else F.lit(depth + 1.0))
    return F.struct(
        (_col(x) / tiles * 360.0 - 180.0).alias("lon_min"), ((_col(x) + 1) / tiles * 360.0 - 180.0).alias("lon_max"),
        (_col(y) / tiles * 180.0 - 90.0).alias("lat_min"), ((_col(y) + 1) / tiles * 180.0 - 90.0).alias("lat_max"),
    )


def ancestor(index, levels) -> Column:
    """Index, in either direction, of the tile that many levels up."""
    return F.call_function("shiftright", _col(index).cast("long"), _col(levels).cast("int"))


def quadrant(x, y) -> Column:
    """struct(dx, dy): which quarter of its parent a tile is; dy = 0 is the southern half."""
    return F.struct((_col(x) % 2).cast("int").alias("dx"), (_col(y) % 2).cast("int").alias("dy"))


def hex16(n) -> Column:
    """16 hexadecimal digits of a 64-bit number, unsigned."""
    return F.lpad(F.lower(F.hex(_col(n))), 16, "0")


def place_id(lon, lat) -> Column:
    """Identifier of a place to a thousandth of a degree; the same in any engine and run."""
    return hex16(F.xxhash64(F.round(_col(lon) * 1000).cast("long"), F.round(_col(lat) * 1000).cast("long")))


def image_key(name, layer, ts) -> Column:
    return F.format_string(IMAGE_KEY_FORMAT, _col(name), _col(layer), _col(ts))


def point_key(name, ts, identifier) -> Column:
    return F.format_string(POINT_KEY_FORMAT, _col(name), _col(ts), _col(identifier))


def key_parts(key) -> Column:
    """struct(tile, ts, identifier) of a point's or polygon's row key, by its fixed places."""
    return F.struct(F.substring(_col(key), 1, 15).alias("tile"), F.substring(_col(key), 17, 10).cast("long").alias("ts"), F.substring(_col(key), 28, 16).alias("identifier"))


def depth_of_zoom(zoom) -> Column:
    return F.least(_col(zoom) - 2, F.lit(DEEPEST)).cast("int")


def marker_size(depth) -> Column:
    return F.pow(F.lit(2.0), _col(depth) - DEEPEST)


def group_depth(depth, coarse: int = 4) -> Column:
    """Depth at which points are thinned: 4 for shallow views, else the deepest, which thins nothing."""
    return F.when(_col(depth) <= coarse, F.lit(coarse)).otherwise(F.lit(DEEPEST)).cast("int")


def with_tile(points: DataFrame, depth: int = DEEPEST, lon: str = "lon", lat: str = "lat") -> DataFrame:
    return points.withColumns({"long_index": long_index(depth, F.col(lon)), "lat_index": lat_index(depth, F.col(lat))})


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else F.lit(c) if isinstance(c, (int, float)) else c
