"""Scenes cut into quad-tree tiles, rendered to layers and rolled up: the steps that need whole arrays.

A scene row holds bands, height, width, transform (affine, six numbers) and one binary of float64 per band; a tile row the
same for one tile. A scene is one row on its way to Python, where its bands are prepared once and tiles leave one by one.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from gridfold.functions import geodesy, png, tiling
from gridfold.session import cut

# Poles of the recursive prefilters of B-splines by order.
POLES = {
    2: (np.sqrt(8.0) - 3.0,),
    3: (np.sqrt(3.0) - 2.0,),
    4: (np.sqrt(664.0 - np.sqrt(438976.0)) + np.sqrt(304.0) - 19.0, np.sqrt(664.0 + np.sqrt(438976.0)) - np.sqrt(304.0) - 19.0),
    5: (np.sqrt(67.5 - np.sqrt(4436.25)) + np.sqrt(26.25) - 6.5, np.sqrt(67.5 + np.sqrt(4436.25)) - np.sqrt(26.25) - 6.5),
}


def spline_coefficients(a: np.ndarray, order: int = 3) -> np.ndarray:
    """B-spline coefficients along both axes, with mirrored ends: two first-order recursions a line and pole."""
    out = a.astype(float).copy()
    for axis in (0, 1):
        c = np.moveaxis(out, axis, 0)
        n = len(c)
        if n < 2:
            continue
        for pole in POLES[order]:
            c *= (1 - pole) * (1 - 1 / pole)
            reach = min(n, 60)
            powers = pole ** np.arange(reach)
            if reach < n:
                first = np.tensordot(powers, c[:reach], 1)
            else:  # the mirrored sequence in full
                k = np.arange(1, n - 1)
                both = pole**k + pole ** (2 * n - 2 - k)
                first = (c[0] + pole ** (n - 1) * c[-1] + np.tensordot(both, c[1:-1], 1)) / (1 - pole ** (2 * n - 2))
            c[0] = first
            for i in range(1, n):
                c[i] += pole * c[i - 1]
            c[-1] = pole / (pole * pole - 1) * (c[-1] + pole * c[-2])
            for i in range(n - 2, -1, -1):
                c[i] = pole * (c[i + 1] - c[i])
    return out


def prepared(a: np.ndarray, order: int = 3) -> np.ndarray:
    """What interpolation of this order reads: spline coefficients, or the picture itself."""
    return spline_coefficients(a, order) if order in POLES else a.astype(float)


def basis(order: int, u: np.ndarray) -> np.ndarray:
    """The centred B-spline of an order at u."""
    terms = ((-1) ** j * math.comb(order + 1, j) * np.maximum(u + (order + 1) / 2 - j, 0.0) ** order for j in range(order + 2))
    return sum(terms) / math.factorial(order)


def resample(a: np.ndarray, y: np.ndarray, x: np.ndarray, order: int = 3) -> np.ndarray:
    """Values of a picture at fractional rows and columns, 0 outside; order 0 nearest, 1 linear, 2 to 5 splines."""
    return interpolated(prepared(a, order), y, x, order)


def interpolated(source: np.ndarray, y: np.ndarray, x: np.ndarray, order: int = 3) -> np.ndarray:
    """As resample, of a picture that is prepared for the order."""
    height, width = source.shape
    inside = (y >= 0) & (y <= height - 1) & (x >= 0) & (x <= width - 1)
    if order == 0:
        yi, xi = np.clip(np.rint(y), 0, height - 1).astype(int), np.clip(np.rint(x), 0, width - 1).astype(int)
        return np.where(inside, source[yi, xi], 0.0)
    if order != 1 and order not in POLES:
        raise ValueError("orders 0 to 5")

    def weights(at: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The first place that counts, and the weights from there on."""
        if order == 1:
            low = np.floor(at)
            return low.astype(int), [1 - (at - low), at - low]
        low = np.ceil(at - (order + 1) / 2)
        return low.astype(int), [basis(order, at - low - k) for k in range(order + 1)]

    def mirrored(i: np.ndarray, n: int) -> np.ndarray:
        if n == 1:
            return np.zeros_like(i)
        i = np.abs(i) % (2 * n - 2)
        return np.where(i >= n, 2 * n - 2 - i, i)

    (top, down), (left, across) = weights(y), weights(x)
    out = np.zeros(y.shape)
    for dy, wy in enumerate(down):
        row = mirrored(top + dy, height)
        for dx, wx in enumerate(across):
            out += wy * wx * source[row, mirrored(left + dx, width)]
    return np.where(inside, out, 0.0)


def tile_arrays(valid: np.ndarray, sources: list[np.ndarray], y: np.ndarray, x: np.ndarray, order: int = 3):
    """(mask, bands) at fractional rows and columns of a scene: the mask of valid pixels first, and None if none of it is half
    valid. valid, sources: the mask and the bands as `prepared`."""
    mask = interpolated(valid, y, x, order)
    if not (mask > 0.5).any():
        return None
    return mask, [np.where(mask < 0.01, 0.0, interpolated(s, y, x, order)) for s in sources]


TILE = "scene_id string, depth int, long_index long, lat_index long, bands array<string>, data array<binary>, metadata map<string,string>"


def outline(transform: list[float], height: int, width: int, zone: tuple[int, bool] | None) -> tuple[np.ndarray, np.ndarray]:
    """Longitudes and latitudes of points around a scene: its corners, and 16 steps a side, which zones bend."""
    left, dx, _, top, _, dy = transform
    t = np.arange(17) / 16
    x, y = np.r_[t, t, 0 * t, 0 * t + 1] * width, np.r_[0 * t, 0 * t + 1, t, t] * height
    east, north = left + x * dx, top + y * dy
    if not zone:
        return east, north
    lon, lat = geodesy.from_utm(east, north, *zone, f=np)
    return lon, lat


def scene_tiles(bands: list[np.ndarray], transform: list[float], zone: tuple[int, bool] | None, depth: int, width: int, height: int, order: int, masked_by: int | None):
    """(long_index, lat_index, mask, bands) of each tile that a scene meets with a half valid pixel. Bands are prepared once."""
    n = 2 << depth
    left, dx, _, top, _, dy = transform
    lon, lat = outline(transform, *bands[0].shape, zone)
    cell = lambda v, low, span: int(np.floor((v - low) / span * n))
    columns = range(cell(lon.min(), -180.0, 360.0), cell(lon.max(), -180.0, 360.0) + 1)
    rows = range(max(cell(lat.min(), -90.0, 180.0), 0), min(cell(lat.max(), -90.0, 180.0), n - 1) + 1)
    valid = prepared(np.all([b > 0 for b in bands[: masked_by or len(bands)]], 0), order)
    sources = [prepared(b, order) for b in bands]
    for c in columns:
        for r in rows:
            lon = c / n * 360.0 - 180.0 + (np.arange(width) + 0.5) / width * (360.0 / n)
            lat = r / n * 180.0 - 90.0 + (1 - (np.arange(height) + 0.5) / height) * (180.0 / n)
            east, north = np.meshgrid(lon, lat)
            if zone:
                east, north = geodesy.to_utm(east, north, *zone)
            if (made := tile_arrays(valid, sources, (north - top) / dy - 0.5, (east - left) / dx - 0.5, order)) is not None:
                yield c, r, *made


def make_tiles(scenes: DataFrame, depth: int = tiling.DEEPEST, width: int = 512, height: int = 256, order: int = 3, masked_by: int | None = None) -> DataFrame:
    """Tiles of scenes(scene_id, bands, height, width, transform array<double>, data array<binary>, metadata): one row for
    each tile that a scene meets with a half valid pixel. Bands gain MASK; each tile's own place is in its metadata.

    Scenes with a column `projection` (WKT) may be in a UTM zone: each tile pixel is projected into it, exactly, rather than
    by a linear map. masked_by: how many of the bands, the first ones, decide what is valid. A scene goes to Python once and
    its tiles come back one by one. Scenes without bands give no tiles. Row 0 is north.
    """
    n = 2 << depth
    wkt = F.col("projection") if "projection" in scenes.columns else F.lit(None).cast("string").alias("projection")

    def run(frames):
        for f in frames:
            for r in f.itertuples(index=False):
                bands = [np.frombuffer(b, "<f8").reshape(r.height, r.width) for b in r.data]
                zone = geodesy.utm_zone(r.projection) if r.projection else None
                for x, y, mask, planes in scene_tiles(bands, list(r.transform), zone, depth, width, height, order, masked_by) if bands else ():
                    place = {"depth": str(depth), "longIndex": str(x), "latIndex": str(y), "tileName": f"T{depth:02d}-{x:05d}-{y:05d}"}
                    place["geoCenter"] = "lat=%.3f&lng=%.3f&z=12" % ((y + 0.5) / n * 180 - 90, (x + 0.5) / n * 360 - 180)
                    tile = (r.scene_id, depth, x, y, [*r.bands, "MASK"], [p.astype("<f8").tobytes() for p in (*planes, mask)], dict(r.metadata or {}) | place)
                    yield pd.DataFrame([tile], columns=[c.split()[0] for c in ("scene_id", "depth", "long_index", "lat_index", "bands", "data", "metadata")])

    return scenes.select("scene_id", "bands", "height", "width", "transform", "data", "metadata", wkt).mapInPandas(run, TILE)


@dataclass(frozen=True)
class Layer:
    """How bands become a picture: RGB of three bands, grey of one, or yellow, one band as red, green and opacity."""

    layer: str
    bands: tuple[str, ...]
    output: str = "RGB"
    low: float | str = "5%"
    high: float | str = "95%"


def radiance_range(planes: list[np.ndarray], low: float | str, high: float | str, sun_elevation: float = 90.0) -> tuple[float, float]:
    """Numbers, percentiles "p%" of the values above 10 (of all, if no band has any), or "sun" for the highest."""

    def bound(spec: float | str, default: float, pick) -> float:
        if spec == "sun":
            return max(400.0 * np.sin(np.radians(sun_elevation)), 10.0)
        if not isinstance(spec, str):
            return float(spec)
        try:
            share = float(spec.rstrip("%"))
        except ValueError:
            share = default
        above = [np.percentile(p[p > 10], share) for p in planes if (p > 10).any()]
        return float(pick(above or [np.percentile(p, share) for p in planes]))

    lo, hi = bound(low, 5.0, min), bound(high, 95.0, max)
    if lo == hi:
        lo, hi = float(min(p.min() for p in planes)), float(max(p.max() for p in planes))
    return (0.0, 1.0) if lo == hi else (lo, hi)


def make_image(bands: dict[str, np.ndarray], layer: Layer, sun_elevation: float = 90.0) -> np.ndarray | None:
    """RGBA of a layer, None if a band of it is missing; pixels with a mask of half a step or less are transparent."""
    if any(b not in bands for b in layer.bands):
        return None
    planes = [bands[b] for b in layer.bands]
    lo, hi = radiance_range(planes, layer.low, layer.high, sun_elevation)
    scaled = [np.clip((p - lo) / (hi - lo) * 255.0, 0, 255).astype(np.uint8) for p in planes]
    alpha = np.where(bands["MASK"] * 255.0 > 0.5, 255, 0).astype(np.uint8) if "MASK" in bands else np.full(planes[0].shape, 255, np.uint8)
    if layer.output == "RGB":
        return np.stack([*scaled[:3], alpha], 2)
    if layer.output == "grey":
        return np.stack([scaled[0]] * 3 + [alpha], 2)
    if layer.output == "yellow":
        return np.stack([scaled[0], scaled[0], np.zeros_like(scaled[0]), np.where(alpha > 0, scaled[0], 0)], 2)
    raise NotImplementedError(layer.output)


IMAGE = "depth int, long_index long, lat_index long, layer string, ts long, metadata map<string,string>, png binary"


def render(tiles: DataFrame, layers: list[Layer], width: int = 512, height: int = 256) -> DataFrame:
    """Tiles as PNG layers; ts is the metadata's timestamp, 0 without one."""

    def run(frames):
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                bands = {n: np.frombuffer(b, "<f8").reshape(height, width) for n, b in zip(r.bands, r.data, strict=True)}
                meta = dict(r.metadata)
                sun = float(meta.get("SUN_ELEVATION", 90.0))
                for layer in layers:
                    if (picture := make_image(bands, layer, sun)) is not None:
                        out.append((r.depth, r.long_index, r.lat_index, layer.layer, int(float(meta.get("timestamp", 0))), meta, png.encode(picture)))
            yield pd.DataFrame(out, columns=["depth", "long_index", "lat_index", "layer", "ts", "metadata", "png"])

    return tiles.mapInPandas(run, IMAGE)


def image_files(images: DataFrame) -> DataFrame:
    """(name, content) of images: a PNG and its metadata as JSON, named by tile, layer and time; for files.write_files."""
    stem = tiling.image_key(tiling.tile_name("depth", "long_index", "lat_index"), "layer", "ts")
    kinds = F.array(F.struct(F.concat(stem, F.lit(".png")).alias("name"), F.col("png").alias("content")), F.struct(F.concat(stem, F.lit(".json")).alias("name"), F.to_json("metadata").cast("binary").alias("content")))
    return images.select(F.explode(kinds).alias("f_")).select("f_.*")


def image_pixels(images: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, y, x, r, g, b, a): the pixels of RGBA pictures in a column png; transparent ones too."""
    schema = StructType([*images.select(*keys).schema.fields, *[StructField(c, IntegerType()) for c in ("y", "x", *"rgba")]])

    def run(frames):
        for f in frames:
            for _, row in f.iterrows():
                p = png.decode(bytes(row["png"]))
                y, x = np.indices(p.shape[:2], "int32")
                cells = {"y": y.ravel(), "x": x.ravel()} | {c: p[..., i].ravel().astype("int32") for i, c in enumerate("rgba")}
                yield pd.DataFrame({k: [row[k]] * y.size for k in keys} | cells)

    return images.select(*keys, "png").mapInPandas(run, schema)


def halved(picture: np.ndarray) -> np.ndarray:
    """Half size by means of four, weighted by opacity, so that transparent pixels don't darken an edge."""
    p = picture.astype(float)
    p = np.pad(p, ((0, p.shape[0] % 2), (0, p.shape[1] % 2), (0, 0)), mode="edge")
    blocks = p.reshape(p.shape[0] // 2, 2, p.shape[1] // 2, 2, 4)
    alpha = blocks[..., 3:].sum((1, 3))
    colour = (blocks[..., :3] * blocks[..., 3:]).sum((1, 3)) / np.maximum(alpha, 1e-9)
    return np.concatenate([colour, alpha / 4], 2).round().astype(np.uint8)


def zoom_out(images: DataFrame, smooth: bool = False) -> DataFrame:
    """One level up: a parent's picture from its children's, a missing one transparent; the southern ones are at the bottom.
    Children shrink to their even rows and columns, which is what an interpolating spline of any order gives there; `smooth`
    takes means of four instead. A group is four pictures at most. Metadata is the first child's, without what belongs to a tile."""
    from gridfold.operators.rollup import TILE_FIELDS

    up = images.withColumns({"px": tiling.ancestor("long_index", F.lit(1)), "py": tiling.ancestor("lat_index", F.lit(1))})

    def run(key, f):
        _, px, py, layer, ts = key
        f = f.sort_values(["long_index", "lat_index"])
        pictures = [png.decode(b) for b in f["png"]]
        height, width = pictures[0].shape[:2]
        out = np.zeros((height, width, 4), np.uint8)
        for p, x, y in zip(pictures, f["long_index"], f["lat_index"], strict=True):
            small = halved(p) if smooth else p[::2, ::2]
            top, left = (0 if y % 2 else height // 2), (width // 2 if x % 2 else 0)
            part = small[: height // 2, : width // 2]
            out[top : top + part.shape[0], left : left + part.shape[1]] = part
        meta = {k: v for k, v in dict(f["metadata"].iloc[0]).items() if k not in TILE_FIELDS}
        return pd.DataFrame([(int(f["depth"].iloc[0]) - 1, px, py, layer, ts, meta, png.encode(out))], columns=["depth", "long_index", "lat_index", "layer", "ts", "metadata", "png"])

    return up.groupBy("depth", "px", "py", "layer", "ts").applyInPandas(run, IMAGE)


def pyramid(images: DataFrame, shallowest: int = 0, smooth: bool = False) -> DataFrame:
    """All levels up from the images' own; each level is materialised once and grouped by parent."""
    deepest = images.agg(F.max("depth")).first()[0]
    if deepest is None:
        return images
    level, whole = images, images
    for _ in range(deepest - shallowest):
        level = cut(zoom_out(level, smooth))
        whole = whole.unionByName(level)
    return whole


def layers_of_json(text: str) -> list[Layer]:
    """Layers of a job's configuration: [{"layer", "bands", "outputType", "minRadiance", "maxRadiance"}, ...]."""
    return [Layer(x["layer"], tuple(x["bands"]), x.get("outputType", "RGB"), x.get("minRadiance", "5%"), x.get("maxRadiance", "95%")) for x in json.loads(text)]


def trimmed(plane: np.ndarray, low: float = 5.0, high: float = 95.0, steps: float = 255.0) -> np.ndarray:
    """uint8 of a plane between two percentiles."""
    lo, hi = np.percentile(plane, [low, high])
    return np.clip((plane - lo) / ((hi - lo) or 1.0) * steps, 0, 255).astype(np.uint8)
