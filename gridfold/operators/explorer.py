"""Interactive looks at one scene: spectra, scatter data and false-colour images of a rectangle.

Pixels are long, (y, x, band, value), or wide, (y, x, <band>...). A value of 0 is no data.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridfold.functions import radiometry

#: Functions that expressions over bands may use.
ALLOWED = frozenset("abs acos asin atan atan2 ceil cos exp floor greatest least log log10 pow power round sign sin sqrt tan if nullif coalesce".split())


def in_rectangle(x1: int, y1: int, x2: int, y2: int, width: int, height: int) -> Column:
    """Pixels from the lesser corner to before the greater one, whichever is given first; corners are clamped to the scene,
    so its last row and column can't be reached."""
    clamp = lambda v, size: min(max(v, 0), size - 1)
    (x1, x2), (y1, y2) = sorted((clamp(x1, width), clamp(x2, width))), sorted((clamp(y1, height), clamp(y2, height)))
    return (F.col("x") >= x1) & (F.col("x") < x2) & (F.col("y") >= y1) & (F.col("y") < y2)


def spectrum(pixels: DataFrame, log: bool = False, band: str = "band", value: str = "value") -> DataFrame:
    """Mean of the positive values by band; bands without any give no row. The log form is log(sum) - log(count)."""
    v = F.col(value)
    out = F.log(F.sum(v)) - F.log(F.count(v).cast("double")) if log else F.avg(v)
    return pixels.where(v > 0).groupBy(band).agg(out.alias("radiance"))


def bands_in(expression: str, bands: list[str]) -> list[str]:
    """Bands that an expression uses. Other names than bands and allowed functions are refused, as are strings and comments."""
    if re.search(r"['\"`;\\]|--|/\*", expression):
        raise ValueError(f"not an expression over bands: {expression}")
    names = re.findall(r"(?<![\w.])[A-Za-z_]\w*", expression)
    unknown = [n for n in names if n not in bands and n.lower() not in ALLOWED]
    if unknown:
        raise ValueError(f"unknown names in expression: {unknown}")
    return [b for b in bands if b in names]


def _has_data(bands: list[str]) -> Column:
    out = F.lit(True)
    for b in bands:
        out = out & (F.col(b) != 0)
    return out


def scatter(wide: DataFrame, horizontal: str, vertical: str, bands: list[str]) -> DataFrame:
    """Two expressions over bands at each pixel where no band that they use is 0."""
    used = sorted({*bands_in(horizontal, bands), *bands_in(vertical, bands)})
    return wide.where(_has_data(used)).select(F.expr(horizontal).cast("double").alias("horizontal"), F.expr(vertical).cast("double").alias("vertical"))


def channel_range(wide: DataFrame, channels: dict[str, str], bands: list[str]) -> DataFrame:
    """One row (low, high): the 5th and 95th of 100 sorted values, by index, over all channels' least and greatest.

    Positions are counted with one sort per channel; nothing is gathered.
    """
    used = sorted({b for e in channels.values() for b in bands_in(e, bands)})
    data = wide.where(_has_data(used))
    values = data.select(F.explode(F.array(*[F.struct(F.lit(k).alias("channel"), F.expr(e).cast("double").alias("v")) for k, e in channels.items()])).alias("s")).select("s.*")
    return sorted_percentiles(values, ["channel"], "v").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def sorted_percentiles(rows: DataFrame, keys: list[str], value: str, share: float = 0.05) -> DataFrame:
    """(keys, low, high): the values at places floor(n * share) and ceil(n * (1 - share)) of the sorted rows, clamped."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"))
    from pyspark.sql import Window as W

    run = W.partitionBy(*keys).orderBy(value)
    placed = counts.withColumns({"last": F.sum("c").over(run) - 1, "n": F.sum("c").over(W.partitionBy(*keys))}).withColumn("first", F.col("last") - F.col("c") + 1)
    low = F.least(F.floor(F.col("n") * F.lit(share)), F.col("n") - 1)
    high = F.least(F.ceil(F.col("n") * F.lit(1 - share)), F.col("n") - 1)
    at = lambda place: F.max(F.when((F.col("first") <= place) & (place <= F.col("last")), F.col(value)))
    return placed.groupBy(*keys).agg(at(low).alias("low"), at(high).alias("high"))


def false_colour(wide: DataFrame, channels: dict[str, str], bands: list[str], low: float, high: float) -> DataFrame:
    """(y, x, r, g, b, a): three expressions on 256 steps from low to high; transparent where a band they use is 0. low and
    high equal: the range of the scene's own channels."""
    used = sorted({b for e in channels.values() for b in bands_in(e, bands)})
    if low == high:
        rows = wide.crossJoin(F.broadcast(channel_range(wide, channels, bands)))
    else:
        rows = wide.withColumns({"low": F.lit(float(low)), "high": F.lit(float(high))})
    colours = [F.coalesce(radiometry.scaled_floor(F.expr(e).cast("double"), F.col("low"), F.col("high")), F.lit(0)).alias(k) for k, e in channels.items()]
    return rows.select("y", "x", *colours, F.when(_has_data(used), 255).otherwise(0).alias("a"))


def respond(request: dict, wide: DataFrame, scenes: DataFrame, bands: list[str], shape: tuple[int, int]) -> DataFrame:
    """What a request of text parameters asks of a scene by `command`: bandNames, dimensions, json, spectrum, scatter or image,
    the last four within corners x1, y1, x2, y2 of a scene of shape (height, width). spectrum takes log; scatter horizontal
    and vertical; image red, green, blue, low and high. No command, another one or corners that aren't numbers give one row
    with a message. scenes has height, width, depth and bands; wide a column a band."""
    command = request.get("command")
    say = lambda text: wide.sparkSession.createDataFrame([(text,)], "message string")
    if command is None:
        return say("Missing command.")
    if command in ("bandNames", "dimensions"):
        return dimensions_json(scenes).select("scene_id", "band_names" if command == "bandNames" else command)
    if command not in ("json", "spectrum", "scatter", "image"):
        return say(f'Unrecognized command "{command}".')
    try:
        corners = [int(request[k]) for k in ("x1", "y1", "x2", "y2")]
    except (KeyError, TypeError, ValueError):
        return say("Corners must be whole numbers.")
    part = wide.where(in_rectangle(*corners, shape[1], shape[0]))
    if command == "json":
        return rectangle_json(part.select("y", "x", F.array(*bands).alias("spectrum")), bands)
    if command == "spectrum":
        cells = F.array(*[F.struct(F.lit(b).alias("band"), F.col(b).alias("value")) for b in bands])
        return spectrum(part.select(F.explode(cells).alias("c_")).select("c_.*"), request.get("log") in ("true", "1"))
    if command == "scatter":
        return scatter(part, request["horizontal"], request["vertical"], bands)
    channels = {"r": request["red"], "g": request["green"], "b": request["blue"]}
    return false_colour(part, channels, bands, float(request.get("low", 0)), float(request.get("high", 0)))


def rectangle_json(pixels: DataFrame, bands: list[str], metadata: str = "{}") -> DataFrame:
    """One row: {"bands", "metadata", "picture", "shape"} of a rectangle's pixels(y, x, spectrum), picture[x][y][band]."""
    columns = pixels.groupBy("x").agg(F.transform(F.array_sort(F.collect_list(F.struct("y", "spectrum"))), lambda s: s["spectrum"]).alias("column"))
    whole = columns.agg(F.transform(F.array_sort(F.collect_list(F.struct("x", "column"))), lambda s: s["column"]).alias("picture"))
    shape = F.array(F.size("picture"), F.coalesce(F.size(F.get("picture", F.lit(0))), F.lit(0)), F.lit(len(bands)))
    return whole.select(F.to_json(F.struct(F.array(*[F.lit(b) for b in bands]).alias("bands"), F.lit(metadata).alias("metadata"), "picture", shape.alias("shape"))).alias("json"))


def dimensions_json(scenes: DataFrame) -> DataFrame:
    return scenes.select("scene_id", F.to_json(F.struct("height", "width", "depth")).alias("dimensions"), F.to_json("bands").alias("band_names"))
