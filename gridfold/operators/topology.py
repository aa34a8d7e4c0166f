"""Elevation grids: neighbours that wrap around, gradients, curvature, box means, classes, a report and basins.

Rows are (granule, y, x, h). Neighbour values come from windows along rows and columns of a granule, or for curvature of a
block of it with its surroundings; the far ends are neighbours, so plain lag and lead won't do.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Pixels along the side of a block, and granules up to which their sizes are broadcast.
SIDE, MOST_BROADCAST = 128, 20_000


def rolled(value: Column, by: int, keys: list[str], axis: str) -> Column:
    """Value that stands `by` places before along the axis, around the ends. Beside the row `by` places away only the far end's
    last `by` values are looked up, so a row never carries its line."""
    lines, ahead, k = W.partitionBy(*keys), (F.asc, F.desc) if by > 0 else (F.desc, F.asc), abs(by)
    line = lines.orderBy(ahead[0](axis))
    back = lines.orderBy(ahead[1](axis)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    place, size = F.row_number().over(line) - 1, F.count(F.lit(1)).over(lines)
    from_end = size - F.pmod(place - k, size)
    around = F.coalesce(*[F.when(from_end == j, F.nth_value(value, j).over(back)) for j in range(1, k + 1)])
    return F.when(place < k, around).otherwise(F.lag(value, k).over(line))


def neighbours(grid: DataFrame, value: str = "h") -> DataFrame:
    """up, down (along y) and left, right (along x) beside each pixel."""
    v = F.col(value)
    return grid.withColumns({"up": rolled(v, 1, ["granule", "x"], "y"), "down": rolled(v, -1, ["granule", "x"], "y"), "left": rolled(v, 1, ["granule", "y"], "x"), "right": rolled(v, -1, ["granule", "y"], "x")})


def _sloped(n: DataFrame) -> DataFrame:
    fall = lambda before, after: (F.col(before) - F.col("h")).cast("long") + (F.col("h") - F.col(after)).cast("long")
    out = n.withColumns({"gy": fall("up", "down") / 2.0, "gx": fall("left", "right") / 2.0, "mean5": (F.col("h") + F.col("up") + F.col("down") + F.col("left") + F.col("right")) / 5.0})
    return out.withColumn("magnitude", F.col("gy") * F.col("gy") + F.col("gx") * F.col("gx")).drop("up", "down", "left", "right")


def gradients(grid: DataFrame) -> DataFrame:
    """gy, gx: mean of the falls from the neighbour before and to the one after, each cut to whole numbers; magnitude is their
    squared norm; mean5 the mean height with the four neighbours."""
    return _sloped(neighbours(grid))


def blocks(grid: DataFrame, reach: int) -> DataFrame:
    """Pixels dealt by block_, squares of a granule, each with a copy of what lies up to `reach` places around it, over
    the granule's ends too; own_: the pixel itself. y and x of a copy count on past the ends. Everything that looks no farther
    than `reach` is then found without a further shuffle."""
    whole = lambda q: F.floor(q).cast("int")
    sizes = grid.groupBy("granule").agg((F.max("y") + 1).alias("y_size_"), (F.max("x") + 1).alias("x_size_"))
    out = grid.join(F.broadcast(sizes) if sizes.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else sizes, "granule").withColumn("own_", F.lit(True))
    for c in "yx":
        v, n, place, block = F.col(c), F.col(f"{c}_size_"), F.col(f"{c}_place_"), F.col(f"{c}_block_")
        out = out.withColumn("turn_", F.explode(F.sequence(-whole((v + reach) / n), whole((n + reach - 1 - v) / n)))).withColumn(f"{c}_place_", v + F.col("turn_") * n)
        out = out.withColumn(f"{c}_block_", F.explode(F.sequence(F.greatest(whole((place - reach) / SIDE), F.lit(0)), F.least(whole((place + reach) / SIDE), whole((n - 1) / SIDE)))))
        out = out.withColumn("own_", F.col("own_") & (F.col("turn_") == 0) & (block == whole(place / SIDE))).withColumn(c, place).drop("turn_", f"{c}_place_")
    # one column names granule and block: a granule that is a constant would be dropped from the windows, and they would shuffle again
    named = out.withColumn("block_", F.concat_ws(" ", "y_block_", "x_block_", "granule"))
    return named.drop("y_block_", "x_block_", "y_size_", "x_size_").repartition("block_")


def _at(value: str, by: int, axis: str) -> Column:
    """struct of the value `by` places before along the axis in a block; null where no pixel is."""
    line = W.partitionBy("block_", "x" if axis == "y" else "y").orderBy(axis)
    return F.first(F.struct(F.col(value).alias("v"))).over(line.rangeBetween(-by, -by))


def _beside(pixels: DataFrame, value: str, found: dict[str, tuple[int, str]]) -> DataFrame:
    """The named values beside each pixel that has a pixel at all those places."""
    out = pixels.withColumns({name: _at(value, by, axis) for name, (by, axis) in found.items()})
    for name in found:
        out = out.where(F.col(name).isNotNull())
    return out.withColumns({name: F.col(name)["v"] for name in found})


def curvature(grid: DataFrame, arm: int = 5) -> DataFrame:
    """cy, cx: half the difference of the whole-number falls over a long arm before and after, on five-point means; for pixels
    that have all those neighbours. A pixel is shuffled once, with its block."""
    g = _sloped(_beside(blocks(grid, arm + 1), "h", {"up": (1, "y"), "down": (-1, "y"), "left": (1, "x"), "right": (-1, "x")}))
    m = F.col("mean5")
    wide = {f"{c}{s}": (s * arm, c) for c in "xy" for s in (1, -1)}
    g = _beside(g, "mean5", wide).where("own_")
    bend = lambda c: ((F.col(f"{c}1") - m).cast("long") - (m - F.col(f"{c}-1")).cast("long")) / 2.0
    return g.withColumns({"cy": bend("y"), "cx": bend("x")}).drop(*wide, "own_", "block_")


def _shapes() -> dict[str, Column]:
    return {"bowl": F.least("cy", "cx") >= 0, "hill": F.greatest("cy", "cx") <= 0}


def classified(grid: DataFrame, arm: int = 5, flat_share: float = 0.6) -> DataFrame:
    """flat: gradient below that percentile of the granule; bowl: no negative curvature; hill: no positive one."""
    c = curvature(grid, arm)
    cut = c.groupBy("granule").agg(F.percentile("magnitude", flat_share).alias("flat_cut"))
    flags = c.join(cut, "granule")
    return flags.withColumns({"flat": F.col("magnitude") < F.col("flat_cut"), **_shapes()})


def report(grid: DataFrame, arm: int = 5, flat_share: float = 0.6) -> DataFrame:
    """A row a granule: extremes, median and percentiles of the gradient, shares of the classes, distinct whole values. Pixels are
    counted by gradient and by height first, so that only those counts meet by granule."""
    c = curvature(grid, arm).select("granule", "magnitude", F.col("h").cast("int").alias("whole"), *[v.alias(k) for k, v in _shapes().items()])
    sets = [[F.col("granule"), F.col("magnitude")], [F.col("granule"), F.col("whole")]]
    # rows by height have no magnitude and count no pixels, rows by magnitude have no height
    some = lambda n: F.when(F.grouping("magnitude") == 0, n).otherwise(0)
    counts = c.groupingSets(sets, "granule", "magnitude", "whole").agg(some(F.count(F.lit(1))).alias("n"), some(F.count_if("bowl")).alias("bowls"), some(F.count_if("hill")).alias("hills"))
    flat = F.col("magnitude") < F.percentile("magnitude", flat_share, F.col("n")).over(W.partitionBy("granule"))
    counts = counts.withColumn("flat", F.coalesce(flat, F.lit(False)))
    share = lambda n: F.sum(n) * 100.0 / F.sum("n")
    of_flat = lambda n: F.when(F.col("flat"), F.col(n)).otherwise(0)
    return counts.groupBy("granule").agg(
        F.sum("n").alias("n"), F.min("magnitude").alias("least"), F.max("magnitude").alias("greatest"), F.percentile("magnitude", 0.5, F.col("n")).alias("median"), F.percentile("magnitude", 0.9, F.col("n")).alias("p90"),
        share(of_flat("n")).alias("flat_pct"), share("bowls").alias("bowl_pct"), share("hills").alias("hill_pct"), share(of_flat("bowls")).alias("flat_bowl_pct"),
        F.count("whole").alias("heights"), F.min("whole").alias("lowest"), F.max("whole").alias("highest"),
    )


def histogram(grid: DataFrame) -> DataFrame:
    return grid.groupBy("granule", F.col("h").cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def lowest(grid: DataFrame) -> DataFrame:
    """Place of the least and greatest height of a granule, the first in row order."""
    place = F.struct("h", "y", "x")
    high = F.struct((-F.col("h")).alias("h"), "y", "x")
    return grid.groupBy("granule").agg(F.min(place).alias("lo"), F.min(high).alias("hi")).select("granule", F.col("lo.y").alias("min_y"), F.col("lo.x").alias("min_x"), F.col("hi.y").alias("max_y"), F.col("hi.x").alias("max_x"))


def box_means(grid: DataFrame, size: int) -> DataFrame:
    """Mean of each size x size box that lies in the grid whole, at its first corner: sums along rows, then along columns."""
    along = W.partitionBy("granule", "y").orderBy("x").rowsBetween(0, size - 1)
    across = W.partitionBy("granule", "x").orderBy("y").rowsBetween(0, size - 1)
    rows = grid.withColumns({"s_": F.sum("h").over(along), "k_": F.count("h").over(along)}).where(F.col("k_") == size)
    both = rows.withColumns({"t_": F.sum("s_").over(across), "m_": F.count("s_").over(across)}).where(F.col("m_") == size)
    return both.select("granule", "y", "x", (F.col("t_") / float(size * size)).alias("box_mean"))


def outline(mask: DataFrame) -> DataFrame:
    """Inner pixels whose 3 x 3 surroundings hold some but not all of a 0/1 mask(granule, y, x, m)."""
    along = W.partitionBy("granule", "y").orderBy("x").rowsBetween(-1, 1)
    across = W.partitionBy("granule", "x").orderBy("y").rowsBetween(-1, 1)
    rows = mask.withColumns({"s_": F.sum("m").over(along), "k_": F.count("m").over(along)})
    both = rows.withColumns({"t_": F.sum("s_").over(across), "u_": F.sum("k_").over(across)})
    return both.where((F.col("u_") == 9) & F.col("t_").between(1, 8)).select("granule", "y", "x")


def holes_filled(grid: DataFrame, tag: float) -> DataFrame:
    """Pixels all of whose four neighbours are tagged get the tag."""
    n = neighbours(grid)
    return n.withColumn("h", F.when(F.least("up", "down", "left", "right") >= tag, F.lit(tag)).otherwise(F.col("h"))).drop("up", "down", "left", "right")


def decimated(value: Column, step: float) -> Column:
    return F.floor(F.floor(value) / step) * step


def degrees_to_pixel(lat: Column, lon: Column, lat_min: float, lon_min: float, size: float = 1.0, pixels: int = 3600) -> Column:
    """struct(y, x) of a place in a granule."""
    at = lambda v, low: F.floor((v - low) / size * pixels).cast("int")
    return F.struct(at(lon, lon_min).alias("y"), at(lat, lat_min).alias("x"))


def quadrants(grid: DataFrame, half: int) -> DataFrame:
    return grid.select("granule", F.floor(F.col("y") / half).cast("int").alias("qy"), F.floor(F.col("x") / half).cast("int").alias("qx"), (F.col("y") % half).alias("y"), (F.col("x") % half).alias("x"), "h")


def resized(a: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Bilinear, corners on corners."""
    out = a.astype(float)
    for axis, n in enumerate(shape):
        at = np.linspace(0, out.shape[axis] - 1, n)
        low = np.floor(at).astype(int)
        high = np.minimum(low + 1, out.shape[axis] - 1)
        part = (at - low).reshape((-1, 1) if axis == 0 else (1, -1))
        out = np.take(out, low, axis) * (1 - part) + np.take(out, high, axis) * part
    return out


def basin_regions(h: np.ndarray, regions: int = 5, sweeps: int = 10, least_share: float = 0.01, least_rows: int = 3) -> tuple[np.ndarray, int]:
    """Region number of each pixel, 0 for none: from the lowest untaken pixel a run grows along its row while the ground
    doesn't fall away or belongs to another region; sweeps down and up carry it to the next rows over non-falling neighbours;
    pixels surrounded by it join. Small regions are given up, and heights are smoothed between passes."""
    ground, label = h.astype(float).copy(), np.zeros(h.shape, int)
    found = 0

    def stretch(row: np.ndarray, free: np.ndarray, at: int) -> tuple[int, int]:
        low = high = at
        while low > 0 and free[low - 1] and row[low - 1] >= row[low]:
            low -= 1
        while high + 1 < len(row) and free[high + 1] and row[high + 1] >= row[high]:
            high += 1
        return low, high + 1

    for _ in range(regions):
        free = label == 0
        if not free.any():
            break
        y, x = np.unravel_index(np.where(free, ground, np.inf).argmin(), h.shape)
        mine = np.zeros(h.shape, bool)
        low, high = stretch(ground[y], free[y], int(x))
        mine[y, low:high] = True
        for sweep in range(sweeps):
            before = int(mine.sum())
            order = range(1, len(h)) if sweep % 2 == 0 else range(len(h) - 2, -1, -1)
            step = 1 if sweep % 2 == 0 else -1
            for r in order:
                grow = mine[r - step] & free[r] & ~mine[r] & (ground[r] >= ground[r - step])
                for c in np.flatnonzero(grow):
                    if not mine[r, c]:
                        low, high = stretch(ground[r], free[r], int(c))
                        mine[r, low:high] = True
            if int(mine.sum()) == before:
                break
        around = np.roll(mine, 1, 0) & np.roll(mine, -1, 0) & np.roll(mine, 1, 1) & np.roll(mine, -1, 1)
        mine |= around & free
        if mine.sum() >= least_share * mine.size and mine.any(1).sum() >= least_rows:
            found += 1
            label[mine] = found
        else:
            label[mine] = -1
        small = tuple(max(2, math.floor(n * 0.8)) for n in h.shape)
        ground = np.maximum(ground, resized(resized(ground, small), h.shape))
    label[label < 0] = 0
    return label, found


def basins(grid: DataFrame, regions: int = 5, sweeps: int = 10) -> DataFrame:
    """(granule, y, x, basin): a granule, at most 3600 pixels square, is one group; its fill is sequential by nature."""

    def run(key, f):
        height, width = int(f["y"].max()) + 1, int(f["x"].max()) + 1
        h = np.full((height, width), np.inf)
        y, x = f["y"].to_numpy(), f["x"].to_numpy()
        h[y, x] = f["h"].to_numpy()
        finite = np.where(np.isfinite(h), h, h[np.isfinite(h)].max())
        label, _ = basin_regions(finite, regions, sweeps)
        return f[["granule", "y", "x"]].assign(basin=label[y, x].astype("int32"))

    return grid.groupBy("granule").applyInPandas(run, "granule string, y int, x int, basin int")
