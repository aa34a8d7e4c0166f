"""Comparisons of spectra: change detection, nearest centres, clusters and unusual pixels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridfold.functions import radiometry
from gridfold.session import cut


def squared_norm(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v))


def cloud_threshold(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Mean plus population deviation of the squared norms: what is brighter counts as cloud."""
    n2 = squared_norm(F.col("spectrum"))
    return pixels.groupBy(*keys).agg((F.avg(n2) + F.stddev_pop(n2)).alias("threshold"))


def cloudless(pixels: DataFrame, keys: list[str]) -> DataFrame:
    return pixels.join(cloud_threshold(pixels, keys), keys).where(squared_norm(F.col("spectrum")) <= F.col("threshold")).drop("threshold")


def common_bands(a: DataFrame, b: DataFrame) -> DataFrame:
    """(band, first, second): bands of two scenes(band, place) with their places in either."""
    return a.select("band", F.col("place").alias("first")).join(b.select("band", F.col("place").alias("second")), "band")


def change(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Chance of change of each pixel that both scenes hold: sin^2 of the angle between its spectra, and its colour."""
    met = a.select(*keys, F.col("spectrum").alias("s1")).join(b.select(*keys, F.col("spectrum").alias("s2")), keys)
    p = radiometry.angle_change(F.col("s1"), F.col("s2"))
    return met.select(*keys, p.alias("change")).withColumns(dict(zip(("change_r", "change_g", "change_b"), change_colour(F.col("change")), strict=True)))


def change_colour(p: Column) -> list[Column]:
    """White without change, red with it."""
    return [F.lit(1.0), 1.0 - 0.5 * p, 1.0 - 0.75 * p]


def nearest(pixels: DataFrame, centers: DataFrame, keys: list[str]) -> DataFrame:
    """Closest centre (cluster) and distance of each pixel; of equally close ones the least number. Centres are few by
    definition, so they are one array beside each pixel and no pair is ever a row."""
    listed = centers.agg(F.array_sort(F.collect_list(F.struct("cluster", "center"))).alias("centers"))
    each = F.transform("centers", lambda c: F.struct(distance(F.col("spectrum"), c["center"]).alias("distance"), c["cluster"].alias("cluster")))
    return pixels.crossJoin(F.broadcast(listed)).withColumn("n_", F.array_min(each)).select(*keys, "spectrum", "n_.cluster", "n_.distance")


def moved_centers(assigned: DataFrame, centers: DataFrame) -> DataFrame:
    """Mean of each centre's pixels, and how many; a centre without pixels stays where it is."""
    parts = assigned.select("cluster", F.posexplode("spectrum").alias("band", "v")).groupBy("cluster", "band").agg(F.avg("v").alias("v"), F.count(F.lit(1)).alias("n"))
    means = parts.groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("band", "v"))), lambda s: s["v"]).alias("mean"), F.max("n").alias("n"))
    return centers.join(means, "cluster", "left").select("cluster", F.coalesce("mean", "center").alias("center"), F.coalesce("n", F.lit(0)).alias("population"))


def cost(assigned: DataFrame) -> DataFrame:
    return assigned.agg(F.sqrt(F.sum(F.col("distance") * F.col("distance"))).alias("cost"))


def k_means(pixels: DataFrame, centers: DataFrame, keys: list[str], rounds: int = 100, still: float = 1e-2, very_still: float = 1e-3) -> DataFrame:
    """Centres after as many rounds as it takes until all move less than `still` and more than half less than `very_still`."""
    for _ in range(rounds):
        new = cut(moved_centers(nearest(pixels, centers, keys), centers))
        moves = new.join(centers.select("cluster", F.col("center").alias("old")), "cluster").select(distance(F.col("center"), F.col("old")).alias("m"))
        r = moves.agg(F.max("m").alias("most"), F.count_if(F.col("m") < very_still).alias("calm"), F.count(F.lit(1)).alias("k")).first()
        centers = new.select("cluster", "center")
        if r.most < still and r.calm > r.k / 2:
            break
    return centers


def seeded(pixels: DataFrame, k: int, seed: int, of: int = 1000) -> DataFrame:
    """k centres drawn from a sample of so many pixels, the same for the same seed."""
    pool = pixels.select("spectrum").orderBy(F.xxhash64("spectrum", F.lit(seed))).limit(max(of, k))
    drawn = pool.orderBy(F.xxhash64("spectrum", F.lit(seed + 1))).limit(k).collect()
    return pixels.sparkSession.createDataFrame([(i, list(r.spectrum)) for i, r in enumerate(drawn)], "cluster int, center array<double>")


def best_start(pixels: DataFrame, k: int, keys: list[str], trials: int = 10, of: int = 1000, rounds: int = 10) -> DataFrame:
    """The cheapest of several clusterings of samples, as centres to go on from with all pixels."""
    found = []
    for seed in range(trials):
        part = cut(pixels.orderBy(F.xxhash64("spectrum", F.lit(seed))).limit(of))
        centers = k_means(part, seeded(part, k, seed, of), keys, rounds)
        found.append((cost(nearest(part, centers, keys)).first().cost, seed, centers))
    return min(found, key=lambda r: r[:2])[2]


def commonness(assigned: DataFrame, keys: list[str]) -> DataFrame:
    """Population of a pixel's cluster over its distance, and its rareness on 256 steps of the scene's range."""
    sizes = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("population"))
    rows = assigned.join(F.broadcast(sizes), "cluster").withColumn("commonness", F.col("population") / F.col("distance"))
    ends = rows.agg(F.min("commonness").alias("lo"), F.max("commonness").alias("hi"))
    return rows.crossJoin(F.broadcast(ends)).select(*keys, "cluster", "commonness", F.least((F.col("hi") - F.col("commonness")) / (F.col("hi") - F.col("lo")) * 256, F.lit(255.0)).cast("int").alias("rareness"))


def covariance(assigned: DataFrame) -> DataFrame:
    """(cluster, i, j, covariance), i <= j: sample covariance of each two bands within a cluster.

    Sums of products of the deviations from the cluster's mean, by cluster and pair of bands, which combine before the shuffle.
    """
    values = assigned.select("cluster", F.posexplode("spectrum").alias("band", "v"))
    means = values.groupBy("cluster", "band").agg(F.avg("v").alias("m")).groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("band", "m"))), lambda s: s["m"]).alias("mean"))
    off = assigned.join(F.broadcast(means), "cluster").select("cluster", F.zip_with("spectrum", "mean", lambda v, m: v - m).alias("d"))
    pairs = off.select("cluster", "d", F.posexplode("d").alias("i", "di")).select("cluster", "i", "di", F.posexplode("d").alias("j", "dj")).where("i <= j")
    return pairs.groupBy("cluster", "i", "j").agg((F.sum(F.col("di") * F.col("dj")) / (F.count(F.lit(1)) - 1)).alias("covariance"))


def significance(assigned: DataFrame, centers: DataFrame, keys: list[str]) -> DataFrame:
    """Distance of a pixel from its centre over the cluster's deviation in that direction, sqrt(u' C u).

    The covariance of a cluster is one broadcast matrix; pixels stream past it in Arrow batches.
    """
    matrix = covariance(assigned).groupBy("cluster").agg(F.collect_list(F.struct("i", "j", "covariance")).alias("c"))
    known = {r.cluster: (np.array(r.center), r.c) for r in centers.join(matrix, "cluster").collect()}
    table = {}
    for cluster, (center, cells) in known.items():
        c = np.zeros((len(center),) * 2)
        for x in cells:
            c[x.i, x.j] = c[x.j, x.i] = x.covariance
        table[cluster] = (center, c)
    shared = assigned.sparkSession.sparkContext.broadcast(table)
    schema = assigned.select(*keys, "cluster").schema.add("significance", "double")

    def run(frames):
        for f in frames:
            out = np.full(len(f), np.nan)
            for cluster, rows in f.groupby("cluster").indices.items():
                if cluster in shared.value:
                    center, c = shared.value[cluster]
                    d = np.stack(f["spectrum"].to_numpy()[rows]) - center
                    n = np.sqrt((d * d).sum(1))
                    u = np.divide(d, n[:, None], out=np.zeros_like(d), where=n[:, None] > 0)
                    s = np.sqrt(np.maximum((u @ c * u).sum(1), 0))
                    out[rows] = np.divide(n, s, out=np.full(len(n), np.nan), where=s > 0)
            yield f[[*keys, "cluster"]].assign(significance=out)

    return assigned.select(*keys, "cluster", "spectrum").mapInPandas(run, schema)


def seeds(significances: DataFrame, most: float = 2.5) -> DataFrame:
    """The cluster where a pixel is within so many deviations, else -1."""
    return significances.withColumn("seed", F.when(F.col("significance") < most, F.col("cluster")).otherwise(-1))


def outliers(significances: DataFrame, least: float = 5.0) -> DataFrame:
    return significances.withColumn("outlier", F.when(F.col("significance") > least, F.col("cluster")).otherwise(-1))


def anomalous(assigned: DataFrame, share: float = 0.02) -> DataFrame:
    """Clusters with less than that share of all pixels."""
    sizes = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("population"))
    total = sizes.agg(F.sum("population").alias("total"))
    return sizes.crossJoin(F.broadcast(total)).where(F.col("population") < F.col("total") * share).drop("total")


def by_mean_wavelength(centers: DataFrame, nanometres: list[float]) -> DataFrame:
    """Clusters in the order of the mean wavelength, weighted by their centres."""
    from pyspark.sql import Window as W

    lam = F.array(*[F.lit(float(x)) for x in nanometres])
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    mean = total(F.zip_with("center", lam, lambda w, x: w * x)) / total(F.col("center"))
    return centers.select("cluster", mean.alias("mean_wavelength")).withColumn("place", F.row_number().over(W.orderBy("mean_wavelength", "cluster")))


def grown(labels: DataFrame, width: int, height: int) -> DataFrame:
    """One step of region growing: an unassigned pixel (-1) next to a cluster, across the edges too, takes that of the most
    alike neighbour, 1 / distance. labels(y, x, spectrum, cluster). Each pixel sends itself to its four neighbours; no two
    pixels are joined but neighbours."""
    steps = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in ((0, 1), (0, -1), (1, 0), (-1, 0))])
    sent = labels.where("cluster >= 0").select("y", "x", F.col("spectrum").alias("s"), F.col("cluster").alias("c"), F.explode(steps).alias("d"))
    sent = sent.select(F.pmod(F.col("y") + F.col("d.dy"), F.lit(height)).alias("ny"), F.pmod(F.col("x") + F.col("d.dx"), F.lit(width)).alias("nx"), "s", "c")
    met = labels.where("cluster < 0").join(sent, (F.col("y") == F.col("ny")) & (F.col("x") == F.col("nx")))
    taken = met.groupBy("y", "x").agg(F.min(F.struct(distance(F.col("spectrum"), F.col("s")).alias("d"), "c")).alias("n_")).select(F.col("y").alias("ty"), F.col("x").alias("tx"), F.col("n_.c").alias("new"))
    return labels.join(taken, (F.col("y") == F.col("ty")) & (F.col("x") == F.col("tx")), "left").select("y", "x", "spectrum", F.coalesce("new", "cluster").alias("cluster"))


def region_growth(labels: DataFrame, width: int, height: int, steps: int = 19) -> DataFrame:
    for _ in range(steps):
        labels = cut(grown(labels, width, height))
    return labels


def growth_frames(labels: DataFrame, width: int, height: int, steps: int) -> DataFrame:
    """(step, y, x, cluster) after each step of growing, step 0 being the start: the frames of a film of it."""
    labels = cut(labels)
    frames = labels.select(F.lit(0).alias("step"), "y", "x", "cluster")
    for step in range(1, steps + 1):
        labels = cut(grown(labels, width, height))
        frames = frames.unionAll(labels.select(F.lit(step), "y", "x", "cluster"))
    return frames


def band_deviation(spectrum: Column) -> Column:
    """Population deviation of a pixel's bands."""
    n = F.size(spectrum).cast("double")
    mean = F.aggregate(spectrum, F.lit(0.0), lambda s, v: s + v) / n
    return F.sqrt(F.aggregate(spectrum, F.lit(0.0), lambda s, v: s + (v - mean) * (v - mean)) / n)


def on_grid(pixels: DataFrame, own: list[float], other: list[float]) -> DataFrame:
    """Pixels with row and col of the other scene's grid, by the two affine transforms: the nearest place, so that pixels of
    two scenes meet by equality. Rotation terms aren't applied."""
    lon, lat = F.lit(own[0]) + (F.col("x") + 0.5) * own[1], F.lit(own[3]) + (F.col("y") + 0.5) * own[5]
    place = lambda v, start, step: F.floor((v - start) / step).cast("int")
    return pixels.withColumns({"col": place(lon, other[0], other[1]), "row": place(lat, other[3], other[5])})


def aligned_change(a: DataFrame, b: DataFrame, a_transform: list[float], b_transform: list[float]) -> DataFrame:
    """Change of scene b against scene a where they overlap, on a's grid; of several pixels of b in one place the first."""
    on = on_grid(b, b_transform, a_transform).groupBy("row", "col").agg(F.min_by("spectrum", F.struct("y", "x")).alias("spectrum"))
    return change(a.select(F.col("y").alias("row"), F.col("x").alias("col"), "spectrum"), on, ["row", "col"])
