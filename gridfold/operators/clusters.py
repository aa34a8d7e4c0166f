"""Bright spots: threshold, intensity-weighted clusters of places, and statistics by cluster."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridfold.functions import tiling


def bright(pixels: DataFrame, threshold: float | str, scene: str = "scene_id", value: str = "intensity") -> DataFrame:
    """Pixels above a number, or above a percentile "p%" of their scene."""
    if isinstance(threshold, str) and threshold.endswith("%"):
        limits = pixels.groupBy(scene).agg(F.percentile(value, float(threshold[:-1]) / 100.0).alias("t_")).withColumnRenamed(scene, "s_")
        return pixels.join(limits, F.col(scene) == F.col("s_")).where(F.col(value) > F.col("t_")).drop("s_", "t_")
    return pixels.where(F.col(value) > float(threshold))


def statistics(rows: DataFrame) -> DataFrame:
    """rows(cluster, distance, weight, ts): by cluster the count, the sum and maximum (0 at least) of the weights, the root
    mean square distance, plain and weighted, and the last time."""
    d2 = F.col("distance") * F.col("distance")
    w = F.col("weight")
    return rows.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(w).alias("total"), F.greatest(F.max(w), F.lit(0.0)).alias("highest"), F.sqrt(F.sum(d2) / F.count(F.lit(1))).alias("rms"),
        F.sqrt(F.sum(w * d2) / F.sum(w)).alias("weighted_rms"), F.max("ts").alias("ts"),
    )


def assign(points: DataFrame, centers: DataFrame) -> DataFrame:
    """Each point with its closest centre(cluster, clon, clat) and the distance; few centres, as one array."""
    listed = centers.agg(F.array_sort(F.collect_list(F.struct("cluster", "clon", "clat"))).alias("centers"))
    d = lambda c: F.sqrt((F.col("lon") - c["clon"]) * (F.col("lon") - c["clon"]) + (F.col("lat") - c["clat"]) * (F.col("lat") - c["clat"]))
    best = F.array_min(F.transform("centers", lambda c: F.struct(d(c).alias("distance"), c["cluster"].alias("cluster"))))
    return points.crossJoin(F.broadcast(listed)).withColumn("b_", best).drop("centers").select("*", "b_.cluster", "b_.distance").drop("b_")


def fit(points: DataFrame, k: int = 20, seed: int = 1, tolerance: float = 1e-5) -> DataFrame:
    """Centres of k weighted clusters of (lon, lat); a point weighs its squared intensity."""
    rows = VectorAssembler(inputCols=["lon", "lat"], outputCol="features").transform(points.withColumn("weight", F.col("intensity") * F.col("intensity")).where("weight > 0"))
    model = KMeans(k=k, weightCol="weight", tol=tolerance, seed=seed, maxIter=100).fit(rows)
    return points.sparkSession.createDataFrame([(i, float(c[0]), float(c[1])) for i, c in enumerate(model.clusterCenters())], "cluster int, clon double, clat double")


def spots(points: DataFrame, centers: DataFrame) -> DataFrame:
    """The clusters as points of the map: place, row key and statistics."""
    stats = statistics(assign(points.withColumn("weight", F.col("intensity") * F.col("intensity")), centers))
    placed = tiling.with_tile(stats.join(F.broadcast(centers), "cluster"), lon="clon", lat="clat")
    name = tiling.tile_name(tiling.DEEPEST, "long_index", "lat_index")
    return placed.withColumn("identifier", tiling.place_id("clon", "clat")).withColumn("row_key", tiling.point_key(name, "ts", "identifier"))
