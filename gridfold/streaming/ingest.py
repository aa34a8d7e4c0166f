"""Streams of points: files that arrive, the same steps as for batches, and upserts into a store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridfold.functions import tiling
from gridfold.sources.store import Store


def arriving(spark: SparkSession, path: str, schema: str | StructType, kind: str = "parquet", files_at_once: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).format(kind).load(path)


def bright_stream(points: DataFrame, threshold: float) -> DataFrame:
    """Points above a threshold, with tile and row key."""
    placed = tiling.with_tile(points.where(F.col("intensity") > threshold)).withColumn("identifier", tiling.place_id("lon", "lat"))
    return placed.withColumn("row_key", tiling.point_key(tiling.tile_name(tiling.DEEPEST, "long_index", "lat_index"), "ts", "identifier"))


def upsert_into(stream: DataFrame, store: Store, checkpoint: str, step: Callable[[DataFrame], DataFrame] = lambda df: df):
    """All that has arrived, once; the checkpoint knows what was taken, and an upsert may run twice without harm."""

    def batch(df: DataFrame, _: int) -> None:
        if not df.isEmpty():
            store.upsert(step(df))

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tile_counts(points: DataFrame, depth: int, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Count and greatest intensity by tile and time window; points later than `late` are left out."""
    timed = points.withColumn("time", F.timestamp_seconds("ts")).withWatermark("time", late)
    up = F.lit(tiling.DEEPEST - depth)
    tile = tiling.tile_name(F.lit(depth), tiling.ancestor("long_index", up), tiling.ancestor("lat_index", up))
    return timed.groupBy(F.window("time", window).alias("w"), tile.alias("tile")).agg(F.count(F.lit(1)).alias("n"), F.max("intensity").alias("highest")).select(F.unix_timestamp("w.start").alias("start"), "tile", "n", "highest")
