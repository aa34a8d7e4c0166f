"""Zero suppression: runs of consecutive cells that aren't 0, and back to dense rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def runs(cells: DataFrame, keys: list[str], index: str = "i", value: str = "v") -> DataFrame:
    """(keys, start, length, strip): maximal runs of cells that aren't 0, by the difference of index and rank among them."""
    kept = cells.where(F.col(value) != 0)
    island = F.col(index) - F.row_number().over(W.partitionBy(*keys).orderBy(index))
    strip = F.transform(F.array_sort(F.collect_list(F.struct(index, value))), lambda s: s[value])
    return kept.withColumn("island_", island).groupBy(*keys, "island_").agg(F.min(index).alias("start"), F.count(F.lit(1)).alias("length"), strip.alias("strip")).drop("island_")


def dense(suppressed: DataFrame, sizes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, i, v) for each index below sizes(keys, size): the runs' values, 0 in the gaps."""
    values = suppressed.select(*keys, "start", F.posexplode("strip").alias("at_", "v")).select(*keys, (F.col("start") + F.col("at_")).alias("i"), "v")
    places = sizes.where("size > 0").select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1)).alias("i"))
    return places.join(values, [*keys, "i"], "left").select(*keys, "i", F.coalesce("v", F.lit(0.0)).alias("v"))
