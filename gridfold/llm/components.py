"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    return both.join(least, F.col("a") == F.col("k")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
    met = down.join(least, F.col("a") == F.col("k"))
    return met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select(F.col("k").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every id in edges(a, b), component the smallest id reachable.

    Each round is two shuffles of the links; a round at least halves the depth, so a few rounds do. Rows of a hub are
    joined with one row, which skew handling splits; nothing is gathered in one place. Self-links count as no links.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    for _ in range(rounds):
        now = cut(_small_star(_large_star(now)))
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
