"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, hash60, held, small

#: A word with the white space behind it, and the characters that are white space.
WORD, SPACE = r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", " \t\n\x0b\x0c\r"
#: Cells of a level of the permutation: 12 bits of its 60-bit hash.
CELL_BITS = 12
#: Blocks into which a source's permuted documents are cut: 6 bits.
BLOCK_BITS = 6


def size_of(text: str = "text") -> Column:
    """Words of a text; 0 for null. Each becomes one character: regexp_count would make a list of all words of a text."""
    return F.coalesce(F.length(F.translate(F.regexp_replace(F.col(text), WORD, "x"), SPACE, "")), F.lit(0)).cast("long")


def with_keys(docs: DataFrame, seed: str, text: str = "text", source: str = "source") -> DataFrame:
    return docs.select(F.col("doc_id"), F.col(source).alias("source"), size_of(text).alias("size"), hash60(seed, F.col("doc_id")).alias("h"))


def targets(sources: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int) -> DataFrame:
    """sources(source, source_size) with the double target.

    Sources in code-point order, null last, weigh `weights` in turn and share share[0]/share[1] of all sizes; a target
    stops at `most` times its source's size, and the excess is shared again by weight until none is above. With
    sources ordered by cap / weight, the first at which an even level reaches no cap fixes that level for all that follow.
    One row a source, in one window: sources are names, not documents.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")).cast("long")
    up = W.orderBy("ratio", F.col("source").asc_nulls_last())
    rest = up.rowsBetween(W.currentRow, W.unboundedFollowing)
    before = up.rowsBetween(W.unboundedPreceding, -1)
    caps = (
        sources.withColumn("w", weight).withColumn("cap", F.col("source_size") * most).withColumn("ratio", F.col("cap") / F.col("w"))
        .withColumn("over", F.lit(share[0]) * F.sum("source_size").over(W.partitionBy()) - F.lit(share[1]) * F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("wsum", F.lit(share[1]) * F.sum("w").over(rest))
    )
    level = F.min(F.when(F.col("over") * F.col("w") <= F.col("wsum") * F.col("cap"), F.struct("ratio", F.col("over") / F.col("wsum")))).over(W.partitionBy())
    leveled = caps.withColumn("level", level["col2"])
    return leveled.select("source", "source_size", F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("w"), F.col("cap").cast("double"))).alias("target"))


def mix_plan(keys: DataFrame, weights=(5, 2, 1), share=(3, 2), most: int = 2, patches: int = 3) -> DataFrame:
    """One row a source: source, source_size, target, base, h_cut, patches.

    A document of hash h is taken base times, and once more if h <= h_cut or h is one of patches. Documents stand in
    the order of their hash; h_cut ends the longest run of them that fits into what the target leaves after `base`
    whole copies, and patches are the largest further documents that fit into the gap, one after the other. The run's end is found from sums
    by hash cell on two levels, so no task sees more than 4096 cells of a source, however many documents it has.
    """
    units = cut(keys.groupBy("source", "h").agg(F.sum("size").alias("words")))

    def cell(level: int) -> Column:
        return F.shiftright("h", 60 - CELL_BITS * level)

    first = cut(units.groupBy("source", cell(1).alias("c1")).agg(F.sum("words").alias("words")))
    plan = targets(first.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    plan = plan.withColumn("base", F.floor(F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most - 1.0))).otherwise(0)))
    plan = held(plan.withColumn("left", F.floor(F.col("target") - F.col("base") * F.col("source_size"))))

    def edge(cells: DataFrame, c: str, room: DataFrame) -> DataFrame:
        """The first cell of each source that doesn't fit whole into its room, and the words before it."""
        ran = beside(cells.withColumn("cum", F.sum("words").over(W.partitionBy("source").orderBy(c))), room)
        return ran.where(F.col("cum") > F.col("room")).groupBy("source").agg(F.min(F.struct(c, (F.col("cum") - F.col("words")).alias("before"))).alias("e")).select("source", f"e.{c}", "e.before")

    room = plan.select("source", F.col("left").alias("room"))
    at1 = held(edge(first, "c1", room))
    inside = beside(units, at1.select("source", F.col("c1").alias("x1"))).where(cell(1) == F.col("x1"))
    second = inside.groupBy("source", (cell(2) - F.shiftleft("x1", CELL_BITS)).alias("c2")).agg(F.sum("words").alias("words"))
    room = held(beside(room, at1).select("source", (F.col("room") - F.col("before")).alias("room")))
    at2 = held(edge(second, "c2", room))
    last = beside(inside, at2.select("source", F.col("c2").alias("x2"))).where(cell(2) == F.shiftleft("x1", CELL_BITS) + F.col("x2"))
    room = held(beside(room, at2).select("source", (F.col("room") - F.col("before")).alias("room")))
    ends = beside(edge(last, "h", room), room)
    gap = held(ends.select("source", (F.col("h") - 1).alias("h_cut"), (F.col("room") - F.col("before")).alias("gap")))
    fits = (F.col("h") > F.col("h_cut")) & (F.col("words") <= F.col("gap")) & (F.col("words") > 0) & ~F.array_contains("patches", F.col("h"))
    gap = gap.withColumn("patches", F.array().cast("array<long>"))
    for _ in range(patches):
        best = beside(units, gap).where(fits).groupBy("source").agg(F.max(F.struct("words", (-F.col("h")).alias("m"))).alias("p"))
        gap = held(beside(gap, held(best), "left").select("source", "h_cut", (F.col("gap") - F.coalesce("p.words", F.lit(0))).alias("gap"), F.when(F.col("p").isNull(), F.col("patches")).otherwise(F.array_append("patches", -F.col("p.m"))).alias("patches")))
    out = beside(plan, gap, "left")
    return held(out.select("source", "source_size", "target", "base", F.coalesce("h_cut", F.lit((1 << 60) - 1)).alias("h_cut"), F.coalesce("patches", F.array().cast("array<long>")).alias("patches")))


def beside(rows: DataFrame, by: DataFrame, how: str = "inner") -> DataFrame:
    """rows with the columns of by(source, ...) beside them; null is a source. by has a row a source and is broadcast if few."""
    by = by.withColumnRenamed("source", "s_")
    return rows.join(small(by), F.col("source").eqNullSafe(F.col("s_")), how).drop("s_")


def copies() -> Column:
    """Times that a row of hash h is taken, with its source's plan beside it."""
    return (F.col("base") + F.when((F.col("h") <= F.col("h_cut")) | F.array_contains("patches", F.col("h")), 1).otherwise(0)).cast("int")


def split_tree(keyed: DataFrame, plan: DataFrame, seed: str, levels: int) -> DataFrame:
    """(source, copy, block, shard): each drawn block of permuted documents, dealt to one of 2^levels output shards.

    A node of the tree holds the block quotas of all sources and gives half of its blocks, drawn without replacement, to
    each child: the sources' shares of a half are one multivariate-hypergeometric draw. Blocks are at most 64 a source
    and copy, so a node is a few thousand rows at any input size.
    """
    blocks = keyed.where(F.col("copies") > 0).groupBy("source", F.col("block")).agg(F.max("copies").alias("most"))
    tree = blocks.select("source", "block", F.explode(F.sequence(F.lit(1), F.col("most"))).alias("copy")).withColumn("shard", F.lit(0))
    for level in range(levels):
        w = W.partitionBy("shard")
        key = hash60(f"{seed}/{level}", F.col("source"), F.col("block"), F.col("copy"))
        at = F.row_number().over(w.orderBy(key, F.col("source").asc_nulls_last(), "block", "copy"))
        tree = tree.select("source", "block", "copy", (F.col("shard") * 2 + F.when(at * 2 > F.count(F.lit(1)).over(w) + 1, 1).otherwise(0)).alias("shard"))
    return cut(tree)


def mix(docs: DataFrame, weights=(5, 2, 1), share=(3, 2), most: int = 2, levels: int = 3, seed: str = "mix", text: str = "text", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """The mix: a row for each row of docs with doc_id, source, size, source_size, target, copies, shard_1 to shard_<most>; and the plan by source.

    shard_k is the output shard of a row's k-th copy, null if it has none; h orders a shard's rows locally. Null texts
    have size 0; a null source is a source of its own; rows of equal doc_id and source move together. An empty table
    gives no rows. Only doc_id, text and source are read, so other columns may have any name.
    """
    keys = cut(with_keys(docs, seed, text, source))
    plan = mix_plan(keys, weights, share, most)
    rows = beside(keys, plan).withColumn("copies", copies())
    rows = rows.withColumn("block", F.shiftright("h", 60 - BLOCK_BITS).cast("int"))
    tree = small(split_tree(rows, plan, seed, levels))
    for k in range(1, most + 1):
        t = tree.where(F.col("copy") == k).select(F.col("source").alias("s_"), F.col("block").alias("b_"), F.col("shard").alias(f"shard_{k}"))
        rows = rows.join(t, F.col("source").eqNullSafe(F.col("s_")) & (F.col("block") == F.col("b_")) & (F.col("copies") >= k), "left").drop("s_", "b_")
    return rows, plan


def mix_documents(docs: DataFrame, seed: str = "mix", levels: int = 3, **options) -> DataFrame:
    """docs as mixed: each row as often as it is taken, in its own columns, shard after shard of the splitting tree and in
    random order within a shard, the same at each run.

    A row's block has a shard for each of its copies, which the tree deals. The order is a range shuffle by shard and hash, so
    a shard is not one task. Null texts have size 0; a null source is a source of its own; repeated rows are taken each; an
    empty table gives no rows; columns may have any name.
    """
    names = docs.columns
    keys = cut(with_keys(docs, seed))
    plan = small(mix_plan(keys, **options))
    block = F.shiftright("h", 60 - BLOCK_BITS).cast("int")
    tree = small(split_tree(beside(keys, plan).withColumn("copies", copies()).withColumn("block", block), plan, seed, levels))
    t = tree.select(F.col("source").alias("t_"), F.col("block").alias("b_"), "copy", "shard")
    p = plan.select(F.col("source").alias("s_"), "base", "h_cut", "patches")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("source").alias("k_"), hash60(seed, F.col("doc_id")).alias("h"))
    met = keyed.join(p, F.col("k_").eqNullSafe(F.col("s_"))).withColumn("copies", copies()).where(F.col("copies") > 0).withColumn("block", block)
    drawn = met.join(t, F.col("k_").eqNullSafe(F.col("t_")) & (F.col("block") == F.col("b_")) & (F.col("copy") <= F.col("copies")))
    drawn = drawn.select("row", "shard", F.xxhash64("h", "copy").alias("place"))
    return drawn.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place").select("row.*")
