"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, mapped, slices, texts
from .components import components

BITS = 64
#: Members of a bucket that are compared pair by pair; a larger bucket is hashed again on its other bits.
DENSE = 4096


def fingerprint(text: str, words: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles (A-Z lowered, repeats counted), each bit the majority of the shingles' XXH64."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(tokens) - words + 1
    if not tokens:
        return 0
    if n < 2:
        return xxhash.xxh64_intdigest(b" ".join(tokens), seed)
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[i:j], seed) for i, j in zip((ends - lengths)[:n].tolist(), ends[words - 1 :].tolist(), strict=True)], ">u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 255):
        ones += np.add.reduce(np.unpackbits(h[at : at + 255].view(np.uint8)).reshape(-1, BITS), 0, np.uint8)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of each whole text; null texts count as empty, which have 0."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                fps = np.array([fingerprint(t, words) for t in part.column("text").to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fps)], names=["doc_id", "fp"])

    return mapped(texts(docs), run, "doc_id long, fp long")


def ball(fp: Column, block: int, width: int, radius: int) -> Column:
    """Array of the block's variants within the radius (0, 1 or 2 flipped bits), tagged with the block's number."""
    part = F.shiftrightunsigned(fp, block * width).bitwiseAND(F.lit((1 << width) - 1)) if width < BITS else fp
    # 64-bit blocks leave no room for a tag, and there is but one of them
    tag = F.lit(block << width if width < BITS else 0)
    ones = [1 << i for i in range(width)]
    masks = [0] + ones * (radius >= 1) + [a ^ b for i, a in enumerate(ones) for b in ones[:i]] * (radius >= 2)
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    if len(masks) <= 256:
        return F.array(*[part.bitwiseXOR(F.lit(m).cast("long")).bitwiseOR(tag.cast("long")) for m in masks])
    return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: part.bitwiseXOR(m).bitwiseOR(tag.cast("long")))


def _pairs(start: np.ndarray, end: np.ndarray, fp: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of rows of the same run; row i's run is [start[i], end[i]). Bits are counted on unsigned numbers: numpy counts those of absolute values."""
    left, right = [], []
    rows = np.flatnonzero(end - start > 1)
    lag = 1
    while len(rows := rows[rows + lag < end[rows]]):
        near = rows[np.bitwise_count((fp[rows] ^ fp[rows + lag]).view(np.uint64)) <= most]
        left.append(near), right.append(near + lag)
        lag += 1
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64),) * 2


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each row's run of equal keys."""
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
    size = np.diff(edge)
    return np.repeat(edge[:-1], size), np.repeat(edge[1:], size)


def forest(key: np.ndarray, fp: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (pairs of ids) of the links, fingerprints within `most` bits, inside each run of equal keys."""
    start, end = _runs(key)
    size = end - start
    big = size > DENSE
    if big.any():
        a, b = zip(*(_large(fp[i:j], ids[i:j], most) for i, j in dict.fromkeys(zip(start[big].tolist(), end[big].tolist(), strict=True))), strict=True)
        if not big.all():
            x, y = forest(key[~big], fp[~big], ids[~big], most)
            a, b = (*a, x), (*b, y)
        return np.concatenate(a), np.concatenate(b)
    i, j = _pairs(start, end, fp, most)
    return spanning(i, j, ids)


def spanning(i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids, one for each row but a component's least, that connect what the links (i, j) of rows connect."""
    label = np.arange(len(ids))
    while len(i):
        low = np.minimum(label[i], label[j])
        if (label[i] == low).all() and (label[j] == low).all():
            break
        np.minimum.at(label, i, low), np.minimum.at(label, j, low)
        while (label[label] != label).any():
            label = label[label]
    at = np.flatnonzero(label != np.arange(len(ids)))
    return ids[at], ids[label[at]]


def _large(fp: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """forest of one large run: its rows are hashed again, on balls in each 16-bit block of the fingerprint.

    A pair within 4 bits has a block of at most one differing bit among four, so exact blocks and their one-bit variants
    on one side meet. Runs that stay large hold rows that agree in a 16-bit block; they're compared in slabs.
    """
    if most > 4:
        raise ValueError("large buckets are rehashed for at most 4 bits")
    out_a, out_b = [], []
    for block in range(4):
        part = ((fp.view(np.uint64) >> np.uint64(16 * block)) & np.uint64(0xFFFF)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part, f, d = part[order], fp[order], ids[order]
        for mask in [0, *(1 << k for k in range(16))]:
            # rows whose block is c against rows whose block is c ^ mask
            low, high = np.searchsorted(part, part ^ mask), np.searchsorted(part, part ^ mask, "right")
            for i in range(0, len(f), 1 << 16):
                rows = np.arange(i, min(i + (1 << 16), len(f)))
                if mask:
                    rows = rows[part[rows] < part[rows] ^ mask]
                at = np.maximum(low[rows], rows + 1) if mask == 0 else low[rows].copy()
                keep_a, keep_b = [], []
                while len(rows):
                    live = at < high[rows]
                    rows, at = rows[live], at[live]
                    near = np.bitwise_count((f[rows] ^ f[at]).view(np.uint64)) <= most
                    keep_a.append(rows[near]), keep_b.append(at[near])
                    at = at + 1
                    if sum(map(len, keep_a)) > 1 << 20:
                        x, y = spanning(np.concatenate(keep_a), np.concatenate(keep_b), d)
                        out_a.append(x), out_b.append(y)
                        keep_a, keep_b = [], []
                if keep_a:
                    x, y = spanning(np.concatenate(keep_a), np.concatenate(keep_b), d)
                    out_a.append(x), out_b.append(y)
    return np.concatenate(out_a), np.concatenate(out_b)


def links(classes: DataFrame, most: int = 4, blocks: int = 2) -> DataFrame:
    """Links (a, b) that connect what all pairs of fingerprints within `most` bits connect. classes(fp, id), fp distinct.

    Meet in the middle: with blocks=1 every fingerprint emits all variants within most/2 bits, and two within `most` bits
    share one. With more blocks the bits are split first: some block differs in at most most/blocks bits, and each block
    emits its variants within half of that. 64 bits at 4: 2,081 variants in one block, 2 x 33 in two.
    Rows meet by variant; each bucket's pairs are verified on all 64 bits, and a spanning forest of its links is returned.
    """
    width = BITS // blocks
    radius = (most // blocks + 1) // 2
    if radius > 2:
        raise ValueError("balls of at most 2 bits")
    variants = F.flatten(F.array(*[ball(F.col("fp"), b, width, radius) for b in range(blocks)]))
    # classes are small and their variants many: as many tasks emit them as take them, however few bytes the classes have
    spread = classes.repartition(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    emitted = spread.select(F.explode(variants).alias("key"), "fp", "id")
    dealt = emitted.repartition(F.col("key")).sortWithinPartitions("key", "fp")

    def run(batches):
        held: list[tuple[np.ndarray, ...]] = []

        def out(parts):
            rows = [np.concatenate(x) for x in zip(*parts, strict=True)]
            a, b = forest(*rows, most)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            cols = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            key = cols[0]
            if not len(key):
                continue
            # the last run may go on in the next batch
            if not held or held[-1][0][-1] != key[-1]:
                last = int(np.searchsorted(key, key[-1]))
                if held or last:
                    yield out([*held, tuple(c[:last] for c in cols)])
                held, cols = [], tuple(c[last:] for c in cols)
            held.append(cols)
        if held:
            yield out(held)

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    return mapped(dealt, run, schema).distinct()


def near_duplicates(docs: DataFrame, most: int = 4, blocks: int = 2, words: int = 4) -> DataFrame:
    """A row a document: doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable by links.

    Empty, null and white texts have fingerprint 0 and are linked like any others. Equal fingerprints are one class from
    the start, so copies never meet each other in a bucket. Rows with a null doc_id get the component of their class's
    other documents, or null, and link nothing. An empty table gives no rows; only doc_id and text are read.
    """
    fps = cut(fingerprints(docs, words))
    classes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("id")).where("id is not null"))
    found = components(links(classes, most, blocks))
    named = classes.join(found.withColumnRenamed("id", "k"), F.col("id") == F.col("k"), "left").select(F.col("fp").alias("f"), F.coalesce("component", "id").alias("component_id"))
    return fps.join(named, F.col("fp") == F.col("f"), "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """docs with one document of each group of near-duplicates, the one of smallest doc_id, in its own columns.

    Of repeated rows with that doc_id one stays; rows with a null doc_id stay, since nothing names them.
    """
    names = docs.columns
    kept = near_duplicates(docs, **options).where("doc_id = component_id").select(F.col("doc_id").alias("k")).distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id").alias("d"))
    firsts = row.where("d is not null").join(kept, F.col("d") == F.col("k"), "left_semi").groupBy("d").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return firsts.select("row.*").unionByName(row.where("d is null").select("row.*"))
