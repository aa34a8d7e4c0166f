"""Exact substring dedup: repeated byte strings by hash-compared suffix sorting.

Strings of WINDOW bytes that occur twice are found without sorting every suffix of the corpus. Each window names one of
its K-byte grams, the least by hash, so equal windows name equal grams at equal offsets: only suffixes around such anchors
need to meet. An anchor whose whole surroundings occur twice, by a 128-bit BLAKE2b digest, settles its windows at once. The rest, at the ends of
repeated regions, come together with their surroundings by anchor and are suffix-sorted there: prefix polynomial hashes
and binary search give the common extension of two suffixes, a mergesort compares by it, and neighbours' extensions, whose
bytes are then compared, say which windows occur twice.
"""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import mapped, slices, text_or_empty, written

WINDOW = 200
GRAM = 80
#: Places of a gram in a window.
PLACES = WINDOW - GRAM + 1
#: Bytes beside an anchor's start that its windows can cover.
LEFT, RIGHT = PLACES - 1, WINDOW
#: Surroundings of one anchor that a task sorts; more are counted window by window in a further shuffle.
MOST = 20_000
BLOCK = 1 << 19

# Odd, so that powers have inverses modulo 2^64; two of them for independent hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class _Powers:
    """Powers of the bases and of their inverses, as far as they have been needed."""

    def __init__(self):
        self.up, self.down = ([np.ones(1, np.uint64)] * 2 for _ in range(2))

    def upto(self, n: int, k: int = 0) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up[k]) < n:
            size = max(n, 1 << 16, 2 * len(self.up[k]))
            for table, base in ((self.up, BASES[k]), (self.down, pow(BASES[k], -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                table[k] = np.multiply.accumulate(steps)
        return self.up[k], self.down[k]


POWERS = _Powers()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def prefix(data: np.ndarray, k: int = 0) -> np.ndarray:
    """p with p[j] - p[i] the sum of (byte + 1) * base^position over i..j-1."""
    up, _ = POWERS.upto(len(data) + 1, k)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def digests(parts: Iterable[bytes]) -> np.ndarray:
    """A row of two numbers for each string: its BLAKE2b digest of 128 bits."""
    out = bytearray()
    for part in parts:
        out += blake2b(part, digest_size=16).digest()
    return np.frombuffer(out, np.int64).reshape(-1, 2)


def anchors(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(position, least offset, greatest offset, gram hash, two numbers of the surroundings' digest) of a text's anchors.

    The windows that name an anchor are those that start at position - offset. Surroundings reach LEFT bytes to the left
    and RIGHT to the right, or the text's ends, whose distances the first number holds too.
    """
    n = len(data)
    if n < WINDOW:
        return (np.zeros(0, np.int64),) * 6
    p = prefix(data)
    _, down = POWERS.upto(n + 1)
    gram = mixed((p[GRAM:] - p[:-GRAM]) * down[: n - GRAM + 1])
    parts = []
    for block in range(0, n - WINDOW + 1, BLOCK):
        h = gram[block : block + BLOCK + PLACES - 1]
        # the hash's high bits, then the place: the least is the leftmost of the least
        low = (h & ~np.uint64((1 << 20) - 1)) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while size * 2 <= PLACES:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        rest = PLACES - size
        named = (np.minimum(low[:-rest], low[rest:]) & np.uint64((1 << 20) - 1)).astype(np.int64) + block
        parts.append(named)
    named = np.concatenate(parts)
    first = np.flatnonzero(np.r_[True, named[1:] != named[:-1]])
    last = np.r_[first[1:], len(named)] - 1
    at = named[first]
    start, end = np.maximum(at - LEFT, 0), np.minimum(at + RIGHT, n)
    ends = ((at - start) * 1000 + (end - at)).astype(np.uint64)
    raw = data.tobytes()
    around = digests(raw[i:j] for i, j in zip(start.tolist(), end.tolist(), strict=True))
    return at, at - last, at - first, gram[at].view(np.int64), around[:, 0] ^ mixed(ends).view(np.int64), around[:, 1]


class Suffixes:
    """Suffixes of one text, compared by hash."""

    def __init__(self, data: np.ndarray):
        self.data, self.prefix = data, prefix(data)
        self.down = POWERS.upto(len(data) + 1)[1]

    def common(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at x and y have in common, at most limit: binary search on equal hashes."""
        low, high = np.zeros(len(x), np.int64), np.array(limit, np.int64)
        p, down = self.prefix, self.down
        px, py, dx, dy = p[x], p[y], down[x], down[y]
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = (p[x + mid] - px) * dx == (p[y + mid] - py) * dy
            low = np.where(same, mid, low)
            high = np.where(same, high, mid - 1)
        return low

    def verified(self, x: np.ndarray, y: np.ndarray, length: np.ndarray) -> np.ndarray:
        """length where the bytes agree so far, else the bytes that do."""
        out = length.copy()
        for i in range(0, len(x), 1 << 13):
            n = length[i : i + (1 << 13)]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            bad = self.data[np.repeat(x[i : i + (1 << 13)], n) + step] != self.data[np.repeat(y[i : i + (1 << 13)], n) + step]
            if bad.any():
                row = np.repeat(np.arange(len(n)), n)[bad]
                np.minimum.at(out, i + row, step[bad])
        return out

    def less(self, x: np.ndarray, lx: np.ndarray, y: np.ndarray, ly: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether suffix x of length lx comes before y; for equal ones, ties."""
        n = np.minimum(lx, ly)
        k = self.common(x, y, n)
        inside = k < n
        a, b = np.where(inside, self.data[np.where(inside, x + k, 0)], 0), np.where(inside, self.data[np.where(inside, y + k, 0)], 0)
        return np.where(inside, a < b, np.where(lx == ly, ties, lx < ly))

    def sort(self, start: np.ndarray, length: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Order of the suffixes within each segment (equal, adjacent numbers), by a bottom-up mergesort of all segments at once.

        An element's place in a merged pair of runs is its place in its own run plus the elements of the other run before
        it, which a binary search counts.
        """
        n = len(start)
        order = np.arange(n)
        edge = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1], True])
        first, end = np.repeat(edge[:-1], np.diff(edge)), np.repeat(edge[1:], np.diff(edge))
        width = 1
        while (rows := np.flatnonzero(end - first > width)).size:
            inside = rows - first[rows]
            run = inside // width
            low = first[rows] + (run ^ 1) * width
            high = np.minimum(low + width, end[rows])
            low = np.minimum(low, high)
            base = low.copy()
            item = order[rows]
            right = (run & 1).astype(bool)
            while (live := np.flatnonzero(low < high)).size:
                mid = (low[live] + high[live]) >> 1
                other, own = order[mid], item[live]
                # of equal suffixes, those of the left run come first
                before = self.less(start[other], length[other], start[own], length[own], right[live])
                low[live] = np.where(before, mid + 1, low[live])
                high[live] = np.where(before, high[live], mid)
            place = first[rows] + (run & ~1) * width + inside % width + (low - base)
            order[place] = item
            width *= 2
        return order


def _pairs(order: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours in the order, within a segment."""
    near = segment[order[:-1]] == segment[order[1:]]
    return order[:-1][near], order[1:][near]


def repeated(texts: list[bytes], left: np.ndarray, segment: np.ndarray, least: np.ndarray, greatest: np.ndarray) -> np.ndarray:
    """Which windows of each surrounding occur in another one of its segment: a row an anchor, a column an offset.

    texts: the surroundings, with the anchor `left` bytes from their start. Windows with offsets least..greatest count.
    """
    n = len(texts)
    size = np.fromiter(map(len, texts), np.int64, n)
    base = np.cumsum(size) - size
    data = np.frombuffer(b"".join(texts), np.uint8)
    forth, back = Suffixes(data), Suffixes(data[::-1].copy())
    at, mirror = base + left, len(data) - base - left
    after = size - left
    most_right, most_left = np.zeros(n, np.int64), np.zeros(n, np.int64)
    offsets = np.arange(PLACES)
    sure = np.zeros((n, PLACES), bool)
    for one, x, limit, other, y, other_limit, best, forward in ((forth, at, after, back, mirror, left, most_right, True), (back, mirror, left, forth, at, after, most_left, False)):
        i, j = _pairs(one.sort(x, limit, segment), segment)
        k = one.verified(x[i], x[j], one.common(x[i], x[j], np.minimum(limit[i], limit[j])))
        m = other.verified(y[i], y[j], other.common(y[i], y[j], np.minimum(other_limit[i], other_limit[j])))
        np.maximum.at(best, i, k), np.maximum.at(best, j, k)
        right, low = (k, m) if forward else (m, k)
        both = (offsets >= (WINDOW - right)[:, None]) & (offsets <= low[:, None])
        np.logical_or.at(sure, i, both), np.logical_or.at(sure, j, both)
    own = (offsets >= least[:, None]) & (offsets <= greatest[:, None])
    may = own & (offsets >= (WINDOW - most_right)[:, None]) & (offsets <= most_left[:, None])
    # windows that some third surrounding may share: sorted as suffixes of their own, with all that may equal them
    doubt = may & ~sure
    if doubt.any():
        key = segment * np.int64(PLACES)
        asked = np.unique((key[:, None] + offsets)[doubt])
        row, d = np.nonzero(may)
        keys = key[row] + d
        inside = np.isin(keys, asked)
        row, d, keys = row[inside], d[inside], keys[inside]
        by = np.argsort(keys, kind="stable")
        row, d, keys = row[by], d[by], keys[by]
        start, whole = at[row] - d, np.full(len(row), WINDOW)
        i, j = _pairs(forth.sort(start, whole, keys), keys)
        k = forth.verified(start[i], start[j], forth.common(start[i], start[j], whole[i]))
        for x in (i[k == WINDOW], j[k == WINDOW]):
            sure[row[x], d[x]] = True
    return sure & own


def packed(at, least, greatest):
    return (at << 16) | (least << 8) | greatest


def unpacked(meta):
    return meta >> 16, (meta >> 8) & 255, meta & 255


def _bytes(column) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def find_anchors(rows: DataFrame) -> DataFrame:
    """(doc_id, tag, meta, key, around, around2, again) of all anchors; key is the gram.

    Of anchors alike in gram and surroundings that one batch holds, all are known to occur again; one stands for them under
    the gram, and the others get keys of their own. So what a very common passage sends to one place is a row a batch.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                out = []
                for i, text in enumerate(_bytes(part.column("text"))):
                    at, least, greatest, gram, around, around2 = anchors(np.frombuffer(text, np.uint8))
                    out.append((np.full(len(at), i), packed(at, least, greatest), gram, around, around2))
                row, meta, gram, around, around2 = (np.concatenate(c) for c in zip(*out, strict=True))
                by = np.lexsort((around2, around, gram))
                same = (gram[by][1:] == gram[by][:-1]) & (around[by][1:] == around[by][:-1]) & (around2[by][1:] == around2[by][:-1])
                later, again = np.zeros(len(row), bool), np.zeros(len(row), bool)
                later[by[1:][same]] = True
                again[by[1:][same]] = again[by[:-1][same]] = True
                doc_id = part.column("doc_id").take(pa.array(row))
                own = mixed(meta.view(np.uint64) ^ mixed(np.arange(len(row), dtype=np.uint64) ^ gram.view(np.uint64))).view(np.int64)
                yield pa.RecordBatch.from_arrays([doc_id, part.column("tag").take(pa.array(row)), pa.array(meta), pa.array(np.where(later, own, gram)), pa.array(around), pa.array(around2), pa.array(again)], names=["doc_id", "tag", "meta", "key", "around", "around2", "again"])

    return mapped(rows.select("doc_id", "tag", "text"), run, "doc_id long, tag long, meta long, key long, around long, around2 long, again boolean")


def shared_anchors(found: DataFrame) -> DataFrame:
    """Anchors whose gram occurs again: settled (their surroundings do too), and asked (one of each of a gram's surroundings).

    One shuffle of the anchors; a gram's anchors are sorted, which spills, and never gathered.
    """
    order, all_ = W.partitionBy("key").orderBy("around", "around2"), W.partitionBy("key")
    other = lambda neighbour: F.coalesce((neighbour("around").over(order) == F.col("around")) & (neighbour("around2").over(order) == F.col("around2")), F.lit(False))
    differs = lambda c: F.min(c).over(all_) != F.max(c).over(all_)
    seen = found.withColumns({"prev": other(F.lag), "next": other(F.lead), "several": differs("around") | differs("around2")})
    settled = F.col("again") | F.col("prev") | F.col("next")
    asked = F.col("several") & ~F.col("prev")
    return seen.select("doc_id", "tag", "meta", F.col("key").alias("gram"), settled.alias("settled"), asked.alias("asked")).where("settled or asked")


def surroundings(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """(gram, doc_id, tag, meta, settled, left, around): the bytes around each asked anchor. A text's anchors travel as one row."""
    by = asked.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("gram", "meta", "settled")).alias("asked"))
    by = by.select(F.col("doc_id").alias("d_"), F.col("tag").alias("t_"), "asked")
    met = rows.join(by, F.col("doc_id").eqNullSafe(F.col("d_")) & (F.col("tag") == F.col("t_"))).select("doc_id", "tag", "text", "asked")

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                asked = part.column("asked")
                size = pa.compute.list_value_length(asked).to_numpy(zero_copy_only=False)
                flat = asked.flatten()
                meta = flat.field("meta").to_numpy(zero_copy_only=False)
                at = unpacked(meta)[0]
                row = np.repeat(np.arange(len(size)), size)
                texts = _bytes(part.column("text"))
                around, left = [], np.minimum(at, LEFT)
                for i, a, k in zip(row.tolist(), at.tolist(), left.tolist(), strict=True):
                    around.append(texts[i][a - k : a + RIGHT])
                by = pa.array(row)
                for i in range(0, len(row), 4096):
                    j = min(i + 4096, len(row))
                    take = by.slice(i, j - i)
                    yield pa.RecordBatch.from_arrays(
                        [flat.field("gram").slice(i, j - i), part.column("doc_id").take(take), part.column("tag").take(take), pa.array(meta[i:j]), flat.field("settled").slice(i, j - i), pa.array(left[i:j].astype(np.int32)), pa.array(around[i:j], pa.binary())],
                        names=["gram", "doc_id", "tag", "meta", "settled", "left", "around"],
                    )

    return mapped(met, run, "gram long, doc_id long, tag long, meta long, settled boolean, left int, around binary")


SPANS = "doc_id long, tag long, start long, end long, window long, window2 long"


def _spans(doc_id, tag, start, end, window=None) -> pa.RecordBatch:
    windows = [pa.nulls(len(doc_id), pa.int64()) if window is None else pa.array(np.ascontiguousarray(window[:, k])) for k in (0, 1)]
    return pa.RecordBatch.from_arrays([doc_id, tag, pa.array(start, pa.int64()), pa.array(end, pa.int64()), *windows], names=["doc_id", "tag", "start", "end", "window", "window2"])


def sorted_spans(around: DataFrame, most: int = MOST) -> DataFrame:
    """Spans (doc_id, tag, start, end) that windows repeated at several anchors' surroundings cover, by suffix sorting.

    Anchors with more than `most` surroundings give their single windows instead, with a digest to count them by.
    """
    dealt = around.repartition("gram").sortWithinPartitions("gram")

    def solve(part: pa.RecordBatch) -> pa.RecordBatch:
        gram = part.column("gram").to_numpy(zero_copy_only=False)
        segment = np.cumsum(np.r_[False, gram[1:] != gram[:-1]]).astype(np.int64)
        at, least, greatest = unpacked(part.column("meta").to_numpy(zero_copy_only=False))
        hit = repeated(part.column("around").to_pylist(), part.column("left").to_numpy(zero_copy_only=False).astype(np.int64), segment, least, greatest)
        hit &= ~part.column("settled").to_numpy(zero_copy_only=False)[:, None]
        edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, low = np.nonzero(edge == 1)
        _, high = np.nonzero(edge == -1)
        by = pa.array(row)
        return _spans(part.column("doc_id").take(by), part.column("tag").take(by), at[row] - (high - 1), at[row] - low + WINDOW)

    def windows(part: pa.RecordBatch):
        """Each window of the surroundings by itself, settled or not, with its digest."""
        meta = part.column("meta").to_numpy(zero_copy_only=False)
        at, least, greatest = unpacked(meta)
        left = part.column("left").to_numpy(zero_copy_only=False).astype(np.int64)
        texts = part.column("around").to_pylist()
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        raw = b"".join(texts)
        n = greatest - least + 1
        row = np.repeat(np.arange(len(at)), n)
        d = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + least[row]
        start = (np.cumsum(size) - size + left)[row] - d
        named = digests(raw[i : i + WINDOW] for i in start.tolist())
        by = pa.array(row)
        return _spans(part.column("doc_id").take(by), part.column("tag").take(by), at[row] - d, at[row] - d + WINDOW, named)

    def run(batches):
        held: list[pa.RecordBatch] = []
        rows, over = 0, None

        def whole(parts):
            return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                gram = part.column("gram").to_numpy(zero_copy_only=False)
                if over is not None:
                    k = int(np.searchsorted(gram, over, "right")) if gram[0] == over else 0
                    if k:
                        yield windows(part.slice(0, k))
                        part, gram = part.slice(k), gram[k:]
                    if len(gram):
                        over = None
                    else:
                        continue
                held.append(part)
                rows += part.num_rows
                if rows < 4096:
                    continue
                # all grams but the last, which may go on, are complete
                table = whole(held)
                gram = table.column("gram").to_numpy(zero_copy_only=False)
                last = int(np.searchsorted(gram, gram[-1]))
                if last:
                    yield solve(table.slice(0, last))
                held, rows = [table.slice(last)], table.num_rows - last
                if rows > most:
                    yield windows(held[0])
                    held, rows, over = [], 0, int(gram[-1])
        if held:
            table = whole(held)
            if table.num_rows:
                yield solve(table)

    return mapped(dealt, run, SPANS)


def counted_spans(spans: DataFrame) -> DataFrame:
    """Of single windows, those whose digest another one shares; they are counted by neighbours in a sort."""
    order = W.partitionBy("window", "window2").orderBy("doc_id", "tag", "start")
    again = F.lag("start").over(order).isNotNull() | F.lead("start").over(order).isNotNull()
    return spans.where("window is not null").withColumn("again", again).where("again").select("doc_id", "tag", "start", "end")


def repeated_spans(rows: DataFrame, most: int = MOST) -> DataFrame:
    """(doc_id, tag, start, end): spans of bytes that WINDOW-byte strings with another occurrence cover; they may overlap.
    rows(doc_id, tag, text), tag a 64-bit hash that tells texts of equal doc_id apart."""
    shared = written(shared_anchors(find_anchors(rows)))
    at, least, greatest = F.shiftright("meta", 16), F.shiftright("meta", 8).bitwiseAND(F.lit(255)), F.col("meta").bitwiseAND(F.lit(255))
    settled = shared.where("settled").select("doc_id", "tag", (at - greatest).alias("start"), (at - least + WINDOW).alias("end"))
    spans = written(sorted_spans(surroundings(rows, shared.where("asked")), most))
    return settled.unionByName(spans.where("window is null").select("doc_id", "tag", "start", "end")).unionByName(counted_spans(spans))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("tag"), text_or_empty().alias("text"))


def joined(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching spans as one."""
    by = np.argsort(start, kind="stable")
    start, end = start[by], np.maximum.accumulate(end[by])
    first = np.flatnonzero(np.r_[True, start[1:] > end[:-1]]) if len(start) else np.zeros(0, np.int64)
    return start[first], end[np.r_[first[1:] - 1, len(end) - 1]] if len(start) else end


def dedup(docs: DataFrame, most: int = MOST) -> DataFrame:
    """A row a document: doc_id, kept (the bytes that stay), n_bytes, n_removed and n_spans.

    Every byte goes that a WINDOW-byte string covers which also starts elsewhere, in the same document or another. Null
    texts count as empty; texts shorter than WINDOW stay whole; rows that repeat in full lose all windows. Rows of equal
    doc_id with other texts are kept apart by a 64-bit hash. An empty table gives no rows. Spans reach a text as one list,
    no longer than the text.
    """
    rows = keyed(docs)
    # each text's spans on the way are merged by their start first, so that a long copy is a short list
    spans = repeated_spans(rows, most).groupBy("doc_id", "tag").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    met = rows.join(spans.select(F.col("doc_id").alias("d_"), F.col("tag").alias("t_"), "spans"), F.col("doc_id").eqNullSafe(F.col("d_")) & (F.col("tag") == F.col("t_")), "left").select("doc_id", "text", "spans")

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                out = []
                for text, spans in zip(_bytes(part.column("text")), part.column("spans"), strict=True):
                    if spans.as_py() is None:
                        out.append((text, len(text), 0, 0))
                        continue
                    flat = spans.values
                    start, end = joined(*(flat.field(k).to_numpy(zero_copy_only=False) for k in ("start", "end")))
                    keep = [text[i:j] for i, j in zip([0, *end.tolist()], [*start.tolist(), len(text)], strict=True)]
                    out.append((b"".join(keep), len(text), int((end - start).sum()), len(start)))
                kept, *counts = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(kept, pa.binary()), *[pa.array(c, pa.int64()) for c in counts]], names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return mapped(met, run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def digest(docs: DataFrame, most: int = MOST) -> DataFrame:
    """dedup with the SHA-256 of the kept bytes in their place; odd rows as there, an empty text's digest is that of no bytes."""
    return dedup(docs, most).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
