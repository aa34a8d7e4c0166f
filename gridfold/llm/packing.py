"""Best-fit packing: few-document length patterns fitted to the length histogram by non-negative least squares."""

from __future__ import annotations

import json
import os
import re
import string
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, mapped, slices, texts

CAPACITY = 4096
END_ID = 1
#: Grids of the patterns: units of a sequence, to which lengths are rounded up, and most lengths of a pattern.
GRIDS = ((64, 4), (128, 3), (512, 2))
#: Pieces of at most so many tokens stay out of the patterns: they fill what the rounding leaves.
FILLER = 256

#: ASCII letters lowered, and the white space that texts have, all blanks; and the latter alone.
PLAIN = bytes(32 if b in b"\t\n\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
SPACED = bytes(32 if b in b"\t\n\r" else b for b in range(256))
#: Kinds of bytes: blank, ASCII letter, ASCII sign but the apostrophe, which may be part of a word, and the rest.
BLANK, LETTER, SIGN, REST = range(4)
KINDS = np.array([BLANK if b == 32 else LETTER if chr(b) in string.ascii_letters else SIGN if chr(b) in string.punctuation and b != 39 else REST for b in range(256)], np.uint8)
#: Whether a chunk ends between two kinds of bytes, by 4 * kind + next kind.
ENDS = np.array([a != b and (BLANK in (a, b) or {a, b} == {LETTER, SIGN}) for a in range(4) for b in range(4)])
#: Letters that neither case nor NFC changes.
SIMPLE = re.compile("[a-zß-öø-ÿœ]+")
#: Longest chunk, in bytes, that the table holds; and the masks that keep the first bytes of eight.
HELD = 24
FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Pieces:
    """Token ids of texts, by chunks.

    The tokenizer of word_bpe_49k.json drops white space and matches none of its patterns across it, nor between a letter and
    a sign other than the apostrophe, so a text's ids are its chunks' ids in a row; ASCII letters are lowered first, as it
    does. Chunks are looked up all at once in an open hash table of their bytes, whose size is fixed: 32 bytes a slot and two
    bytes an id. When it is half full, the chunks that were asked for since the last time stay, if they leave room. Texts are
    taken in stretches of a byte a slot, whose different chunks always fit. A tokenizer of another make encodes whole texts.
    """

    def __init__(self, path: str, slots: int = 1 << 20):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as f:
            made = json.load(f)
        self.by_chunk = (
            [n["type"] for n in (made["normalizer"] or {}).get("normalizers", ())] == ["NFC", "Replace", "Lowercase"]
            and made["model"].get("end_of_word_suffix") == "</w>"
            and len(made["model"]["vocab"]) < 1 << 16
            and not any(a["normalized"] or " " in a["content"] or "<|" not in a["content"] for a in made["added_tokens"])
        )
        # the same model on words that need no normalising
        self.simple = Tokenizer(self.tokenizer.model)
        self.simple.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.final = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.final[i] = token.endswith("</w>")
        self.slots, self.rebuilt = slots, 0
        self.empty()

    def empty(self) -> None:
        self.table, self.used, self.count = np.zeros((self.slots, 4), np.uint64), np.zeros(self.slots, bool), 0
        self.store, self.end = np.zeros(4 * self.slots, np.uint16), 0
        self.rebuilt += 1

    @staticmethod
    def keys(data: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Rows of a chunk's first 24 bytes as three numbers, and its length; data goes on 24 bytes behind the last chunk."""
        eight = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
        out = np.empty((len(start), 4), np.uint64)
        for k in range(3):
            out[:, k] = eight[start + 8 * k] & FIRST[np.clip(size - 8 * k, 0, 8)]
        out[:, 3] = size
        return out

    @staticmethod
    def hashed(keys: np.ndarray) -> np.ndarray:
        h = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ keys[:, 3]
        for k in (1, 2):
            h = (h ^ (h >> np.uint64(32)) ^ keys[:, k]) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))

    def slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(self.slots - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of the chunks, -1 where the table has none."""
        slot = self.slot(self.hashed(keys))
        out = np.full(len(keys), -1)
        open_ = np.arange(len(keys))
        while len(open_):
            row, own = self.table[slot[open_]], keys[open_]
            size = row[:, 3] & np.uint64(255)
            same = (row[:, 0] == own[:, 0]) & (row[:, 1] == own[:, 1]) & (row[:, 2] == own[:, 2]) & (size == own[:, 3])
            out[open_[same]] = slot[open_[same]]
            open_ = open_[~same & (size > 0)]
            slot[open_] = (slot[open_] + 1) & (self.slots - 1)
        return out

    def put(self, keys: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        """Chunks that the table doesn't hold, all different, with their ids in a row."""
        need = int(count.sum())
        if self.count + len(keys) > self.slots // 2 or self.end + need > len(self.store):
            self.make_room(len(keys), need)
        if 2 * len(keys) > self.slots or need > len(self.store):
            raise ValueError("more new chunks than the table holds")
        offset = self.end + np.cumsum(count) - count
        self.store[self.end : self.end + need] = ids
        self.end += need
        rows = keys.copy()
        rows[:, 3] |= (count.astype(np.uint64) << np.uint64(8)) | (offset.astype(np.uint64) << np.uint64(24))
        self.place(rows, self.slot(self.hashed(keys)))

    def place(self, rows: np.ndarray, slot: np.ndarray) -> None:
        self.count += len(rows)
        open_ = np.arange(len(rows))
        while len(open_):
            free = open_[self.table[slot[open_], 3] == 0]
            _, first = np.unique(slot[free], return_index=True)
            took = free[first]
            self.table[slot[took]] = rows[took]
            self.used[slot[took]] = True
            open_ = np.setdiff1d(open_, took, assume_unique=True)
            slot[open_] = (slot[open_] + 1) & (self.slots - 1)

    def make_room(self, chunks: int, ids: int) -> None:
        rows, store = self.table[self.used], self.store
        count, offset = ((rows[:, 3] >> np.uint64(8)) & np.uint64(0xFFFF)).astype(np.int64), (rows[:, 3] >> np.uint64(24)).astype(np.int64)
        self.empty()
        if 4 * (len(rows) + chunks) <= self.slots and 2 * (int(count.sum()) + ids) <= len(store):
            keys = rows.copy()
            keys[:, 3] &= np.uint64(255)
            self.put(keys, store[spread(offset, count)], count)
            self.used[:] = False

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of simple words in a row, and how many each has. Many words go as one text, which their last tokens cut again."""
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for i in range(0, len(words), 1024):
            some = words[i : i + 1024]
            got = np.array(self.simple.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.final[got]) + 1
            if len(ends) == len(some) and ends[-1] == len(got):
                ids.append(got), counts.append(np.diff(ends, prepend=0))
            else:
                more = self.whole(some)
                ids += more
                counts.append(np.array([*map(len, more)]))
        return np.concatenate(ids), np.concatenate(counts)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encoded(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks in a row, and how many each has: simple words as such, others by the tokenizer as it is."""
        texts = [c.decode("utf-8", "surrogatepass") for c in chunks]
        simple = np.array([SIMPLE.fullmatch(t) is not None for t in texts], bool)
        ids, counts = self.words([t for t, s in zip(texts, simple.tolist(), strict=True) if s])
        others = self.whole([t for t, s in zip(texts, simple.tolist(), strict=True) if not s])
        all_, size = np.concatenate([ids, *others]), np.zeros(len(chunks), np.int64)
        size[simple], size[~simple] = counts, [*map(len, others)]
        first = np.zeros(len(chunks), np.int64)
        first[simple], first[~simple] = np.cumsum(counts) - counts, len(ids) + np.cumsum(size[~simple]) - size[~simple]
        return all_[spread(first, size)], size

    def window(self, data: bytes, special: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a stretch of text, its chunks' starts, and how many ids each has. special: it ends at blanks alone."""
        raw = np.frombuffer(data, np.uint8)
        kind = KINDS[raw]
        # letters of two bytes, C3 80 to C3 BF but the signs of times and division
        two = np.flatnonzero(raw[:-1] == 0xC3)
        two = two[(raw[two + 1] != 0x97) & (raw[two + 1] != 0xB7)]
        kind[two] = kind[two + 1] = LETTER
        if special:
            kind[kind != BLANK] = REST
        edge = np.r_[0, np.flatnonzero(ENDS[4 * kind[:-1] + kind[1:]]) + 1, len(raw)]
        solid = kind[edge[:-1]] != BLANK
        start, size = edge[:-1][solid], np.diff(edge)[solid]

        def taken(at: np.ndarray) -> list[bytes]:
            return [data[a:b] for a, b in zip(start[at].tolist(), (start[at] + size[at]).tolist(), strict=True)]

        held, long = np.flatnonzero(size <= HELD), np.flatnonzero(size > HELD)
        keys = self.keys(data, start[held], size[held])
        slot = self.find(keys)
        while (miss := np.flatnonzero(slot < 0)).size:
            # of two chunks with one hash the second comes with the next turn
            named = miss[np.unique(self.hashed(keys[miss]), return_index=True)[1]]
            before = self.rebuilt
            self.put(keys[named], *self.encoded(taken(held[named])))
            again = miss if before == self.rebuilt else np.arange(len(keys))
            slot[again] = self.find(keys[again])
        self.used[slot] = True
        row = self.table[slot, 3]
        count = np.zeros(len(start), np.int64)
        count[held] = (row >> np.uint64(8)) & np.uint64(0xFFFF)
        texts = taken(long)
        once = list(dict.fromkeys(texts))
        flat, sizes = self.encoded(once)
        codes = dict(zip(once, np.split(flat, np.cumsum(sizes)[:-1]), strict=True)) if once else {}
        count[long] = [len(codes[t]) for t in texts]
        ids = np.empty(int(count.sum()), np.uint32)
        place = np.cumsum(count) - count
        ids[spread(place[held], count[held])] = self.store[spread((row >> np.uint64(24)).astype(np.int64), count[held])]
        for t, i in zip(texts, place[long].tolist(), strict=True):
            ids[i : i + len(codes[t])] = codes[t]
        return ids, start, count

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of UTF-8 texts, all in a row, and the places at which a text's begin (and the last one's end)."""
        if not self.by_chunk:
            parts = self.whole([t.decode("utf-8", "surrogatepass") for t in texts])
            return np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        data = b" ".join(texts)
        # where special tokens may be, their case counts, and they may have signs and letters
        special = b"<|" in data
        data = data.translate(SPACED if special else PLAIN)
        found, at = [], 0
        while at < len(data):
            end = j if (j := data.find(b" ", at + self.slots)) >= 0 else len(data)
            ids, start, count = self.window(data[at:end] + b" " * (HELD + 8), special)
            found.append((ids, start + at, count))
            at = end
        ids, start, count = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, t) for t in (np.uint32, np.int64, np.int64))
        text = np.cumsum([0, *(len(t) + 1 for t in texts)])
        return ids, np.r_[0, np.cumsum(count)][np.searchsorted(start, text)]


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, as many as its count."""
    end = np.cumsum(count)
    return np.repeat(start - end + count, count) + np.arange(end[-1] if len(end) else 0)


_caches: dict[str, Pieces] = {}


def cached(path: str) -> Pieces:
    """One cache for each Python worker, kept over its tasks."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _caches:
        _caches[path] = Pieces(path)
    return _caches[path]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """A row a piece: doc_id, piece, start, length, ids_crc32, and the ids as bytes if asked for.

    A document is its token ids and the end id; one longer than the capacity is cut into pieces of that length and a
    rest. Null and empty texts are one piece, the end id alone. vocabulary: a tokenizer file at the same path everywhere.
    """
    end, step = np.array([END_ID], "<u4").tobytes(), 4 * capacity
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def run(batches):
        cache = cached(vocabulary)
        for batch in batches:
            for part in slices(batch, most=2 << 20):
                rows = []
                all_ids, bounds = cache.ids(part.column("text").cast(pa.binary()).to_pylist())
                flat, bounds = all_ids.astype("<u4").tobytes(), (4 * bounds).tolist()
                for doc_id, i, j in zip(part.column("doc_id").to_pylist(), bounds, bounds[1:], strict=False):
                    ids = flat[i:j] + end
                    for k in range(0, len(ids), step):
                        cut_ids = ids[k : k + step]
                        rows.append((doc_id, k // step, k // 4, len(cut_ids) // 4, zlib.crc32(cut_ids), cut_ids))
                cols = list(zip(*rows, strict=True))
                arrays = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)][: 5 + with_ids]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in schema.split(", ")])

    return mapped(texts(docs), run, schema)


def patterns(units: int, most: int) -> list[tuple[int, ...]]:
    """Non-increasing tuples of at most `most` lengths in 1..units that add up to units."""
    out: list[tuple[int, ...]] = []

    def grow(head: tuple[int, ...], left: int) -> None:
        if left == 0:
            out.append(head)
        elif len(head) < most:
            low = -(-left // (most - len(head)))
            for n in range(min(left, head[-1] if head else units), low - 1, -1):
                grow((*head, n), left - n)

    grow((), units)
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 1500) -> np.ndarray:
    """x >= 0 of least |a x - b|^2, by accelerated projected gradients with restarts."""
    step = 1.0 / max(np.linalg.norm(a, 2) ** 2, 1e-12)
    x = z = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(z - step * (a.T @ (a @ z - b)), 0)
        if (z - new) @ (new - x) > 0:
            t = 1.0
        later = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z = new + (t - 1) / later * (new - x)
        x, t = new, later
    return x


class Placing:
    """Pieces by length on their way into sequences, as runs: rows of (length, rank, count, sequence, offset)."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {n: c for n, c in histogram.items() if c > 0}
        self.lengths = sorted(self.left)  # those of which some are left
        self.placed: dict[int, int] = defaultdict(int)
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.rooms: dict[int, deque] = defaultdict(deque)  # room: [first sequence, count], ...
        self.sizes: list[int] = []  # the rooms that there are, in order
        self.total = 0

    def put(self, n: int, count: int, first: int, room: int) -> None:
        """The next `count` pieces of length n, one to each sequence from `first` on, which all have this room."""
        self.rows.append((n, self.placed[n], count, first, self.capacity - room))
        self.placed[n] += count
        self.left[n] -= count
        if not self.left[n]:
            del self.left[n]
            self.lengths.pop(bisect_left(self.lengths, n))

    def opened(self, first: int, count: int, room: int) -> None:
        if room and count:
            if not self.rooms[room]:
                insort(self.sizes, room)
            self.rooms[room].append([first, count])

    def pattern(self, shape: tuple[int, ...], unit: int, count: int) -> None:
        """At most `count` new sequences of this shape, as its units last: each place takes the longest piece of its unit, the last one the longest that fits at all."""
        for u in set(shape):
            i, j = bisect_right(self.lengths, (u - 1) * unit), bisect_right(self.lengths, u * unit)
            count = min(count, sum(self.left[n] for n in self.lengths[i:j]) // shape.count(u))
        runs = [[self.total, count, self.capacity]] if count else []
        self.total += count
        for k, u in enumerate(shape):
            after = []
            for start, size, room in runs:
                while size:
                    most = room if k == len(shape) - 1 else min(room, u * unit)
                    i = bisect_right(self.lengths, most) - 1
                    if i < 0 or (k < len(shape) - 1 and self.lengths[i] <= (u - 1) * unit):
                        after.append([start, size, room])
                        break
                    n = self.lengths[i]
                    some = min(size, self.left[n])
                    self.put(n, some, start, room)
                    after.append([start, some, room - n])
                    start, size = start + some, size - some
            runs = after
        for start, size, room in runs:
            self.opened(start, size, room)

    def best_fit(self) -> None:
        """What is left, the longest first, to the sequences with the least room that suffices, or to new ones."""
        while self.lengths:
            n = self.lengths[-1]
            k = bisect_left(self.sizes, n)
            if k == len(self.sizes):
                # as many of this length as fit go to each new sequence
                fit = self.capacity // n
                count = max(self.left[n] // fit, 1)
                first, self.total = self.total, self.total + count
                room = self.capacity
                for _ in range(min(fit, self.left[n])):
                    if self.left.get(n, 0) < count:
                        break
                    self.put(n, count, first, room)
                    room -= n
                self.opened(first, count, room)
                continue
            room = self.sizes[k]
            first, size = self.rooms[room][0]
            count = min(size, self.left[n])
            self.put(n, count, first, room)
            if count == size:
                self.rooms[room].popleft()
                if not self.rooms[room]:
                    self.sizes.pop(k)
            else:
                self.rooms[room][0] = [first + count, size - count]
            self.opened(first, count, room - n)


def fitted(histogram: dict[int, int], capacity: int, unit: int, most: int) -> Placing:
    """Pieces placed by patterns of at most `most` lengths in units, whose repeat counts are fitted to the histogram by
    least squares and rounded down; and the rest by best fit."""
    out = Placing(histogram, capacity)
    units = capacity // unit
    have: dict[int, int] = defaultdict(int)
    for n, c in out.left.items():
        have[-(-n // unit)] += c
    shapes = [p for p in patterns(units, most) if all(u in have and u * unit > FILLER for u in p)]
    if shapes:
        at = {u: i for i, u in enumerate(sorted(have))}
        a = np.zeros((len(at), len(shapes)))
        for j, p in enumerate(shapes):
            for u in p:
                a[at[u], j] += 1
        b = np.array([have[u] for u in sorted(have)], float)
        times = nnls(a, b / b.max()) * b.max()
        for j in np.argsort(-times, kind="stable"):
            if (count := int(times[j] + 1e-6)) > 0:
                out.pattern(shapes[j], unit, count)
    out.best_fit()
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """How to pack `histogram`, the number of pieces by length: rows of (length, rank, count, sequence, offset).

    A row says: the pieces of this length ranked rank .. rank + count - 1 go to as many sequences from `sequence` on, one
    each, at this offset. The number of rows depends on the lengths that occur, not on how many pieces there are.

    Of the patterns' grids in GRIDS, and of best fit without patterns, that with the fewest sequences is taken, the first of
    equal ones.
    """
    made = [fitted(histogram, capacity, max(capacity // units, 1), most) for units, most in GRIDS]
    plain = Placing(histogram, capacity)
    plain.best_fit()
    best = min([*made, plain], key=lambda p: p.total)
    return np.array(sorted(best.rows), np.int64).reshape(-1, 5)


def assign(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """rows(doc_id, piece, start, length, ids_crc32) with sequence_id and offset. rows must be materialised.

    Only the histogram, at most `capacity` numbers, reaches the driver. Ranks within a length come from sorted cells of
    (length, salt) and running sums of the cells' counts, so a length that a third of all pieces have is no hot spot.
    """
    spark = rows.sparkSession
    salts = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    cells = cut(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")))
    counts = {r.length: r.n for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(plan(counts, capacity))
    before = F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    firsts = cells.select(F.col("length").alias("l_"), F.col("salt").alias("s_"), before.alias("first"))
    local = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    ranked = salted.withColumn("local", local).join(firsts, (F.col("length") == F.col("l_")) & (F.col("salt") == F.col("s_")))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("local")).alias("rank"))

    def run(batches):
        p = table.value
        # lengths and ranks as one increasing key
        width = int(p[:, 1].max(initial=0)) + int(p[:, 2].max(initial=0)) + 1
        keys = p[:, 0] * width + p[:, 1]
        for batch in batches:
            n, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            at = np.searchsorted(keys, n * width + rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(p[at, 3] + rank - p[at, 1]), pa.array(p[at, 4])], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return mapped(ranked, run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Each piece of each document with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Sequences hold at most `capacity` tokens, without gaps. Null doc_ids pass through; repeated rows are packed each.
    An empty table gives no rows. Only doc_id and text are read.
    """
    return assign(cut(pieces(docs, vocabulary, capacity)), capacity)
