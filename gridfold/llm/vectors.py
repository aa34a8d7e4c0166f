"""Near-duplicate vectors by a robust-pruned flat graph, built on overlapping cluster shards and searched by range."""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small
from .components import components
from .simhash import spanning as span

#: Edges of a vertex: nearest ones, and far ones among random members; reverse edges come on top.
NEAR_EDGES, FAR_EDGES = 16, 8
NEAR_POOL, FAR_POOL = 40, 24
ALPHA = 1.2
#: Candidates that a search keeps while it walks.
BEAM = 24
#: Rows of a block in exact comparisons.
BLOCK = 1024


def unit(x: np.ndarray) -> np.ndarray:
    """Rows in double precision, scaled to length 1; scaled by their largest component first, so nothing overflows."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def valid(v: Column) -> Column:
    whole = F.forall(v, lambda x: F.coalesce((F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x), F.lit(False)))
    return F.coalesce(whole & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Unit centroids by spherical k-means; one that loses all its rows starts again at the worst-placed row."""
    rng = np.random.default_rng(seed)
    centers = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = [(like.argmax(1), like.max(1)) for i in range(0, len(x), BLOCK) for like in (x[i : i + BLOCK] @ centers.T,)]
        at, best = (np.concatenate(c) for c in zip(*near, strict=True))
        sums = np.zeros_like(centers)
        np.add.at(sums, at, x)
        size = np.linalg.norm(sums, axis=1)
        lost = np.flatnonzero(size < 1e-9)
        if len(lost):
            sums[lost] = x[np.argsort(best)[: len(lost)]]
            size[lost] = 1.0
        centers = sums / size[:, None]
    return centers


def sample(reps: DataFrame, most: int, seed: str) -> DataFrame:
    """About `most` rows at most, chosen by a hash of their id: the same at each run."""
    share = min(1.0, 0.95 * most / max(reps.count(), 1))
    return reps.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 20)) < max(int(share * (1 << 20)), 1) if share < 1 else F.lit(True)).limit(most)


def assigned(reps: DataFrame, centers: dict[int, np.ndarray], overlap: int) -> DataFrame:
    """(shard, id, v) with a row for each of a vector's `overlap` nearest shards. A shard is of one dimension."""
    shared = reps.sparkSession.sparkContext.broadcast(centers)

    def run(batches):
        for batch in batches:
            sizes = pa.compute.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dim)
                part = batch.take(pa.array(rows))
                c = shared.value.get(dim)
                if c is None:  # too rare for the sample: a shard of their own
                    c = np.zeros((1, dim))
                like = unit(matrix(part.column(1))) @ c.T
                k = min(overlap, len(c))
                near = np.argpartition(-like, k - 1, 1)[:, :k]
                out = part.take(pa.array(np.repeat(np.arange(len(rows)), k)))
                yield pa.RecordBatch.from_arrays([pa.array(near.ravel().astype(np.int64) + (dim << 32)), *out.columns], names=["shard", "id", "v"])

    return reps.select("id", "v").mapInArrow(run, f"shard long, id long, v {reps.schema['v'].dataType.simpleString()}")


def _rows_of_shards(batches, keys: int = 1):
    """Record batches of whole shards from batches sorted by shard, which the first `keys` columns name."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        by = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        edges = [0, *(np.flatnonzero(np.any([b[1:] != b[:-1] for b in by], 0)) + 1).tolist(), batch.num_rows]
        for i, j in zip(edges, edges[1:], strict=False):
            part = batch.slice(i, j - i)
            if held and any(held[-1].column(k)[0].as_py() != b[i] for k, b in enumerate(by)):
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def prune(x: np.ndarray, at: np.ndarray, pool: np.ndarray, most: int) -> np.ndarray:
    """Robust pruning for the points `at`, all at once: of each one's pool (rows of x) the nearest stays, and drops what is
    ALPHA times nearer to it than to the point; and so on until `most` stay. -1 fills up."""
    there = pool >= 0
    to = np.where(there, 1 - np.einsum("id,ijd->ij", x[at], x[pool]), np.inf)
    to[pool == at[:, None]] = np.inf
    order = np.argsort(to, 1, kind="stable")
    pool, to = np.take_along_axis(pool, order, 1), np.take_along_axis(to, order, 1)
    vectors = x[pool]
    kept = np.full((len(at), most), -1)
    rows = np.arange(len(at))
    live = np.isfinite(to)
    for k in range(most):
        any_left = live.any(1)
        if not any_left.any():
            break
        best = live.argmax(1)
        kept[any_left, k] = pool[rows, best][any_left]
        between = 1 - np.einsum("id,ijd->ij", vectors[rows, best], vectors)
        # squared distances are compared, so the factor is squared too
        live &= ALPHA * ALPHA * between > to
        live[rows, best] = False
    return kept


def build(x: np.ndarray, seed: int = 3) -> np.ndarray:
    """Adjacency (rows of neighbours, -1 filled) of a shard's unit vectors: robust-pruned near and far edges and their
    reverses. Similarities are taken in blocks of rows."""
    n = len(x)
    rng = np.random.default_rng(seed)
    kept = []
    for i in range(0, n, 512):
        at = np.arange(i, min(i + 512, n))
        like = x[at] @ x.T
        like[np.arange(len(at)), at] = -np.inf
        k = min(NEAR_POOL, n - 1)
        near = np.argpartition(-like, k - 1, 1)[:, :k] if k else np.full((len(at), 1), -1)
        far = rng.integers(0, n, (len(at), FAR_POOL))
        kept.append(np.concatenate([prune(x, at, near, NEAR_EDGES), prune(x, at, far, FAR_EDGES)], 1))
    out = np.concatenate(kept)
    a, b = np.repeat(np.arange(n), out.shape[1]), out.ravel()
    a, b = a[b >= 0], b[b >= 0]
    return padded(np.concatenate([a, b]), np.concatenate([b, a]), n, 2 * (NEAR_EDGES + FAR_EDGES))


def padded(a: np.ndarray, b: np.ndarray, n: int, most: int) -> np.ndarray:
    """Edges (a, b) as a row of at most `most` distinct b for each a in 0..n-1."""
    pairs = np.unique(a * np.int64(n) + b)
    a, b = pairs // n, pairs % n
    first = np.searchsorted(a, np.arange(n))
    place = np.arange(len(a)) - first[a]
    out = np.full((n, max(min(int(place.max(initial=0)) + 1, most), 1)), -1)
    inside = place < out.shape[1]
    out[a[inside], place[inside]] = b[inside]
    return out


def search(x: np.ndarray, edges: np.ndarray, queries: np.ndarray, start: int, least: float, slack: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) at least `least` alike that greedy searches from `start` meet, for all queries at once.

    Each search expands the best candidate of its beam until all of the beam are expanded. Then the range grows: every row
    met that is within `slack` of the range is expanded too, and what that brings into it, until nothing new comes.
    """
    q = len(queries)
    seen = np.zeros((q, len(x)), bool)
    seen[:, start] = True
    ids = np.full((q, BEAM), -1)
    like = np.full((q, BEAM), -np.inf, x.dtype)
    done = np.ones((q, BEAM), bool)
    ids[:, 0], like[:, 0], done[:, 0] = start, x[queries] @ x[start], False
    found_q, found_v, found_s = [np.arange(q)], [np.full(q, start)], [like[:, 0].copy()]
    while True:
        open_ = np.where(done, -np.inf, like)
        best = open_.argmax(1)
        rows = np.flatnonzero(open_[np.arange(q), best] > -np.inf)
        if not len(rows):
            break
        done[rows, best[rows]] = True
        next_ = edges[ids[rows, best[rows]]]
        new = (next_ >= 0) & ~seen[rows[:, None], next_]
        seen[rows[:, None], np.where(next_ >= 0, next_, start)] = True
        sims = np.where(new, np.einsum("qd,qrd->qr", x[queries[rows]], x[next_]), -np.inf)
        hit, k = np.nonzero(sims >= least - slack)
        found_q.append(rows[hit]), found_v.append(next_[hit, k]), found_s.append(sims[hit, k])
        all_like = np.concatenate([like[rows], sims], 1)
        top = np.argpartition(-all_like, BEAM - 1, 1)[:, :BEAM]
        like[rows] = np.take_along_axis(all_like, top, 1)
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], next_], 1), top, 1)
        done[rows] = np.take_along_axis(np.concatenate([done[rows], np.zeros(next_.shape, bool)], 1), top, 1) | (like[rows] == -np.inf)
    out_q, out_v, s = np.concatenate(found_q), np.concatenate(found_v), np.concatenate(found_s)
    inside = s >= least - slack
    out = [(out_q[inside], out_v[inside], s[inside])]
    front_q, front_v = out[0][0], out[0][1]
    while len(front_q):
        grown_q, grown_v, grown_s = [], [], []
        for i in range(0, len(front_q), 1 << 13):
            fq, next_ = front_q[i : i + (1 << 13)], edges[front_v[i : i + (1 << 13)]]
            a, k = np.nonzero((next_ >= 0) & ~seen[fq[:, None], next_])
            pair = np.unique(fq[a] * np.int64(len(x)) + next_[a, k])
            a, b = pair // len(x), pair % len(x)
            seen[a, b] = True
            sims = np.einsum("id,id->i", x[queries[a]], x[b])
            inside = sims >= least - slack
            grown_q.append(a[inside]), grown_v.append(b[inside]), grown_s.append(sims[inside])
        front_q, front_v = np.concatenate(grown_q), np.concatenate(grown_v)
        out.append((front_q, front_v, np.concatenate(grown_s)))
    a, b, s = (np.concatenate(c) for c in zip(*out, strict=True))
    inside = (s >= least - 1e-4) & (queries[a] != b)
    return queries[a[inside]], b[inside]


def graph(shards: DataFrame) -> DataFrame:
    """(id, edges): the union of a vector's adjacency lists over its shards."""

    def run(batches):
        for part in _rows_of_shards(batches):
            ids, x = part.column(1).to_numpy(zero_copy_only=False), unit(matrix(part.column(2))).astype(np.float32)
            edges = build(x)
            lists = [ids[row[row >= 0]] for row in edges]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(lists, pa.list_(pa.int64()))], names=["id", "edges"])

    lists = shards.mapInArrow(run, "id long, edges array<long>")
    return lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("edges"))).alias("edges"))


def links(reps: DataFrame, least: float = 0.95, shard_rows: int = 1000, overlap: int = 3, max_sample: int = 20_000, max_shards: int = 4000) -> DataFrame:
    """Pairs (a, b) of reps(id, v) that connect what the links that the graph's searches find connect, each task's as few
    as that takes. The links are verified in double precision.

    Centroids come from a bounded sample; each vector lies in its `overlap` nearest shards. A shard that turns out larger
    than four times `shard_rows` has its centroid replaced by several, from a sample of its own rows, in up to three rounds
    and up to max_shards shards. Searches go out from each shard's medoid, for all of its rows.
    """
    total = reps.count()
    got = sample(reps, max_sample, "centroids").collect()
    by_dim: dict[int, list] = {}
    for r in sorted(got, key=lambda r: r.id):
        by_dim.setdefault(len(r.v), []).append(r.v)
    centers = {}
    for dim, vs in by_dim.items():
        x = unit(np.array(vs))
        want = round(total * len(vs) / max(len(got), 1) * overlap / shard_rows)
        centers[dim] = k_means(x, max(1, min(want, len(x) // 4 or 1, max_shards)))
    for _ in range(3):
        sizes = assigned(reps, centers, overlap).groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 4 * shard_rows).collect()
        if not sizes or sum(map(len, centers.values())) >= max_shards:
            break
        large = {r.shard: r.n for r in sizes}
        inside = assigned(reps, centers, 1).where(F.col("shard").isin(list(large)))
        rows = sample(inside.select("id", "v", "shard"), max_sample, "split").collect()
        split = {dim: list(np.delete(c, [s & 0xFFFFFFFF for s in large if s >> 32 == dim], 0)) for dim, c in centers.items()}
        for shard, n in large.items():
            x = np.array([r.v for r in rows if r.shard == shard])
            parts = min(-(-n // shard_rows) + 1, max(len(x) // 4, 1))
            split[shard >> 32] += list(k_means(unit(x), parts)) if len(x) else [centers[shard >> 32][shard & 0xFFFFFFFF]]
        centers = {dim: np.array(c) for dim, c in split.items()}
    placed = cut(assigned(reps, centers, overlap))
    dealt = placed.repartition("shard").sortWithinPartitions("shard", "id")
    edges = graph(dealt).select(F.col("id").alias("k"), "edges")
    whole = placed.join(edges, F.col("id") == F.col("k")).select("shard", "id", "v", "edges").repartition("shard").sortWithinPartitions("shard", "id")

    def run(batches):
        for part in _rows_of_shards(batches):
            ids, x = part.column(1).to_numpy(zero_copy_only=False), unit(matrix(part.column(2)))
            n, lists = len(ids), part.column(3)
            a = np.repeat(np.arange(n), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
            ends = lists.flatten().to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(ids, ends), n - 1)
            own = ids[at] == ends  # edges to rows of other shards lead nowhere here; counted() compares across shards
            near = padded(a[own], at[own], n, 4 * (NEAR_EDGES + FAR_EDGES))
            low = x.astype(np.float32)
            medoid = int((low @ low.mean(0)).argmax())
            for i in range(0, n, 1024):
                p, q = search(low, near, np.arange(i, min(i + 1024, n)), medoid, least)
                for j in range(0, len(p), 1 << 16):
                    s, t = p[j : j + (1 << 16)], q[j : j + (1 << 16)]
                    sure = np.einsum("id,id->i", x[s], x[t]) >= least
                    s, t = s[sure], t[sure]
                    a, b = span(s, t, ids)
                    yield pa.RecordBatch.from_arrays([pa.array(b), pa.array(a)], names=["a", "b"])

    return whole.mapInArrow(run, "a long, b long").distinct()


def alike(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Matrix of whether the unit vectors x and y are at least `least` alike; what single precision can't tell is taken in double."""
    like = x.astype(np.float32) @ y.astype(np.float32).T
    out = like >= least
    i, j = np.nonzero(np.abs(like - least) < 1e-4)
    for k in range(0, len(i), 1 << 16):
        a, b = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
        out[a, b] = np.einsum("id,id->i", x[a], y[b]) >= least
    return out


def compared(members: DataFrame, least: float) -> DataFrame:
    """Every two members(id, v, n, component) of a component compared: rows (a, null, links, partners) of what a vector has
    in a pair of blocks, partners counting each n times, and rows (a, b, 0, 0) that connect what the links connect.

    A component of more than BLOCK rows is dealt by hash into blocks, which meet two by two, so that no task holds more
    than two blocks at a time and links are counted where they are found.
    """
    sizes = cut(members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts")).where("parts > 1"))
    dealt = members.join(small(sizes.withColumnRenamed("component", "c_")), F.col("component") == F.col("c_"), "left")
    dealt = dealt.withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.pmod(F.xxhash64("id", F.lit("block")), F.col("parts")))
    met = dealt.select("component", "part", "id", "v", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"))
    met = met.select("component", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "id", "v", "n")
    met = met.repartition("component", "p", "q").sortWithinPartitions("component", "p", "q", "part", "id")

    def run(batches):
        for unit_ in _rows_of_shards(batches, 3):
            part, ids, n = (unit_.column(k).to_numpy(zero_copy_only=False) for k in (3, 4, 6))
            x = unit(matrix(unit_.column(5)))
            p, q = unit_.column(1)[0].as_py(), unit_.column(2)[0].as_py()
            left = np.flatnonzero(part == p)
            right = left if p == q else np.flatnonzero(part == q)
            links_, partners, a, b = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), [], []
            for i in range(0, len(left), BLOCK):
                at = left[i : i + BLOCK]
                hit = alike(x[at], x[right], least)
                hit &= at[:, None] != right
                links_[at] += hit.sum(1)
                partners[at] += hit @ n[right]
                if p != q:
                    links_[right] += hit.sum(0)
                    partners[right] += n[at] @ hit
                s, t = np.nonzero(hit)
                s, t = span(at[s], right[t], ids)
                a.append(t), b.append(s)
            seen = np.flatnonzero(links_)
            a, b = np.concatenate(a or [ids[:0]]), np.concatenate(b or [ids[:0]])
            ends = pa.array(np.r_[np.zeros(len(seen), np.int64), b], mask=np.arange(len(seen) + len(b)) < len(seen))
            none = np.zeros(len(b), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[ids[seen], a]), ends, pa.array(np.r_[links_[seen], none]), pa.array(np.r_[partners[seen], none])], names=["a", "b", "links", "partners"])

    return met.mapInArrow(run, "a long, b long, links long, partners long")


def counted(classes: DataFrame, found: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(id, component) of the ids in found(a, b), and (a, links, partners): all links inside a component, across shards."""
    comps = cut(components(found))
    members = classes.join(comps.withColumnRenamed("id", "k"), F.col("id") == F.col("k")).select("id", "v", "n", "component")
    return comps, _summed(compared(members, least))


def _summed(rows: DataFrame) -> DataFrame:
    return cut(rows.where("b is null").groupBy("a").agg(F.sum("links").alias("links"), F.sum("partners").alias("partners")))


def audit(reps: DataFrame, found: DataFrame, least: float = 0.95, queries: int = 400, most: int = 6400) -> float | None:
    """Recall: the share of the links of at most so many sampled vectors, by brute force over all rows, that found(a, links)
    counts. Where the sample has no link at all, a sample four times as large is taken, up to `most`; None if that has none
    either. 1.0 for a table of which all rows were asked and none has a link."""
    got, asked = _recall(reps, found, least, queries)
    if got is None and asked >= reps.count():
        return 1.0
    return got if got is not None or queries >= most else audit(reps, found, least, min(4 * queries, most), most)


def _recall(reps: DataFrame, found: DataFrame, least: float, queries: int) -> tuple[float | None, int]:
    asked = sample(reps, queries, "audit").collect()
    by_dim = {d: ([r.id for r in asked if len(r.v) == d], unit(np.array([r.v for r in asked if len(r.v) == d]))) for d in {len(r.v) for r in asked}}
    shared = reps.sparkSession.sparkContext.broadcast(by_dim)

    def run(batches):
        for batch in batches:
            sizes = pa.compute.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            for dim, (qs, y) in shared.value.items():
                part = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                if not part.num_rows:
                    continue
                ids = part.column(0).to_numpy(zero_copy_only=False)
                x, n = unit(matrix(part.column(1))), np.zeros(len(qs), np.int64)
                for i in range(0, len(ids), BLOCK):
                    n += (alike(x[i : i + BLOCK], y, least) & (ids[i : i + BLOCK, None] != np.array(qs))).sum(0)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(qs)), pa.array(n)], names=["q", "n"])

    true = reps.select("id", "v").mapInArrow(run, "q long, n long").groupBy("q").agg(F.sum("n").alias("n"))
    n, got = true.join(found, F.col("q") == F.col("a"), "left").agg(F.sum("n"), F.sum("links")).first()
    return ((got or 0) / n if n else None), len(asked)


def near_duplicates(vectors: DataFrame, least: float = 0.95, recall: float = 0.9, id_column: str = "vec_id", vector: str = "embedding", **options) -> DataFrame:
    """A row a vector: vec_id, n_links, component_id (the smallest vec_id reachable by links) and kept (vec_id = component_id).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do those without a
    vec_id; vectors of different dimensions aren't compared. Equal vectors are one class from the start, and their links
    among themselves are counted, not listed. The graph's searches give the components; inside each, blocks of its members
    are compared exactly, so n_links doesn't depend on shards. Cosines that decide are of double precision; vectors of doubles
    stay doubles, all others are floats. If the audited recall is below `recall`, the graph is built
    again with wider overlaps, twice at most, and all links found count; if it is still below, all vectors of a dimension
    are compared block by block. Where the audit's samples have no link, recall is unmeasured, which a warning tells. An
    empty table gives no rows.
    """
    kind = "float" if vectors.schema[vector].dataType.simpleString() in ("array<float>", "array<tinyint>", "array<smallint>") else "double"
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast(f"array<{kind}>").alias("v"))
    rows = cut(rows.withColumn("ok", valid(F.col("v")) & F.col("vec_id").isNotNull()))
    classes = cut(rows.where("ok").groupBy("v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n")))
    every = cut(links(classes, least, **options))
    comps, partners = counted(classes, every, least)
    overlap = options.pop("overlap", 3)
    for _ in range(2):
        if (measured := audit(classes, partners, least)) is None:
            warnings.warn("no sampled vector has a link, so recall was not measured", stacklevel=2)
        if measured is None or measured >= recall:
            break
        overlap *= 2
        every = cut(every.unionAll(links(classes, least, overlap=overlap, **options)).distinct())
        comps, partners = counted(classes, every, least)
    else:
        if (audit(classes, partners, least) or 0.0) < recall:
            rows_of = cut(compared(classes.select("id", "v", "n", F.size("v").cast("long").alias("component")), least))
            comps, partners = cut(components(rows_of.where("b is not null").select("a", "b"))), _summed(rows_of)
    comps = comps.withColumnRenamed("id", "c")
    named = classes.join(partners, F.col("id") == F.col("a"), "left").join(comps, F.col("id") == F.col("c"), "left")
    named = named.select(F.col("v").alias("w"), (F.col("n") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    met = rows.join(named, F.col("ok") & (F.col("v") == F.col("w")), "left")
    component = F.coalesce("component_id", "vec_id")
    return met.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
