"""The operators on small tables, against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables
and extra columns with clashing names."""

import bisect
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from gridfold.llm import common, components, licenses, media, mixing, packing, queries, secrets, simhash, suffixes, toxicity, urlfilter, vectors

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def word(rng):
    return "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))


def prose(rng, n):
    return " ".join(word(rng) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Rows that break naive code, with columns named like the operators' own."""
    rng = random.Random(3)
    long = prose(rng, 30_000)
    base = prose(rng, 120)
    texts = [None, "", " \n\t", "a", "a b", base, base, base.replace(" ", "  "), base + " x", long, long[:-5], "x" * 5000, "IDIOT you idiot!!!", "é" * 300, "\x00\x1c|.", "password = hunter2hunter2"]
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, "no id", None, "s0", 5), (5, base, "en", "s2", len(base))]
    df = spark.createDataFrame(rows, DOCS)
    for name in ("row", "k", "h", "size", "copies", "score", "key", "s_"):
        df = df.withColumn(name, F.lit(1))
    return df.cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_media(odd, empty):
    got = media.media_columns(odd).collect()
    assert len(got) == odd.count() and media.digest(empty).count() == 0
    texts = Counter((r.doc_id, r.text or "") for r in odd.collect())
    for r in got:
        text = r.payload[: r.n_bytes].decode()
        texts[(r.doc_id, text)] -= 1
        assert len(r.payload) % 576 == 0 and len(r.payload) > 0 and set(r.payload[r.n_bytes :]) <= {255}
        assert media.decode(r.media).tobytes() == r.payload
    assert not +texts
    by = {r.doc_id: r for r in media.digest(odd).collect()}
    assert by[0].payload_sha256 == by[1].payload_sha256 == hashlib.sha256(b"\xff" * 576).hexdigest() and by[5].feature == by[6].feature
    assert by[3].tail_crc32 == zlib.crc32(b"\xff" * 32)


def test_png_picks_filters():
    rng = np.random.default_rng(30)
    text = rng.integers(97, 123, (6, 576), dtype=np.uint8)
    text[2] = text[1]
    text[3, 20:] = 255
    text[5] = 7
    made = media.encode(text.tobytes())
    lines = np.frombuffer(zlib.decompress(b"".join(part for kind, part in media.chunks(made) if kind == b"IDAT")), np.uint8).reshape(6, -1)
    assert lines[:, 0].tolist() == [0, 0, 2, 1, 0, 1] and media.decode(made).tobytes() == text.tobytes()


def test_png_filters_and_checksums():
    import struct

    rng = np.random.default_rng(0)
    for bpp, colour in ((1, 0), (3, 2), (4, 6)):
        a = rng.integers(0, 256, (12, 10 * bpp), dtype=np.uint8)
        lines, above = [], np.zeros(10 * bpp, np.int64)
        for y, row in enumerate(a.astype(np.int64)):
            left = np.r_[np.zeros(bpp, np.int64), row[:-bpp]]
            corner = np.r_[np.zeros(bpp, np.int64), above[:-bpp]]
            p = left + above - corner
            d = np.abs([p - left, p - above, p - corner])
            paeth = np.where((d[0] <= d[1]) & (d[0] <= d[2]), left, np.where(d[1] <= d[2], above, corner))
            kind = y % 5
            lines.append(bytes([kind]) + ((row - [np.zeros_like(row), left, above, (left + above) // 2, paeth][kind]) & 255).astype(np.uint8).tobytes())
            above = row
        data = media.SIGNATURE + media.chunk(b"IHDR", struct.pack(">IIBBBBB", 10, 12, 8, colour, 0, 0, 0)) + media.chunk(b"IDAT", zlib.compress(b"".join(lines))) + media.chunk(b"IEND", b"")
        assert (media.decode(data).reshape(12, -1) == a).all()
        for i in (3, 20, 45, len(data) - 2):
            with pytest.raises(ValueError):
                media.decode(data[:i] + bytes([data[i] ^ 1]) + data[i + 1 :])


def brute_base(text):
    out = []
    for k, pattern, flags, least, group in ((0, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 8, 2), (1, "AKIA[A-Z0-9]+", 0, 16, 0), (2, "[0-9a-f]+", 0, 32, 0)):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text, flags) if len(m.group(group)) >= least]
    return sorted(out)


def test_secrets(spark, odd, empty):
    rng = random.Random(1)
    parts = ["password", "PassWord", "api_key", "token", "passſword", "=", ":", " ", '"', "'", "AKIA", "ABCDEF123456", "deadbeef", "0123456789abcdef" * 2, "é", "\n", "hunter2X9q", "secret="]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    for t in texts:
        assert secrets.base_spans(t) == brute_base(t)
    got = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        base = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in brute_base(t))
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and set(filter(None, base.split(","))) <= set(got[i].spans.split(","))
    assert secrets.scan(odd).count() == odd.count() and secrets.scan(empty).count() == 0
    clean = secrets.redact(odd)
    assert clean.columns == odd.columns and clean.where("doc_id = 15").first().text == "[SECRET]"
    assert clean.where("doc_id = 9").first().text == odd.where("doc_id = 9").first().text


def brute_cost(value, words):
    """Least bits over all ways to cut the value into segments, each taken at the cheapest kind that it can be."""
    n = len(value)
    step = lambda a, b: any(a + b in row or b + a in row for row in secrets.KEYBOARD)

    def bits(i, j):
        return sum(math.log2(10 if c in "0123456789" else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 4096) for c in value[i:j])

    def cost(i, j):
        part, out = value[i:j], [bits(i, j)]
        for form, extra in ((part.lower(), 0), (part.lower().translate(secrets.LEET), secrets.LEET_BITS)):
            if rank := words.get(form) if len(part) > 2 else None:
                big = sum(c.isupper() for c in part)
                out.append(math.log2(rank + 1) + extra + (1 if big == j - i else big))
                break
        if (m := secrets.DATE.match(value, i)) and m.end() == j:
            out.append(math.log2(150 if j - i == 4 else 365 * 150))
        if j - i > 2 and all(step(a, b) for a, b in zip(part.lower(), part.lower()[1:], strict=False)):
            out.append(secrets.WALK_BITS + math.log2(j - i))
        if j - i > 2 and len(set(part)) == 1:
            out.append(secrets.SAME_BITS + math.log2(j - i))
        out += [bits(i, i + p) + math.log2((j - i) // p + 1) for p in range(2, (j - i) // 2 + 1) if part[p:] == part[:-p]]
        return min(out)

    best = [0.0]
    for j in range(1, n + 1):
        best.append(min(best[i] + (secrets.SWITCH_BITS if i else 0.0) + cost(i, j) for i in range(j)))
    return best[n]


def test_guess_cost():
    words = secrets.words_of(VOCABULARY)
    assert len(words) > 10_000
    rng = random.Random(31)
    values = ["password123", "qwerty2024", "aaaaaaaa", "Tr0ub4dor&3", "abcabcabcabc", "x9$kQz!27", "2019-05-06hello", "6381cf9fbcc9", "aaaaaaaaaab"]
    values += ["".join(rng.choice(["a", "b", "ab", "1", "2", "qwe", "W", "@", "pass", "Love", "2019", "-05-", "é", "0", "zz"]) for _ in range(rng.randint(1, 9))) for _ in range(400)]
    unit = "".join(rng.choice("abcdefghijklmnop0123456789!") for _ in range(65))
    for v in (*values, unit * 2, "x" * 70 + "y"):
        for known in (words, secrets.words_of(None)):
            assert secrets.guess_cost(v, known)[0] == pytest.approx(brute_cost(v, known)), v
    for v in values[:40]:
        whole = secrets.guess_cost(v, words)[0]
        assert [secrets.guess_cost(v, words, e)[0] >= e for e in (whole - 0.5, whole + 0.5)] == [True, False]
    plain = secrets.words_of(None)
    assert secrets.guess_cost("password", plain)[0] < 5 < secrets.guess_cost("x9$kQz!27", plain)[0]
    assert secrets.guess_cost("letmein2020", plain)[1] == "word+date" and "walk" in secrets.guess_cost("qwertyui", plain)[1]
    costly = secrets.Costs(plain, 36.0)
    assert not secrets.guessed_spans("password: changeme", costly)
    assert secrets.guessed_spans("auth = 'kX9$vv!q27Lw#'", costly)


def test_toxicity_features():
    words, starts = {"idiot": 2.0, "moron": 1.25}, {"stup": 1.5, "stupid": 3.0}
    weight = lambda w: max([words.get(w, 0.0), *(v for k, v in starts.items() if len(k) in (4, 5, 6) and w.startswith(k))])
    rng = random.Random(32)
    parts = ["you", "IDIOT", "Moron", "stupidly", "stupor", "a", "tree", "id10t", "m0ron", "f*ck", "sooo", "Nooooo", "été", "!", "?!", "...", "42", "\n", "I", "_x_", ""]
    for _ in range(300):
        text = " ".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        found = re.findall(r"[^\W\d_]+", text)
        low = [w.lower() for w in found]
        n, chars, w = max(len(found), 1), max(len(text), 1), [weight(x) for x in low]
        hits, you = [i for i, x in enumerate(w) if x > 0], [i for i, x in enumerate(low) if x in toxicity.SECOND_PERSON]
        masked = re.findall(r"\b[^\W\d_]+[@$!*0-9]+[^\W\d_]+", text)
        undone = [m.lower().translate(str.maketrans("0134578@$!*", "oieastbasi.")) for m in masked]
        share = lambda signs: sum(c in signs for c in text) / chars
        want = [
            len(hits), len(hits) / n, sum(w), max(w, default=0), sum(any(abs(i - j) <= 5 for j in you) for i in hits), len(you) / n, sum(x.isupper() for x in found) / n, sum(x[0].isupper() for x in found) / n,
            share("!"), share(".,;:?"), sum(not (c.isalpha() or c in " \n") for c in text) / chars, len(masked) / n, sum(weight(m) > 0 for m in undone),
            len(re.findall(r"([^\W\d_])\1\1+", text)) / n, share("0123456789"), math.log1p(len(found)),
        ]
        if not text:
            want[10] = toxicity.features("", toxicity.Weights(words, starts))[10]
        assert toxicity.features(text, toxicity.Weights(words, starts)) == pytest.approx(want), text


def brute_boost(x, y, rounds, depth=3, rate=0.15):
    """Margins of boosted trees whose every cut between two values of every feature is tried, row by row."""
    margin = np.full(len(y), math.log(y.mean() / (1 - y.mean())))
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-margin))
        g, h, add = y - q, q * (1 - q), np.zeros(len(y))

        def grow(rows, level, g=g, h=h, add=add):
            gs, hs, best = g[rows].sum(), h[rows].sum(), (1e-6, None)
            for f in range(x.shape[1] if level < depth else 0):
                values = np.unique(x[:, f])
                for cut in (values[1:] + values[:-1]) / 2:
                    left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                    gl, hl, gr, hr = g[left].sum(), h[left].sum(), g[right].sum(), h[right].sum()
                    gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - gs**2 / (hs + 1)
                    if min(hl, hr) >= 0.1 and gain > best[0] + 1e-9:
                        best = (gain, (left, right))
            if best[1] is None:
                add[rows] = rate * gs / (hs + 1)
            else:
                for side in best[1]:
                    grow(side, level + 1)

        grow(np.arange(len(y)), 0)
        margin = margin + add
    return margin


def test_boosting_against_brute_force():
    rng = np.random.default_rng(33)
    x = np.stack([rng.integers(0, k, 250) * s for k, s in ((6, 1.0), (9, 0.25), (4, 3.0))], 1)
    y = (x[:, 0] + 2 * x[:, 1] - 0.3 * x[:, 2] + rng.normal(size=250) > 4).astype(float)
    assert np.allclose(toxicity.boost(x, y, rounds=6).margin(x), brute_boost(x, y, 6))


def test_toxicity(spark, sf, odd, empty):
    docs, labels = queries.table(spark, sf, "documents"), queries.table(spark, sf, "labels")
    model = toxicity.fit(docs, labels)
    a, b = (sorted(map(tuple, toxicity.score(docs, toxicity.fit(docs, labels)).collect())) for _ in range(2))
    assert a == b and all(0 <= s <= 1 for _, s in a)
    got = toxicity.score(odd, model).collect()
    assert len(got) == odd.count() and toxicity.score(empty, model).count() == 0
    kept = toxicity.keep_clean(odd, model)
    assert kept.columns == odd.columns and kept.count() == sum(r.score < 0.5 for r in got)
    # no labels, or one class: everything is scored alike
    flat = toxicity.fit(docs, labels.limit(0))
    assert all(r.score == pytest.approx(0.01) for r in toxicity.score(odd, flat).collect())


def test_toxicity_learns(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(1500):
        bad = i % 5 == 0
        words = prose(rng, rng.randint(5, 80)).split()
        if bad:
            words.insert(rng.randrange(len(words)), "grimlo" + rng.choice(["x", "ya", "zzu", "dade"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scored = toxicity.score(docs, toxicity.fit(docs, known)).join(known, "doc_id").where(toxicity.held_out())
    assert scored.where("(score >= 0.5) <> (toxic = 1)").count() <= 2


def test_isotonic_and_boosting():
    rng = np.random.default_rng(4)
    s = rng.normal(size=400)
    y = (rng.random(400) < 1 / (1 + np.exp(-2 * s))).astype(float)
    knots, levels = toxicity.isotonic(s, y)
    assert (np.diff(levels) > 0).all() and (np.diff(knots) > 0).all()
    x = rng.normal(size=(800, 3))
    z = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = toxicity.boost(x, z)
    assert ((model.margin(x) > 0) == (z > 0)).mean() > 0.95


def groups(ids, pairs):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_fingerprint():
    rng = random.Random(5)
    for n in (0, 1, 3, 4, 5, 60, 700):
        text = "\n".join(rng.choice(["A", "É", "b\tc"]) + str(rng.randint(0, 9)) for _ in range(n))
        w = text.encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
        assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("blocks", [1, 2])
def test_ball_links(spark, blocks):
    rng = np.random.default_rng(6)
    centers = rng.integers(-(2**63), 2**63, 12)
    fp = np.unique(np.concatenate([centers, *(c ^ np.bitwise_xor.reduce(np.int64(1) << rng.integers(0, 64, (8, 3)), 1) for c in centers), [0, -1, 1, 15, 31]]))
    df = spark.createDataFrame([(int(f), i) for i, f in enumerate(fp)], "fp long, id long")
    near = np.bitwise_count((fp[:, None] ^ fp[None]).view(np.uint64)) <= 4
    want = groups(range(len(fp)), zip(*np.nonzero(np.triu(near, 1)), strict=True))
    got = {r.id: r.component for r in components.components(simhash.links(df, 4, blocks)).collect()}
    assert {i: got.get(i, i) for i in range(len(fp))} == want


def test_large_buckets(monkeypatch):
    monkeypatch.setattr(simhash, "DENSE", 10)
    rng = np.random.default_rng(7)
    fp = np.unique(np.concatenate([c ^ np.bitwise_xor.reduce(np.int64(1) << rng.integers(0, 64, (60, 3)), 1) for c in rng.integers(-(2**63), 2**63, 6)]))
    near = np.bitwise_count((fp[:, None] ^ fp[None]).view(np.uint64)) <= 4
    a, b = simhash.forest(np.zeros(len(fp), np.int64), fp, np.arange(len(fp)), 4)
    assert groups(range(len(fp)), zip(a.tolist(), b.tolist(), strict=True)) == groups(range(len(fp)), zip(*np.nonzero(np.triu(near, 1)), strict=True))


def test_near_duplicates(odd, empty):
    rows = [r for r in odd.collect()]
    fps = [simhash.fingerprint(r.text or "") for r in rows]
    named = [(r.doc_id, f) for r, f in zip(rows, fps, strict=True) if r.doc_id is not None]
    want = groups({d for d, _ in named}, [(a, b) for a, f in named for b, g in named if (f ^ g).bit_count() <= 4])
    got = simhash.near_duplicates(odd).collect()
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((r.doc_id, f"{f:016x}") for r, f in zip(rows, fps, strict=True))
    assert all(r.component_id == want[r.doc_id] for r in got if r.doc_id is not None)
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted({w for w in want.values()})
    assert kept.where("doc_id is null").count() == 1
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_first(empty).count() == 0


def test_components(spark):
    rng = random.Random(8)
    pairs = [(i, i + 1) for i in range(60)] + [(rng.randint(100, 400), rng.randint(100, 400)) for _ in range(200)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = groups({x for p in pairs for x in p}, pairs)
    assert all(got.get(i, i) == c for i, c in want.items())
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_removed(texts):
    seen = Counter(b[i : i + 200] for b in texts for i in range(len(b) - 199))
    for b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        yield len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()


@pytest.mark.parametrize("most", [20_000, 6])
def test_repeated_spans(spark, most):
    rng = random.Random(9)
    passages = [prose(rng, n) for n in (30, 55, 90, 200)]
    texts = [None, "", "x" * 199, "x" * 200, "ab" * 300, "a line that is there again and again, with more than eighty bytes in it, each time the same.\n" * 8]
    for _ in range(60):
        t = prose(rng, rng.randint(0, 150))
        for p in rng.sample(passages, rng.randint(0, 2)):
            k = rng.randint(0, len(t))
            t = t[:k] + p[rng.randint(0, 20) : len(p) - rng.randint(0, 20)] + t[k:]
        texts.append(t)
        if rng.random() < 0.4 and t:
            k = rng.randrange(len(t))
            texts += [t, t[:k] + "#" + t[k + 1 :]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("key", F.lit(0)).withColumn("gram", F.lit(0))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.digest(docs, most).collect()}
    for i, want in enumerate(brute_removed([(t or "").encode() for t in texts])):
        assert got[i] == want, i


def test_repeated_spans_of_odd_rows(odd, empty):
    rows = odd.collect()
    want = Counter((r.doc_id, *w) for r, w in zip(rows, brute_removed([(r.text or "").encode() for r in rows]), strict=True))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.digest(odd).collect()) == want
    assert suffixes.digest(empty).count() == 0


def test_suffix_sort():
    rng = np.random.default_rng(10)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    s = suffixes.Suffixes(data)
    start = rng.integers(0, 2900, 500)
    length = rng.integers(0, 100, 500)
    segment = np.sort(rng.integers(0, 20, 500))
    order = s.sort(start, length, segment)
    raw = data.tobytes()
    got = [(int(segment[i]), raw[start[i] : start[i] + length[i]]) for i in order]
    assert got == sorted(got)
    x, y = rng.integers(0, 2900, (2, 300))
    common = s.common(x, y, np.full(300, 100))
    for a, b, c in zip(x.tolist(), y.tolist(), common.tolist(), strict=True):
        n = next((k for k in range(100) if raw[a + k] != raw[b + k]), 100)
        assert c == n
    # hashes that claim too much are found out by the bytes
    assert (s.verified(x, y, np.full(300, 100)) == common).all()


def best_fit_decreasing(lengths, capacity=4096):
    rooms, n = [], 0
    for length in sorted(lengths, reverse=True):
        k = bisect.bisect_left(rooms, length)
        n += k == len(rooms)
        room = rooms.pop(k) if k < len(rooms) else capacity
        if room > length:
            bisect.insort(rooms, room - length)
    return n


def mixes():
    rng = np.random.default_rng(11)
    yield "none", []
    yield "full", [4096] * 5
    yield "one", [1]
    yield "few", [3000] * 10 + [1096] * 5 + [2048] * 7 + [1] * 3
    yield "wide", rng.integers(1500, 4097, 8000)
    yield "all", rng.integers(1, 4097, 6000)
    yield "log-normal", np.clip(rng.lognormal(6.3, 1.1, 12000).astype(int), 1, 4096)
    yield "thirds", rng.integers(1200, 1500, 6000)
    yield "halves", np.r_[rng.integers(2049, 2800, 3000), rng.integers(300, 1900, 3500)]
    yield "short", rng.geometric(1 / 300, 9000).clip(1, 4096)


@pytest.mark.parametrize("name, lengths", list(mixes()))
def test_packing_plan(name, lengths):
    h = dict(Counter(map(int, lengths)))
    seq, ranks = defaultdict(list), defaultdict(set)
    for n, rank, count, first, offset in packing.plan(h).tolist():
        for i in range(count):
            seq[first + i].append((offset, n))
            assert rank + i not in ranks[n]
            ranks[n].add(rank + i)
    assert all(ranks[n] == set(range(c)) for n, c in h.items())
    for parts in seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096
    assert len(seq) <= best_fit_decreasing(map(int, lengths))
    if name == "thirds":  # three to a sequence, which best fit doesn't see
        assert len(seq) < 0.95 * best_fit_decreasing(map(int, lengths))


def test_nnls():
    rng = np.random.default_rng(12)
    a, x = rng.random((20, 8)), np.maximum(rng.normal(size=8), 0)
    assert np.allclose(packing.nnls(a, a @ x, 20_000), x, atol=1e-3)


def test_packing(odd, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    want = Counter()
    for r in odd.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want[(r.doc_id, k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    got = packing.pack(odd, VOCABULARY).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    seq = defaultdict(list)
    for r in got:
        seq[r.sequence_id].append((r.offset, r.length))
    for parts in seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096
    assert packing.pack(empty, VOCABULARY).count() == 0


@pytest.mark.parametrize("slots", [1 << 20, 256])
def test_tokens_are_the_tokenizers(slots):
    """20,000 texts against the plain call; with few slots the table is rebuilt again and again."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    rng = random.Random(13)
    cache = packing.Pieces(VOCABULARY, slots)
    odd_words = """It's don't. x1y2 ΣΑΣ <|endoftext|> foo<|endoftext|>bar <|ENDOFTEXT|> <|EndOfText|>x a.b,c! *** été. İstanbul, İ. DİYARBAKIRLİ, naïve?! 's ﬁ été É
    KK Å. ÿ Œuvre; ß ẞ (word) "word". 日本語。 ١٢ ½ ǅ. ŉ, ΐ! i̇. 're we'll, '' ' l'été 😀 x×y÷z = à'la ,'s""".split() + ["\x1cq", "\u2003", "\u3000字", "\0a", "a\0", "a\0b", "x" * 30 + ".", "é" * 20, "\x85y", "\x0bz", "\ud7ff"]
    texts = []
    for k in range(20_000 if slots > 1000 else 2000):
        if k % 2:
            texts.append("".join(rng.choice("abcXYZ.,'!?éİΣÉ<|>0129-_\u0301\u0338=  \n\t") for _ in range(rng.randint(0, 25))))
        else:
            texts.append(rng.choice([" ", "\n", "  "]).join(rng.choice(odd_words) if rng.random() < 0.4 else word(rng).title() + rng.choice(["", ".", ",", "!!", "&&&.", "'s"]) for _ in range(rng.randint(0, 15))))
    for i in range(0, len(texts), 500):
        some = texts[i : i + 500]
        ids, at = cache.ids([x.encode() for x in some])
        for x, a, b in zip(some, at, at[1:], strict=False):
            assert ids[a:b].tolist() == t.encode(x, add_special_tokens=False).ids, x


def test_mixing(spark, odd, empty):
    rows, plan = mixing.mix(odd)
    got = rows.collect()
    assert len(got) == odd.count() and mixing.mix(empty)[0].count() == 0
    assert all(r.copies in (0, 1, 2) and 0 <= r.size * r.copies <= 2 * r.size for r in got)
    assert all((r.shard_1 is not None) == (r.copies >= 1) and (r.shard_2 is not None) == (r.copies >= 2) for r in got)
    again = mixing.mix(odd)[0].collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    kept = mixing.mix_documents(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.copies for r in got)
    assert Counter((r.doc_id, r.source) for r in kept.collect()) == sum((Counter({(r.doc_id, r.source): r.copies}) for r in got), Counter())
    thrice = mixing.mix(odd, share=(3, 1), most=3)[0].collect()
    assert {r.copies for r in thrice} <= {0, 1, 2, 3} and all((r[f"shard_{k}"] is not None) == (r.copies >= k) for r in thrice for k in (1, 2, 3))
    assert mixing.mix_documents(empty).count() == 0


def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > 2 * sizes[s]}
        if not over:
            target |= {s: left * w[s] / total for s in open_}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mixing_targets_and_amounts(spark):
    rng = random.Random(14)
    docs = [(i, prose(rng, rng.randint(0, 40)), rng.choice(["big"] * 6 + ["a", "b", "Z", "é", None])) for i in range(1500)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows, _ = mixing.mix(df)
    got = rows.collect()
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
    want = brute_targets(dict(sizes))
    for r in got:
        assert r.target == pytest.approx(want[r.source])
    assert all(abs(taken[s] - want[s]) <= max(3, 0.01 * want[s]) for s in sizes)
    shards = Counter()
    for r in got:
        for s in (r.shard_1, r.shard_2):
            if s is not None:
                shards[s] += r.size
    assert len(shards) == 8 and max(shards.values()) < 1.6 * min(shards.values())


def test_tree_halves_blocks(spark):
    keyed = spark.createDataFrame([(s, b, 2) for s, n in (("a", 40), ("b", 21), (None, 3)) for b in range(n)], "source string, block int, copies int")
    tree = mixing.split_tree(keyed, None, "t", 3).collect()
    assert len(tree) == 128 and set(Counter(r.shard for r in tree).values()) == {16}


def test_licenses(spark, odd, empty):
    mit = next(t for n, t in licenses.KNOWN if n == "MIT")
    shown = "/*\n * Copyright (c) 2020 Someone\n" + "\n".join(" * " + x for x in mit.upper().replace("LICENSE", "LICENCE").split("\n")) + "\n */"
    texts = [mit, shown, mit + " more", "Copyright 1999 X\nReleased under the MIT Licence\nfoo\nLicensed under CC BY 4.0", None, ""]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("license", F.lit("x"))).collect()}
    assert [got[i].license for i in range(6)] == ["MIT", "MIT", None, None, None, None]
    assert got[0].digest == got[1].digest and (got[3].n_notices, got[3].notices) == (2, "CC-BY-4.0,MIT")
    assert got[4].digest == hashlib.sha256(b"").hexdigest()
    assert licenses.scan(odd).count() == odd.count() and licenses.scan(empty).count() == 0


def test_url_filter(spark):
    entries = spark.createDataFrame([("ads", "bad.com", "add", "2024-01-10"), ("ads", "bad.com", "remove", "2024-02-10"), ("mal", "x.bad.com", "add", "2024-02-01"), ("ads", None, "add", "2024-01-01"), ("ads", "bad.com", "add", None)], "list string, domain string, action string, day string").withColumn("day", F.to_date("day"))
    rows = [(1, "http://X.bad.com:80/a", "2024-01-09"), (2, "https://u@x.bad.com/a", "2024-01-10"), (3, "http://x.bad.com", "2024-02-05"), (4, "http://x.bad.com", "2024-02-10"), (5, "http://bad.com/", "2024-02-10"), (6, None, "2024-02-05"), (7, "http://notbad.com", "2024-02-05"), (8, "http://bad.com", None), (9, "junk", "2024-02-05"), (2, "https://u@x.bad.com/a", "2024-01-10")]
    captures = spark.createDataFrame(rows, "id long, url string, day string").withColumn("day", F.to_date("day")).withColumn("lists", F.lit("z"))
    got = sorted((r.id, r.blocked, r.lists) for r in urlfilter.filter_urls(captures, entries).collect())
    assert got == [(1, False, ""), (2, True, "ads"), (2, True, "ads"), (3, True, "ads,mal"), (4, True, "mal"), (5, False, ""), (6, False, ""), (7, False, ""), (8, False, ""), (9, False, "")]
    assert not any(r.blocked for r in urlfilter.filter_urls(captures, entries.limit(0)).collect())
    assert urlfilter.filter_urls(captures.limit(0), entries).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(15)
    x = rng.normal(size=(700, 24))
    near = np.concatenate([x[i] + 0.12 * rng.normal(size=(12, 24)) for i in range(12)])
    v = np.concatenate([x, near, x[:40], x[50:60] * 3]).astype("f4")
    rows = [(i, a.tolist()) for i, a in enumerate(v)]
    n = len(rows)
    rows += [(n, None), (n + 1, [0.0] * 24), (n + 2, [float("nan")] * 24), (n + 3, [None] * 24), (n + 4, []), (n + 5, [1.0, 2.0]), (n + 6, [1.0, 2.0]), (n + 7, [float("inf")] * 24), (None, v[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)).withColumn("v", F.lit(2))
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    hit = u @ u.T >= 0.95 - 1e-12
    np.fill_diagonal(hit, False)
    got = {r.vec_id: r for r in vectors.near_duplicates(df, shard_rows=200).collect()}
    found = sum(got[i].n_links for i in range(n))
    assert found >= 0.97 * hit.sum() and all(got[i].n_links <= hit[i].sum() for i in range(n))
    want = groups(range(n), zip(*np.nonzero(np.triu(hit)), strict=True))
    assert np.mean([got[i].component_id == want[i] for i in range(n)]) > 0.97
    for i in (n, n + 1, n + 2, n + 3, n + 4, n + 7):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[n + 5].n_links, got[n + 6].component_id) == (1, n + 5) and got[None].n_links == 0
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_vectors_of_doubles(spark):
    # cosines of 0.95 and a little more or less, which single precision can't tell apart
    turned = lambda c: [c, math.sqrt(1 - c * c), 0.0]
    rows = [(0, [1.0, 0.0, 0.0]), (1, turned(0.950000002)), (2, turned(0.949999998)[:1] + [0.0, math.sqrt(1 - 0.949999998**2)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [(r.n_links, r.component_id) for r in vectors.near_duplicates(df).orderBy("vec_id").collect()] == [(1, 0), (1, 0), (0, 2)]


def test_audit_without_links(spark):
    x = np.random.default_rng(18).normal(size=(300, 32))
    reps = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    none = spark.createDataFrame([], "a long, links long, partners long")
    # nobody asked has a link: not measured, unless all were asked
    assert vectors.audit(reps, none, 0.95, 20, 40) is None and vectors._recall(reps, none, 0.95, 20)[0] is None
    pair = reps.unionAll(spark.createDataFrame([(300, x[0].tolist())], "id long, v array<double>"))
    assert vectors.audit(pair, none, 0.95, 20, 6400) == 0.0


def test_splitting_of_large_shards(spark):
    rng = np.random.default_rng(16)
    v = np.concatenate([rng.normal(size=(1, 16)) + 0.3 * rng.normal(size=(900, 16)), rng.normal(size=(300, 16))]).astype("f4")
    df = spark.createDataFrame([(i, a.tolist()) for i, a in enumerate(v)], "vec_id long, embedding array<float>")
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    true = (u @ u.T >= 0.97).sum() - len(u)
    # where small shards miss too much, the audit tells and the overlap grows
    found = vectors.near_duplicates(df, 0.97, shard_rows=60).agg(F.sum("n_links")).first()[0]
    assert 0.9 * true <= found <= true


def test_links_across_shards(spark):
    rng = np.random.default_rng(17)
    v = np.concatenate([rng.normal(size=(1, 64)) + 0.12 * rng.normal(size=(1500, 64)), rng.normal(size=(1500, 64))]).astype("f4")
    df = spark.createDataFrame([(i, a.tolist()) for i, a in enumerate(v)], "vec_id long, embedding array<float>")
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    true = (u @ u.T >= 0.95).sum(1) - 1
    assert true.sum() > 1_000_000
    got = {r.vec_id: r for r in vectors.near_duplicates(df, shard_rows=60).collect()}
    # a group of 25 times a shard's rows: each of its links counts, wherever the ends lie
    assert [got[i].n_links for i in range(len(v))] == true.tolist()
    assert {got[i].component_id for i in range(1500)} == {0}
    # and where the shards' searches never reach the wanted recall, everything is compared
    few = df.where("vec_id % 10 = 0")
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(few, shard_rows=60, recall=1.1).collect()}
    assert [got[i] for i in range(0, len(v), 10)] == ((u[::10] @ u[::10].T >= 0.95).sum(1) - 1).tolist()


def test_licenses_as_published(spark):
    isc = dict(licenses.KNOWN)["ISC"]
    shown = "ISC License\n\nCopyright (c) 2020 Someone\n\n" + isc.replace("provided that the above copyright", "provided that the above\ncopyright")
    bsd = "BSD 2-Clause License\n\nCopyright 2020, Someone\nAll rights reserved.\n\n" + dict(licenses.KNOWN)["BSD-2-Clause"].replace("SHALL THE COPYRIGHT", "SHALL THE\nCOPYRIGHT")
    texts, want = [shown, bsd, "Copyright Someone Else\nhello"], ["ISC", "BSD-2-Clause", None]
    for name, file in (("Apache-2.0", "Apache-2.0"), ("GPL-3.0-only", "GPL-3"), ("LGPL-2.1-only", "LGPL-2.1"), ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0")):
        path = f"/usr/share/common-licenses/{file}"
        if os.path.exists(path):
            with open(path) as f:
                texts.append(f.read()), want.append(name)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert [got[i].license for i in range(len(texts))] == want
    assert got[2].digest == hashlib.sha256(b"hello").hexdigest()
    # lines are met by whatever list is passed in
    assert {r.doc_id: r.notices for r in licenses.scan(df, (("X", "Hello!"),)).collect()}[2] == "X"


def test_words_are_counted_without_lists(spark):
    texts_ = [None, "", " ", "\t\n\x0b\x0c\r ", "a", " a", "a ", "\r\na\x0bb\x0c c\t", "x y z", "  ä\U0001f600 b", "\x00 \x1f", "xx x" * 50, "a " * 30000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts_)], "doc_id long, text string").withColumn("n", mixing.size_of())
    for r in df.collect():
        assert r.n == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    assert "extract_all" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_sources_are_held_without_files(spark, monkeypatch):
    df = spark.createDataFrame([(i, "w " * (i % 9), f"s{i % 7}" if i % 5 else None) for i in range(300)], "doc_id long, text string, source string")
    plans, rows = [], []
    for most in (20_000, 2):  # held, and kept in files as the tables are larger
        monkeypatch.setattr(mixing, "held", lambda d, most=most: common.held(d, most))
        plan = mixing.mix_plan(common.cut(mixing.with_keys(df, "mix")))
        plans.append(plan._jdf.queryExecution().analyzed().toString())
        rows.append(sorted(map(str, plan.collect())))
    assert "LocalRelation" in plans[0] and "LocalRelation" not in plans[1] and rows[0] == rows[1] and len(rows[0]) == 8
