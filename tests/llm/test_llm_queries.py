"""The registered queries against their SQL, and the pipeline stage by stage against brute force."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from gridfold.llm import mixing, packing, queries, secrets, simhash, toxicity
from gridfold.llm.common import written


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(name, same):
    same(queries.QUERIES[name], queries.ORACLES[name])


def test_all_ten_are_registered():
    assert sorted({int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES}) == list(range(1, 11))


def test_pipeline(spark, sf):
    docs = queries.table(spark, sf, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_copies", "secrets", "mixing", "packing"]
    stage = dict(corpus_pipeline.STAGES)

    clean = written(stage["toxicity"](spark, docs, sf))
    model = toxicity.fit(docs, queries.table(spark, sf, "labels"))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, s in scores.items() if s < 0.5}

    firsts = written(stage["near_copies"](spark, clean, sf))
    fps = [(r.doc_id, simhash.fingerprint(r.text or "")) for r in clean.collect()]
    parent = {d: d for d, _ in fps}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, (a, f) in enumerate(fps):
        for b, g in fps[:i]:
            if (f ^ g).bit_count() <= 4:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    assert {r.doc_id for r in firsts.collect()} == {root(d) for d, _ in fps} and firsts.columns == docs.columns

    safe = written(stage["secrets"](spark, firsts, sf))
    want, costly = {}, secrets.Costs(secrets.words_of(queries.public_tokenizers.path(corpus_pipeline.VOCABULARY)), 36.0)
    for r in firsts.collect():
        spans = sorted(secrets.base_spans(r.text or "") + secrets.guessed_spans(r.text or "", costly))
        want[r.doc_id] = secrets.redacted(r.text, spans) if spans else r.text
    assert {r.doc_id: r.text for r in safe.collect()} == want and safe.columns == docs.columns
    assert not any(secrets.base_spans(t or "") for t in want.values())

    mixed = written(stage["mixing"](spark, safe, sf))
    rows, _ = mixing.mix(safe)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: r.copies for r in rows.collect() if r.copies})

    packed = stage["packing"](spark, mixed, sf).collect()
    pieces = packing.pieces(mixed, queries.public_tokenizers.path(corpus_pipeline.VOCABULARY)).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert Counter(map(key, packed)) == Counter(map(key, pieces))
    assert sorted(map(key, corpus_pipeline.run(spark, sf).collect())) == sorted(map(key, packed))


def test_empty_pipeline(spark, sf, tmp_path):
    docs = queries.table(spark, sf, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf))
    assert docs.count() == 0


def test_stages_keep_odd_rows(spark, sf):
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", None, 0), (1, None, "en", None, 0), (4, "x y z", "en", "s", 5), (2, "", None, "s", None)], "doc_id long, text string, lang string, source string, n_chars long")
    long = "word " * 200_000
    odd = odd.unionAll(spark.createDataFrame([(3, long, "en", "s", len(long))], odd.schema))
    for _, stage in corpus_pipeline.STAGES[:3]:
        odd = written(stage(spark, odd, sf))
    # the first of equal texts stays, whole
    assert {(r.doc_id, r.text) for r in odd.collect()} >= {(None, None), (1, None), (4, "x y z"), (3, long)}
    before = Counter(map(tuple, odd.collect()))
    stage = corpus_pipeline.STAGES[3][1]
    odd = written(stage(spark, odd, sf))
    after = Counter(map(tuple, odd.collect()))
    assert after and all(n <= 2 * before[r] for r, n in after.items())
    assert dict(odd.dtypes) == {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
