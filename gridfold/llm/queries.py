"""The queries opN_<name> of this subpackage, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import licenses, media, mixing, packing, secrets, simhash, suffixes, toxicity, urlfilter, vectors
from .common import hash60, table

MIX_SEED, MIX_LEVELS = "mix", 3


def op2_media_columns(spark, sf_dir):
    return media.digest(table(spark, sf_dir, "documents"))


def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"), vocabulary=public_tokenizers.path("word_bpe_49k.json"))


def captures(spark, sf_dir):
    """The pages as captures: the day of the fetch, which the table lacks, is made from page_id."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int"))
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url", day.alias("day"))


def list_entries(seen):
    """Dated list entries for the hosts of captures: up to 6 a host, each for the host or for its last three labels."""
    hosts = seen.select(urlfilter.host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    made = hosts.select("host", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("i")).withColumn("k", hash60("entry", F.col("host"), F.col("i"))).where("k % 3 = 0")
    return made.select(
        F.element_at(F.array(F.lit("ads"), F.lit("malware"), F.lit("spam")), (F.expr("k div 12") % 3 + 1).cast("int")).alias("list"),
        F.when(F.col("i") % 2 == 0, F.col("host")).otherwise(F.regexp_extract("host", r"[^.]+\.[^.]+\.[^.]+$", 0)).alias("domain"),
        F.when(F.expr("k div 3") % 4 == 0, "remove").otherwise("add").alias("action"),
        F.date_add(F.lit("2023-12-01").cast("date"), (F.expr("k div 36") % 420).cast("int")).alias("day"),
    ).distinct()


def op4_url_filter(spark, sf_dir):
    seen = captures(spark, sf_dir)
    return urlfilter.filter_urls(seen, list_entries(seen)).select(F.col("id").alias("page_id"), "url", "day", "host", "blocked", "lists")


def op5_repeated_spans(spark, sf_dir):
    return suffixes.digest(table(spark, sf_dir, "documents"))


def op6_pack_sequences(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_simhash_duplicates(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_mix_sources(spark, sf_dir):
    rows, _ = mixing.mix(table(spark, sf_dir, "documents"), seed=MIX_SEED, levels=MIX_LEVELS)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "shard_1", "shard_2")


def op9_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_vector_duplicates(spark, sf_dir):
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_media_columns": op2_media_columns,
    "op3_secret_scan": op3_secret_scan,
    "op4_url_filter": op4_url_filter,
    "op5_repeated_spans": op5_repeated_spans,
    "op6_pack_sequences": op6_pack_sequences,
    "op7_simhash_duplicates": op7_simhash_duplicates,
    "op8_mix_sources": op8_mix_sources,
    "op9_license_scan": op9_license_scan,
    "op10_vector_duplicates": op10_vector_duplicates,
}


def _op8_sql() -> str:
    h = f"('0x' || substr(md5('{MIX_SEED}:' || doc_id), 1, 15))::BIGINT"
    patches = "".join(
        f""",
best{k} AS (SELECT g.source, max({{'w': u.words, 'm': -u.h}}) p FROM gap{k - 1} g JOIN units u ON u.source IS NOT DISTINCT FROM g.source
  WHERE u.h > g.h_cut AND u.words <= g.gap AND u.words > 0 AND NOT list_contains(g.patches, u.h) GROUP BY ALL),
gap{k} AS (SELECT g.source, g.h_cut, g.gap - coalesce(b.p.w, 0) gap, CASE WHEN b.p IS NULL THEN g.patches ELSE list_append(g.patches, -b.p.m) END patches
  FROM gap{k - 1} g LEFT JOIN best{k} b ON b.source IS NOT DISTINCT FROM g.source)"""
        for k in (1, 2, 3)
    )
    tree = "".join(
        f""",
tree{k + 1} AS (SELECT source, block, copy, shard * 2 + CASE WHEN row_number() OVER (PARTITION BY shard ORDER BY
  ('0x' || substr(md5('{MIX_SEED}/{k}:' || coalesce(source, '~') || ':' || block || ':' || copy), 1, 15))::BIGINT, source NULLS LAST, block, copy) * 2
  > count(*) OVER (PARTITION BY shard) + 1 THEN 1 ELSE 0 END shard FROM tree{k})"""
        for k in range(MIX_LEVELS)
    )
    return f"""
WITH keys AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')), 0) size, {h} h FROM documents),
units AS (SELECT source, h, sum(size)::BIGINT words FROM keys GROUP BY ALL),
sized AS (SELECT source, sum(words)::BIGINT source_size FROM units GROUP BY ALL),
weighed AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] w, source_size * 2 cap FROM sized),
ordered AS (SELECT *, cap / w ratio, 3 * sum(source_size) OVER ()
  - 2 * coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) over_,
  2 * sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) wsum FROM weighed),
level AS (SELECT min({{'r': ratio, 'l': over_::DOUBLE / wsum}}).l l FROM ordered WHERE over_ * w <= wsum * cap),
goal AS (SELECT source, source_size, least(cap::DOUBLE, coalesce(l * w, cap::DOUBLE)) target FROM ordered, level),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN floor(least(target / source_size, 1))::BIGINT ELSE 0 END base FROM goal),
room AS (SELECT *, floor(target - base * source_size)::BIGINT room FROM plan),
ran AS (SELECT u.*, r.room, sum(u.words) OVER (PARTITION BY u.source ORDER BY u.h) cum FROM units u JOIN room r ON r.source IS NOT DISTINCT FROM u.source),
gap0 AS (SELECT source, min(h) - 1 h_cut, min({{'h': h, 'g': room - (cum - words)}}).g gap, []::BIGINT[] patches FROM ran WHERE cum > room GROUP BY source){patches},
taken AS (SELECT k.*, p.source_size, p.target, p.base + CASE WHEN g.h_cut IS NULL OR k.h <= g.h_cut OR list_contains(g.patches, k.h) THEN 1 ELSE 0 END copies, (k.h >> 54)::INT block
  FROM keys k JOIN plan p ON p.source IS NOT DISTINCT FROM k.source LEFT JOIN gap3 g ON g.source IS NOT DISTINCT FROM k.source),
tree0 AS (SELECT source, block, unnest(range(1, max(copies) + 1)) copy, 0 shard FROM taken WHERE copies > 0 GROUP BY source, block){tree}
SELECT t.doc_id, t.size::BIGINT size, t.source_size, t.target, (t.size * t.copies)::BIGINT taken, a.shard::INT shard_1, b.shard::INT shard_2 FROM taken t
LEFT JOIN tree{MIX_LEVELS} a ON a.source IS NOT DISTINCT FROM t.source AND a.block = t.block AND a.copy = 1 AND t.copies >= 1
LEFT JOIN tree{MIX_LEVELS} b ON b.source IS NOT DISTINCT FROM t.source AND b.block = t.block AND b.copy = 2 AND t.copies >= 2"""


_OP4_SQL = r"""
WITH cap AS (SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 37) % 366 AS INT) AS "day",
  lower(regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^.*@', ''), '\.?(:[0-9]*)?$', '')) host FROM pages),
keyed AS (SELECT host, i, ('0x' || substr(md5('entry:' || host || ':' || i), 1, 15))::BIGINT k FROM (SELECT DISTINCT host FROM cap WHERE host <> ''), range(6) t(i)),
entries AS (SELECT DISTINCT ['ads', 'malware', 'spam'][(k // 12) % 3 + 1] list, CASE WHEN i % 2 = 0 THEN host ELSE regexp_extract(host, '[^.]+\.[^.]+\.[^.]+$') END "domain",
  CASE WHEN (k // 3) % 4 = 0 THEN 'remove' ELSE 'add' END action, DATE '2023-12-01' + CAST((k // 36) % 420 AS INT) "day" FROM keyed WHERE k % 3 = 0),
spans AS (SELECT *, coalesce(lead("day") OVER (PARTITION BY list, "domain" ORDER BY "day", action), DATE '9999-12-31') "until" FROM entries),
names AS (SELECT host, "day", unnest(list_transform(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.'))) "name"
  FROM (SELECT DISTINCT host, "day" FROM cap WHERE host <> '')),
hit AS (SELECT n.host, n."day", array_to_string(list_sort(list(DISTINCT s.list)), ',') lists FROM names n JOIN spans s
  ON s."domain" = n."name" AND s.action = 'add' AND n."day" >= s."day" AND n."day" < s."until" GROUP BY ALL)
SELECT c.page_id, c.url, c."day", c.host, h.lists IS NOT NULL blocked, coalesce(h.lists, '') lists FROM cap c LEFT JOIN hit h ON h.host = c.host AND h."day" = c."day" """


def _op9_sql() -> str:
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def canonical(x: str) -> str:
        out = rf"regexp_replace(translate({x}, '{licenses.UPPER}', '{licenses.LOWER}'), {quoted(licenses.COPYRIGHT)}, '\1', 'g')"
        out = f"' ' || trim(regexp_replace({out}, {quoted(licenses.BETWEEN)}, ' ', 'g'), ' ') || ' '"
        for a, b in licenses.SPELLINGS:
            out = f"replace({out}, {quoted(a)}, {quoted(b)})"
        return f"sha256(trim({out}, ' '))"

    values = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in licenses.KNOWN)
    return f"""
WITH known AS (SELECT {canonical("t")} k, min(n) "license", bool_or(NOT contains(t, chr(10))) one FROM (VALUES {values}) v(n, t) GROUP BY 1),
docs AS (SELECT row_number() OVER () r, doc_id, coalesce(text, '') t FROM documents),
lines AS (SELECT r, unnest(list_filter(string_split(t, chr(10)), lambda x: contains(translate(x, '{licenses.UPPER}', '{licenses.LOWER}'), 'licen'))) l FROM docs),
met AS (SELECT r, count(*) n, array_to_string(list_sort(list(DISTINCT "license")), ',') s FROM (SELECT r, {canonical("l")} k FROM lines) JOIN known USING (k) WHERE one GROUP BY r)
SELECT doc_id, {canonical("t")} digest, known."license", coalesce(n, 0)::BIGINT n_notices, coalesce(s, '') notices
FROM docs LEFT JOIN known ON known.k = {canonical("t")} LEFT JOIN met USING (r)"""


ORACLES = {"op4_url_filter": _OP4_SQL, "op8_mix_sources": _op8_sql(), "op9_license_scan": _op9_sql()}
