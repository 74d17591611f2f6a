"""Queries of this subpackage and their SQL, for ``__spark_entry__``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, divergence, language, licenses, line_dedup, mixing, periodic, pii, quality, sharding, simhash, suffix_dedup, topk
from .common import table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.digests(byte_bpe.encode_decode(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"), licenses.room_path())


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(periodic.with_repeats(table(spark, sf_dir, "documents")))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_pii": op2_pii,
    "op3_topk_search": op3_topk_search,
    "op4_quality_rules": op4_quality_rules,
    "op5_line_dedup": op5_line_dedup,
    "op6_sharding": op6_sharding,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_mixing": op8_mixing,
    "op9_simhash": op9_simhash,
    "op10_license_scan": op10_license_scan,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_language_id": op12_language_id,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE: dict[str, str] = {
    # Bytes as hex digits; every 50-byte string with the smallest id it starts in, covered stretches merged, gaps joined.
    "op7_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
s AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS p FROM d)),
c AS (SELECT s.doc_id, s.p FROM s JOIN (SELECT s, min(doc_id) AS least FROM s GROUP BY s HAVING count(DISTINCT doc_id) > 1) m
      ON s.s = m.s AND m.least < s.doc_id),
i AS (SELECT doc_id, p, sum(CASE WHEN p > prev + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS g
      FROM (SELECT doc_id, p, lag(p, 1, p) OVER (PARTITION BY doc_id ORDER BY p) AS prev FROM c)),
spans AS (SELECT doc_id, g, min(p) AS a, max(p) + 50 AS b FROM i GROUP BY ALL),
gaps AS (SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS x, a AS y FROM spans
         UNION ALL SELECT d.doc_id, coalesce(max(b), 0), any_value(n) FROM d LEFT JOIN spans ON spans.doc_id = d.doc_id GROUP BY d.doc_id),
kept AS (SELECT g.doc_id, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS k FROM gaps g JOIN d ON d.doc_id = g.doc_id GROUP BY 1),
sums AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM spans GROUP BY 1)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN sums ON sums.doc_id = d.doc_id""",
    "op3_topk_search": """
WITH v AS (SELECT row_number() OVER () AS tag, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.tag, q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON c.tag <> q.tag WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10""",
    # Lines of every document; a window is its three lines as text; later windows cover their lines.
    "op5_line_dedup": r"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
wins AS (SELECT doc_id, unnest(range(0, len(lines) - 2)) AS pos, lines FROM docs WHERE len(lines) >= 3),
keyed AS (SELECT doc_id, pos, lines[pos + 1] || chr(10) || lines[pos + 2] || chr(10) || lines[pos + 3] AS win FROM wins),
numbered AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS rn FROM keyed),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM numbered, (SELECT unnest(range(0, 3)) AS k) WHERE rn > 1),
kept AS (SELECT d.doc_id, l.pos, d.lines[l.pos + 1] AS line
         FROM docs d, LATERAL (SELECT unnest(range(0, len(d.lines))) AS pos) l
         ANTI JOIN gone g ON g.doc_id = d.doc_id AND g.pos = l.pos),
texts AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n FROM kept GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.lines), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(d.lines), 0) - coalesce(t.n, 0) AS BIGINT) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t.text, '') END AS text
FROM docs d LEFT JOIN texts t ON t.doc_id = d.doc_id""",
    # Every term of every group, absent ones included; shares as whole numbers.
    "op13_source_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 30),
q AS (SELECT lang, term, CAST(1 + (1000000000 * CAST(n + 5 AS HUGEINT)) // (sum(n) OVER l + 5 * count(*) OVER l) AS BIGINT) AS q
      FROM kept WINDOW l AS (PARTITION BY lang)),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
f AS (SELECT g.lang, g.source, q.term, q.q, coalesce(c.n, 0) AS n
      FROM g JOIN q ON q.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = q.term),
p AS (SELECT *, CAST(1 + (1000000000 * CAST(n + 5 AS HUGEINT)) // (sum(n) OVER s + 5 * count(*) OVER s) AS BIGINT) AS p
      FROM f WINDOW s AS (PARTITION BY lang, source)),
v AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
          UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50""",
}
