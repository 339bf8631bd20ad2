"""The registered queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import encode_decode
from .common import table
from .decontaminate import contaminated
from .divergence import source_divergence
from .hard_negatives import hard_negatives
from .language import predict_languages
from .licenses import CUE, PHRASES, TEMPLATES, scan_licenses
from .near_dedup import near_duplicates
from .neighbours import nearest
from .ngram_join import ngram_join
from .quality import quality_scores
from .secrets import secret_spans
from .sharding import shards
from .token_counts import token_counts


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source, language and thousand of the id are directories; every tenth id is a licence file there,
    or, where it ends in 50, one directory up."""
    docs = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    name = F.when(i % 10 == 0, F.concat(F.lit("LICENSE-"), i.cast("string"))).otherwise(i.cast("string"))
    thousand = F.when(i % 100 == 50, F.lit(None)).otherwise(F.floor(i / 1000).cast("string"))
    path = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), thousand, name)
    found = scan_licenses(docs.select(path.alias("path"), "text"))
    return found.select(F.regexp_extract("path", r"[0-9]*$", 0).cast("long").alias("doc_id"), "path", "license", "score", "origin", "directory")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"), model=public_tokenizers.path("piece_bpe_32k.model"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    values = ", ".join("({}, '{}', '{}')".format(i, k, t.replace("'", "''")) for i, (k, t) in enumerate(TEMPLATES))
    phrases = " OR ".join(" AND ".join(f"w[i + {n}] = '{x}'" for n, x in enumerate(p.split())) for p in PHRASES)
    return rf"""
WITH templates(template, license, text) AS (VALUES {values}),
words AS (SELECT template, license, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM templates),
counts AS (SELECT template, license, word, count(*) AS tf FROM words GROUP BY ALL),
known AS (SELECT word, count(*) AS df, count(DISTINCT license) AS licenses, ln((1 + (SELECT count(*) FROM templates)) / (1 + count(*))) + 1 AS idf FROM counts GROUP BY word),
norms AS (SELECT template, sqrt(sum((tf * idf) ** 2)) AS norm FROM counts JOIN known USING (word) GROUP BY 1),
weights AS (SELECT template, license, word, tf * idf / norm AS share FROM counts JOIN known USING (word) JOIN norms USING (template)),
keyed AS (
    SELECT template, license, (SELECT count(*) FROM words v WHERE v.template = c.template) AS n, list(word) FILTER (licenses = 1) AS own,
        list(word) FILTER (df = least) AS rarest FROM (SELECT *, min(df) OVER (PARTITION BY template) AS least FROM counts JOIN known USING (word)) c GROUP BY ALL
), fitted AS (SELECT template, license, n, coalesce(own, rarest) AS keys, CASE WHEN own IS NULL THEN len(rarest) ELSE 1 END AS need FROM keyed),
files AS (
    SELECT concat_ws('/', coalesce(source, '-'), coalesce(lang, '-'), CASE WHEN doc_id % 100 <> 50 THEN CAST(doc_id // 1000 AS VARCHAR) END,
        CASE WHEN doc_id % 10 = 0 THEN 'LICENSE-' ELSE '' END || doc_id) AS path, doc_id, doc_id % 10 = 0 AS whole, text FROM documents
), spoken AS (SELECT path, whole, text, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM files WHERE text IS NOT NULL AND (whole OR regexp_matches(text, '{CUE}'))),
units AS (
    SELECT path, unnest(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{CUE}'))) AS unit FROM spoken UNION SELECT path, text FROM spoken WHERE whole
), terms AS (
    SELECT unit, word, count(*) AS tf FROM (SELECT unit, unnest(regexp_extract_all(lower(unit), '[a-z0-9]+')) AS word FROM (SELECT DISTINCT unit FROM units)) GROUP BY ALL
), weighed AS (SELECT unit, word, tf * coalesce(idf, ln(1 + (SELECT count(*) FROM templates)) + 1) AS weight FROM terms LEFT JOIN known USING (word)),
lengths AS (SELECT unit, sqrt(sum(weight * weight)) AS length FROM weighed GROUP BY 1),
lines AS (SELECT w.unit, t.license, round(sum(w.weight * t.share) / any_value(l.length), 6) AS score FROM weighed w JOIN weights t USING (word) JOIN lengths l ON l.unit = w.unit GROUP BY w.unit, t.template, t.license),
cues AS (SELECT * FROM (SELECT path, w, unnest(range(1, len(w) + 1)) AS i FROM spoken) WHERE regexp_matches(w[i], 'licen[cs]|spdx|copyleft') OR {phrases}),
stretches AS (
    SELECT DISTINCT path, template, x FROM (SELECT path, template, keys, need, w[s:s + n - 1] AS x FROM (SELECT *, unnest(range(greatest(i - n + 1, 1), i + 1)) AS s FROM cues, fitted)) WHERE len(list_intersect(x, keys)) >= need
), parts AS (SELECT template, x, word, count(*) AS tf FROM (SELECT template, x, unnest(x) AS word FROM (SELECT DISTINCT template, x FROM stretches)) GROUP BY ALL),
fits AS (
    SELECT template, x, round(sum(p.tf * coalesce(idf, ln(1 + (SELECT count(*) FROM templates)) + 1) * coalesce(share, 0)) / sqrt(sum((p.tf * coalesce(idf, ln(1 + (SELECT count(*) FROM templates)) + 1)) ** 2)), 6) AS score
    FROM parts p LEFT JOIN known USING (word) LEFT JOIN weights USING (template, word) GROUP BY ALL
), scored AS (
    SELECT path, license, score FROM units JOIN lines USING (unit) UNION ALL SELECT path, license, score FROM stretches JOIN fits USING (template, x) JOIN fitted USING (template)
), own AS (SELECT path, license, score FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY score DESC, license) AS place FROM scored WHERE score >= 0.6) WHERE place = 1),
granted AS (SELECT regexp_replace(path, '/?[^/]*$', '') AS above, first(license ORDER BY score DESC, license) AS lent, max(score) AS lent_score FROM own JOIN (SELECT DISTINCT path FROM files WHERE whole) USING (path) GROUP BY 1),
above AS (
    SELECT path, depth, array_to_string(steps[1:depth], '/') AS above
    FROM (SELECT path, steps, unnest(range(0, len(steps) + 1)) AS depth FROM (SELECT DISTINCT path, string_split(regexp_replace(path, '/?[^/]*$', ''), '/') AS steps FROM files))
), inherited AS (SELECT path, arg_max(lent, depth) AS lent, arg_max(lent_score, depth) AS lent_score, arg_max(above, depth) AS directory FROM above JOIN granted USING (above) GROUP BY 1)
SELECT DISTINCT doc_id, path, coalesce(o.license, i.lent) AS license, coalesce(o.score, i.lent_score) AS score,
    CASE WHEN o.license IS NOT NULL THEN CASE WHEN whole THEN 'file' ELSE 'header' END WHEN i.lent IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
    CASE WHEN o.license IS NULL THEN i.directory END AS directory
FROM files f LEFT JOIN own o USING (path) LEFT JOIN inherited i USING (path)
"""


OP5_SQL = _license_sql()

OP8_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4])) END AS s
    FROM words
), items AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) + any_value(b.n) AS n, count(*) AS c
    FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common WHERE 100 * c >= 85 * (n - c)
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
), least AS (
    SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (doc_id)
"""

OP13_SQL = OP8_SQL.replace("w[i:i + 4]", "w[i:i + 3]").replace("len(w) < 5", "len(w) < 4").replace("len(w) - 3", "len(w) - 2").replace(", doc_id = component_id AS kept", "")

OP11_SQL = r"""
WITH docs AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS i,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), words AS (SELECT lang, source, i, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT i) >= 30),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT lang, count(term) AS v FROM (SELECT DISTINCT lang FROM groups) LEFT JOIN kept USING (lang) GROUP BY 1),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
full_counts AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
shares AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM full_counts JOIN sizes USING (lang)),
totals AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL),
whole AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q FROM totals JOIN sizes USING (lang)),
gaps AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source
    UNION ALL SELECT lang, source, 'term', term, p - q FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 50
"""

OP12_SQL = """
WITH able AS (
    SELECT vec_id AS id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS score
    FROM able a JOIN able b ON a.id <> b.id WHERE a.id % 100 = 0
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id,
    CAST(positive_score AS BIGINT) AS positive_score, CAST(score AS BIGINT) AS negative_score
FROM positives JOIN scores USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score QUALIFY rank <= 5
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_neighbours": op1_neighbours,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_language": op3_language,
        "op4_token_counts": op4_token_counts,
        "op5_licenses": op5_licenses,
        "op6_decontaminate": op6_decontaminate,
        "op7_quality": op7_quality,
        "op8_near_dedup": op8_near_dedup,
        "op9_secrets": op9_secrets,
        "op10_shards": op10_shards,
        "op11_divergence": op11_divergence,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_ngram_join": op13_ngram_join,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_licenses": OP5_SQL,
        "op8_near_dedup": OP8_SQL,
        "op11_divergence": OP11_SQL,
        "op12_hard_negatives": OP12_SQL,
        "op13_ngram_join": OP13_SQL,
    }
