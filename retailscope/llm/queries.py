"""The operators as registered queries over whole tables, each beside its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailscope.llm.common import documents
from retailscope.llm.decontaminate import contamination, decontaminate
from retailscope.llm.exact_dedup import exact_dedup
from retailscope.llm.langid import identify_languages, in_fold
from retailscope.llm.mixing import mix
from retailscope.llm.quality import score_quality
from retailscope.llm.secret_scan import scan_secrets, secret_report
from retailscope.llm.simhash import simhash_groups
from retailscope.llm.source_audit import audit_sources
from retailscope.llm.token_alignment import align_tokens
from retailscope.llm.token_counts import count_tokens
from retailscope.llm.token_shards import token_shards
from retailscope.llm.url_filter import BLOCKED_WORDS, judge_urls
from retailscope.llm.vector_search import nearest_neighbours


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(scan_secrets(documents(spark, sf_dir)))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(decontaminate(documents(spark, sf_dir), benchmark))


def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards(documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).drop("copies")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = in_fold("doc_id", 3, 1)
    found = identify_languages(docs, docs.where(~held_out))
    return found.withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(documents(spark, sf_dir))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(documents(spark, sf_dir))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_neighbours(points, points.where(F.col("vec_id") % 100 == 0))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_decontamination": op3_decontamination,
    "op4_token_shards": op4_token_shards,
    "op5_token_counts": op5_token_counts,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_mixing": op7_mixing,
    "op8_url_filter": op8_url_filter,
    "op9_language_id": op9_language_id,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_source_audit": op12_source_audit,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

EXACT_DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

DECONTAMINATION_SQL = r"""
WITH documents_ AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0),
phrases AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM starts),
places AS (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM documents_, (SELECT DISTINCT size FROM phrases) WHERE len(w) >= size),
windows AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM places),
hits AS (SELECT doc_id, i, size, item_id FROM windows JOIN phrases USING (size, phrase)),
words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id),
found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM documents_ LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

MIXING_SQL = r"""
WITH rows_ AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS hash
    FROM documents),
sources AS (
    SELECT source, sum(size)::HUGEINT AS source_size,
           [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::HUGEINT AS weight
    FROM rows_ GROUP BY source),
ordered AS (
    SELECT *, 3 * source_size AS most,
           coalesce(sum(3 * source_size) OVER low, 0) AS fixed, sum(weight) OVER rest AS parts,
           sum(source_size) OVER () AS words, row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS place
    FROM sources
    WINDOW low AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           rest AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (
    SELECT (words - fixed)::HUGEINT AS share, parts::HUGEINT AS parts FROM ordered
    WHERE (words - fixed) * weight <= most * parts ORDER BY place LIMIT 1),
targets AS (
    SELECT s.source, source_size::BIGINT AS source_size,
           CASE WHEN 3 * source_size * parts < share * weight THEN (3 * source_size)::DOUBLE
                ELSE (share * weight)::DOUBLE / parts::DOUBLE END AS target
    FROM sources s, level),
budgets AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM targets),
sums AS (
    SELECT r.source, hash, sum(size)::BIGINT AS words FROM rows_ r GROUP BY r.source, hash),
running AS (
    SELECT b.source, hash, words, sum(words) OVER (PARTITION BY b.source ORDER BY hash) AS reached,
           target - passes * source_size AS budget
    FROM sums s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source WHERE source_size > 0),
met AS (
    SELECT source, min_by(hash + CASE WHEN reached - budget < budget - (reached - words) THEN 1 ELSE 0 END, hash) AS below
    FROM running WHERE reached >= budget GROUP BY source)
SELECT doc_id, size, source_size, target,
       ((passes + CASE WHEN hash < coalesce(below, 0) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM rows_ r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source LEFT JOIN met m ON r.source IS NOT DISTINCT FROM m.source
"""

WORD_TESTS = " OR ".join(f"regexp_matches(low, '(^|[^a-z0-9]){w}([^a-z0-9]|$)')" for w in BLOCKED_WORDS)
URL_SQL = rf"""
WITH rest AS (
    SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
places AS (
    SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest),
ruled AS (
    SELECT page_id, host, path, translate(host || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, CASE
        WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/'
        WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/' END AS rule
    FROM places)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow' WHEN {WORD_TESTS} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

AUDIT_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
counted AS (
    SELECT doc, lang, source, term, count(*) AS n FROM (SELECT doc, lang, source, unnest(w) AS term FROM docs)
    GROUP BY doc, lang, source, term),
kept AS (SELECT lang, term, sum(n) AS n FROM counted GROUP BY lang, term HAVING count(*) >= 3),
held AS (SELECT c.lang, source, term, sum(c.n) AS n FROM counted c JOIN kept USING (lang, term) GROUP BY c.lang, source, term),
langs AS (SELECT lang, count(*) AS v, sum(n) AS words FROM kept GROUP BY lang),
groups_ AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (
    SELECT g.lang, g.source, coalesce(sum(n), 0) AS words FROM groups_ g LEFT JOIN held USING (lang, source) GROUP BY g.lang, g.source),
shares AS (
    SELECT s.lang, s.source, k.term, coalesce(h.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(h.n, 0) + 1)::HUGEINT) // (s.words + v)::HUGEINT AS p,
           1 + (1000000000::HUGEINT * (k.n + 1)::HUGEINT) // (l.words + v)::HUGEINT AS q
    FROM sizes s JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN held h USING (lang, source, term)),
apart AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM shares a JOIN shares b USING (lang, term) GROUP BY a.lang, a.source, b.source),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups_ a JOIN groups_ b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, place::INTEGER AS rank FROM ranked WHERE part = 'pair' OR place <= 200
"""

SQL = {
    "op1_exact_dedup": EXACT_DEDUP_SQL,
    "op3_decontamination": DECONTAMINATION_SQL,
    "op7_mixing": MIXING_SQL,
    "op8_url_filter": URL_SQL,
    "op12_source_audit": AUDIT_SQL,
}
