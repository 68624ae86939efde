"""The registered queries of the corpus operators and their DuckDB oracles."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import centroids, html, language, lines, minhash, packing, quality, runs, sampling, secrets, substrings, vectors, warc
from ledgerline.llm.common import cut, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


@register("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned from two thirds of the documents."""
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out.alias("held_out"))
    model = language.fit(docs.where("not held_out"))
    return language.predict(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


QUALITY_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w
), grams AS (
  SELECT doc_id, i, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), again AS (
  SELECT doc_id, i, w3 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, word, w2, w3) > 1 AS hit FROM grams
), repeats AS (
  SELECT doc_id, sum(CASE WHEN covered THEN 1 ELSE 0 END) AS n_repeat_words FROM (
    SELECT doc_id, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS covered FROM again
  ) GROUP BY doc_id
), sizes AS (
  SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars, max(length(word)) AS longest_word,
         count(*) FILTER (regexp_matches(word, '[A-Za-z]|[^\x00-\x7F]')) AS n_letter_words
  FROM words GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (
    SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w
  ) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         coalesce(n_letter_words, 0) AS n_letter_words, coalesce(longest_word, 0) AS longest_word
  FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)
), judged AS (
  SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
         + 8 * (2 * n_dup_lines > n_lines)::INT + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 20 * n_words)::INT
         + 64 * (10 * n_letter_words < 6 * n_words)::INT + 128 * (longest_word > 1000)::INT AS BIGINT) AS fail_mask
  FROM m
)
"""

OP6_SQL = QUALITY_SQL + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_mask & 3) <> 0 AS base_failed, (fail_mask & 127) = 0 AS kept, fail_mask
FROM judged
"""


@register("op6_quality_rules", OP6_SQL)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failure bits and the verdict of the current policy per document."""
    led = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return led.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("fail_mask").bitwiseAND(F.lit(quality.BASE.mask)) != 0).alias("base_failed"), "kept", "fail_mask",
    )


@register(
    "quality_ablations",
    QUALITY_SQL
    + """
, policy(policy, version, mask) AS (VALUES ('base', 1, 3), ('strict', 1, 7), ('strict', 2, 127)),
rule(rule, bit) AS (VALUES ('few_words', 1), ('repeated_windows', 2), ('symbols', 4), ('duplicate_lines', 8),
                           ('short_words', 16), ('long_words', 32), ('few_letter_words', 64))
SELECT policy, version, rule, CAST(sum(((fail_mask & bit) <> 0)::INT) AS BIGINT) AS n_failed,
       CAST(sum(((fail_mask & mask) = bit)::INT) AS BIGINT) AS n_only,
       CAST(sum(((fail_mask & mask) = 0)::INT) AS BIGINT) AS n_kept,
       CAST(sum(((fail_mask & (mask - bit)) = 0)::INT) AS BIGINT) AS n_kept_without
FROM judged, policy JOIN rule ON (mask & bit) <> 0 GROUP BY policy, version, rule
""",
)
def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy version rejects, alone and with others."""
    return quality.ablations(quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")))


@register("op2_minhash_near_duplicates")
def op2_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets overlap by 85 % or more."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op3_repeated_substrings")
def op3_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document that a 50-byte string of an earlier document covers."""
    out = substrings.repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])
    return out.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@register("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate secret of every text with the forest's score and verdict."""
    # the texts are searched once; the candidates serve the training and the verdicts
    found = cut(secrets.candidates(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), path="source"))
    judged = secrets.judge(found, secrets.fit_forest(secrets.weak_labels(found)))
    return judged.select("doc_id", "start", "length", F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")


OP5_SQL = r"""
WITH p AS (
  SELECT page_id AS i, url, 1700000000 + (page_id * 7919) % 30 * 86400 + (page_id * 104729) % 86400 AS start, md5(coalesce(html, '')) AS body
  FROM pages
), q AS (
  SELECT *, md5(body || '2') AS second, '"' || substr(body, 1, 16) || '"' AS tag, '"' || substr(md5(body || '2'), 1, 16) || '"' AS tag2,
         regexp_replace(url, '#.*$', '') AS plain, CASE WHEN contains(url, '?') THEN '&' ELSE '?' END AS sep
  FROM p
), r AS (
  SELECT i * 8 AS record_id, false AS is_full, url, start - 3600 AS ts, NULL AS digest, tag AS etag, '0' AS n FROM q WHERE i % 7 = 0
  UNION ALL SELECT i * 8 + 1, true, url, start, body, tag, '1' FROM q
  UNION ALL SELECT i * 8 + 2, false, plain || sep || 'utm_source=feed', start + 90000, NULL, 'W/' || tag, '2' FROM q
  UNION ALL SELECT i * 8 + 3, true, url, start + 180000, second, tag2, '3' FROM q WHERE i % 5 = 0
  UNION ALL SELECT i * 8 + 4, false, url || '#top', start + 270000, NULL, CASE WHEN i % 5 = 0 THEN tag2 ELSE tag END, '4' FROM q
  UNION ALL SELECT i * 8 + 5, false, regexp_replace(url, '^https?', 'HTTP'), start + 300000, NULL, tag, '5' FROM q WHERE i % 3 = 0
), parts AS (
  SELECT *, regexp_replace(trim(url), '#.*$', '') AS bare FROM r
), c AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*@)?([^/?]*)', 2)), ':(80|443)$', ''), '^www\.', '') AS host,
         regexp_replace(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*@)?([^/?]*)([^?]*)', 3), '/+$', '') AS path,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
           lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[a-z]+|gclid|fbclid|ref|sessionid)(=|$)'))), '&') AS tail
  FROM parts
), d AS (
  SELECT *, host || path || CASE WHEN tail <> '' THEN '?' || tail ELSE '' END AS canon FROM c
), revisit AS (SELECT * FROM d WHERE NOT is_full), answer AS (SELECT * FROM d WHERE is_full),
j AS (
  SELECT v.record_id, v.canon AS url, v.etag AS etag, v.n, a.record_id AS to_id, a.digest AS to_digest, a.etag AS to_etag, a.ts AS to_ts
  FROM revisit v LEFT JOIN answer a ON a.canon = v.canon AND (a.ts < v.ts OR a.ts = v.ts AND a.record_id < v.record_id)
  QUALIFY row_number() OVER (PARTITION BY v.record_id ORDER BY a.ts DESC NULLS LAST, a.record_id DESC) = 1
), s AS (
  SELECT *, CASE WHEN to_id IS NULL THEN 'no_earlier_response'
                 WHEN regexp_replace(etag, '^W/', '') <> to_etag THEN 'validator_mismatch' ELSE 'resolved' END AS status FROM j
)
SELECT record_id, url, status, CASE WHEN status = 'resolved' THEN to_id END AS refers_to, CASE WHEN status = 'resolved' THEN to_digest END AS digest,
       CASE WHEN status = 'resolved' THEN 'cache-control: max-age=' || (60 * n::INT) || chr(10) || 'content-type: text/html' || chr(10) || 'etag: ' || etag
            || chr(10) || 'last-modified: ' || strftime(to_timestamp(to_ts) AT TIME ZONE 'UTC', '%Y-%m-%d') || chr(10) || 'x-cache: HIT' END AS headers
FROM s
"""


@register("op5_warc_revisits", OP5_SQL)
def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every not-modified revisit of the pages' capture records, resolved."""
    found = warc.resolve(warc.records_of(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.withColumn("headers", F.array_join(lines, "\n"))


@register("op7_html_main_text")
def op7_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = html.main_text(pages, html.learn(pages))
    return text.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@register("op8_sampled_segmentations")
def op8_sampled_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every text, with inclusion scores and the
    result of decoding them."""
    rows = sampling.sample(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", "sample", F.size("ids").cast("bigint").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
        "log_prob", "perturbed", "inclusion", "log_inclusion", "round_trip",
    )


@register("op9_embedding_near_duplicates")
def op9_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of equally labelled vectors with cosine of 0.98 or more."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@register("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 1024 tokens."""
    pieces = packing.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


OP11_START = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64 AND len(embedding) = 64
), v AS MATERIALIZED (
  SELECT vec_id, q, generate_subscripts(q, 1) AS i, unnest(q) AS x FROM whole
), c0 AS MATERIALIZED (
  SELECT c, generate_subscripts(q, 1) AS i, unnest(q) AS y
  FROM (SELECT q, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c FROM whole QUALIFY c < 40)
)"""

OP11_NEAREST = """
, a{n} AS MATERIALIZED (
  SELECT vec_id, c, d FROM (SELECT vec_id, c, sum((x - y) * (x - y)) AS d FROM v JOIN c{n} USING (i) GROUP BY vec_id, c)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1
)"""

OP11_MOVE = """
, m{n} AS MATERIALIZED (
  SELECT c, i, sum(x) AS s, count(*) AS k FROM v JOIN a{p} USING (vec_id) GROUP BY c, i
), c{n} AS MATERIALIZED (
  SELECT c, i, CASE WHEN k IS NULL THEN y ELSE (s - ((s % k) + k) % k) // k END AS y FROM c{p} LEFT JOIN m{n} USING (c, i)
)"""

OP11_SQL = (
    OP11_START
    + "".join(OP11_NEAREST.format(n=n) + OP11_MOVE.format(n=n + 1, p=n) for n in range(5))
    + OP11_NEAREST.format(n=5)
    + """
, named AS (
  SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c5 GROUP BY c
)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a5 JOIN named USING (c)
"""
)


@register("op11_centroid_clusters", OP11_SQL)
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's nearest of 40 centroids after five rounds."""
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    listed = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(listed, 256).alias("centroid_sha256"))


OP12_SQL = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM line
), first AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1
), judged AS (
  SELECT doc_id, i, line, coalesce(doc_id > first, false) AS gone FROM keyed LEFT JOIN first USING (k)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@register("op12_line_dedup", OP12_SQL)
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds."""
    out = lines.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def repeated_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """Where crc32 of the id ends in 0, the words from one on repeat a stretch of themselves."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate((np.arange(a), a + np.arange(n - a) % p))


@register("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words per document, a tenth of the documents with a repeated tail."""
    out = runs.periodic_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), arrange=repeated_tail)
    more = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    nothing = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    best = F.aggregate("runs", nothing, lambda best, r: F.when(more(best, r), r).otherwise(best))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return out.select("doc_id", "collapsed", "runs", best.alias("best")).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over ``documents``."""
    return corpus_pipeline.run(spark, sf_dir)
