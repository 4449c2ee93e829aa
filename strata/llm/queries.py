"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import chat, lang_id, metric_join, mixing, packing, secret_crf, simhash, token_grammar, topk, url_filter, vector_code, warc, whitening
from strata.llm.common import table

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by weights 3, 1, 2 to 150 % of all words, at most twice each."""
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, cap=2)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules."""
    rules = spark.createDataFrame(URL_RULES, url_filter.RULES)
    return url_filter.judge(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest integer inner products of every fiftieth vector with all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document: counts and digest of the base kinds, and all spans."""
    found = secret_crf.secrets(table(spark, sf_dir, "documents"))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    n = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("secrets", lambda s: s["kind"] != "crf")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(said(base).cast("binary"), 256).alias("base_sha256"),
                        said(F.col("secrets")).alias("spans"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids."""
    return packing.packed_documents(table(spark, sf_dir, "documents"), length=1024)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back through the capture index."""
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those that are not held out."""
    return lang_id.languages(table(spark, sf_dir, "documents"))


def op8_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of vectors of one label with a cosine of at least 0.93."""
    return metric_join.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one with control strings in its texts, formatted and read back."""
    said = r"\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    return chat.read_back(chat.bundles(rows.unionByName(more)))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every document (4-word shingles) and its component at 4 bits or fewer."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, max_bits=4, seed=42)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors whitened on the first 16 components of their distinct integer vectors."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=16, scale=64, offset=1_000_000)


def op12_vector_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors: 16 parts, 64 entries, two rounds."""
    return vector_code.vector_codes(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)


def op13_token_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of all documents, written as grammars and read back."""
    return token_grammar.encoded_documents(table(spark, sf_dir, "documents"), name="word_bpe_49k.json", end=2)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages of ``corpus_pipeline`` over all documents."""
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_source_mix, op2_url_filter, op3_top_k, op4_secret_scan, op5_packing, op6_warc, op7_language_id, op8_metric_join,
    op9_chat_format, op10_simhash, op11_whitening, op12_vector_code, op13_token_grammar, pipeline)}

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op2_url_filter"] = r"""
WITH a AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
j AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' ELSE 'allow' END AS verdict FROM j
"""

ORACLE_SQL["op3_top_k"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLE_SQL["op6_warc"] = r"""
WITH h AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, lower(sha1(b)) AS s FROM h),
w AS (
  SELECT page_id, n, s, list_aggregate(list_transform(range(1, 41),
    lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (instr('0123456789abcdef', substr(s, i, 1)) - 1) + 1, 4)),
    'string_agg', '') AS bits FROM d),
e AS (
  SELECT page_id, n, s, list_aggregate(list_transform(range(0, 32),
    lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * CAST(substr(bits, 5 * k + 1, 1) AS INTEGER) + 8 * CAST(substr(bits, 5 * k + 2, 1) AS INTEGER)
      + 4 * CAST(substr(bits, 5 * k + 3, 1) AS INTEGER) + 2 * CAST(substr(bits, 5 * k + 4, 1) AS INTEGER) + CAST(substr(bits, 5 * k + 5, 1) AS INTEGER), 1)),
    'string_agg', '') AS digest, min(page_id) OVER (PARTITION BY s) AS first FROM w)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM e
"""

ORACLE_SQL["op8_metric_join"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT vec_id, label, x, sqrt(list_inner_product(x, x)) AS l FROM v),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.x, b.x) / (a.l * b.l) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a, min(b) AS comp FROM reach GROUP BY a),
k AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(k.n, 0) AS n_links, c.comp AS component_id, e.vec_id = c.comp AS kept
FROM embeddings e JOIN c ON e.vec_id = c.a LEFT JOIN k ON e.vec_id = k.a
"""

ORACLE_SQL["op9_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (
  SELECT *, length('### ') + length(regexp_replace(role, '(\\|### |</turn>|:)', '\\\1', 'g')) + 2
         + length(regexp_replace(text, '(\\|### |</turn>)', '\\\1', 'g')) + length('</turn>') + 1 AS n FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""

ORACLE_SQL["op12_vector_code"] = r"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT *, len(x) // 16 AS w, row_number() OVER (ORDER BY vec_id) AS n FROM v),
p AS (SELECT vec_id, label, n, k AS part, x[k * w + 1:(k + 1) * w] AS v FROM s, range(16) AS t(k)),
q AS (SELECT *, list_inner_product(v, v) AS l FROM p),
e0 AS (SELECT part, n - 1 AS entry, v, l FROM q WHERE n <= 64),
a0 AS (SELECT q.vec_id, q.part, any_value(q.v) AS v, arg_min(entry, (q.l - 2 * list_inner_product(q.v, e.v) + e.l, entry)) AS entry
       FROM q JOIN e0 e USING (part) GROUP BY q.vec_id, q.part),
m0 AS (SELECT part, entry, list(floor(t / n) ORDER BY i) AS v
       FROM (SELECT part, entry, i, sum(v[i]) AS t, count(*) AS n FROM a0, range(1, 1025) AS r(i) WHERE i <= len(v) GROUP BY part, entry, i) GROUP BY part, entry),
e1 AS (SELECT part, entry, coalesce(m0.v, e0.v) AS v, list_inner_product(coalesce(m0.v, e0.v), coalesce(m0.v, e0.v)) AS l FROM e0 LEFT JOIN m0 USING (part, entry)),
a1 AS (SELECT q.vec_id, q.part, any_value(q.v) AS v, arg_min(entry, (q.l - 2 * list_inner_product(q.v, e.v) + e.l, entry)) AS entry
       FROM q JOIN e1 e USING (part) GROUP BY q.vec_id, q.part),
m1 AS (SELECT part, entry, list(floor(t / n) ORDER BY i) AS v
       FROM (SELECT part, entry, i, sum(v[i]) AS t, count(*) AS n FROM a1, range(1, 1025) AS r(i) WHERE i <= len(v) GROUP BY part, entry, i) GROUP BY part, entry),
e2 AS (SELECT part, entry, coalesce(m1.v, e1.v) AS v, list_inner_product(coalesce(m1.v, e1.v), coalesce(m1.v, e1.v)) AS l FROM e1 LEFT JOIN m1 USING (part, entry)),
a2 AS (SELECT q.vec_id, any_value(q.label) AS label, q.part, min((q.l - 2 * list_inner_product(q.v, e.v) + e.l, entry)) AS best
       FROM q JOIN e2 e USING (part) GROUP BY q.vec_id, q.part),
c AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM a2 GROUP BY vec_id),
d AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, i)) AS codebooks_sha256
      FROM (SELECT part, entry, i, CAST(v[i] AS BIGINT) AS x FROM e2, range(1, 1025) AS r(i) WHERE i <= len(v)))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c, d
"""
