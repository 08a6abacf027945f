"""The registered queries of this subpackage and the SQL that some are checked with."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm import (
    bpe,
    divergence,
    exact_dedup,
    filter_audit,
    html_crf,
    mixing,
    quality,
    secret_scan,
    simhash,
    suffix_dedup,
    token_counts,
    topk,
    url_filter,
)
from casemill.llm.common import table

RANKS, MERGES = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
#: Fixed values: (action, host, path prefix) of the rules for pages.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of the documents, learned from the labels that are not held out."""
    return quality.scores(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best vectors by inner product for every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), 10)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of the documents; of equal texts the largest doc_id stays."""
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), keep="largest")
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of the bytes that 50-byte strings of earlier documents cover."""
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the pages' urls."""
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of the documents."""
    return simhash.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in the documents, base spans and linked parts."""
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(secret_scan.spans_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("spans")).alias("spans"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curriculum's share of every document, in training order."""
    mixed = mixing.curriculum(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixing.in_training_order(mixed).select("doc_id", "size", "source_size", "target", "taken")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of the pages."""
    out = html_crf.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def encoded(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) by the public 50k vocabulary."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    rank_map = bpe.RankMap(spark, ranks)
    out = bpe.encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN, rank_map=rank_map)
    out = bpe.decode(out, ranks, rank_map=rank_map)
    return out.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(bpe.ids_text("ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and their decoding."""
    return encoded(spark, table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of the documents by the public 50k vocabulary."""
    merges = token_counts.read_merges(public_tokenizers.path(MERGES))
    return token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), merges).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit"
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from every language, in all orders."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit.audit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term divergence between the sources of every language."""
    return divergence.source_divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_topk": op2_topk,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_secret_scan": op7_secret_scan,
    "op8_mixing": op8_mixing,
    "op9_html_extraction": op9_html_extraction,
    "op10_bpe": op10_bpe,
    "op11_token_counts": op11_token_counts,
    "op12_filter_audit": op12_filter_audit,
    "op13_source_divergence": op13_source_divergence,
}

ORACLES = {
    "op2_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op3_exact_dedup": """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size, sha256(t) AS text_sha256 FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM d JOIN g USING (t)""",
    "op8_mixing": """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS source_size FROM d GROUP BY source),
r AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, 3 * source_size AS cap FROM s),
o AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS k FROM r),
lv AS (
  SELECT k, cap / weight AS ratio,
    ((SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM o),
w AS (SELECT level FROM lv WHERE level <= ratio ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(cap, weight * (SELECT level FROM w)) AS target FROM r),
p AS (
  SELECT d.*, t.source_size, t.target,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (greatest(0, least(size, round(target)::BIGINT - start))
   + greatest(0, least(size, round(target)::BIGINT - start - source_size::BIGINT))
   + greatest(0, least(size, round(target)::BIGINT - start - 2 * source_size::BIGINT)))::BIGINT AS taken
FROM p""",
    "op12_filter_audit": """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM t),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (CASE WHEN len(words) < 100 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * strlen(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN least < w.doc_id THEN 'E' ELSE '' END) AS failed
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
c AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, failed),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (
  SELECT filter_order, step::INTEGER AS step, filter_order[step] AS letter, '[' || filter_order[1:step - 1] || '0]' AS before
  FROM o, range(1, 6) r(step)),
r AS (
  SELECT part, filter_order, step, letter, failed, n, good, toxic, contains(failed, letter) AS fails, regexp_matches(failed, before) AS gone
  FROM c, s),
a AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (failed = letter), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM r GROUP BY ALL)
SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM a""",
    "op13_source_divergence": """
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT lang, source, doc, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
tf AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT doc) AS docs FROM t GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM tf GROUP BY lang, term HAVING sum(docs) >= 30),
v AS (SELECT lang, count(*) AS terms, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
gt AS (SELECT lang, source, sum(tf.n) AS total FROM tf JOIN k USING (lang, term) GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(tf.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(tf.n, 0) + 5)) // (coalesce(gt.total, 0) + 5 * v.terms) AS p,
    1 + (1000000000::HUGEINT * (k.n + 5)) // (v.total + 5 * v.terms) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang)
  LEFT JOIN tf ON tf.lang = g.lang AND tf.source = g.source AND tf.term = k.term
  LEFT JOIN gt ON gt.lang = g.lang AND gt.source = g.source),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r)
SELECT * FROM o WHERE part = 'pair' OR rank <= 50""",
}
