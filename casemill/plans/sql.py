"""The adapters as SQL text, for checking results side by side in another engine."""

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

STAGES = f"""
ev AS (SELECT *, {K} AS k FROM events),
stages AS (
  SELECT 'run-' || (user_id % 10) AS run_id, event_id AS ord, 'art-' || event_id AS artifact_id,
    CASE WHEN event_type <> 'signup' THEN 'cand-' || user_id END AS parent_artifact_id,
    CASE event_type WHEN 'click' THEN 'generate_candidate_sample' WHEN 'view' THEN 'validate_candidate_deterministically'
      WHEN 'purchase' THEN 'curate_committed_sample' WHEN 'signup' THEN 'quality_gate_candidate'
      ELSE 'rubric_gate_candidate' END AS role,
    CASE event_type WHEN 'click' THEN 'generation' WHEN 'purchase' THEN 'curation' ELSE 'validation' END AS stage_kind,
    CASE WHEN k % 4 = 0 THEN 'reject' ELSE 'accept' END AS verdict,
    CASE WHEN k % 4 <> 0 THEN 'accept' WHEN k % 3 = 0 THEN 'reject_schema' WHEN k % 3 = 1 THEN 'reject_leakage'
      ELSE 'reject_duplicate' END AS route_code,
    CASE WHEN k % 4 <> 0 THEN NULL WHEN k % 3 = 0 THEN 'schema_violation' WHEN k % 3 = 1 THEN 'shortcut_leakage'
      ELSE 'near_duplicate' END AS code,
    CASE WHEN k % 10 = 0 THEN 0 ELSE CAST(floor(value * 100) AS BIGINT) END AS latency_ms,
    CASE WHEN k % 10 = 0 THEN 'provider failed elapsed_ms=' || (k * 10) END AS error,
    k * 10 AS input_tokens, k AS output_tokens, event_id % 4 AS retry_index,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS wallclock_ts
  FROM ev),
timed AS (
  SELECT *, coalesce(nullif(latency_ms, 0), TRY_CAST(regexp_extract(error, 'elapsed_ms=(\\d+)', 1) AS BIGINT), 0) AS ms
  FROM stages)"""

CORPUS = """
corpus AS (
  SELECT 'run-' || (doc_id % 10) AS run_id, doc_id AS ord, lang, 1 + n_chars % 5 AS difficulty, source,
    lang || '|' || (1 + n_chars % 5) || '|' || source AS cell_key,
    CASE WHEN n_chars % 9 <> 0 THEN 'ability-' || (n_chars % 4) END AS ability,
    'env-' || (n_chars % 3) AS environment,
    CASE WHEN n_chars % 2 = 0 THEN 'rubric' ELSE 'deterministic_execution' END AS score_type,
    [lang, CASE WHEN n_chars % 3 = 0 THEN lang ELSE source END] AS tags,
    n_chars % 5 AS risks, n_chars % 6 AS limits
  FROM documents)"""

VERDICTS = """
verdicts AS (
  SELECT doc_id, 'run-' || (doc_id % 10) AS run_id, 'cand-' || doc_id AS candidate_id, kind AS check_kind,
    CASE WHEN ok THEN 'accept' ELSE 'reject' END AS verdict,
    CASE WHEN ok THEN 'accept' WHEN doc_id % 5 = 0 THEN 'retry_infra' ELSE 'reject_semantic_mismatch' END AS route_code,
    CASE WHEN ok THEN CAST([] AS VARCHAR[]) ELSE [code, 'ambiguous_success_criteria'] END AS subcodes
  FROM (SELECT doc_id, 'quality' AS kind, quality = 1 AS ok, 'weak_diagnostic_pressure' AS code FROM labels
        UNION ALL SELECT doc_id, 'rubric', toxic = 0, 'unreliable_score' FROM labels))"""

ORDER_LINES = """
links AS (SELECT DISTINCT 'S-' || l_suppkey AS entity_id, 'P-' || l_partkey AS product_id FROM lineitem),
order_lines AS (
  SELECT 'SO-' || o_orderkey AS id, c_name AS customer, 'P-' || l_partkey AS product_id,
    CAST(l_quantity AS BIGINT) AS quantity, CAST(floor(l_extendedprice) AS BIGINT) AS unit_revenue, o_orderstatus = 'O' AS is_open
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
stock AS (SELECT 'P-' || p_partkey AS product_id, sum(p_size) AS stock FROM part GROUP BY 1)"""

SCANS = """
facts AS (
  SELECT 'SO-' || o_orderkey AS case_id, o_orderkey % 8 AS style, o_orderstatus = 'F' AS zero FROM orders),
graded AS (
  SELECT *, style <> 5 AS valid, style = 2 OR (zero AND style <> 3) AS silent FROM facts),
n AS (SELECT *, CASE WHEN silent THEN 0 WHEN style = 3 THEN 2 ELSE 1 END AS alerts FROM graded)"""
