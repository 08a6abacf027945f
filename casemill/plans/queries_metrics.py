"""Registered queries: distributions, performance, orderings, display."""

import uuid

from pyspark.sql import functions as F

from casemill.functions import scalars as S
from casemill.operators import metrics as M
from casemill.operators import route as R
from casemill.plans import adapters as A
from casemill.plans.sql import CORPUS, STAGES, VERDICTS
from casemill.session import ensure_checkpoint_dir
from casemill.sources.artifacts import append_artifact, scan_runs

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


@query(
    "role_performance",
    f"WITH {STAGES} SELECT role, count(*) AS n, CAST(sum(ms) AS BIGINT) AS total_ms, CAST(floor(median(ms)) AS BIGINT) AS median_ms, "
    "CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens FROM timed GROUP BY role",
)
def role_performance(spark, sf):
    return M.perf_by_role(A.stage_records(spark, sf))


@query("logged_role_performance", ORACLES["role_performance"])
def logged_role_performance(spark, sf):
    """The same report over stage records that were appended to a log and found there again."""
    root = f"{ensure_checkpoint_dir(spark)}/logs-{uuid.uuid4().hex}"
    append_artifact(A.stage_records(spark, sf), root, "stage_records")
    append_artifact(A.stage_events(spark, sf), root, "stage_events")
    records, _ = scan_runs(spark, root, all_runs=True)
    return M.perf_by_role(records)


@query(
    "request_body_sizes",
    f"WITH {STAGES}, b AS (SELECT coalesce(CASE WHEN k % 2 = 0 THEN 'generate_candidate_sample' END, "
    "CASE WHEN k % 3 = 0 THEN 'generation' END, 'model') AS label, length(props) * k AS bytes FROM ev WHERE event_type = 'click') "
    "SELECT label, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS total_bytes, CAST(floor(median(bytes)) AS BIGINT) AS median_bytes, "
    "max(bytes) AS max_bytes FROM b GROUP BY label",
)
def request_body_sizes(spark, sf):
    return M.request_sizes(A.stage_events(spark, sf))


@query(
    "rejection_waste",
    f"WITH {STAGES} SELECT role, route_code, code AS subcodes, count(*) AS n, CAST(sum(ms) AS BIGINT) AS total_ms FROM timed "
    "WHERE verdict = 'reject' GROUP BY ALL ORDER BY total_ms DESC, role, route_code, subcodes LIMIT 8",
)
def rejection_waste(spark, sf):
    return M.rejection_waste(A.stage_records(spark, sf)).withColumn("subcodes", F.array_join("subcodes", ","))


@query("route_counts", f"WITH {STAGES} SELECT role, route_code, count(*) AS n FROM stages GROUP BY ALL")
def route_counts(spark, sf):
    return M.route_counts(A.stage_records(spark, sf))


@query(
    "performance_totals",
    f"WITH {STAGES} SELECT count(DISTINCT run_id) AS runs, count(*) AS stage_records, CAST(sum(ms) AS BIGINT) AS total_ms, "
    "CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, "
    "count(*) FILTER (role = 'curate_committed_sample' AND verdict = 'accept') AS commits, "
    "count(*) FILTER (verdict = 'reject') AS rejects FROM timed",
)
def performance_totals(spark, sf):
    return M.perf_totals(A.stage_records(spark, sf))


@query(
    "tokens_by_role",
    f"WITH {STAGES} SELECT run_id, role, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, "
    "CAST(sum(output_tokens) AS BIGINT) AS output_tokens FROM stages GROUP BY ALL",
)
def tokens_by_role(spark, sf):
    return M.tokens_by_role(A.stage_records(spark, sf))


@query("route_distribution", f"WITH {STAGES} SELECT route_code AS key, count(*) AS n FROM stages GROUP BY ALL")
def route_distribution(spark, sf):
    return M.distribution(A.stage_records(spark, sf), "route_code")


@query("stage_distribution", f"WITH {STAGES} SELECT stage_kind AS key, count(*) AS n FROM stages GROUP BY ALL")
def stage_distribution(spark, sf):
    return M.distribution(A.stage_records(spark, sf), "stage_kind")


@query(
    "verdict_distribution",
    f"WITH {VERDICTS} SELECT check_kind || ':' || verdict AS key, count(*) AS n FROM verdicts GROUP BY ALL",
)
def verdict_distribution(spark, sf):
    return M.distribution(A.verdicts(spark, sf), F.concat_ws(":", "check_kind", "verdict"))


@query("ability_distribution", f"WITH {CORPUS} SELECT coalesce(ability, 'None') AS key, count(*) AS n FROM corpus GROUP BY ALL")
def ability_distribution(spark, sf):
    return M.distribution(A.corpus(spark, sf), "ability").fillna("None", ["key"])


@query(
    "scoring_distribution",
    f"WITH {CORPUS} SELECT lang || '/' || environment || '/' || score_type AS key, count(*) AS n FROM corpus GROUP BY ALL",
)
def scoring_distribution(spark, sf):
    return M.distribution(A.corpus(spark, sf), F.concat_ws("/", "cell.case_type", "environment", "score_type"))


@query("pressure_tags", f"WITH {CORPUS} SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM corpus) GROUP BY ALL")
def pressure_tags(spark, sf):
    return M.tag_distribution(A.corpus(spark, sf), "diagnostic_pressure")


@query("leakage_risk_sizes", f"WITH {CORPUS} SELECT CAST(risks AS INT) AS size, count(*) AS n FROM corpus GROUP BY ALL")
def leakage_risk_sizes(spark, sf):
    return M.size_distribution(A.corpus(spark, sf), "leakage_risks")


@query("known_limit_sizes", f"WITH {CORPUS} SELECT CAST(limits AS INT) AS size, count(*) AS n FROM corpus GROUP BY ALL")
def known_limit_sizes(spark, sf):
    return M.size_distribution(A.corpus(spark, sf), "known_limits")


_ENTROPY = (
    "c AS (SELECT cell_key, count(*) AS n FROM corpus GROUP BY 1), p AS (SELECT n / sum(n) OVER () AS p FROM c) "
)


@query("coverage_entropy", f"WITH {CORPUS}, {_ENTROPY} SELECT round(-sum(p * log2(p)), 6) AS coverage_entropy FROM p")
def coverage_entropy(spark, sf):
    return M.coverage_entropy(A.corpus(spark, sf)).select(F.round("coverage_entropy", 6).alias("coverage_entropy"))


_RATE = "coalesce(avg(CASE WHEN verdict = 'accept' THEN 1.0 ELSE 0.0 END) FILTER (check_kind = '{0}'), 0.0)"


@query(
    "pass_rates",
    f"WITH {VERDICTS} SELECT "
    + ", ".join(
        f"round(CAST({_RATE.format(k)} AS DOUBLE), 6) AS {k}_pass_rate" for k in ("deterministic", "quality", "rubric", "curation")
    )
    + " FROM verdicts",
)
def pass_rates(spark, sf):
    rates = M.pass_rates(A.verdicts(spark, sf))
    return rates.select(*[F.round(c, 6).alias(c) for c in rates.columns])


@query(
    "run_metrics",
    f"""WITH {STAGES}, {CORPUS}, {VERDICTS},
    rows AS (
      SELECT run_id, 'stage_count' AS metric, '' AS key FROM stages
      UNION ALL SELECT run_id, 'route_code_distribution', route_code FROM stages
      UNION ALL SELECT run_id, 'stage_distribution', stage_kind FROM stages
      UNION ALL SELECT run_id, 'validation_verdict_distribution', verdict FROM verdicts
      UNION ALL SELECT run_id, 'committed_count', '' FROM corpus
      UNION ALL SELECT run_id, 'coverage_cells', cell_key FROM corpus
      UNION ALL SELECT run_id, 'case_type_distribution', lang FROM corpus
      UNION ALL SELECT run_id, 'ability_distribution', coalesce(ability, 'None') FROM corpus
      UNION ALL SELECT run_id, 'environment_distribution', environment FROM corpus
      UNION ALL SELECT run_id, 'scoring_method_distribution', score_type FROM corpus
      UNION ALL SELECT run_id, 'leakage_risk_count_distribution', CAST(risks AS VARCHAR) FROM corpus
      UNION ALL SELECT run_id, 'known_limit_count_distribution', CAST(limits AS VARCHAR) FROM corpus
      UNION ALL SELECT run_id, 'diagnostic_pressure_distribution', unnest(tags) FROM corpus),
    rates AS (
      SELECT run_id, {_RATE.format('deterministic')} AS d, {_RATE.format('quality')} AS q, {_RATE.format('rubric')} AS r,
        {_RATE.format('curation')} AS c FROM verdicts GROUP BY run_id),
    cells AS (SELECT run_id, cell_key, count(*) AS n FROM corpus GROUP BY ALL),
    shares AS (SELECT run_id, n / sum(n) OVER (PARTITION BY run_id) AS p FROM cells)
    SELECT run_id, metric, key, round(CAST(count(*) AS DOUBLE), 6) AS value FROM rows GROUP BY ALL
    UNION ALL SELECT run_id, 'deterministic_pass_rate', '', round(CAST(d AS DOUBLE), 6) FROM rates
    UNION ALL SELECT run_id, 'quality_gate_pass_rate', '', round(CAST(q AS DOUBLE), 6) FROM rates
    UNION ALL SELECT run_id, 'rubric_gate_pass_rate', '', round(CAST(r AS DOUBLE), 6) FROM rates
    UNION ALL SELECT run_id, 'curator_accept_rate', '', round(CAST(c AS DOUBLE), 6) FROM rates
    UNION ALL SELECT run_id, 'coverage_entropy', '', round(-sum(p * log2(p)), 6) FROM shares GROUP BY run_id""",
)
def run_metrics(spark, sf):
    rows = M.run_metrics(A.stage_records(spark, sf), A.verdicts(spark, sf), A.corpus(spark, sf))
    return rows.withColumn("value", F.round("value", 6))


@query(
    "coverage_merge",
    f"WITH {CORPUS} SELECT cell_key, CAST(sum(n) AS BIGINT) AS n FROM (SELECT cell_key, 1 AS n FROM corpus "
    "UNION ALL SELECT lang || '|1|' || source, count(*) FROM documents GROUP BY 1) GROUP BY ALL",
)
def coverage_merge(spark, sf):
    ledger = A.table(spark, sf, "documents").groupBy(F.concat_ws("|", "lang", F.lit("1"), "source").alias("cell_key")).agg(
        F.count("*").alias("n")
    )
    return M.merge_coverage(ledger, A.corpus(spark, sf))


@query("slowest_stages", f"WITH {STAGES} SELECT ord, role, ms AS effective_ms FROM timed ORDER BY ms DESC, ord LIMIT 8")
def slowest_stages(spark, sf):
    return M.slowest(A.stage_records(spark, sf)).select("ord", "role", "effective_ms")


@query("recent_rejections", f"WITH {STAGES} SELECT ord, role, route_code FROM stages WHERE verdict = 'reject' ORDER BY ord DESC LIMIT 12")
def recent_rejections(spark, sf):
    return M.recent(A.stage_records(spark, sf).where(F.col("verdict") == "reject")).select("ord", "role", "route_code")


@query(
    "stage_timeline",
    f"WITH {STAGES} SELECT ord, replace(wallclock_ts, 'T', ' ') AS ts, stage_kind, role, verdict, route_code, "
    "retry_index + 1 AS attempt, coalesce(code, '') AS codes FROM stages",
)
def stage_timeline(spark, sf):
    return M.timeline(A.stage_records(spark, sf))


@query(
    "most_common_routes",
    f"WITH {STAGES} SELECT role || '->' || route_code AS key, count(*) AS n, min(ord) AS first_ord FROM stages GROUP BY ALL",
)
def most_common_routes(spark, sf):
    rows = A.stage_records(spark, sf).withColumn("step", F.concat("role", F.lit("->"), "route_code"))
    return M.most_common(rows, "step")


@query(
    "target_quota",
    f"WITH {STAGES} SELECT ord, artifact_id FROM stages WHERE role = 'curate_committed_sample' AND verdict = 'accept' ORDER BY ord LIMIT 25",
)
def target_quota(spark, sf):
    commits = A.stage_records(spark, sf).where((F.col("role") == "curate_committed_sample") & (F.col("verdict") == "accept"))
    return M.take_quota(commits, 25).select("ord", "artifact_id")


@query(
    "case_positions",
    f"WITH {CORPUS} SELECT run_id, ord, row_number() OVER (PARTITION BY run_id ORDER BY ord) AS position FROM corpus",
)
def case_positions(spark, sf):
    return M.ranked_within(A.corpus(spark, sf).select("run_id", "ord"), ["run_id"], "ord")


@query(
    "last_cases",
    f"WITH {CORPUS}, r AS (SELECT ord, cell_key, row_number() OVER (ORDER BY ord) - 1 AS row_index FROM corpus) "
    "SELECT * FROM r ORDER BY ord DESC LIMIT 20",
)
def last_cases(spark, sf):
    picked = M.select_cases(A.corpus(spark, sf), limit=20)
    return picked.select("ord", S.cell_key(F.col("cell")).alias("cell_key"), F.col("row_index").cast("bigint").alias("row_index"))


@query(
    "display_sizes",
    f"WITH {STAGES} SELECT ord, CASE WHEN ms >= 60000 THEN printf('%.1fm', ms / 60000.0::DOUBLE) WHEN ms >= 1000 THEN "
    "printf('%.1fs', ms / 1000.0::DOUBLE) ELSE ms || 'ms' END AS shown_ms, "
    "CASE WHEN b >= 1048576 THEN printf('%.1fMiB', b / 1048576.0::DOUBLE) WHEN b >= 1024 THEN printf('%.1fKiB', b / 1024.0::DOUBLE) "
    "ELSE b || 'B' END AS shown_bytes FROM (SELECT ord, ms, ms * 37 AS b FROM timed)",
)
def display_sizes(spark, sf):
    stages = A.stage_records(spark, sf)
    ms = S.effective_latency(F.col("latency_ms"), F.col("error"))
    return stages.select("ord", S.fmt_ms(ms).alias("shown_ms"), S.fmt_bytes(ms * 37).alias("shown_bytes"))


@query(
    "display_texts",
    "WITH t AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS flat, source || ':' || sha256(text) AS long_id FROM documents) "
    "SELECT doc_id, CASE WHEN length(flat) <= 220 THEN flat ELSE left(flat, 219) || '...' END AS clipped, "
    "CASE WHEN length(long_id) <= 48 THEN long_id ELSE left(long_id, 22) || '...' || right(long_id, 22) END AS short FROM t",
)
def display_texts(spark, sf):
    d = A.table(spark, sf, "documents")
    return d.select(
        "doc_id",
        S.clip(F.col("text"), 220).alias("clipped"),
        S.short_id(F.concat("source", F.lit(":"), F.sha2("text", 256))).alias("short"),
    )


@query("cell_keys", f"WITH {CORPUS} SELECT ord, cell_key FROM corpus")
def cell_keys(spark, sf):
    return A.corpus(spark, sf).select("ord", S.cell_key(F.col("cell")).alias("cell_key"))


@query(
    "content_hashes",
    "SELECT doc_id, sha256('{\"lang\":\"' || lang || '\",\"n_chars\":' || n_chars || ',\"source\":\"' || source || '\"}') AS hash FROM documents",
)
def content_hashes(spark, sf):
    d = A.table(spark, sf, "documents")
    return d.select("doc_id", S.stable_hash(source=F.col("source"), lang=F.col("lang"), n_chars=F.col("n_chars")).alias("hash"))


@query(
    "attempt_numbers",
    f"WITH {STAGES} SELECT ord, CASE WHEN ord % 3 = 0 THEN ord % 100 ELSE retry_index END AS attempt, "
    "CASE role WHEN 'generate_candidate_sample' THEN 'generation' WHEN 'validate_candidate_deterministically' THEN 'validation_det' "
    "WHEN 'quality_gate_candidate' THEN 'quality_gate' WHEN 'rubric_gate_candidate' THEN 'rubric_gate' ELSE 'curation' END AS label, "
    "stage_kind || ':' || artifact_id AS stage_id FROM stages",
)
def attempt_numbers(spark, sf):
    s = A.stage_records(spark, sf)
    ident = F.when(F.col("ord") % 3 == 0, F.concat(F.lit("run-c-"), (F.col("ord") % 100).cast("string"))).otherwise(F.lit("run-cx"))
    return s.select(
        "ord",
        S.attempt_number(ident, F.col("retry_index")).alias("attempt"),
        S.stage_label(F.col("role"), F.col("stage_kind")).alias("label"),
        S.stage_id(F.col("stage_kind"), F.col("artifact_id")).alias("stage_id"),
    )


def _decisions(spark, sf):
    s = A.stage_records(spark, sf)
    terminal = (F.col("verdict") == "reject") & ((F.col("stage_kind") == "curation") | (F.col("retry_index") >= 2))
    return s.select(
        F.concat(F.lit("run-"), F.col("parent_artifact_id")).alias("run_id"), "ord", F.col("stage_kind").alias("from_stage"),
        "verdict", "route_code", "subcodes", F.col("artifact_id").alias("candidate_id"), terminal.alias("terminal"),
    ).where(F.col("run_id").isNotNull())


@query(
    "run_outcomes",
    f"""WITH {STAGES}, d AS (SELECT 'run-' || parent_artifact_id AS run_id, ord, stage_kind, verdict, route_code, artifact_id, code,
      verdict = 'reject' AND (stage_kind = 'curation' OR retry_index >= 2) AS terminal FROM stages WHERE parent_artifact_id IS NOT NULL),
    t AS (SELECT run_id, count(*) FILTER (stage_kind = 'curation' AND verdict = 'accept') AS committed,
      count(*) FILTER (terminal) AS dropped, arg_max(artifact_id, ord) AS last_candidate, arg_max(route_code, ord) AS last_route,
      arg_max(coalesce(code, ''), ord) AS last_subcodes FROM d GROUP BY run_id)
    SELECT run_id, CASE WHEN committed > 0 THEN 'committed' WHEN dropped > 0 THEN 'dropped' ELSE 'incomplete' END AS final_status,
      committed, dropped, last_candidate, last_route, last_subcodes FROM t""",
)
def run_outcomes(spark, sf):
    return R.run_outcome(_decisions(spark, sf)).withColumn("last_subcodes", F.array_join("last_subcodes", ","))


_ROUTED = f"""WITH {STAGES}, r AS (SELECT ord, stage_kind, verdict, route_code, retry_index,
  CASE WHEN verdict = 'accept' THEN CASE stage_kind WHEN 'generation' THEN 'validation' WHEN 'validation' THEN 'curation' END
    WHEN stage_kind = 'validation' AND retry_index < 2 THEN 'generation' END AS next_stage,
  CASE WHEN verdict = 'accept' AND stage_kind <> 'curation' THEN 'criteria_only'
    WHEN verdict = 'reject' AND stage_kind = 'validation' AND retry_index < 2 THEN 'criteria_plus_route_code' ELSE 'fresh' END AS policy,
  CASE WHEN verdict = 'accept' THEN route_code WHEN stage_kind = 'curation' THEN 'reject_duplicate'
    WHEN stage_kind = 'validation' AND retry_index < 2 THEN route_code ELSE 'drop_retry_exhausted' END AS final_route FROM stages) """


@query(
    "routing_decisions",
    _ROUTED + "SELECT ord, coalesce(next_stage, 'end') AS next_stage, policy AS context_policy, next_stage IS NULL AS terminal, final_route FROM r",
)
def routing_decisions(spark, sf):
    routed = R.route(A.stage_records(spark, sf))
    return routed.select(
        "ord", F.coalesce("next_stage", F.lit("end")).alias("next_stage"), F.col("context_policy_out").alias("context_policy"),
        "terminal", "final_route",
    )


@query(
    "route_audit",
    _ROUTED
    + """, logged AS (SELECT *, CASE WHEN ord % 7 <> 0 THEN next_stage END AS said_next, ord % 7 = 0 OR next_stage IS NULL AS said_end,
      CASE WHEN ord % 7 = 0 THEN route_code ELSE final_route END AS said_route FROM r)
    SELECT ord, coalesce(next_stage, 'end') AS expected_next_stage, final_route AS expected_route FROM logged
    WHERE said_next IS DISTINCT FROM next_stage OR said_end <> (next_stage IS NULL) OR said_route <> final_route""",
)
def route_audit(spark, sf):
    """The whole log is replayed; its adapter wrote a plain end over some decisions, and those must surface."""
    routed = R.route(A.stage_records(spark, sf))
    spoiled = F.col("ord") % 7 == 0
    logged = routed.select(
        "ord", "stage_kind", "verdict", "route_code", "retry_index",
        F.when(~spoiled, F.col("next_stage")).alias("next_stage"),
        F.when(spoiled, F.lit(True)).otherwise(F.col("terminal")).alias("terminal"),
        F.when(spoiled, F.col("route_code")).otherwise(F.col("final_route")).alias("final_route"),
    )
    found = R.audit_routes(logged)
    return found.select("ord", F.coalesce("expected_next_stage", F.lit("end")).alias("expected_next_stage"), "expected_route")


@query(
    "adversary_routing",
    """SELECT 'cand-' || doc_id AS candidate_id,
      CASE doc_id % 4 WHEN 0 THEN 'gates' WHEN 2 THEN 'reject' ELSE 'revise' END AS action,
      CASE WHEN doc_id % 4 = 2 THEN CASE WHEN doc_id % 3 < 2 THEN 'reject_semantic_mismatch' ELSE 'drop_retry_exhausted' END ELSE 'none' END AS route_code,
      CASE WHEN doc_id % 4 = 2 THEN 'adversary_nuke' ELSE '' END AS subcodes,
      CASE WHEN doc_id % 4 = 2 THEN CASE WHEN doc_id % 3 < 2 THEN 'generation' ELSE 'none' END
        WHEN doc_id % 4 = 0 THEN 'none' ELSE 'validation' END AS next_stage,
      doc_id % 4 = 2 AND doc_id % 3 = 2 AS terminal FROM documents""",
)
def adversary_routing(spark, sf):
    d = A.table(spark, sf, "documents")
    ident = F.concat(F.lit("cand-"), F.col("doc_id").cast("string"))
    cands = d.select(ident.alias("id"), (F.col("doc_id") % 3).alias("retry_index"))
    says = A.choose(F.col("doc_id") % 4, {0: "Pass", 1: "revise", 2: "nuke"}, "unsure")
    out = R.route_adversary(cands, d.select(ident.alias("candidate_id"), says.alias("revision_disposition")))
    return out.withColumn("subcodes", F.array_join("subcodes", ",")).fillna("none", ["route_code", "next_stage"])
