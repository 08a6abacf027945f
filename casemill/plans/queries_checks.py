"""Registered queries: validation rules, verdicts, leakage, gate hygiene."""

from pyspark.sql import functions as F

from casemill.functions import scalars as S
from casemill.functions import text as T
from casemill.functions.documents import json_nodes
from casemill.operators import audit as U
from casemill.operators import checks as C
from casemill.operators import leakage as L
from casemill.operators import workspace as W
from casemill.operators.document_schema import check_schema, compile_schema
from casemill.plans import adapters as A
from casemill.plans.sql import K, VERDICTS
from casemill.sources.domain import Domain

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


DOMAIN = Domain(
    domain_id="benchmark_code_debug",
    case_types=["en", "fr", "de"],
    difficulties=[1, 2, 3, 4],
    scenarios=[f"src{i}" for i in range(15)],
    rules={
        "require_negative_control": True,
        "require_benchmark_oracle": True,
        "require_runtime_requirements": True,
        "min_proxy_claim_chars": 80,
        "min_diagnostic_pressure_items": 2,
        "min_leakage_risk_items": 1,
        "min_known_limit_items": 1,
        "min_hidden_tests": 2,
        "min_shallow_fix_failures": 1,
        "max_initial_failure_files": 2,
        "require_initial_test_failure": True,
    },
)
TEXT_DOMAIN = Domain(**{**DOMAIN.__dict__, "domain_id": "documents"})

_SCENARIOS = ", ".join(f"'src{i}'" for i in range(15))


def _flat(checks):
    return checks.select(
        "candidate_id", "passed", "route_code", F.coalesce("subcode", F.lit("none")).alias("subcode"),
        F.coalesce(F.array_join(F.transform("evidence", lambda e: F.concat_ws("|", e["path"], e["value"])), ";"), F.lit("")).alias("note"),
    )


def _plain(checks):
    return _flat(checks).drop("note")


_V2 = "CASE WHEN n_chars % 31 = 0 THEN 'schema_violation' END"
_V3 = (
    "CASE WHEN lang NOT IN ('en', 'fr', 'de') THEN 'unknown_case_type' "
    f"WHEN source NOT IN ({_SCENARIOS}) THEN 'unknown_scenario' END"
)
_V5 = """CASE WHEN length(trim(text, E' \\t\\r\\n')) < 80 THEN 'weak_proxy_validity' WHEN n_chars % 4 < 2 THEN 'weak_diagnostic_pressure'
  WHEN n_chars % 5 < 1 THEN 'shortcut_leakage' WHEN n_chars % 6 < 1 THEN 'missing_known_limits'
  WHEN n_chars % 7 = 0 THEN 'missing_negative_control' WHEN n_chars % 11 = 0 THEN 'unreliable_score'
  WHEN n_chars % 13 = 0 THEN 'vague_scoring_contract' WHEN n_chars % 17 = 0 THEN 'vague_scoring_contract'
  WHEN n_chars % 29 = 0 THEN 'weak_proxy_validity' END"""
_V5_ROUTE = "CASE WHEN v5 = 'shortcut_leakage' THEN 'reject_leakage' WHEN v5 IS NOT NULL THEN 'reject_criteria_mismatch' END"
_V6 = "CASE WHEN n_chars % 37 = 0 OR n_chars % 3 = 0 OR n_chars % 4 < 2 OR n_chars % 5 < 1 THEN 'missing_oracle' END"
_V7 = """CASE WHEN n_chars % 23 = 0 THEN 'missing_runtime_requirements' WHEN n_chars % 19 = 0 THEN NULL
  WHEN n_chars % 4 = 0 THEN 'unsupported_runtime_requirements' WHEN n_chars % 5 = 0 THEN 'missing_runtime_requirements' END"""
RULES = f"""r AS (SELECT 'cand-' || doc_id AS candidate_id, {_V2} AS v2, {_V3} AS v3, {_V5} AS v5, {_V6} AS v6, {_V7} AS v7 FROM documents)"""


def _one(col, route):
    return (
        f"WITH {RULES} SELECT candidate_id, {col} IS NULL AS passed, "
        f"CASE WHEN {col} IS NULL THEN 'accept' ELSE {route} END AS route_code, coalesce({col}, 'none') AS subcode FROM r"
    )


@query("candidate_invariants", _one("v2", "'reject_schema'"))
def candidate_invariants(spark, sf):
    return _plain(C.check_invariants(A.candidates(spark, sf)))


@query("taxonomy_rules", _one("v3", "'reject_coverage_mismatch'"))
def taxonomy_rules(spark, sf):
    return _plain(C.check_taxonomy(A.candidates(spark, sf), DOMAIN))


@query("contract_rules", _one("v5", _V5_ROUTE))
def contract_rules(spark, sf):
    return _plain(C.check_contract(A.candidates(spark, sf), DOMAIN))


@query("oracle_rules", _one("v6", "'reject_criteria_mismatch'"))
def oracle_rules(spark, sf):
    return _plain(C.check_oracle(A.candidates(spark, sf), DOMAIN))


@query("runtime_rules", _one("v7", "'reject_schema'"))
def runtime_rules(spark, sf):
    return _plain(C.check_runtime(A.candidates(spark, sf), DOMAIN))


@query(
    "deterministic_verdicts",
    f"""WITH {RULES}, first AS (SELECT candidate_id, v5,
      CASE WHEN v7 IS NOT NULL THEN 7 WHEN v3 IS NOT NULL THEN 3 WHEN v5 IS NOT NULL THEN 5 WHEN v6 IS NOT NULL THEN 6 END AS step,
      coalesce(v7, v3, v5, v6) AS code FROM r)
    SELECT candidate_id, CASE WHEN step IS NULL THEN 'accept' ELSE 'reject' END AS verdict,
      CASE step WHEN 3 THEN 'reject_coverage_mismatch' WHEN 5 THEN {_V5_ROUTE}
        WHEN 6 THEN 'reject_criteria_mismatch' WHEN 7 THEN 'reject_schema' ELSE 'accept' END AS route_code,
      coalesce(code, '') AS subcodes FROM first""",
)
def deterministic_verdicts(spark, sf):
    """All row rules in the order that decides a verdict; the first failure is found inside the row."""
    rules = [C.runtime_outcome(DOMAIN), C.taxonomy_outcome(DOMAIN), C.contract_outcome(DOMAIN), C.oracle_outcome(DOMAIN)]
    verdicts = C.row_verdict(C.prepared(A.candidates(spark, sf)), *rules)
    return verdicts.select("candidate_id", "verdict", "route_code", F.array_join("subcodes", ",").alias("subcodes"))


@query(
    "test_commands",
    """SELECT 'cand-' || doc_id AS candidate_id, doc_id % 8 IN (0, 1, 4) AS passed,
      CASE WHEN doc_id % 8 IN (0, 1, 4) THEN 'accept' ELSE 'reject_schema' END AS route_code,
      CASE WHEN doc_id % 8 IN (0, 1, 4) THEN 'none' ELSE 'unsupported_workspace_test_command' END AS subcode FROM documents""",
)
def test_commands(spark, sf):
    command = A.choose(
        F.col("doc_id") % 8,
        {
            0: "pytest -q",
            1: "/usr/bin/python3 -m pytest tests",
            2: "pytest; rm x",
            3: "bash run.sh",
            4: "python -m pytest -k 'a b'",
            5: "pytest -k 'open",
            6: "python -m unittest",
        },
        "pytest $(id)",
    )
    d = A.table(spark, sf, "documents").select(F.concat(F.lit("cand-"), F.col("doc_id").cast("string")).alias("id"), command.alias("command"))
    return _plain(C.check_test_command(d, "command"))


@query(
    "text_hygiene",
    """SELECT 'doc-' || doc_id AS candidate_id, NOT bad AS passed, CASE WHEN bad THEN 'reject_schema' ELSE 'accept' END AS route_code,
      CASE WHEN bad THEN 'malformed_text' ELSE 'none' END AS subcode,
      CASE WHEN bad THEN 'document.parts[0]|U+200B ZERO WIDTH SPACE' ELSE '' END AS note
    FROM (SELECT doc_id, doc_id % 50 = 0 AS bad FROM documents)""",
)
def text_hygiene(spark, sf):
    """Whole documents as JSON; the adapter adds a zero-width space to some."""
    d = A.texts(spark, sf)
    body = F.concat(F.col("text"), F.when(F.col("doc_id") % 50 == 0, F.lit("​")).otherwise(F.lit("")))
    docs = d.select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("id"),
        F.to_json(F.struct("lang", F.array(body, F.col("source")).alias("parts"))).alias("body"),
    )
    return _flat(C.check_text_hygiene(docs, "body", root="document"))


@query(
    "text_repair",
    """SELECT doc_id, nfc_normalize(t || CASE WHEN doc_id % 3 = 0 THEN 'é' ELSE '' END) AS repaired,
      CAST((CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END)
        + (CASE WHEN nfc_normalize(t || CASE WHEN doc_id % 3 = 0 THEN 'é' ELSE '' END) <> t || CASE WHEN doc_id % 3 = 0 THEN 'é' ELSE '' END
           THEN 1 ELSE 0 END) AS INT) AS replacements
    FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN nfc_normalize(text) || 'e' || chr(769) ELSE text END AS t FROM documents)""",
)
def text_repair(spark, sf):
    """Whole texts; the adapter adds a decomposed accent to some and escaped bytes to others."""
    d = A.texts(spark, sf)
    accent = F.when(F.col("doc_id") % 2 == 0, F.lit("é")).otherwise(F.lit(""))
    escaped = F.when(F.col("doc_id") % 3 == 0, F.lit("\x00c3\x00a9")).otherwise(F.lit(""))
    fixed = d.select("doc_id", T.normalize_text(F.concat("text", accent, escaped)).alias("r"))
    return fixed.select("doc_id", F.col("r.text").alias("repaired"), F.col("r.n").alias("replacements"))


SCHEMA = {
    "type": "object",
    "additionalProperties": False,
    "required": ["lang", "text"],
    "properties": {
        "lang": {"type": "string", "enum": ["en", "fr", "de"]},
        "text": {"type": "string", "minLength": 40},
        "stats": {
            "type": "object",
            "required": ["n"],
            "properties": {"n": {"type": "integer", "minimum": 50, "maximum": 60000}},
        },
        "tags": {"type": "array", "maxItems": 2, "items": {"type": "string", "pattern": "^src1"}},
    },
}


@query(
    "schema_rules",
    """SELECT 'doc-' || doc_id AS candidate_id, bad IS NULL AS passed, CASE WHEN bad IS NULL THEN 'accept' ELSE 'reject_schema' END AS route_code,
      CASE WHEN bad IS NULL THEN 'none' ELSE 'schema_violation' END AS subcode, coalesce(bad, 'ok') AS path
    FROM (SELECT doc_id, CASE WHEN doc_id % 20 = 7 THEN 'root' WHEN lang = 'es' THEN 'lang'
        WHEN n_chars < 50 OR n_chars > 60000 THEN 'stats.n' WHEN source NOT LIKE 'src1%' THEN 'tags.0'
        WHEN length(text) < 40 THEN 'text' END AS bad FROM documents)""",
)
def schema_rules(spark, sf):
    d = A.texts(spark, sf)
    extra = F.when(F.col("doc_id") % 20 == 7, F.lit(1))
    docs = d.select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("id"),
        F.to_json(
            F.struct("lang", "text", F.struct(F.col("n_chars").alias("n")).alias("stats"), F.array("source").alias("tags"), extra.alias("extra"))
        ).alias("body"),
    )
    checks = check_schema(docs, "body", compile_schema(SCHEMA), "case_schema")
    path = F.when(F.col("passed"), F.lit("ok")).otherwise(F.coalesce(F.nullif(F.col("evidence")[0]["path"], F.lit("")), F.lit("root")))
    return checks.select(
        "candidate_id", "passed", "route_code", F.coalesce("subcode", F.lit("none")).alias("subcode"), path.alias("path")
    )


@query(
    "document_nodes",
    """SELECT doc_id, unnest([0, 1, 2, 3, 4, 5]) AS ord, unnest(['', 'lang', 'parts', 'parts.0', 'parts.1', 'stats.n']) AS path,
      unnest(['object', 'string', 'array', 'string', 'string', 'number']) AS kind,
      unnest(['', lang, '', text, source, CAST(n_chars AS VARCHAR)]) AS text FROM documents""",
)
def document_nodes(spark, sf):
    d = A.texts(spark, sf)
    docs = d.select(
        "doc_id",
        F.to_json(F.struct("lang", F.array("text", "source").alias("parts"), F.struct(F.col("n_chars").alias("n")).alias("stats"))).alias("body"),
    )
    nodes = json_nodes(docs, "body", "doc_id").where("path <> 'stats'")
    shifted = F.when(F.col("ord") > 5, F.col("ord") - 1).otherwise(F.col("ord"))
    return nodes.select("doc_id", shifted.alias("ord"), "path", "kind", F.coalesce("text", F.lit("")).alias("text"))


def _marked(spark, sf):
    """Document texts with a leak marker appended to some."""
    d = A.texts(spark, sf)
    note = A.choose(F.col("doc_id") % 30, {3: " Root cause: the cache", 11: " see Starter Code, the intended fix", 17: " BUG: off"}, "")
    key = F.struct(
        F.lit(0).alias("section"), F.lit(0).alias("ord"), F.lit("").alias("file"), F.lit(0).alias("part")
    )
    return d.select(
        F.concat(F.lit("cand-"), F.col("doc_id").cast("string")).alias("candidate_id"), key.alias("text_key"),
        F.lit("benchmark_case.prompt").alias("path"), F.concat("text", note).alias("text"),
    )


@query(
    "answer_leaks",
    """WITH t AS (SELECT doc_id, lower(text || CASE doc_id % 30 WHEN 3 THEN ' Root cause: the cache'
        WHEN 11 THEN ' see Starter Code, the intended fix' WHEN 17 THEN ' BUG: off' ELSE '' END) AS text FROM documents),
    m AS (SELECT doc_id, CASE WHEN contains(text, 'bug:') THEN 'answer_leak_explicit_bug_label'
        WHEN contains(text, 'root cause:') THEN 'answer_leak_root_cause_disclosure'
        WHEN contains(text, 'intended fix') THEN 'answer_leak_fix_instruction'
        WHEN contains(text, 'starter code') THEN 'answer_leak_scaffold_label' END AS code FROM t)
    SELECT 'cand-' || doc_id AS candidate_id, code IS NULL AS passed,
      CASE WHEN code IS NULL THEN 'accept' ELSE 'reject_leakage' END AS route_code, coalesce(code, 'none') AS subcode FROM m""",
)
def answer_leaks(spark, sf):
    return _plain(L.check_leakage(_marked(spark, sf)))


@query(
    "marker_leaks",
    """WITH h AS (SELECT d.doc_id, min(b.item_id) AS item FROM documents d JOIN benchmark b ON contains(lower(d.text), lower(b.text)) GROUP BY 1)
    SELECT 'cand-' || doc_id AS candidate_id, item IS NULL AS passed,
      CASE WHEN item IS NULL THEN 'accept' ELSE 'reject_leakage' END AS route_code, coalesce('item-' || item, 'none') AS subcode,
      CASE WHEN item IS NULL THEN 'none' ELSE 'benchmark_case.prompt' END AS path
    FROM documents LEFT JOIN h USING (doc_id)""",
)
def marker_leaks(spark, sf):
    """The first benchmark passage, taken as a table of markers, that each whole document holds."""
    markers = A.table(spark, sf, "benchmark").select(
        F.col("item_id").cast("int").alias("ord"), F.concat(F.lit("item-"), F.col("item_id").cast("string")).alias("subcode"), F.col("text").alias("pattern")
    )
    plain = _marked(spark, sf).withColumn("text", F.regexp_replace("text", "( Root cause: the cache| see Starter Code, the intended fix| BUG: off)$", ""))
    checks = L.check_leakage(plain, markers)
    return checks.select("candidate_id", "passed", "route_code", F.coalesce("subcode", F.lit("none")).alias("subcode"), F.coalesce(F.get("evidence", F.lit(0))["path"], F.lit("none")).alias("path"))


@query(
    "passage_leaks",
    "SELECT d.doc_id AS id, b.item_id AS passage_id FROM documents d JOIN benchmark b ON contains(lower(d.text), lower(b.text))",
)
def passage_leaks(spark, sf):
    """Every benchmark passage inside every whole document."""
    texts = A.texts(spark, sf).select(F.col("doc_id").alias("id"), "text")
    passages = A.table(spark, sf, "benchmark").select(F.col("item_id").alias("passage_id"), F.col("text").alias("passage"))
    return L.passage_hits(texts, passages)


@query(
    "design_partition",
    f"""WITH j AS (SELECT doc_id, sha256(text) AS hash, {_V3.replace("WHEN source", "WHEN 1 + n_chars % 5 > 4 THEN 'unknown_difficulty' WHEN source")} AS bad
      FROM documents),
    k AS (SELECT hash, min(doc_id) FILTER (bad IS NULL) AS kept FROM j GROUP BY 1)
    SELECT 'design-' || doc_id AS id,
      CASE WHEN doc_id > kept OR bad IS NOT NULL THEN 'reject' ELSE 'accept' END AS verdict,
      CASE WHEN doc_id > kept THEN 'reject_duplicate' WHEN bad IS NOT NULL THEN 'reject_coverage_mismatch' ELSE 'accept' END AS route_code,
      CASE WHEN doc_id > kept THEN 'duplicate_design' ELSE coalesce(bad, 'none') END AS subcode
    FROM j JOIN k USING (hash)""",
)
def design_partition(spark, sf):
    parted = C.partition_designs(A.designs(spark, sf), TEXT_DOMAIN)
    return parted.select("id", "verdict", "route_code", F.coalesce("subcode", F.lit("none")).alias("subcode"))


@query(
    "design_batch_verdict",
    f"""WITH j AS (SELECT doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS nth,
      {_V3.replace("WHEN source", "WHEN 1 + n_chars % 5 > 4 THEN 'unknown_difficulty' WHEN source")} AS bad FROM documents),
    f AS (SELECT CASE WHEN bad IS NOT NULL THEN bad ELSE 'duplicate_design' END AS code FROM j WHERE bad IS NOT NULL OR nth > 1
      ORDER BY doc_id LIMIT 1)
    SELECT 'reject' AS verdict, CASE WHEN code = 'duplicate_design' THEN 'reject_duplicate' ELSE 'reject_coverage_mismatch' END AS route_code,
      code AS subcode FROM f""",
)
def design_batch_verdict(spark, sf):
    return C.check_designs(A.designs(spark, sf), TEXT_DOMAIN)


@query(
    "design_depth",
    """SELECT 'design-' || doc_id AS id, code IS NULL AS passed, coalesce(code, 'none') AS subcode FROM (
      SELECT doc_id, CASE WHEN n_chars % 11 = 0 THEN 'missing_runtime_requirements'
        WHEN n_chars % 7 = 0 THEN 'unsupported_runtime_requirements' WHEN n_chars % 5 = 0 THEN 'missing_runtime_requirements'
        WHEN n_chars % 3 = 0 OR n_chars % 2 = 0 OR n_chars % 13 = 0 THEN 'weak_diagnostic_pressure' END AS code FROM documents)""",
)
def design_depth(spark, sf):
    d = A.table(spark, sf, "documents")
    n = F.col("n_chars")
    fields = ["product_context", "codebase_shape", "state_model", "core_invariant", "failure_surface", "tempting_wrong_fix", "actual_causal_region"]
    premise = F.to_json(
        F.struct(
            *[F.lit("stateful worker").alias(f) for f in fields],
            F.when(n % 2 == 0, F.lit("a One-Line patch")).otherwise(F.lit("two modules")).alias("required_depth"),
        )
    )
    short = F.to_json(F.struct(F.lit("x").alias("product_context")))
    mode = F.when(n % 7 == 0, F.lit("task_image/container")).otherwise(F.lit("container"))
    test = F.when(n % 5 == 0, F.lit("")).otherwise(F.lit("pytest"))
    runtime = F.to_json(
        F.struct(
            F.lit("filesystem_task").alias("kind"),
            F.struct(mode.alias("mode"), F.lit("python:3.11-slim").alias("base_image")).alias("execution"),
            F.struct(test.alias("test")).alias("commands"),
        )
    )
    lists = ["diagnostic_pressure", "why_weak_agents_fail", "tempting_shallow_solutions", "success_evidence_required", "minimum_depth_requirements", "forbidden_shortcuts"]
    rows = d.select(
        F.concat(F.lit("design-"), F.col("doc_id").cast("string")).alias("id"),
        F.when(n % 3 == 0, short).otherwise(premise).alias("environment_premise"),
        F.when(n % 11 != 0, runtime).alias("runtime_requirements"),
        *[F.array("lang").alias(c) for c in lists],
        F.array_repeat(F.col("lang"), F.when(n % 13 == 0, 0).otherwise(1)).alias("non_goals"),
    )
    return C.check_code_design(rows).select("id", "passed", F.coalesce("subcode", F.lit("none")).alias("subcode"))


@query(
    "gate_coercion",
    f"""WITH {VERDICTS}, raw AS (SELECT candidate_id, check_kind, doc_id,
      CASE WHEN doc_id % 6 = 0 THEN 'accept' WHEN doc_id % 6 = 1 THEN 'unsure' ELSE verdict END AS said,
      CASE WHEN doc_id % 7 = 0 THEN 'reject_leakage' WHEN doc_id % 7 = 1 THEN 'other' ELSE route_code END AS said_route,
      CASE WHEN doc_id % 4 = 0 THEN list_append(subcodes, 'answer_leak_fix_instruction') ELSE subcodes END AS codes,
      doc_id % 8 = 0 AS grounded FROM verdicts),
    s AS (SELECT *, CASE WHEN grounded THEN codes ELSE list_filter(codes, lambda c: NOT starts_with(c, 'answer_leak_')) END AS kept,
      CASE WHEN said IN ('accept', 'reject') THEN said ELSE 'reject' END AS v FROM raw),
    q AS (SELECT *, list_contains(kept, 'answer_leak_fix_instruction') AS leak,
      list_has_any(kept, ['answer_leak_fix_instruction', 'weak_diagnostic_pressure', 'unreliable_score', 'ambiguous_success_criteria']) AS signal,
      CASE WHEN said_route = 'other' THEN CASE WHEN v = 'accept' THEN 'accept' ELSE 'reject_semantic_mismatch' END ELSE said_route END AS known FROM s)
    SELECT candidate_id, check_kind, CASE WHEN v = 'accept' AND signal THEN 'reject' ELSE v END AS verdict,
      CASE WHEN v = 'accept' AND signal THEN CASE WHEN leak THEN 'reject_leakage' ELSE 'reject_semantic_mismatch' END
        WHEN known = 'reject_leakage' AND NOT leak THEN 'reject_semantic_mismatch' ELSE known END AS route_code,
      array_to_string(kept, ',') AS subcodes FROM q""",
)
def gate_coercion(spark, sf):
    v = A.verdicts(spark, sf).withColumn("doc_id", F.split_part("candidate_id", F.lit("-"), F.lit(2)).cast("bigint"))
    n = F.col("doc_id")
    leak = F.array(F.lit("answer_leak_fix_instruction"))
    where = F.when(n % 8 == 0, F.lit("agent_artifact.benchmark_case.prompt")).otherwise(F.lit("evaluator_private_context.judge_artifact"))
    raw = v.select(
        "candidate_id", "check_kind",
        F.when(n % 6 == 0, F.lit("accept")).when(n % 6 == 1, F.lit("unsure")).otherwise(F.col("verdict")).alias("verdict"),
        F.when(n % 7 == 0, F.lit("reject_leakage")).when(n % 7 == 1, F.lit("other")).otherwise(F.col("route_code")).alias("route_code"),
        F.when(n % 4 == 0, F.concat("subcodes", leak)).otherwise(F.col("subcodes")).alias("subcodes"),
        F.array(F.struct(F.lit("reviewer").alias("source"), where.alias("path"), F.lit("span").alias("value"))).alias("evidence"),
    )
    out = C.coerce_gate_verdicts(C.sanitize_leak_claims(raw))
    return out.select("candidate_id", "check_kind", "verdict", "route_code", F.array_join("subcodes", ",").alias("subcodes"))


@query(
    "attack_relabelling",
    """WITH a AS (SELECT conv_id, turn, lower(text || CASE conv_id % 5 WHEN 0 THEN ' README.md' WHEN 1 THEN ' score_x README.md'
        WHEN 2 THEN ' the proxy' WHEN 3 THEN ' rubric' ELSE '' END) AS t FROM conversations)
    SELECT conv_id, turn, CASE WHEN turn % 2 = 1 THEN 'cheap_pass'
      WHEN list_has_any([true], [contains(t, 'readme'), contains(t, 'prompt'), contains(t, 'setup'), contains(t, 'comment'), contains(t, 'fixture'),
        contains(t, 'tests/'), contains(t, '.py'), contains(t, '.ts'), contains(t, '.js'), contains(t, '.java'), contains(t, '.go'), contains(t, '.rs'),
        contains(t, 'test name'), contains(t, 'visible output'), contains(t, 'visible test')]) AND NOT contains(t, 'score_x') THEN 'answer_leakage'
      WHEN contains(t, 'scoring') OR contains(t, 'score') OR contains(t, 'rubric') THEN 'scoring_ambiguity'
      WHEN contains(t, 'proxy') THEN 'proxy_overclaim' ELSE 'other' END AS attack_type FROM a""",
)
def attack_relabelling(spark, sf):
    c = A.table(spark, sf, "conversations")
    note = A.choose(F.col("conv_id") % 5, {0: " README.md", 1: " score_x README.md", 2: " the proxy", 3: " rubric"}, "")
    attack = F.struct(
        F.lit("case").alias("attack_target"),
        F.when(F.col("turn") % 2 == 1, F.lit("cheap_pass")).otherwise(F.lit("Answer_Leakage ")).alias("attack_type"),
        F.lit("").alias("exploit_path"), F.concat("text", note).alias("evidence"), F.lit("high").alias("severity"),
        F.lit("").alias("why_it_invalidates_proxy"),
    )
    out = C.sanitize_attacks(c.select("conv_id", "turn", F.array(attack).alias("attacks")))
    kind = F.lower(F.trim(F.col("attacks")[0]["attack_type"]))
    return out.select("conv_id", "turn", kind.alias("attack_type"))


@query(
    "workspace_structure",
    """WITH f AS (SELECT page_id // 5 AS ws, page_id % 5 AS ord, CASE WHEN page_id % 17 = 0 THEN '../' ELSE '' END
        || regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS path, CASE WHEN page_id % 13 = 0 THEN '# TODO' ELSE html END AS content FROM pages),
    p AS (SELECT *, min(ord) OVER (PARTITION BY ws, path) AS first_ord, count(*) OVER (PARTITION BY ws) AS n FROM f),
    j AS (SELECT ws, ord, n, CASE WHEN trim(path) = '' THEN 'invalid_workspace_file' WHEN starts_with(path, '/') OR contains(path, '..') THEN 'invalid_workspace_path'
        WHEN ord > first_ord THEN 'duplicate_workspace_path' WHEN trim(content) = '' THEN 'invalid_workspace_file'
        WHEN lower(trim(content)) = '# todo' OR regexp_matches(lower(content), 'implementation omitted|content omitted|placeholder file|todo: implement|replace with actual')
          THEN 'placeholder_workspace_file' END AS code FROM p),
    b AS (SELECT ws, any_value(n) AS n, arg_min(code, ord) FILTER (code IS NOT NULL) AS code FROM j GROUP BY ws),
    v AS (SELECT ws, CASE WHEN n < 3 THEN 'missing_workspace' ELSE code END AS code FROM b)
    SELECT 'ws-' || ws AS candidate_id, code IS NULL AS passed, CASE WHEN code IS NULL THEN 'accept' ELSE 'reject_schema' END AS route_code,
      coalesce(code, 'none') AS subcode FROM v""",
)
def workspace_structure(spark, sf):
    files = A.files(spark, sf)
    ids = files.select(F.col("candidate_id").alias("id")).distinct()
    return _plain(W.check_workspace(ids, files))


@query(
    "recorded_runs",
    f"""SELECT 'cand-' || event_id AS candidate_id, code IS NULL AS passed, CASE WHEN code IS NULL THEN 'accept' ELSE 'reject_schema' END AS route_code,
      coalesce(code, 'none') AS subcode FROM (
        SELECT event_id, CASE WHEN k % 9 = 0 THEN 'workspace_test_timeout' WHEN k % 3 = 1 AND k % 5 > 2 THEN 'workspace_test_command_failed'
          WHEN k % 3 = 1 THEN NULL WHEN k % 3 = 0 THEN 'workspace_tests_do_not_reproduce_failure' ELSE 'workspace_test_command_failed' END AS code
        FROM (SELECT *, {K} AS k FROM events))""",
)
def recorded_runs(spark, sf):
    e = A.table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    lines = F.transform(
        F.slice(F.sequence(F.lit(1), F.lit(5)), 1, (F.col("k") % 5).cast("int")),
        lambda i: F.concat(F.lit("FAILED tests/test_"), i.cast("string"), F.lit(".py::test_a - assert 1")),
    )
    results = e.select(
        F.concat(F.lit("cand-"), F.col("event_id").cast("string")).alias("candidate_id"),
        (F.col("k") % 3).cast("int").alias("returncode"),
        F.array_join(lines, "\n").alias("stdout"),
        F.lit("").alias("stderr"),
        (F.col("k") % 9 == 0).alias("timed_out"),
    )
    return _plain(C.check_exec_results(results, DOMAIN))


@query(
    "trace_violations",
    """WITH t AS (SELECT conv_id AS trial, turn + 1 AS line_no, turn, (conv_id + turn) % 5 AS c,
        CASE turn % 4 WHEN 1 THEN 'Read' WHEN 2 THEN 'Grep' ELSE 'Bash' END AS tool FROM conversations WHERE role <> 'user')
    SELECT trial, line_no, 'tool input references hidden/evaluation material' AS violation FROM t WHERE c = 4
    UNION ALL SELECT trial, line_no, tool || ' accessed public records/headlines outside risk_tools API' FROM t WHERE tool <> 'Bash' AND c IN (1, 3)
    UNION ALL SELECT trial, line_no, 'Bash command accessed public records/headlines outside risk_tools API' FROM t WHERE tool = 'Bash' AND c = 1""",
)
def trace_violations(spark, sf):
    return U.trace_violations(A.trace_events(spark, sf))


@query(
    "tool_calls",
    """WITH t AS (SELECT conv_id AS trial, turn + 1 AS line_no, (conv_id + turn) % 5 AS c, text FROM conversations
        WHERE role <> 'user' AND turn % 4 IN (0, 3))
    SELECT trial, line_no, CASE c WHEN 0 THEN 'read_headline_pack' WHEN 2 THEN 'calculate_exposure' ELSE 'read_record' END AS command_name,
      left(text, 1200) AS output FROM t WHERE c IN (0, 2, 3)""",
)
def tool_calls(spark, sf):
    return U.tool_calls(A.trace_events(spark, sf)).drop("command")


@query(
    "record_search",
    """SELECT page_id, url AS path, replace(substr(html, greatest(0, i - 80) + 1, i + 160 - greatest(0, i - 80)), chr(10), ' ') AS excerpt
    FROM (SELECT *, strpos(lower(html), 'href') - 1 AS i FROM pages WHERE contains(lower(html), 'href'))""",
)
def record_search(spark, sf):
    p = A.table(spark, sf, "pages").select("page_id", F.col("url").alias("path"), F.col("html").alias("content"))
    return W.search_records(p, "HREF", "page_id")


@query(
    "provider_errors",
    """SELECT doc_id, CASE WHEN regexp_matches(m, 'invalid JSON|structured output|revision patch|environment_ops') THEN 'retry_parse'
      WHEN contains(lower(m), 'empty') THEN 'retry_provider_empty' ELSE 'retry_infra' END AS route
    FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'invalid JSON near ' WHEN 1 THEN 'Empty reply ' WHEN 2 THEN 'bad revision patch ' ELSE '' END || text AS m FROM documents)""",
)
def provider_errors(spark, sf):
    d = A.texts(spark, sf)
    lead = A.choose(F.col("doc_id") % 4, {0: "invalid JSON near ", 1: "Empty reply ", 2: "bad revision patch "}, "")
    return d.select("doc_id", S.error_route(F.concat(lead, F.col("text"))).alias("route"))


@query(
    "fenced_answers",
    """SELECT doc_id, doc_id % 5 = 4 AS failed, CASE WHEN doc_id % 5 = 4 THEN '' ELSE source END AS source FROM documents""",
)
def fenced_answers(spark, sf):
    d = A.texts(spark, sf)
    body = F.to_json(F.struct("source", "text"))
    fenced = (
        F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(F.col("doc_id") % 5 == 1, F.concat(F.lit("  ```\n"), body, F.lit("\n```  \n")))
        .when(F.col("doc_id") % 5 == 4, F.concat(F.lit("```json\n{"), F.col("source")))
        .otherwise(body)
    )
    parsed = d.select("doc_id", S.parse_fenced_json(fenced).alias("p"))
    return parsed.select(
        "doc_id", F.col("p.parsing_error").isNotNull().alias("failed"),
        F.coalesce(F.try_variant_get("p.parsed", "$.source", "string"), F.lit("")).alias("source"),
    )
