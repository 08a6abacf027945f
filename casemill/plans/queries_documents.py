"""Registered queries: whole-candidate validation, case sets, prompts, views and audits."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill import fixed, schemas
from casemill.operators import audit as U
from casemill.operators import checks as C
from casemill.operators import project as P
from casemill.operators import workspace as W
from casemill.plans import adapters as A
from casemill.plans.batch import BatchInputs, run_batch, run_batches, validate_candidates
from casemill.plans.queries_checks import _V3, _V5, _V5_ROUTE, _V6, _V7, DOMAIN
from casemill.sources import cases as K
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


CASE_SCHEMA = {
    "type": "object",
    "required": ["prompt"],
    "properties": {"prompt": {"type": "string", "minLength": 120}, "setup": {"type": "string", "pattern": "^src"}},
}
TEXT_DOMAIN = Domain(**{**DOMAIN.__dict__, "domain_id": "documents", "case_schema": CASE_SCHEMA})


@query(
    "validated_candidates",
    f"""SELECT candidate_id, CASE WHEN code IS NULL THEN 'accept' ELSE 'reject' END AS verdict, coalesce(code, '') AS subcodes FROM (
      SELECT 'cand-' || doc_id AS candidate_id, coalesce(CASE WHEN length(text) < 120 THEN 'schema_violation' END, {_V3}, {_V5}, {_V6}) AS code FROM documents)""",
)
def validated_candidates(spark, sf):
    """Every check of a text domain over every candidate: hygiene, case schema, taxonomy, contract, oracle."""
    files = spark.createDataFrame([], schemas.FILES)
    verdicts = C.deterministic_verdict(validate_candidates(A.candidates(spark, sf), files, TEXT_DOMAIN))
    return verdicts.select("candidate_id", "verdict", F.array_join("subcodes", ",").alias("subcodes"))


def _batch(spark, sf):
    """A batch over all documents in which reports, patches and gate verdicts are missing for some."""
    d = A.table(spark, sf, "documents")
    ident = F.concat(F.lit("cand-"), F.col("doc_id").cast("string")).alias("candidate_id")
    stated = A.choose(F.col("doc_id") % 5, {0: "nuke", 1: "revise"}, "pass")
    reports = d.where(F.col("doc_id") % 7 != 3).select(ident, stated.alias("revision_disposition"))
    prompt = F.concat(F.lit('{"setup":"src1 revised '), F.col("doc_id").cast("string"), F.lit('"}'))
    patches = d.where((F.col("doc_id") % 5 == 1) & (F.col("doc_id") % 2 == 0)).select(
        ident, prompt.alias("benchmark_case_updates"), F.lit("{}").alias("metadata_updates"),
        F.array().cast(schemas.PATCHES["environment_ops"].dataType).alias("environment_ops"), F.lit("why").alias("revision_rationale"),
    )
    gates = A.verdicts(spark, sf)
    gate = lambda kind: gates.where(F.col("check_kind") == kind).select("candidate_id", "check_kind", "verdict", "route_code", "subcodes")
    inputs = BatchInputs(
        "run-all", A.designs(spark, sf), A.candidates(spark, sf), spark.createDataFrame([], schemas.FILES), reports, gate("quality"), gate("rubric"),
        patches=patches, target_n=3,
    )
    return run_batch(inputs, TEXT_DOMAIN)


@query(
    "batch_outcomes",
    f"""WITH j AS (SELECT doc_id, text, sha256(text) AS hash, coalesce(CASE WHEN length(text) < 120 THEN 'schema_violation' END, {_V3}, {_V5}, {_V6}) AS code,
      {_V3.replace("WHEN source", "WHEN 1 + n_chars % 5 > 4 THEN 'unknown_difficulty' WHEN source")} AS bad FROM documents),
    k AS (SELECT hash, min(doc_id) FILTER (bad IS NULL) AS kept FROM j GROUP BY 1)
    SELECT 'cand-' || doc_id AS candidate_id, CAST(1 AS BIGINT) AS outcomes,
      CASE WHEN doc_id > kept OR bad IS NOT NULL THEN 'design_audit' WHEN code IS NOT NULL THEN 'validation' ELSE 'later' END AS stage
    FROM j JOIN k USING (hash)""",
)
def batch_outcomes(spark, sf):
    """Every candidate of a batch leaves exactly one row that ends it, and where."""
    ends = _batch(spark, sf).decisions.where(
        F.col("candidate_id").isNotNull() & ((F.col("verdict") != "accept") | (F.col("from_stage") == "curation"))
    )
    revised = F.endswith("candidate_id", F.lit("-rev"))
    stage = (
        F.when(F.col("from_stage") == "design_audit", "design_audit")
        .when((F.col("check_kind") == "deterministic") & ~revised, "validation")
        .otherwise("later")
    )
    return ends.groupBy(F.regexp_replace("candidate_id", "-rev$", "").alias("candidate_id")).agg(F.count("*").alias("outcomes"), F.min(stage).alias("stage"))


def _code(turn):
    """SQL: the first failing rule of a document's candidate in batch number ``turn``."""
    return f"""coalesce(CASE WHEN length(text) < 120 THEN 'schema_violation' END, {_V3}, {_V5}, {_V6})""".replace("n_chars", f"(n_chars + {turn})")


@query(
    "regenerated_batches",
    f"""WITH j AS (SELECT *, sha256(text) AS hash, {_V3.replace("WHEN source", "WHEN 1 + n_chars % 5 > 4 THEN 'unknown_difficulty' WHEN source")} AS bad
      FROM documents),
    k AS (SELECT hash, min(doc_id) FILTER (bad IS NULL) AS kept FROM j GROUP BY 1),
    t AS (SELECT j.*, r, 'cand-' || doc_id || CASE WHEN r > 0 THEN '-try' || r ELSE '' END AS cand, coalesce({_code("r")},
        CASE WHEN (doc_id + r) % 7 = 3 THEN 'provider_error' WHEN (doc_id + r) % 5 = 0 THEN 'adversary_nuke' END) AS code
      FROM j JOIN k USING (hash), range(3) AS turns(r) WHERE doc_id = kept),
    a AS (SELECT * FROM (SELECT *, coalesce(min(r) FILTER (code IS NULL) OVER (PARTITION BY doc_id), 2) AS last FROM t) WHERE r <= last)
    SELECT 'corpus' AS output, 'run-all-committed-' || cand AS id, 'design-' || doc_id AS detail, CAST(r AS BIGINT) AS n FROM a WHERE code IS NULL
    UNION ALL SELECT 'index', sha256('{{"candidate_id":"' || cand || '","run_id":"run-all"}}'), cand, 1 FROM a WHERE code IS NULL
    UNION ALL SELECT 'ledger', lang || '|' || (1 + n_chars % 5) || '|' || source, '', count(*) FROM a WHERE code IS NULL GROUP BY 2
    UNION ALL SELECT 'snapshots', cand, 'design-' || doc_id || ' ' || hash, r FROM a
    UNION ALL SELECT 'rejections', cand, code || CASE WHEN r = 2 THEN ' ends' ELSE '' END, r FROM a WHERE code IS NOT NULL
    UNION ALL SELECT 'rejections', unnest(['cand-' || doc_id, 'design-' || doc_id]),
      CASE WHEN doc_id > kept THEN 'duplicate_design' ELSE bad END || ' ends', 0 FROM j JOIN k USING (hash) WHERE doc_id IS DISTINCT FROM kept""",
)
def regenerated_batches(spark, sf):
    """Corpus, index, ledger, snapshots and rejections of a run whose rejected candidates are regenerated until they end."""
    domain = Domain(**{**TEXT_DOMAIN.__dict__, "novelty_threshold": 1e-9})
    designs = A.designs(spark, sf)
    verdict = lambda ids, kind: ids.select(
        "candidate_id", F.lit(kind).alias("check_kind"), F.lit("accept").alias("verdict"), F.lit("accept").alias("route_code"),
        F.array().cast("array<string>").alias("subcodes"),
    )

    def batch(turn):
        made = A.candidates(spark, sf, turn)
        made = made.withColumn("id", F.concat("id", F.lit(f"-try{turn}"))) if turn else made
        ids = made.select(F.col("id").alias("candidate_id"), (F.col("ord") + turn).alias("at"))
        reports = ids.where("at % 7 <> 3").select("candidate_id", F.when(F.col("at") % 5 == 0, "nuke").otherwise("pass").alias("revision_disposition"))
        return BatchInputs(
            "run-all", designs, made, spark.createDataFrame([], schemas.FILES), reports, verdict(ids, "quality"), verdict(ids, "rubric"), target_n=None,
        )

    out = run_batches(batch(0), domain, lambda _, turn: batch(turn))
    row = lambda df, output, id, detail, n: df.select(
        F.lit(output).alias("output"), id.alias("id"), detail.alias("detail"), n.cast("bigint").alias("n")
    )
    ends = F.when(F.col("terminal"), " ends").otherwise("")
    hashed = F.get_json_object("candidate", "$.content_hash")
    tables = [
        row(out.corpus, "corpus", F.col("committed_id"), F.col("design_id"), F.col("retry_index")),
        row(out.index_rows, "index", F.col("embedding_ref"), F.col("candidate_id"), F.lit(1)),
        row(out.coverage, "ledger", F.col("cell_key"), F.lit(""), F.col("n")),
        row(out.snapshots, "snapshots", F.col("candidate_id"), F.concat_ws(" ", "design_id", hashed), F.col("retry_index")),
        row(out.rejections, "rejections", F.coalesce("candidate_id", "design_id"), F.concat(F.array_join("subcodes", ","), ends), F.col("retry_index")),
    ]
    return reduce(DataFrame.unionByName, tables)


@query(
    "instruction_designs",
    """SELECT 'run-' || doc_id || '-instruction-design' AS id, 'en|3|src0' AS cell, text AS design_intent, text AS first_pressure,
      count(*) OVER (PARTITION BY text) AS same_hash FROM documents""",
)
def instruction_designs(spark, sf):
    """One design per document read as an instruction; equal instructions must hash alike."""
    d = A.texts(spark, sf).select(
        F.concat(F.lit("run-"), F.col("doc_id").cast("string")).alias("run_id"), F.col("text").alias("instruction"), F.col("doc_id").alias("ord")
    )
    made = P.designs_from_instructions(d, Domain(**{**DOMAIN.__dict__, "difficulties": [1, 2, 3, 4]}))
    same = made.groupBy("content_hash").agg(F.count("*").alias("same_hash"))
    cell = F.concat_ws("|", "cell.case_type", "cell.difficulty", "cell.scenario")
    return made.join(same, "content_hash").select(
        "id", cell.alias("cell"), "design_intent", F.get("diagnostic_pressure", F.lit(0)).alias("first_pressure"), "same_hash"
    )


def _cases(spark, sf):
    """Documents as curated cases with a public and a private half."""
    d = A.texts(spark, sf)
    alert = F.struct(F.concat(F.lit("A-"), F.col("doc_id").cast("string")).alias("id"))
    positive = F.col("doc_id") % 3 != 0
    alerts = F.when(positive, F.array(alert)).otherwise(F.array().cast("array<struct<id:string>>"))
    doc = F.struct(
        F.col("text").alias("prompt"),
        F.col("lang").alias("setup"),
        F.struct(F.col("source").alias("vendor"), F.array("lang").alias("edge_classes")).alias("inputs"),
        F.struct(F.lit("mail").alias("name"), F.array(F.lit("key.yaml")).alias("hidden_files")).alias("environment"),
        F.struct(F.struct(F.col("text").alias("thread"), F.struct(F.col("n_chars").alias("amount")).alias("order")).alias("public")).alias("workspace"),
        F.struct(alerts.alias("true_alerts"), (~positive).alias("zero_alert_run"), F.lit("no exposure").alias("note")).alias("hidden_evaluation"),
        F.struct(F.lit(1).alias("weight")).alias("grader_contract"),
    )
    ident = F.concat(F.lit("K-"), F.col("doc_id").cast("string"))
    return d.select(
        ident.alias("case_id"), (1 + F.col("n_chars") % 5).cast("int").alias("difficulty"), F.col("source").alias("scenario"), F.to_json(doc).alias("benchmark_case")
    )


@query(
    "public_tasks",
    """SELECT 'K-' || doc_id AS case_id, text AS prompt, lang AS setup, '{"vendor":"' || source || '"}' AS inputs, '{"name":"mail"}' AS environment FROM documents""",
)
def public_tasks(spark, sf):
    return K.public_rows(_cases(spark, sf)).drop("workspace")


@query(
    "hidden_oracles",
    """SELECT 'K-' || doc_id AS case_id, doc_id % 3 = 0 AS zero_alert_run, CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 1 END AS true_alerts,
      '{"weight":1}' AS grader_contract FROM documents""",
)
def hidden_oracles(spark, sf):
    o = K.hidden_oracles(_cases(spark, sf))
    v = F.parse_json("oracle")
    return o.select(
        "case_id", F.variant_get(v, "$.zero_alert_run", "boolean").alias("zero_alert_run"),
        F.size(F.variant_get(v, "$.true_alerts", "array<variant>")).alias("true_alerts"), "grader_contract",
    )


@query(
    "workspace_file_table",
    """SELECT 'K-' || doc_id AS case_id, 'inbox/thread.md' AS path, text || chr(10) AS content FROM documents
    UNION ALL SELECT 'K-' || doc_id, 'records/order.json', '{"amount":' || n_chars || '}' || chr(10) FROM documents""",
)
def workspace_file_table(spark, sf):
    layout = {"inbox/thread.md": "$.workspace.public.thread", "records/order.json": "$.workspace.public.order", "records/none.json": "$.workspace.none"}
    return K.workspace_files(_cases(spark, sf), layout)


@query(
    "corpus_shape",
    """SELECT 'K-' || doc_id AS scope, 'task rows and hidden oracles differ' AS failure FROM documents WHERE lang = 'es'
    UNION ALL SELECT 'K-' || doc_id, 'task rows contain duplicate ids' FROM documents WHERE lang = 'de'""",
)
def corpus_shape(spark, sf):
    """Task rows against oracles; the adapter loses the Spanish tasks and doubles the German ones."""
    d = A.table(spark, sf, "documents").select(F.concat(F.lit("K-"), F.col("doc_id").cast("string")).alias("case_id"), "lang")
    copies = F.when(F.col("lang") == "es", 0).when(F.col("lang") == "de", 2).otherwise(1)
    tasks = d.select("case_id", F.explode(F.array_repeat(F.lit(1), copies)).alias("one"))
    return U.audit_corpus(tasks, K.hidden_oracles(_cases(spark, sf)).select("case_id", "oracle"))


@query(
    "leaked_workspace_files",
    """WITH f AS (SELECT page_id, regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) || CASE page_id % 6 WHEN 0 THEN '/Hidden.md' WHEN 1 THEN '/oracle.json'
        WHEN 2 THEN '/evaluation/a.md' WHEN 3 THEN '/trial_input.json' ELSE '/a.md' END AS path FROM pages)
    SELECT 'ws-' || (page_id // 5) AS case_id, path FROM f WHERE NOT ends_with(path, '/a.md') OR contains('/' || path, '/evaluation/')""",
)
def leaked_workspace_files(spark, sf):
    p = A.table(spark, sf, "pages")
    tail = A.choose(F.col("page_id") % 6, {0: "/Hidden.md", 1: "/oracle.json", 2: "/evaluation/a.md", 3: "/trial_input.json"}, "/a.md")
    files = p.select(
        F.concat(F.lit("ws-"), F.floor(F.col("page_id") / 5).cast("string")).alias("case_id"),
        F.concat(F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1), tail).alias("path"),
    )
    return U.leaked_files(files)


@query(
    "evaluation_prompts",
    """WITH f AS (SELECT page_id // 5 AS ws, 'f' || (page_id % 5) || CASE page_id % 3 WHEN 0 THEN '.py' WHEN 1 THEN '.MD' ELSE '' END AS path, html,
        CASE page_id % 3 WHEN 0 THEN 'python' WHEN 1 THEN 'markdown' ELSE '' END AS lang FROM pages),
    s AS (SELECT ws, string_agg('--- ' || path || ' ---' || chr(10) || '```' || lang || chr(10) || regexp_replace(html, '\\s+$', '') || chr(10) || '```', chr(10) || chr(10) ORDER BY path) AS body FROM f GROUP BY ws)
    SELECT 'ws-' || ws AS candidate_id, 'SETUP' || chr(10) || 'small service' || chr(10) || chr(10) || 'COMMANDS' || chr(10) || '{' || chr(10) || '  "test": "pytest"' || chr(10) || '}'
      || chr(10) || chr(10) || 'REPOSITORY FILES' || chr(10) || chr(10) || body || chr(10) || chr(10) || 'BENCHMARK PROMPT' || chr(10) || 'repair it' AS prompt FROM s""",
)
def evaluation_prompts(spark, sf):
    p = A.table(spark, sf, "pages")
    ident = F.concat(F.lit("ws-"), F.floor(F.col("page_id") / 5).cast("string"))
    ending = A.choose(F.col("page_id") % 3, {0: ".py", 1: ".MD"}, "")
    files = p.select(ident.alias("candidate_id"), F.concat(F.lit("f"), (F.col("page_id") % 5).cast("string"), ending).alias("path"), F.col("html").alias("content"))
    agent = F.struct(
        F.lit('{"prompt":"repair it","setup":" small service "}').alias("benchmark_case"),
        F.lit(None).cast("string").alias("runtime_requirements"),
        F.struct(F.lit("executioner_workspace").alias("kind"), F.lit('{"commands":{"test":"pytest"}}').alias("payload")).alias("environment_artifact"),
    )
    corpus = files.select(F.col("candidate_id").alias("id")).distinct().withColumn("agent_artifact", agent)
    return W.eval_prompts(corpus, files)


@query(
    "role_views",
    """SELECT 'cand-' || doc_id AS id, least(4, n_chars % 4) AS pressure, least(4, n_chars % 5) AS risks, least(4, n_chars % 6) AS limits,
      CASE WHEN n_chars % 7 = 0 THEN 0 ELSE 1 END AS controls, text AS proxy_claim FROM documents""",
)
def role_views(spark, sf):
    """What the adversary sees of the private half: short lists and the proxy claim, never the fixes."""
    view = P.role_view(A.candidates(spark, sf), "adversary")
    judge = F.col("view.evaluator_private_context.judge_artifact")
    size = lambda c: F.size(judge[c]).cast("bigint")
    return view.select(
        "id", size("diagnostic_pressure").alias("pressure"), size("leakage_risks").alias("risks"), size("known_limits").alias("limits"),
        F.size(judge["negative_controls"]).alias("controls"), judge["proxy_claim"].alias("proxy_claim"),
    )


@query(
    "payload_candidates",
    """SELECT 'run-candidate-d' || doc_id || '-1' AS id, text AS prompt, lang || '|' || (1 + n_chars % 5) || '|' || source AS cell, 0 AS limits,
      count(*) OVER (PARTITION BY doc_id) AS copies FROM documents WHERE lang <> 'es'""",
)
def payload_candidates(spark, sf):
    """Candidates from generator payloads; the Spanish ones lack a judge artifact and yield none."""
    d = A.texts(spark, sf)
    ident = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    agent = F.struct(F.struct(F.col("text").alias("prompt"), F.lit(None).cast("string").alias("setup")).alias("benchmark_case"))
    judge = F.when(F.col("lang") != "es", F.struct(F.col("lang").alias("proxy_claim")))
    payload = F.to_json(F.struct(agent.alias("agent_artifact"), judge.alias("judge_artifact")), {"ignoreNullFields": "false"})
    payloads = d.select(
        ident.alias("design_id"), F.lit("e").alias("envelope_id"), F.lit(1).alias("attempt"), F.lit("Generator").alias("role_name"),
        F.col("doc_id").alias("ord"), payload.alias("payload"),
    )
    made = P.candidates_from_payload(payloads, d.select(ident.alias("id"), A.cell()), "run")
    case = F.parse_json("agent_artifact.benchmark_case")
    return made.select(
        "id", F.variant_get(case, "$.prompt", "string").alias("prompt"), F.concat_ws("|", "cell.case_type", "cell.difficulty", "cell.scenario").alias("cell"),
        F.size("judge_artifact.known_limits").alias("limits"), F.lit(1).cast("bigint").alias("copies"),
    )


OUTPUT_SCHEMA = {
    "type": "object",
    "required": ["agent_artifact", "judge_artifact"],
    "properties": {"ability_z": {"type": "object", "required": ["name"]}},
}
CODE_DOMAIN = Domain(
    **{
        **DOMAIN.__dict__,
        "output_schema": OUTPUT_SCHEMA,
        "case_schema": CASE_SCHEMA,
        "rules": {**DOMAIN.rules, "execute_workspace_tests": True},
    }
)


def _marker(column):
    return "CASE " + " ".join(f"WHEN contains({column}, '{text}') THEN '{code}'" for code, text in fixed.LEAK_MARKERS) + " END"


_EXECUTABLE = f"""p AS (SELECT page_id, CASE WHEN page_id % 17 = 0 THEN '../' ELSE '' END || regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS path,
      CASE WHEN page_id % 13 = 0 THEN '# TODO' ELSE html || CASE page_id % 30 WHEN 4 THEN ' Root cause: the cache'
        WHEN 11 THEN ' see Starter Code, the intended fix' WHEN 19 THEN ' BUG: off' ELSE '' END END AS content FROM pages),
    w AS (SELECT page_id, {_marker("lower(content)")} AS leak, CASE WHEN page_id % 6 = 0 THEN 'missing_workspace' WHEN trim(path) = '' THEN 'invalid_workspace_file'
        WHEN starts_with(path, '/') OR contains(path, '..') THEN 'invalid_workspace_path' WHEN trim(content) = '' THEN 'invalid_workspace_file'
        WHEN lower(trim(content)) = '# todo' OR regexp_matches(lower(content), 'implementation omitted|content omitted|placeholder file|todo: implement|replace with actual')
          THEN 'placeholder_workspace_file' END AS code FROM p),
    j AS (SELECT doc_id, n_chars, text, {_marker("lower(text)")} AS told, leak, {_V3} AS v3, {_V5} AS v5, {_V6} AS v6,
        coalesce({_V7}, CASE WHEN n_chars % 19 <> 0 AND doc_id % 41 = 0 THEN 'runtime_contract_mismatch' END) AS v7,
        CASE WHEN page_id IS NULL THEN 'missing_workspace' WHEN code IS NOT NULL THEN code
          WHEN n_chars % 23 = 0 OR n_chars % 19 = 0 OR n_chars % 4 = 0 OR doc_id % 4 = 1 THEN NULL
          WHEN doc_id % 9 = 0 THEN 'workspace_test_timeout' WHEN doc_id % 3 = 1 AND n_chars % 5 > 2 THEN 'workspace_test_command_failed'
          WHEN doc_id % 3 = 1 THEN NULL WHEN doc_id % 3 = 0 THEN 'workspace_tests_do_not_reproduce_failure'
          ELSE 'workspace_test_command_failed' END AS environment
      FROM documents LEFT JOIN w ON page_id = doc_id),
    k AS (SELECT doc_id, unnest(['text_hygiene', 'output_schema', 'benchmark_case_schema', 'environment_artifact', 'runtime_requirements', 'answer_leakage',
        'taxonomy_cell', 'benchmark_contract', 'benchmark_oracle']) AS check_id, unnest(range(9)) AS check_ord,
      unnest([CASE WHEN doc_id % 43 = 0 THEN 'malformed_text' END, CASE WHEN n_chars % 29 = 0 THEN 'schema_violation' END,
        CASE WHEN length(text) < 120 THEN 'schema_violation' END, environment, v7, coalesce(told, leak), v3, v5, v6]) AS code,
      unnest(['reject_schema', 'reject_schema', 'reject_schema', 'reject_schema', 'reject_schema', 'reject_leakage', 'reject_coverage_mismatch',
        {_V5_ROUTE}, 'reject_criteria_mismatch']) AS route FROM j)"""


@query(
    "executable_checks",
    f"""WITH {_EXECUTABLE} SELECT 'cand-' || doc_id AS candidate_id, CAST(check_ord AS INT) AS check_ord, check_id, code IS NULL AS passed,
      CASE WHEN code IS NULL THEN 'accept' ELSE route END AS route_code, coalesce(code, 'none') AS subcode FROM k""",
)
def executable_checks(spark, sf):
    """All nine checks of an executable domain: one row per candidate and check, with pages as files and recorded runs."""
    checks = validate_candidates(
        A.executable_candidates(spark, sf), A.executable_files(spark, sf), CODE_DOMAIN, A.executable_runs(spark, sf)
    )
    return checks.select("candidate_id", "check_ord", "check_id", "passed", "route_code", F.coalesce("subcode", F.lit("none")).alias("subcode"))


@query(
    "executable_verdicts",
    f"""WITH {_EXECUTABLE}, f AS (SELECT doc_id, arg_min(code, check_ord) FILTER (code IS NOT NULL) AS code, arg_min(route, check_ord) FILTER (code IS NOT NULL) AS route
      FROM k GROUP BY 1) SELECT 'cand-' || doc_id AS candidate_id, CASE WHEN code IS NULL THEN 'accept' ELSE 'reject' END AS verdict,
      coalesce(route, 'accept') AS route_code, coalesce(code, '') AS subcodes FROM f""",
)
def executable_verdicts(spark, sf):
    """The verdict on every executable candidate: the first failing one of its nine checks."""
    checks = validate_candidates(
        A.executable_candidates(spark, sf), A.executable_files(spark, sf), CODE_DOMAIN, A.executable_runs(spark, sf)
    )
    return C.deterministic_verdict(checks).select("candidate_id", "verdict", "route_code", F.array_join("subcodes", ",").alias("subcodes"))


PROMPT_SCHEMA = {"type": "object", "required": ["prompt"], "properties": {"prompt": {"type": "string"}}}
SCAN_SCHEMA = {"type": "object", "required": ["scan"], "properties": {"scan": {"type": "object"}}}


@query(
    "experiment_failures",
    f"""WITH c AS (SELECT c_custkey AS k, 'case-' || c_custkey AS scope FROM customer),
    e AS (SELECT l_orderkey AS trial, (l_linenumber + l_orderkey % 3) % 6 AS c, l_partkey % 3 AS x, l_partkey % 10 = 0 AS odd, l_suppkey % 20 = 0 AS grep
      FROM lineitem WHERE l_partkey % 13 <> 0),
    log AS (SELECT trial, count(*) FILTER ((c = 1 AND grep) OR (c IN (4, 5) AND odd)) AS v, count(DISTINCT c) FILTER (c < 3 AND NOT grep) AS steps,
      bool_or(c = 3 AND NOT grep) AS asked, bool_or(c = 3 AND NOT grep AND x = 0) AS x0, bool_or(c = 3 AND NOT grep AND x = 1) AS x1,
      bool_or(c = 3 AND NOT grep AND x = 2) AS x2 FROM e GROUP BY 1),
    t AS (SELECT o_orderkey AS n, 'case-' || o_custkey || CASE WHEN o_orderkey % 2 = 0 THEN ':baseline' ELSE ':evidence_first' END AS scope,
        o_orderkey % 2 = 0 AS base, o_orderstatus = 'F' AS passed, o_custkey % 4 = 0 AS zero, o_custkey % 3 AS x,
        CASE WHEN trial IS NOT NULL THEN v WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN 0 ELSE 1 END AS v, coalesce(steps, 0) AS steps,
        coalesce(asked, false) AS asked, coalesce(CASE o_custkey % 3 WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END, false) AS hit
      FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN log ON trial = o_orderkey)
    SELECT 'case_schema' AS section, scope, 'violates domain schema: : ''prompt'' is a required property' AS failure FROM c WHERE k % 8 = 3
    UNION ALL SELECT 'corpus', scope, 'task rows contain duplicate ids' FROM c WHERE k % 9 = 6
    UNION ALL SELECT 'corpus', scope, 'task rows and hidden oracles differ' FROM c WHERE k % 9 = 5
    UNION ALL SELECT 'workspace', scope, CASE k % 10 WHEN 1 THEN 'workspace missing'
      WHEN 2 THEN 'missing public workspace file {fixed.REQUIRED_WORKSPACE_FILES[0]}'
      WHEN 3 THEN 'hidden/evaluation file leaked into workspace evaluation/notes.md' WHEN 4 THEN 'headline pack has 2 items, expected 8-12'
      ELSE 'headline pack leaks internal ids SO-7731' END FROM c WHERE k % 10 BETWEEN 1 AND 5
    UNION ALL SELECT 'run', 'run', 'run has ' || a || ' trials, expected ' || b FROM (SELECT (SELECT count(*) FROM orders) AS a, (SELECT 2 * count(*) FROM c) AS b) WHERE a <> b
    UNION ALL SELECT 'trial', scope, 'agent runtime failed' FROM t WHERE n % 11 = 0 OR n % 13 = 0
    UNION ALL SELECT 'trial', scope, 'trace access violations: ' || v FROM t WHERE v > 0
    UNION ALL SELECT 'trial', scope, 'final response is not schema-valid' FROM t WHERE n % 17 = 0 OR n % 19 = 0
    UNION ALL SELECT 'trial', scope, 'trace does not use required workspace API/read/submit path' FROM t WHERE steps < 3
    UNION ALL SELECT 'trial', scope, 'evidence-first trace did not call calculate_exposure' FROM t WHERE NOT base AND NOT asked
    UNION ALL SELECT 'trial', scope, 'evidence-first exposure call did not target expected dependency E-' || x FROM t WHERE NOT base AND NOT zero AND NOT hit
    UNION ALL SELECT 'trial', scope, 'evidence-first did not pass hidden oracle' FROM t WHERE NOT base AND NOT passed
    UNION ALL SELECT 'trial', scope, 'baseline pass=' || passed || ' expected ' || zero FROM t WHERE base AND passed <> zero""",
)
def experiment_failures(spark, sf):
    """Every failure of an experiment whose cases are customers, trials orders and logs line items."""
    oracles = A.experiment_oracles(spark, sf)
    return U.verify_experiment(
        A.experiment_cases(spark, sf), A.experiment_tasks(spark, sf), oracles, A.experiment_files(spark, sf), PROMPT_SCHEMA,
        A.experiment_trials(spark, sf), A.experiment_events(spark, sf), oracles, SCAN_SCHEMA,
    )
