"""Validation rules. Every rule yields rows of the long ``checks`` table (schemas.CHECK).

Rules that look at one row are column expressions, so any number of them run in one pass. Rules over
documents or file tables aggregate per candidate with partial aggregation first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill import fixed, schemas
from casemill.functions.documents import json_nodes
from casemill.functions.scalars import contains_any, field, is_json_array, is_json_object, truthy
from casemill.functions.text import DISALLOWED, char_name, first_disallowed, has_disallowed
from casemill.sources.domain import Domain

RULE = "deterministic_rule"

OUTCOME = "struct<check_id:string,passed:boolean,route_code:string,subcode:string,evidence:array<struct<source:string,path:string,value:string>>>"


def evidence(path: str | Column, value: str | Column, source: str = RULE) -> Column:
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(F.lit(source).alias("source"), as_col(path).alias("path"), as_col(value).alias("value"))


def failure(route: str, subcode: str | Column, *notes: Column) -> tuple[Column, Column, Column]:
    """What a check reports when a condition fails it: route, subcode and evidence."""
    sub = subcode if isinstance(subcode, Column) else F.lit(subcode)
    return F.lit(route), sub, (F.array_compact(F.array(*notes)) if notes else F.array()).cast(schemas.EVIDENCE)


def outcome(check_id: str, *failures: tuple[Column, tuple[Column, Column, Column]]) -> Column:
    """A check result: the first condition that holds fails the check, none passes it."""

    def result(passed: bool, route: Column, subcode: Column, notes: Column) -> Column:
        return F.struct(
            F.lit(check_id).alias("check_id"), F.lit(passed).alias("passed"), route.alias("route_code"),
            subcode.alias("subcode"), notes.alias("evidence"),
        ).cast(OUTCOME)

    out = result(True, F.lit("accept"), F.lit(None).cast("string"), F.array().cast(schemas.EVIDENCE))
    for condition, failed in reversed(failures):
        out = F.when(F.coalesce(condition, F.lit(False)), result(False, *failed)).otherwise(out)
    return out


def prepared(cands: DataFrame) -> DataFrame:
    """Candidates with their JSON columns parsed once, for the row rules to share."""
    agent = F.col("agent_artifact")
    return cands.select(
        "*",
        F.try_parse_json(agent["benchmark_case"]).alias("_case"),
        F.try_parse_json(agent["runtime_requirements"]).alias("_runtime"),
        F.try_parse_json(agent["environment_artifact"]["payload"]).alias("_payload"),
        F.try_parse_json("ability_z").alias("_ability"),
        F.try_parse_json("environment_y").alias("_environment"),
    )


def as_checks(df: DataFrame, *outcomes: Column, id_col: str = "id", first_ord: int = 0) -> DataFrame:
    """Outcome columns of a row as rows of the checks table, computed in one pass."""
    rows = df.select(F.col(id_col).alias("candidate_id"), F.posexplode(F.array(*outcomes)).alias("at", "check"))
    return rows.select("candidate_id", (F.col("at") + first_ord).cast("int").alias("check_ord"), "check.*")


def blank(col: Column) -> Column:
    return F.length(F.btrim(F.coalesce(col, F.lit("")), F.lit(" \t\r\n"))) == 0


def empty(arr: Column) -> Column:
    return F.coalesce(F.size(arr), F.lit(0)) <= 0


# ------------------------------------------------------------------ rules over one candidate row


def invariants_outcome() -> Column:
    bad = lambda why: failure("reject_schema", "schema_violation", evidence("candidate", why))
    return outcome(
        "candidate_invariants",
        (~F.col("difficulty").between(1, 5), bad("difficulty must be between 1 and 5")),
        (~F.col("cell.difficulty").between(1, 5), bad("cell difficulty must be between 1 and 5")),
        (~F.col("difficulty").eqNullSafe(F.col("cell.difficulty")), bad("difficulty must match taxonomy cell difficulty")),
        (~F.col("case_type").eqNullSafe(F.col("cell.case_type")), bad("case_type must match taxonomy cell case_type")),
    )


def _outside(col: Column, allowed: list) -> Column:
    return ~F.coalesce(col.isin(*allowed) if allowed else F.lit(False), F.lit(False))


def taxonomy_outcome(domain: Domain) -> Column:
    """Case type, then scenario. Difficulty is a design rule only."""
    return outcome(
        "taxonomy_cell",
        (_outside(F.col("cell.case_type"), domain.case_types), failure("reject_coverage_mismatch", "unknown_case_type")),
        (_outside(F.col("cell.scenario"), domain.scenarios), failure("reject_coverage_mismatch", "unknown_scenario")),
    )


def _named(parsed_col: str) -> Column:
    return truthy(field(F.col(parsed_col), "$.name"))


def contract_outcome(domain: Domain) -> Column:
    judge = lambda name: F.col(f"judge_artifact.{name}")

    def fail(subcode: str, why: str | Column) -> Column:
        route = "reject_leakage" if subcode == "shortcut_leakage" else "reject_criteria_mismatch"
        return failure(route, subcode, evidence("candidate", why))

    def too_few(name: str, rule: str, default: int) -> Column:
        return F.coalesce(F.size(judge(name)), F.lit(0)) < domain.minimum(rule, default)

    dimensions = F.coalesce(judge("score_x.dimensions"), F.array().cast(schemas.JUDGE["score_x"].dataType["dimensions"].dataType))
    vague = F.filter(
        dimensions,
        lambda d: (F.coalesce(d["high_score_criterion"], F.lit("")) == "")
        | (F.coalesce(d["low_score_criterion"], F.lit("")) == ""),
    )
    vague_name = F.coalesce(F.get(vague, F.lit(0))["name"], F.lit("?"))
    return outcome(
        "benchmark_contract",
        (
            F.length(F.btrim(F.coalesce(judge("proxy_claim"), F.lit("")), F.lit(" \t\r\n")))
            < domain.minimum("min_proxy_claim_chars", 1),
            fail("weak_proxy_validity", "proxy_claim is missing or too short"),
        ),
        (
            too_few("diagnostic_pressure", "min_diagnostic_pressure_items", 1),
            fail("weak_diagnostic_pressure", "diagnostic_pressure has too few items"),
        ),
        (too_few("leakage_risks", "min_leakage_risk_items", 0), fail("shortcut_leakage", "leakage_risks is missing")),
        (too_few("known_limits", "min_known_limit_items", 0), fail("missing_known_limits", "known_limits is missing")),
        (
            empty(judge("negative_controls")) if domain.required("require_negative_control") else F.lit(False),
            fail("missing_negative_control", "negative_controls is required"),
        ),
        (
            F.coalesce(judge("score_x.score_type"), F.lit("")) == "",
            fail("unreliable_score", "score_x.score_type is missing"),
        ),
        (empty(judge("score_x.dimensions")), fail("unreliable_score", "score_x.dimensions is missing")),
        (
            F.size(vague) > 0,
            fail(
                "vague_scoring_contract",
                F.concat(F.lit("dimension '"), vague_name, F.lit("' is missing high_score_criterion or low_score_criterion")),
            ),
        ),
        (
            empty(judge("scoring_contract.credit")) | empty(judge("scoring_contract.penalties")),
            fail("vague_scoring_contract", "scoring_contract needs credit and penalties"),
        ),
        (~_named("_ability"), fail("weak_proxy_validity", "ability_z.name is missing")),
        (~_named("_environment"), fail("irrelevant_environment", "environment_y.name is missing")),
    )


def oracle_outcome(domain: Domain) -> Column:
    oracle = field(F.col("_case"), "$.oracle")

    def short_list(name: str, rule: str) -> Column:
        listed = field(oracle, f"$.{name}")
        n = F.coalesce(F.size(F.try_variant_get(listed, "$", "array<variant>")), F.lit(0))
        return (listed.isNotNull() & ~is_json_array(listed)) | (F.greatest(n, F.lit(0)) < domain.minimum(rule, 1))

    fail = lambda why: failure("reject_criteria_mismatch", "missing_oracle", evidence("benchmark_case.oracle", why))
    if not domain.required("require_benchmark_oracle"):
        return outcome("benchmark_oracle")
    return outcome(
        "benchmark_oracle",
        (~is_json_object(oracle), fail("benchmark_case.oracle is required")),
        (
            ~truthy(field(oracle, "$.expected_repair_characteristics")),
            fail("oracle.expected_repair_characteristics is required"),
        ),
        (short_list("hidden_tests", "min_hidden_tests"), fail("oracle.hidden_tests has too few items")),
        (
            short_list("shallow_fix_failures", "min_shallow_fix_failures"),
            fail("oracle.shallow_fix_failures has too few items"),
        ),
    )


def _text_of(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _given(v: Column) -> Column:
    """Present and not JSON null."""
    return v.isNotNull() & ~F.coalesce(F.is_variant_null(v), F.lit(False))


def container_problem(runtime: Column) -> Column:
    """Why a runtime block cannot run in an approved container; null when it can."""
    execution, language = field(runtime, "$.execution"), field(runtime, "$.language")
    policy, packages = field(runtime, "$.dependencies.policy"), field(runtime, "$.dependencies.packages")
    network = field(runtime, "$.network")
    dependencies = is_json_object(field(runtime, "$.dependencies"))
    listed = F.try_variant_get(packages, "$", "array<string>")
    foreign = _given(packages) & (
        ~is_json_array(packages) | F.coalesce(F.exists(listed, lambda p: ~p.eqNullSafe(F.lit("pytest"))), F.lit(True))
    )
    return (
        F.when(
            ~is_json_object(runtime) | ~_text_of(runtime, "$.kind").eqNullSafe(F.lit("filesystem_task")),
            F.lit("executable workspaces must declare runtime_requirements.kind='filesystem_task'"),
        )
        .when(
            ~is_json_object(execution) | _outside(_text_of(execution, "$.mode"), fixed.EXECUTION_MODES),
            F.lit("filesystem_task execution.mode must be task_image or container"),
        )
        .when(
            _outside(_text_of(execution, "$.base_image"), fixed.APPROVED_IMAGES),
            F.lit(f"filesystem_task base_image must be one of {fixed.APPROVED_IMAGES}"),
        )
        .when(
            ~is_json_object(language) | ~F.lower(_text_of(language, "$.name")).eqNullSafe(F.lit("python")),
            F.lit("filesystem_task language.name must be python"),
        )
        .when(
            dependencies & _given(policy) & _outside(_text_of(policy, "$"), fixed.DEPENDENCY_POLICIES),
            F.lit("only dependency policy stdlib_plus_runner is supported for container validation"),
        )
        .when(dependencies & foreign, F.lit("only the pytest runner package is supported for container validation"))
        .when(
            _given(network) & ~_text_of(network, "$").eqNullSafe(F.lit(fixed.EVAL_NETWORK)),
            F.lit("only disabled_during_eval network policy is supported for container validation"),
        )
    )


def runtime_outcome(domain: Domain) -> Column:
    if not domain.required("require_runtime_requirements"):
        return outcome("runtime_requirements")
    runtime, payload = F.col("_runtime"), F.col("_payload")
    problem = container_problem(runtime)
    command = field(runtime, "$.commands.test")
    workspace_command = F.when(
        F.col("agent_artifact.environment_artifact.kind") == fixed.WORKSPACE_KIND, field(payload, "$.commands.test")
    )
    executes = _text_of(runtime, "$.kind").eqNullSafe(F.lit("filesystem_task"))

    def fail(subcode: str, path: str, why: str | Column) -> Column:
        return failure("reject_schema", subcode, evidence(f"agent_artifact.{path}", why))

    return outcome(
        "runtime_requirements",
        (
            ~is_json_object(runtime) | ~truthy(field(runtime, "$.kind")),
            fail(
                "missing_runtime_requirements",
                "runtime_requirements",
                "runtime_requirements.kind is required when a benchmark environment must execute",
            ),
        ),
        (executes & problem.isNotNull(), fail("unsupported_runtime_requirements", "runtime_requirements.execution", problem)),
        (
            executes & ((F.schema_of_variant(command) != "STRING") | command.isNull() | blank(_text_of(command, "$"))),
            fail(
                "missing_runtime_requirements",
                "runtime_requirements.commands.test",
                "filesystem_task runtime_requirements must declare the visible test command",
            ),
        ),
        (
            executes & _given(workspace_command) & (workspace_command.cast("string") != command.cast("string")),
            fail(
                "runtime_contract_mismatch",
                "environment_artifact.payload.commands.test",
                "workspace test command does not match runtime_requirements.commands.test",
            ),
        ),
    )


def safe_test_command(col: Column) -> Column:
    """A pytest command with no shell syntax. Quoted arguments are accepted when the quotes close."""
    balanced = col.rlike("""^(?:[^'"\\\\]|\\\\.|'[^']*'|"(?:[^"\\\\]|\\\\.)*")*$""")
    command = F.btrim(col, F.lit(" \t\r"))
    runner = command.rlike(r"^(?:[^\s'\"]*/)?pytest(?:\s|$)") | command.rlike(
        r"^(?:[^\s'\"]*/)?python3?\s+-m\s+pytest(?:\s|$)"
    )
    return F.coalesce(balanced & runner & ~contains_any(col, fixed.SHELL_TOKENS), F.lit(False))


def check_test_command(df: DataFrame, command_col: str, id_col: str = "id") -> DataFrame:
    unsafe = failure(
        "reject_schema",
        "unsupported_workspace_test_command",
        evidence(
            "environment_artifact.payload.commands.test",
            "workspace.commands.test must be a pytest command without shell syntax",
        ),
    )
    return as_checks(df, outcome("environment_artifact", (~safe_test_command(F.col(command_col)), unsafe)), id_col=id_col)


def check_invariants(df: DataFrame) -> DataFrame:
    return as_checks(df, invariants_outcome())


def check_taxonomy(df: DataFrame, domain: Domain) -> DataFrame:
    return as_checks(df, taxonomy_outcome(domain))


def check_contract(df: DataFrame, domain: Domain) -> DataFrame:
    return as_checks(prepared(df), contract_outcome(domain))


def check_oracle(df: DataFrame, domain: Domain) -> DataFrame:
    return as_checks(prepared(df), oracle_outcome(domain))


def check_runtime(df: DataFrame, domain: Domain) -> DataFrame:
    return as_checks(prepared(df), runtime_outcome(domain))


# ------------------------------------------------------------------ text hygiene


def candidate_document() -> Column:
    """A candidate row as one JSON document, keys in their declared order."""
    key = lambda name, body: F.concat(F.lit(f'"{name}":'), body)
    options = {"ignoreNullFields": "false"}
    raw = lambda c: F.coalesce(c, F.lit("null"))
    text = lambda c: F.coalesce(F.regexp_extract(F.to_json(F.struct(c.alias("v")), options), r"(?s)^\{\"v\":(.*)\}$", 1), F.lit("null"))
    agent = F.col("agent_artifact")
    artifact = F.concat(
        F.lit("{"), key("kind", text(agent["environment_artifact"]["kind"])), F.lit(","),
        key("payload", raw(agent["environment_artifact"]["payload"])), F.lit("}"),
    )

    def agent_json(keep_nulls: bool) -> Column:
        runtime = F.when(agent["runtime_requirements"].isNotNull(), key("runtime_requirements", agent["runtime_requirements"]))
        env = F.when(agent["environment_artifact"].isNotNull(), key("environment_artifact", artifact))
        if keep_nulls:
            runtime = F.coalesce(runtime, F.lit('"runtime_requirements":null'))
            env = F.coalesce(env, F.lit('"environment_artifact":null'))
        return F.concat(F.lit("{"), F.concat_ws(",", key("benchmark_case", raw(agent["benchmark_case"])), runtime, env), F.lit("}"))

    judge = F.to_json(F.col("judge_artifact"), options)
    tail = [key("ability_z", raw(F.col("ability_z"))), key("environment_y", raw(F.col("environment_y")))]
    output = F.concat(
        F.lit("{"), F.concat_ws(",", key("agent_artifact", agent_json(False)), key("judge_artifact", raw(judge)), *tail), F.lit("}")
    )
    return F.concat(
        F.lit("{"),
        F.concat_ws(
            ",",
            key("id", text(F.col("id"))),
            key("design_id", text(F.col("design_id"))),
            key("content_hash", text(F.col("content_hash"))),
            key("cell", raw(F.to_json("cell", options))),
            key("output", output),
            key("agent_artifact", agent_json(True)),
            key("judge_artifact", raw(judge)),
            *tail,
            key("difficulty", raw(F.col("difficulty").cast("string"))),
            key("case_type", text(F.col("case_type"))),
            key("provenance", raw(F.to_json("provenance", options))),
        ),
        F.lit("}"),
    )


def hygiene_hits(df: DataFrame, json_col: str, id_col: str, root: str) -> DataFrame:
    """(candidate_id, evidence): the first disallowed character of each document that has one.

    Only documents whose text holds such a character, or a JSON escape that could spell one (``\\uXXXX``,
    backspace, form feed), are walked.
    """
    body = F.col(json_col)
    suspect = df.where(has_disallowed(body) | body.rlike(r"\\[ubf]")).select(F.col(id_col).alias("candidate_id"), body.alias("body"))
    nodes = json_nodes(suspect, "body", "candidate_id")
    bad_key = F.nullif(first_disallowed(F.col("key")), F.lit(""))
    bad_value = F.nullif(first_disallowed(F.when(F.col("kind").isin("string", "invalid"), F.col("text"))), F.lit(""))
    found = nodes.select(
        "candidate_id", "ord", F.concat(F.lit(root), "index_path").alias("path"), F.coalesce(bad_key, bad_value).alias("char")
    ).where(F.col("char").isNotNull())
    first = found.groupBy("candidate_id").agg(F.min_by(F.struct("path", "char"), "ord").alias("hit"))
    return first.select(
        "candidate_id",
        F.array(
            F.struct(F.lit(RULE).alias("source"), F.col("hit.path").alias("path"), char_name(F.col("hit.char")).alias("value"))
        ).alias("evidence"),
    )


def check_text_hygiene(df: DataFrame, json_col: str | None = None, id_col: str = "id", root: str = "candidate") -> DataFrame:
    """Control and format characters anywhere in a document, keys included."""
    body = F.col(json_col) if json_col else candidate_document()
    docs = df.select(F.col(id_col).alias("candidate_id"), body.alias("body"))
    hits = hygiene_hits(docs, "body", "candidate_id", root).withColumnRenamed("evidence", "found")
    joined = docs.select("candidate_id").join(hits, "candidate_id", "left")
    bad = F.col("found").isNotNull()
    return joined.select(
        "candidate_id",
        F.lit(0).alias("check_ord"),
        F.lit("text_hygiene").alias("check_id"),
        (~bad).alias("passed"),
        F.when(bad, F.lit("reject_schema")).otherwise(F.lit("accept")).alias("route_code"),
        F.when(bad, F.lit("malformed_text")).alias("subcode"),
        F.coalesce("found", F.array().cast(schemas.EVIDENCE)).alias("evidence"),
    )


# ------------------------------------------------------------------ verdicts from checks


def deterministic_verdict(checks: DataFrame) -> DataFrame:
    """(candidate_id, verdict, route_code, subcodes, evidence): the first failing check decides."""
    result = F.struct("route_code", "subcode", "evidence")
    first = checks.groupBy("candidate_id").agg(
        F.min_by(F.when(~F.col("passed"), result), F.when(~F.col("passed"), F.col("check_ord"))).alias("first")
    )
    return first.select(
        "candidate_id",
        F.when(F.col("first").isNull(), F.lit("accept")).otherwise(F.lit("reject")).alias("verdict"),
        F.coalesce("first.route_code", F.lit("accept")).alias("route_code"),
        F.array_compact(F.array("first.subcode")).alias("subcodes"),
        F.coalesce("first.evidence", F.array().cast(schemas.EVIDENCE)).alias("evidence"),
    )


def row_verdict(df: DataFrame, *outcomes: Column, id_col: str = "id") -> DataFrame:
    """``deterministic_verdict`` of outcome columns in their order, decided inside the row: nothing is shuffled."""
    first = F.get(F.filter(F.array(*outcomes), lambda o: ~o["passed"]), F.lit(0))
    decided = df.select(F.col(id_col).alias("candidate_id"), first.alias("first"))
    return decided.select(
        "candidate_id",
        F.when(F.col("first").isNull(), F.lit("accept")).otherwise(F.lit("reject")).alias("verdict"),
        F.coalesce("first.route_code", F.lit("accept")).alias("route_code"),
        F.array_compact(F.array("first.subcode")).alias("subcodes"),
        F.coalesce("first.evidence", F.array().cast(schemas.EVIDENCE)).alias("evidence"),
    )


# ------------------------------------------------------------------ designs


def parsed_designs(df: DataFrame) -> DataFrame:
    """Designs with their premise and runtime blocks parsed once."""
    return df.select(
        "*",
        F.try_parse_json(F.coalesce("environment_premise", F.lit("{}"))).alias("_premise"),
        F.try_parse_json(F.coalesce("runtime_requirements", F.lit("{}"))).alias("_runtime"),
    )


def code_design_problem() -> Column:
    """The subcode an executable design (``parsed_designs``) fails with; null when it is deep enough."""
    premise, runtime = F.col("_premise"), F.col("_runtime")
    filesystem = _text_of(runtime, "$.kind").eqNullSafe(F.lit("filesystem_task"))
    execution, commands = field(runtime, "$.execution"), field(runtime, "$.commands")
    thin = reduce(lambda a, b: a | b, [~truthy(field(premise, f"$.{f}")) for f in fixed.DESIGN_PREMISE_FIELDS])
    missing_lists = reduce(lambda a, b: a | b, [empty(F.col(f)) for f in fixed.DESIGN_LIST_FIELDS])
    core = F.lower(F.concat_ws(" ", *[_text_of(premise, f"$.{f}") for f in fixed.DESIGN_PREMISE_FIELDS]))
    toy = F.exists(F.array(*[F.lit(m) for m in fixed.TOY_MARKERS]), lambda m: F.contains(core, m))
    return (
        F.when(F.coalesce(~is_json_object(premise), F.lit(True)), F.lit("weak_diagnostic_pressure"))
        .when(~is_json_object(runtime) | ~truthy(field(runtime, "$.kind")), F.lit("missing_runtime_requirements"))
        .when(
            filesystem
            & (
                ~is_json_object(execution)
                | _outside(_text_of(execution, "$.mode"), fixed.EXECUTION_MODES)
                | ~truthy(field(execution, "$.base_image"))
            ),
            F.lit("unsupported_runtime_requirements"),
        )
        .when(
            filesystem & (~is_json_object(commands) | ~truthy(field(commands, "$.test"))),
            F.lit("missing_runtime_requirements"),
        )
        .when(thin | missing_lists | toy, F.lit("weak_diagnostic_pressure"))
    )


def check_code_design(df: DataFrame) -> DataFrame:
    """(id, passed, subcode) of executable designs."""
    judged = parsed_designs(df).select("id", code_design_problem().alias("subcode"))
    return judged.select("id", F.col("subcode").isNull().alias("passed"), "subcode")


def design_problem(domain: Domain) -> Column:
    """Struct(route_code, subcode) a single design fails with, before duplicates; null when valid."""
    code = lambda route, sub: F.struct(F.lit(route).alias("route_code"), (sub if isinstance(sub, Column) else F.lit(sub)).alias("subcode"))
    taxonomy = (
        F.when(_outside(F.col("cell.case_type"), domain.case_types), code("reject_coverage_mismatch", "unknown_case_type"))
        .when(_outside(F.col("cell.difficulty"), domain.difficulties), code("reject_coverage_mismatch", "unknown_difficulty"))
        .when(_outside(F.col("cell.scenario"), domain.scenarios), code("reject_coverage_mismatch", "unknown_scenario"))
    )
    if domain.executable:
        depth = code_design_problem()
        taxonomy = taxonomy.when(depth.isNotNull(), code("reject_criteria_mismatch", depth))
    return taxonomy


def partition_designs(designs: DataFrame, domain: Domain) -> DataFrame:
    """(id, ord, verdict, route_code, subcode): valid first occurrences are accepted.

    A design whose content hash an earlier *valid* design holds is ``duplicate_design``, whatever else
    is wrong with it. Only hashes that occur more than once are joined back, so a hot hash costs one
    partial aggregate and a skew-splittable join rather than one big group.
    """
    designs = parsed_designs(designs) if domain.executable else designs
    judged = designs.select("id", "ord", "content_hash", design_problem(domain).alias("problem"))
    groups = judged.groupBy("content_hash").agg(
        F.count("*").alias("n"), F.min(F.when(F.col("problem").isNull(), F.col("ord"))).alias("kept_ord")
    )
    repeated = groups.where((F.col("n") > 1) & F.col("kept_ord").isNotNull()).select("content_hash", "kept_ord")
    joined = judged.join(repeated, "content_hash", "left")
    duplicate = F.col("ord") > F.col("kept_ord")
    problem = F.when(
        duplicate, F.struct(F.lit("reject_duplicate").alias("route_code"), F.lit("duplicate_design").alias("subcode"))
    ).otherwise(F.col("problem"))
    return joined.select("id", "ord", problem.alias("problem")).select(
        "id",
        "ord",
        F.when(F.col("problem").isNull(), F.lit("accept")).otherwise(F.lit("reject")).alias("verdict"),
        F.coalesce("problem.route_code", F.lit("accept")).alias("route_code"),
        F.col("problem.subcode").alias("subcode"),
    )


def check_designs(designs: DataFrame, domain: Domain) -> DataFrame:
    """(verdict, route_code, subcode) of a whole batch: the first failing design in order decides."""
    designs = parsed_designs(designs) if domain.executable else designs
    judged = designs.select("ord", "content_hash", design_problem(domain).alias("problem"))
    taxonomy = F.col("problem.route_code") == "reject_coverage_mismatch"
    firsts = judged.groupBy("content_hash").agg(F.min("ord").alias("first_ord"))
    joined = judged.join(firsts, "content_hash")
    repeated = F.col("ord") > F.col("first_ord")
    duplicate = F.struct(F.lit("reject_duplicate").alias("route_code"), F.lit("duplicate_design").alias("subcode"))
    problem = F.when(taxonomy, F.col("problem")).when(repeated, duplicate).otherwise(F.col("problem"))
    failing = joined.select("ord", problem.alias("p")).where(F.col("p").isNotNull())
    return failing.agg(F.min_by("p", "ord").alias("p")).select(
        F.when(F.col("p").isNull(), F.lit("accept")).otherwise(F.lit("reject")).alias("verdict"),
        F.coalesce("p.route_code", F.lit("accept")).alias("route_code"),
        F.col("p.subcode").alias("subcode"),
    )


# ------------------------------------------------------------------ gate verdicts


def is_leak_code(code: Column) -> Column:
    return F.startswith(code, F.lit("answer_leak_"))


def _points_at_visible(item: Column) -> Column:
    source = F.lower(F.btrim(F.coalesce(item["source"], F.lit(""))))
    path = F.lower(F.btrim(F.coalesce(item["path"], F.lit(""))))
    private = contains_any(path, fixed.PRIVATE_PATH_MARKERS) | source.isin(*fixed.PRIVATE_SOURCES)
    visible = source.isin(*fixed.VISIBLE_SOURCES)
    for prefix in fixed.VISIBLE_PATH_PREFIXES:
        visible = visible | F.startswith(path, F.lit(prefix))
    return ~private & visible


def sanitize_leak_claims(df: DataFrame) -> DataFrame:
    """Drop ``answer_leak_*`` subcodes that no evidence ties to candidate-visible material."""
    grounded = F.coalesce(F.exists("evidence", _points_at_visible), F.lit(False))
    kept = F.when(grounded, F.col("subcodes")).otherwise(F.filter("subcodes", lambda c: ~is_leak_code(c)))
    return df.withColumn("subcodes", kept)


def coerce_gate_verdicts(df: DataFrame) -> DataFrame:
    """Make raw gate verdicts consistent.

    An unknown verdict is a reject, an unknown route is the verdict's default, leakage without a leak
    code is a semantic mismatch, and an accept that carries a reject signal becomes a reject.
    """
    stated = F.lower(F.coalesce(F.col("verdict").cast("string"), F.lit("none")))
    verdict = F.when(stated.isin("accept", "reject"), stated).otherwise(F.lit("reject"))
    leaks = F.coalesce(F.exists("subcodes", is_leak_code), F.lit(False))
    default = F.when(F.col("verdict") == "accept", F.lit("accept")).otherwise(F.lit("reject_semantic_mismatch"))
    known = F.when(F.col("route_code").isin(*fixed.ROUTE_CODES), F.col("route_code")).otherwise(default)
    route = F.when((known == "reject_leakage") & ~leaks, F.lit("reject_semantic_mismatch")).otherwise(known)
    signals = F.array_intersect("subcodes", F.array(*[F.lit(c) for c in fixed.REJECT_SIGNAL_CODES]))
    flips = (F.col("verdict") == "accept") & (F.size(signals) > 0)
    leaking = F.array_contains(signals, "shortcut_leakage") | F.exists(signals, is_leak_code)
    return (
        df.withColumn("verdict", verdict)
        .withColumn("route_code", route)
        .withColumn(
            "route_code",
            F.when(flips, F.when(leaking, F.lit("reject_leakage")).otherwise(F.lit("reject_semantic_mismatch"))).otherwise(
                F.col("route_code")
            ),
        )
        .withColumn("_flips", flips)
        .withColumn("verdict", F.when(F.col("_flips"), F.lit("reject")).otherwise(F.col("verdict")))
        .withColumn("subcodes", F.when(F.col("_flips"), F.array_distinct("subcodes")).otherwise(F.col("subcodes")))
        .drop("_flips")
    )


def sanitize_attacks(df: DataFrame, attacks_col: str = "attacks") -> DataFrame:
    """Relabel claimed answer leakage that does not point at candidate-visible material."""

    def lowered(a: Column, *names: str) -> Column:
        return F.concat_ws(" ", *[F.lower(F.coalesce(a[n], F.lit(""))) for n in names])

    def relabel(a: Column) -> Column:
        claim = F.lower(F.btrim(F.coalesce(a["attack_type"], F.lit("")))) == "answer_leakage"
        cited = lowered(a, "evidence", "exploit_path")
        visible = contains_any(cited, fixed.ATTACK_VISIBLE_MARKERS) & ~contains_any(cited, fixed.ATTACK_PRIVATE_MARKERS)
        about = lowered(a, "attack_target", "evidence", "exploit_path")
        other = (
            F.when(contains_any(about, ["scoring", "score", "rubric"]), F.lit("scoring_ambiguity"))
            .when(F.contains(about, F.lit("proxy")), F.lit("proxy_overclaim"))
            .otherwise(F.lit("other"))
        )
        return a.withField("attack_type", F.when(claim & ~visible, other).otherwise(a["attack_type"]))

    return df.withColumn(attacks_col, F.transform(F.filter(attacks_col, lambda a: a.isNotNull()), relabel))


# ------------------------------------------------------------------ recorded command results


def command_output(stdout: Column, stderr: Column) -> Column:
    joined = F.btrim(
        F.concat_ws("\n", F.nullif(F.coalesce(stdout, F.lit("")), F.lit("")), F.nullif(F.coalesce(stderr, F.lit("")), F.lit(""))),
        F.lit(" \t\r\n"),
    )
    return F.when(
        F.length(joined) > fixed.COMMAND_OUTPUT_LIMIT,
        F.concat(F.substring(joined, 1, fixed.COMMAND_OUTPUT_LIMIT), F.lit("\n...[truncated]")),
    ).otherwise(joined)


def failed_test_files(stdout: Column, stderr: Column) -> Column:
    text = F.concat_ws("\n", F.nullif(F.coalesce(stdout, F.lit("")), F.lit("")), F.nullif(F.coalesce(stderr, F.lit("")), F.lit("")))
    return F.array_sort(
        F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?m)^[ \t]*FAILED\s+([^:\s]+)::"), F.lit(1)))
    )


def check_exec_results(results: DataFrame, domain: Domain) -> DataFrame:
    """Recorded test runs. Exit 1 is the wanted initial failure unless too many files fail."""
    path = "environment_artifact.payload.commands.test"
    most = domain.minimum("max_initial_failure_files", 0)
    timeout = float(domain.rules.get("workspace_test_timeout_seconds", 10))
    read = results.select(
        "candidate_id",
        F.col("returncode").alias("code"),
        F.coalesce("timed_out", F.lit(False)).alias("timed_out"),
        command_output(F.col("stdout"), F.col("stderr")).alias("output"),
        failed_test_files(F.col("stdout"), F.col("stderr")).alias("files"),
    )
    code, files, output = F.col("code"), F.col("files"), F.col("output")
    shown = evidence(path, output, "workspace_command")

    def fail(subcode: str, why: str | Column) -> tuple[Column, Column, Column]:
        return failure("reject_schema", subcode, evidence(path, why), F.when(output != "", shown))

    result = outcome(
        "environment_artifact",
        (F.col("timed_out"), fail("workspace_test_timeout", f"workspace test command timed out after {timeout:g}s")),
        (
            (code == 1) & F.lit(most > 0) & (F.size(files) > most),
            fail(
                "workspace_test_command_failed",
                F.concat(F.lit("workspace starter tests fail across too many test files: "), F.array_join(files, ", ")),
            ),
        ),
        (
            (code == 0) & F.lit(domain.required("require_initial_test_failure")),
            fail(
                "workspace_tests_do_not_reproduce_failure",
                "workspace tests passed on the starter code; the benchmark does not demonstrate a failing behavior before repair",
            ),
        ),
        (
            ~code.eqNullSafe(F.lit(1)),
            fail(
                "workspace_test_command_failed",
                F.concat(
                    F.lit("workspace test command exited with "),
                    F.coalesce(code.cast("string"), F.lit("None")),
                    F.lit("; tests did not run cleanly to assertions"),
                ),
            ),
        ),
    )
    # a passing run keeps its output as evidence
    rows = read.select("candidate_id", "output", result.alias("check"))
    notes = F.when(F.col("check.passed"), F.array(shown).cast(schemas.EVIDENCE)).otherwise(F.col("check.evidence"))
    return rows.select(
        "candidate_id", F.lit(0).alias("check_ord"), "check.check_id", "check.passed", "check.route_code", "check.subcode",
        notes.alias("evidence"),
    )
