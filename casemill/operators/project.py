"""Projections: candidates from payloads, role views, designs, stage records, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill import schemas
from casemill.functions.documents import canonical_json, drop_null_fields, json_hash
from casemill.functions.scalars import field, is_json_object, is_json_string
from casemill.sources.domain import Domain


def judge_defaults(col: Column) -> Column:
    """A judge artifact (JSON text) as the typed struct with every missing list, text or map empty."""
    parsed = F.from_json(col, schemas.JUDGE.simpleString())
    empty = {
        "array": lambda t: F.array().cast(t),
        "string": lambda t: F.lit(""),
    }
    parts = []
    for f in schemas.JUDGE.fields:
        kind = f.dataType.typeName()
        value = parsed[f.name]
        parts.append((F.coalesce(value, empty[kind](f.dataType)) if kind in empty else value).alias(f.name))
    return F.struct(*parts)


def content_hash(**parts: Column) -> Column:
    """sha256 of the canonical JSON of named JSON texts."""
    body = F.concat_ws(
        ",", *[F.concat(F.lit(f'"{k}":'), F.coalesce(parts[k], F.lit("null"))) for k in sorted(parts)]
    )
    return json_hash(F.concat(F.lit("{"), body, F.lit("}")))


def _quoted(col: Column) -> Column:
    return F.regexp_extract(F.to_json(F.struct(col.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)


def candidates_from_payload(payloads: DataFrame, designs: DataFrame, run_id: str) -> DataFrame:
    """Candidates (schemas.CANDIDATES) from generator payloads.

    ``payloads`` has design_id, envelope_id, attempt, role_name, ord and payload (JSON text). Null case
    fields are dropped; a payload without an agent or judge artifact yields no candidate.
    """
    v = F.try_parse_json("payload")
    part = lambda p: field(v, p)
    text = lambda p: F.to_json(part(p))
    usable = is_json_object(part("$.agent_artifact")) & is_json_object(part("$.judge_artifact"))
    joined = payloads.where(usable).join(designs.select(F.col("id").alias("design_id"), "cell"), "design_id")
    agent = lambda name: F.when(
        ~F.coalesce(F.is_variant_null(part(f"$.agent_artifact.{name}")), F.lit(True)), text(f"$.agent_artifact.{name}")
    )
    env = F.when(
        agent("environment_artifact").isNotNull(),
        F.struct(
            F.try_variant_get(v, "$.agent_artifact.environment_artifact.kind", "string").alias("kind"),
            F.coalesce(text("$.agent_artifact.environment_artifact.payload"), F.lit("{}")).alias("payload"),
        ),
    )
    rows = joined.select(
        F.concat_ws("-", F.lit(run_id), F.lit("candidate"), "design_id", F.col("attempt").cast("string")).alias("id"),
        "design_id",
        "cell",
        drop_null_fields(text("$.agent_artifact.benchmark_case")).alias("benchmark_case"),
        agent("runtime_requirements").alias("runtime_requirements"),
        agent("environment_artifact").alias("environment_json"),
        env.alias("environment"),
        text("$.judge_artifact").alias("judge_json"),
        F.coalesce(text("$.ability_z"), F.lit("{}")).alias("ability_z"),
        F.coalesce(text("$.environment_y"), F.lit("{}")).alias("environment_y"),
        "envelope_id",
        "role_name",
        "ord",
    )
    digest = content_hash(
        generation_envelope_id=_quoted(F.col("envelope_id")),
        design_id=_quoted(F.col("design_id")),
        cell=F.to_json("cell"),
        benchmark_case=F.col("benchmark_case"),
        runtime_requirements=F.col("runtime_requirements"),
        environment_artifact=F.col("environment_json"),
        judge_artifact=F.col("judge_json"),
        ability_z=F.col("ability_z"),
        environment_y=F.col("environment_y"),
    )
    return rows.select(
        "id",
        "design_id",
        digest.alias("content_hash"),
        "cell",
        F.struct("benchmark_case", "runtime_requirements", F.col("environment").alias("environment_artifact")).alias("agent_artifact"),
        judge_defaults(F.col("judge_json")).alias("judge_artifact"),
        "ability_z",
        "environment_y",
        F.col("cell.difficulty").alias("difficulty"),
        F.col("cell.case_type").alias("case_type"),
        F.create_map(
            F.lit("design_id"), F.col("design_id"), F.lit("generation_envelope_id"), F.col("envelope_id"),
            F.lit("generator"), F.col("role_name"),
        ).alias("provenance"),
        "ord",
    )


# ------------------------------------------------------------------ role views

DESIGN_VIEW = [
    "cell", "target_ability", "target_environment", "design_intent", "environment_premise", "runtime_requirements",
    "environment_artifact_spec", "failure_mode_family", "diagnostic_pressure", "why_weak_agents_fail",
    "tempting_shallow_solutions", "success_evidence_required", "minimum_depth_requirements", "forbidden_shortcuts", "non_goals",
]
CLAIM_LISTS = ["diagnostic_pressure", "tempting_shallow_solutions", "minimum_depth_requirements", "forbidden_shortcuts"]


def _context() -> Column:
    return F.struct("ability_z", "environment_y", "difficulty", "case_type", "cell")


def _compact_judge() -> Column:
    judge = F.col("judge_artifact")
    first = lambda f, n=4: F.slice(F.coalesce(judge[f], F.array().cast(schemas.JUDGE[f].dataType)), 1, n).alias(f)
    return F.struct(
        F.struct(
            judge["score_x"]["score_type"].alias("score_type"), F.slice(judge["score_x"]["dimensions"], 1, 4).alias("dimensions")
        ).alias("score_x"),
        judge["private_root_cause"].alias("private_root_cause"),
        judge["proxy_claim"].alias("proxy_claim"),
        first("diagnostic_pressure"),
        first("shallow_solution_traps"),
        judge["scoring_contract"].alias("scoring_contract"),
        first("leakage_risks"),
        first("known_limits"),
        first("negative_controls", 3),
    )


def role_view(df: DataFrame, role: str) -> DataFrame:
    """What a role may see, keyed by id (identity columns are for joining, not for the role).

    ``design`` and ``adversary_design`` read designs, ``candidate`` (rubric), ``quality`` and
    ``adversary`` read candidates, ``report`` reads adversary reports.
    """
    if role == "design":
        return df.select("id", F.struct(F.lit("benchmark").alias("target_stage"), *DESIGN_VIEW).alias("view"))
    if role == "adversary_design":
        plain = ["cell", "target_ability", "target_environment", "design_intent", "failure_mode_family"]
        return df.select("id", F.struct(*plain, *[F.slice(c, 1, 4).alias(c) for c in CLAIM_LISTS]).alias("view"))
    public = [F.col("agent_artifact").alias("agent_visible_artifact"), _context().alias("benchmark_context")]
    if role == "quality":
        return df.select("id", F.struct(*public).alias("view"))
    if role == "candidate":
        private = F.struct("judge_artifact").alias("evaluator_private_context")
        return df.select("id", F.struct(*public, private).alias("view"))
    if role == "adversary":
        private = F.struct(_compact_judge().alias("judge_artifact")).alias("evaluator_private_context")
        return df.select("id", F.struct(*public, private).alias("view"))
    if role == "report":
        shown = [f.name for f in schemas.ADVERSARY_REPORTS.fields if f.name != "candidate_id"]
        return df.select(F.col("candidate_id").alias("id"), F.struct(*shown).alias("view"))
    raise ValueError(f"unknown role {role!r}")


# ------------------------------------------------------------------ designs from instructions

# fixed values: the runtime block and texts of a design made from a bare instruction
TEXT_ONLY_RUNTIME = (
    '{"kind":"text_only","execution":{"mode":"none","os":"none","arch":"none"},'
    '"language":{"name":"none","version":"none"},"dependencies":{"policy":"none","packages":[]},'
    '"commands":{},"network":"not_applicable"}'
)
INSTRUCTION_TEXTS = {
    "failure_mode_family": "user-specified benchmark intent with shallow compliance risk",
    "why_weak_agents_fail": ["they satisfy surface wording without demonstrating the requested capability"],
    "tempting_shallow_solutions": ["generic answer that matches the topic but not the benchmark intent"],
    "success_evidence_required": ["observable output behavior that satisfies the user instruction and domain scoring rules"],
    "minimum_depth_requirements": ["preserve the user instruction while creating a valid benchmark case"],
    "forbidden_shortcuts": ["surface-level compliance", "generic template"],
    "non_goals": ["benchmarking abilities outside the selected domain"],
}


def designs_from_instructions(instr: DataFrame, domain: Domain) -> DataFrame:
    """Designs (schemas.DESIGNS) from (run_id, instruction, ord): the domain's first cell, middle difficulty.

    The domain contributes constants, so this is a projection.
    """
    first = lambda values, fallback: F.lit(values[0] if values else fallback)
    levels = sorted(domain.difficulties)
    middle = levels[len(levels) // 2] if levels else 3
    many = lambda key: F.array(*[F.lit(t) for t in INSTRUCTION_TEXTS[key]]).alias(key)
    instruction = F.col("instruction")
    premise = F.to_json(F.struct(instruction.alias("user_instruction")))
    rows = instr.select(
        F.concat("run_id", F.lit("-instruction-design")).alias("id"),
        F.struct(
            first(domain.case_types, "proxy_strong").alias("case_type"),
            F.lit(middle).cast("int").alias("difficulty"),
            first(domain.scenarios, "nominal").alias("scenario"),
        ).alias("cell"),
        first(domain.abilities, "domain_target_ability").alias("target_ability"),
        first(domain.environments, "single_turn").alias("target_environment"),
        instruction.alias("design_intent"),
        F.lit(INSTRUCTION_TEXTS["failure_mode_family"]).alias("failure_mode_family"),
        premise.alias("environment_premise"),
        F.lit(TEXT_ONLY_RUNTIME).alias("runtime_requirements"),
        F.lit("{}").alias("environment_artifact_spec"),
        F.array(instruction).alias("diagnostic_pressure"),
        *[many(k) for k in INSTRUCTION_TEXTS if k != "failure_mode_family"],
        F.col("ord").cast("bigint").alias("ord"),
    )
    return rows.withColumn("content_hash", design_hash()).select(*schemas.DESIGNS.names)


def design_hash() -> Column:
    """sha256 of the canonical JSON of everything a design says except its id."""
    texts = ["target_ability", "target_environment", "design_intent", "failure_mode_family"]
    docs = ["environment_premise", "runtime_requirements", "environment_artifact_spec"]
    lists = [
        "diagnostic_pressure", "why_weak_agents_fail", "tempting_shallow_solutions", "success_evidence_required",
        "minimum_depth_requirements", "forbidden_shortcuts", "non_goals",
    ]
    return content_hash(
        target_stage=F.lit('"benchmark"'),
        cell=F.to_json("cell"),
        parent_design_batch_id=F.lit("null"),
        **{c: _quoted(F.col(c)) for c in texts},
        **{c: F.coalesce(F.col(c), F.lit("{}")) for c in docs},
        **{c: F.to_json(F.coalesce(F.col(c), F.array().cast("array<string>"))) for c in lists},
    )


# ------------------------------------------------------------------ log rows


def stage_records_from(verdicts: DataFrame, meta: DataFrame, domain: Domain | None = None) -> DataFrame:
    """Stage records (schemas.STAGE_RECORDS): stage results joined to model metadata, defaults filled.

    ``verdicts`` has artifact_id and the stage columns, optionally stage_input and stage_output (JSON);
    ``meta`` has artifact_id and any of the model and revision columns.
    """
    import json
    from dataclasses import asdict

    criteria = json.dumps(asdict(domain), sort_keys=True) if domain else "{}"
    joined = verdicts.join(meta, "artifact_id", "left")
    have = set(joined.columns)
    defaults = {"model": "none", "provider": "local", "prompt_hash": ""}
    stage_input = F.col("stage_input") if "stage_input" in have else F.lit(None).cast("string")
    stage_output = F.col("stage_output") if "stage_output" in have else F.lit(None).cast("string")
    derived = {
        "stage_id": F.concat_ws(":", "stage_kind", "artifact_id"),
        "criteria_hash": F.sha2(F.lit(criteria), 256),
        "input_hash": F.sha2(canonical_json(stage_input), 256),
        "output_hash": F.sha2(canonical_json(stage_output), 256),
        "trace_ref": F.when(stage_input.isNotNull() | stage_output.isNotNull(), F.lit("stage_io.jsonl")),
    }
    cols = []
    for f in schemas.STAGE_RECORDS.fields:
        if f.name in derived:
            value = derived[f.name]
        elif f.name in have:
            value = F.col(f.name).cast(f.dataType)
        else:
            value = F.lit(None).cast(f.dataType)
        if f.name in defaults:
            value = F.coalesce(value, F.lit(defaults[f.name]))
        elif f.dataType.typeName() in ("long", "double"):
            value = F.coalesce(value, F.lit(0).cast(f.dataType))
        elif f.dataType.typeName() == "array":
            value = F.coalesce(value, F.array().cast(f.dataType))
        cols.append(value.alias(f.name))
    return joined.select(*cols)


def candidate_snapshots(df: DataFrame, run_id: str, phase: str, role: str) -> DataFrame:
    """Snapshot rows (schemas.CANDIDATE_SNAPSHOTS). Optional lineage columns are kept when present."""
    optional = lambda c: (F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c)
    body = F.to_json(F.struct(*[c for c in schemas.CANDIDATES.names if c in df.columns and c != "ord"]), {"ignoreNullFields": "false"})
    return df.select(
        F.lit(run_id).alias("run_id"),
        F.lit(phase).alias("phase"),
        F.lit(role).alias("role"),
        F.col("id").alias("candidate_id"),
        "design_id",
        optional("parent_candidate_id"),
        optional("adversary_report_id"),
        F.coalesce(F.col("retry_index") if "retry_index" in df.columns else F.lit(0), F.lit(0)).cast("bigint").alias("retry_index"),
        body.alias("candidate"),
    )


def envelope_rows(designs: DataFrame, run_id: str, role: str) -> DataFrame:
    """Generation-envelope log rows (schemas.GENERATION_ENVELOPES) of designs."""
    optional = lambda c, t: (F.col(c) if c in designs.columns else F.lit(None)).cast(t)
    body = F.to_json(F.struct(*[c for c in schemas.DESIGNS.names if c in designs.columns and c != "ord"]), {"ignoreNullFields": "false"})
    return designs.select(
        F.lit(run_id).alias("run_id"),
        F.lit(role).alias("role"),
        F.coalesce(optional("envelope_id", "string"), F.col("id")).alias("envelope_id"),
        F.col("id").alias("design_id"),
        F.coalesce(optional("retry_index", "bigint"), F.lit(0).cast("bigint")).alias("retry_index"),
        optional("retry_route_code", "string").alias("retry_route_code"),
        F.coalesce(optional("retry_subcodes", "array<string>"), F.array().cast("array<string>")).alias("retry_subcodes"),
        body.alias("envelope"),
    )


def normalize_envelope(df: DataFrame, raw_col: str = "raw") -> DataFrame:
    """(case_id, raw): the submitted envelope with the case id stamped on it and on the scan inside.

    A missing rationale becomes null. Envelopes that are not JSON objects are passed through.
    """
    v = F.try_parse_json(raw_col)
    envelope = F.try_variant_get(v, "$", "map<string, variant>")
    inner = F.when(is_json_string(field(v, "$.response")), F.try_parse_json(F.try_variant_get(v, "$.response", "string")))
    scan = F.when(is_json_object(field(inner, "$.scan")), F.try_variant_get(inner, "$.scan", "map<string, variant>"))
    as_variant = lambda c: F.parse_json(F.to_json(c))
    case = F.parse_json(_quoted(F.col("case_id")))
    put = lambda m, k, value: F.map_concat(F.map_filter(m, lambda key, _: key != k), F.create_map(F.lit(k), value))
    stamped = put(scan, "run_id", case)
    rationale = F.when(F.map_contains_key(stamped, "no_alert_rationale"), stamped).otherwise(
        put(stamped, "no_alert_rationale", F.parse_json(F.lit("null")))
    )
    answer = put(F.try_variant_get(inner, "$", "map<string, variant>"), "scan", as_variant(rationale))
    answer_text = F.to_json(F.struct(F.to_json(answer).alias("v")))
    quoted_answer = F.parse_json(F.regexp_extract(answer_text, r"(?s)^\{\"v\":(.*)\}$", 1))
    out = put(envelope, "case_id", case)
    out = F.when(scan.isNotNull(), put(out, "response", quoted_answer)).otherwise(out)
    return df.select("case_id", F.when(is_json_object(v), F.to_json(out)).otherwise(F.col(raw_col)).alias(raw_col))
