"""Schemas of the tables the library reads and writes. Never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

STRINGS = T.ArrayType(T.StringType())


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


CELL = T.StructType(
    [
        T.StructField("case_type", T.StringType()),
        T.StructField("difficulty", T.IntegerType()),
        T.StructField("scenario", T.StringType()),
    ]
)

EVIDENCE = T.ArrayType(T.StructType(_strings("source", "path", "value")))

CHECK = T.StructType(
    [
        T.StructField("candidate_id", T.StringType()),
        T.StructField("check_ord", T.IntegerType()),
        T.StructField("check_id", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("route_code", T.StringType()),
        T.StructField("subcode", T.StringType()),
        T.StructField("evidence", EVIDENCE),
    ]
)

DIMENSION = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("weight", T.DoubleType()),
        T.StructField("high_score_criterion", T.StringType()),
        T.StructField("low_score_criterion", T.StringType()),
    ]
)

JUDGE = T.StructType(
    [
        T.StructField(
            "score_x",
            T.StructType(
                [T.StructField("score_type", T.StringType()), T.StructField("dimensions", T.ArrayType(DIMENSION))]
            ),
        ),
        T.StructField("private_root_cause", T.StringType()),
        T.StructField("expected_fix_properties", STRINGS),
        T.StructField("hidden_failure_modes", STRINGS),
        T.StructField("shallow_solution_traps", STRINGS),
        T.StructField("candidate_visibility_boundaries", STRINGS),
        T.StructField("proxy_claim", T.StringType()),
        T.StructField("diagnostic_pressure", STRINGS),
        T.StructField(
            "scoring_contract",
            T.StructType(
                [
                    T.StructField("credit", STRINGS),
                    T.StructField("penalties", STRINGS),
                    T.StructField("uncertainty_policy", T.StringType()),
                ]
            ),
        ),
        T.StructField("leakage_risks", STRINGS),
        T.StructField("known_limits", STRINGS),
        T.StructField("coverage_tags", STRINGS),
        T.StructField(
            "negative_controls",
            T.ArrayType(T.StructType(_strings("output", "should_fail_because"))),
        ),
    ]
)

AGENT = T.StructType(
    [
        T.StructField("benchmark_case", T.StringType()),  # JSON object
        T.StructField("runtime_requirements", T.StringType()),  # JSON object or null
        T.StructField(
            "environment_artifact",
            T.StructType(_strings("kind", "payload")),  # payload: JSON object
        ),
    ]
)

CANDIDATES = T.StructType(
    [
        *_strings("id", "design_id", "content_hash"),
        T.StructField("cell", CELL),
        T.StructField("agent_artifact", AGENT),
        T.StructField("judge_artifact", JUDGE),
        T.StructField("ability_z", T.StringType()),
        T.StructField("environment_y", T.StringType()),
        T.StructField("difficulty", T.IntegerType()),
        T.StructField("case_type", T.StringType()),
        T.StructField("provenance", T.MapType(T.StringType(), T.StringType())),
        T.StructField("ord", T.LongType()),
    ]
)

DESIGNS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("cell", CELL),
        *_strings("target_ability", "target_environment", "design_intent", "failure_mode_family"),
        *_strings("environment_premise", "runtime_requirements", "environment_artifact_spec"),
        *[
            T.StructField(n, STRINGS)
            for n in (
                "diagnostic_pressure",
                "why_weak_agents_fail",
                "tempting_shallow_solutions",
                "success_evidence_required",
                "minimum_depth_requirements",
                "forbidden_shortcuts",
                "non_goals",
            )
        ],
        T.StructField("content_hash", T.StringType()),
        T.StructField("ord", T.LongType()),
    ]
)

FILES = T.StructType(
    [
        T.StructField("candidate_id", T.StringType()),
        T.StructField("ord", T.IntegerType()),
        T.StructField("path", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)

EXEC_RESULTS = T.StructType(
    [
        T.StructField("candidate_id", T.StringType()),
        T.StructField("returncode", T.IntegerType()),
        T.StructField("stdout", T.StringType()),
        T.StructField("stderr", T.StringType()),
        T.StructField("timed_out", T.BooleanType()),
    ]
)

VERDICTS = T.StructType(
    [
        *_strings("run_id", "candidate_id", "check_kind", "verdict", "route_code"),
        T.StructField("subcodes", STRINGS),
        T.StructField("evidence", EVIDENCE),
        T.StructField("rationale", T.StringType()),
        T.StructField("ord", T.LongType()),
    ]
)

REVISION_COUNTERS = [
    "revision_op_count",
    "revision_edit_file_count",
    "revision_files_touched",
    "revision_bytes_added",
    "revision_bytes_removed",
    "revision_bytes_changed",
    "revision_full_rewrite_count",
    "revision_create_file_count",
    "revision_replace_all_count",
]

STAGE_RECORDS = T.StructType(
    [
        *_strings("run_id", "stage_id", "role", "stage_kind", "agent_role", "parent_artifact_id", "artifact_id"),
        *_strings("model", "provider", "prompt_hash"),
        T.StructField("input_tokens", T.LongType()),
        T.StructField("output_tokens", T.LongType()),
        T.StructField("latency_ms", T.LongType()),
        T.StructField("cost_usd", T.DoubleType()),
        T.StructField("reasoning_effort", T.StringType()),
        T.StructField("text_normalization_replacements", T.LongType()),
        T.StructField("error", T.StringType()),
        *[T.StructField(n, T.LongType()) for n in REVISION_COUNTERS],
        T.StructField("revision_full_rewrite_ratio", T.DoubleType()),
        *_strings("verdict", "route_code"),
        T.StructField("subcodes", STRINGS),
        *_strings("criteria_hash", "context_policy"),
        T.StructField("retry_index", T.LongType()),
        *_strings("attempt_of", "input_hash", "output_hash", "trace_ref", "wallclock_ts"),
    ]
)

STAGE_EVENTS = T.StructType(
    [
        *_strings("run_id", "event_type", "stage", "stage_event", "role", "ts"),
        T.StructField("body_bytes", T.LongType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    ]
)

STAGE_IO = T.StructType(
    _strings(
        "run_id", "stage_id", "role", "stage_kind", "artifact_id", "parent_artifact_id", "input_hash", "output_hash",
        "input", "output", "wallclock_ts",
    )
)

ATTACK = T.StructType(
    _strings("attack_target", "attack_type", "exploit_path", "evidence", "severity", "why_it_invalidates_proxy")
)

ADVERSARY_REPORTS = T.StructType(
    [
        *_strings("candidate_id", "revision_disposition", "disposition_rationale", "attack_summary"),
        T.StructField("attacks", T.ArrayType(ATTACK)),
        *_strings("cheap_pass_strategy", "proxy_damage"),
        T.StructField("survival_requirements", STRINGS),
    ]
)

ENVIRONMENT_OP = T.StructType(
    [
        *_strings("op", "path", "old_text", "new_text"),
        T.StructField("replace_all", T.BooleanType()),
        T.StructField("create_if_missing", T.BooleanType()),
    ]
)

PATCHES = T.StructType(
    [
        *_strings("candidate_id", "benchmark_case_updates", "metadata_updates"),
        T.StructField("environment_ops", T.ArrayType(ENVIRONMENT_OP)),
        T.StructField("revision_rationale", T.StringType()),
    ]
)

REJECTIONS = T.StructType(
    [
        *_strings("run_id", "candidate_id", "design_id", "case_type", "ability", "prompt", "proxy_claim", "route_code"),
        T.StructField("subcodes", STRINGS),
        T.StructField("ord", T.LongType()),
    ]
)

CANDIDATE_SNAPSHOTS = T.StructType(
    [
        *_strings("run_id", "phase", "role", "candidate_id", "design_id", "parent_candidate_id", "adversary_report_id"),
        T.StructField("retry_index", T.LongType()),
        T.StructField("candidate", T.StringType()),
    ]
)

GENERATION_ENVELOPES = T.StructType(
    [
        *_strings("run_id", "role", "envelope_id", "design_id"),
        T.StructField("retry_index", T.LongType()),
        T.StructField("retry_route_code", T.StringType()),
        T.StructField("retry_subcodes", STRINGS),
        T.StructField("envelope", T.StringType()),
    ]
)

ARTIFACTS = {
    "stage_records": STAGE_RECORDS,
    "stage_io": STAGE_IO,
    "stage_events": STAGE_EVENTS,
    "validation": VERDICTS,
    "rejections": REJECTIONS,
    "adversary": ADVERSARY_REPORTS,
    "candidates": CANDIDATE_SNAPSHOTS,
    "generation_envelopes": GENERATION_ENVELOPES,
}

EXPOSURE = T.StructType(
    [
        T.StructField("revenue_at_risk", T.LongType()),
        T.StructField("affected_orders", STRINGS),
        T.StructField("affected_customers", STRINGS),
        T.StructField("constrained_inventory", T.BooleanType()),
    ]
)

ALERT = T.StructType(
    [
        *_strings("id", "confidence"),
        T.StructField("source_headlines", STRINGS),
        *_strings("latent_edge_hypothesis", "real_world_prior"),
        T.StructField("enterprise_path", STRINGS),
        T.StructField("business_exposure", EXPOSURE),
        T.StructField("reasoning", T.StringType()),
        T.StructField(
            "citations", T.StructType([T.StructField("headlines", STRINGS), T.StructField("records", STRINGS)])
        ),
        T.StructField("uncertainty", STRINGS),
    ]
)

EXPECTED_ALERT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("source_headlines", STRINGS),
        T.StructField("required_concepts", STRINGS),
        T.StructField("hidden_dependency_path", STRINGS),
        T.StructField("business_exposure", EXPOSURE),
    ]
)

SCAN_ORACLES = T.StructType(
    [
        T.StructField("case_id", T.StringType()),
        T.StructField("zero_alert_run", T.BooleanType()),
        T.StructField("true_alerts", T.ArrayType(EXPECTED_ALERT)),
    ]
)

VENDOR_ORACLES = T.StructType(
    [
        *_strings("case_id", "expected_decision"),
        T.StructField("must_cite", STRINGS),
        T.StructField("forbidden_reasoning", STRINGS),
    ]
)

TRACE_EVENTS = T.StructType(
    [
        T.StructField("trial", T.IntegerType()),
        T.StructField("line_no", T.IntegerType()),
        *_strings("event_type", "tool_name", "arguments", "output_text"),
    ]
)

TRIALS = T.StructType(
    [
        T.StructField("trial", T.IntegerType()),
        *_strings("case_id", "variant", "exit_status"),
        T.StructField("passed", T.BooleanType()),
        T.StructField("score", T.DoubleType()),
        *_strings("response", "error"),
    ]
)
