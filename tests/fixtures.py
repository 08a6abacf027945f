"""Small hand-written rows with the shapes the rules expect."""

import json

from casemill import schemas
from casemill.sources.domain import Domain

PROXY = "A model that succeeds here shows it can trace a value through three modules, because surface edits leave the hidden total wrong."

JUDGE = {
    "score_x": {
        "score_type": "rubric",
        "dimensions": [
            {
                "name": "cause",
                "weight": 0.5,
                "high_score_criterion": "names the module where the value first goes wrong",
                "low_score_criterion": "patches only the printed total",
            }
        ],
    },
    "private_root_cause": "the refund sign is lost before grouping",
    "expected_fix_properties": ["keeps the sign"],
    "hidden_failure_modes": ["partial refunds"],
    "shallow_solution_traps": ["rounding"],
    "candidate_visibility_boundaries": ["no cause in public text"],
    "proxy_claim": PROXY,
    "diagnostic_pressure": ["misleading output", "two modules"],
    "scoring_contract": {"credit": ["sign kept"], "penalties": ["test edited"], "uncertainty_policy": "say so"},
    "leakage_risks": ["file names"],
    "known_limits": ["one language"],
    "coverage_tags": ["billing"],
    "negative_controls": [{"output": "round(total)", "should_fail_because": "hides the sign"}],
}
RUNTIME = {
    "kind": "filesystem_task",
    "execution": {"mode": "task_image", "base_image": "python:3.11-slim"},
    "language": {"name": "python"},
    "dependencies": {"policy": "stdlib_plus_runner", "packages": ["pytest"]},
    "commands": {"test": "python -m pytest -q"},
    "network": "disabled_during_eval",
}
CASE = {
    "prompt": "Debug the reconciliation worker and explain the patch.",
    "setup": "A small service.",
    "inputs": {},
    "environment": {"runtime": "python"},
}
FILES = [
    ("billing/parser.py", "def parse(row):\n    return dict(row)\n"),
    ("billing/sums.py", "def total(rows):\n    return sum(abs(r) for r in rows)\n"),
    ("tests/test_sums.py", "from billing.sums import total\n\n\ndef test_total():\n    assert total([2, -1]) == 1\n"),
]
DOMAIN = Domain(
    domain_id="benchmark_code_debug",
    case_types=["proxy_strong"],
    difficulties=[1, 2, 3, 4, 5],
    scenarios=["nominal", "edge"],
    rules={
        "require_negative_control": True,
        "min_proxy_claim_chars": 80,
        "min_diagnostic_pressure_items": 2,
        "min_leakage_risk_items": 1,
        "min_known_limit_items": 1,
        "execute_workspace_tests": True,
        "require_initial_test_failure": True,
        "max_initial_failure_files": 2,
        "require_runtime_requirements": True,
    },
    case_schema={
        "type": "object",
        "required": ["prompt"],
        "properties": {"prompt": {"type": "string", "minLength": 20}, "setup": {"type": "string"}},
    },
)


def candidate(ident="c1", ord_=0, design="d1", case=None, runtime="default", judge=None, env="default", **over):
    cell = {"case_type": "proxy_strong", "difficulty": 3, "scenario": "nominal", **over.pop("cell", {})}
    run = RUNTIME if runtime == "default" else runtime
    artifact = {"kind": "executioner_workspace", "payload": {"commands": {"test": "python -m pytest -q"}}} if env == "default" else env
    row = {
        "id": ident,
        "design_id": design,
        "content_hash": ident,
        "cell": cell,
        "agent_artifact": {
            "benchmark_case": json.dumps({**CASE, **(case or {})}),
            "runtime_requirements": None if run is None else json.dumps(run),
            "environment_artifact": None if artifact is None else {"kind": artifact["kind"], "payload": json.dumps(artifact["payload"])},
        },
        "judge_artifact": {**JUDGE, **(judge or {})},
        "ability_z": '{"name":"tracing"}',
        "environment_y": '{"name":"single_turn"}',
        "difficulty": cell["difficulty"],
        "case_type": cell["case_type"],
        "provenance": {"generator": "test"},
        "ord": ord_,
    }
    row.update(over)
    return row


def candidates(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.CANDIDATES)


def files(spark, *idents, entries=FILES):
    return spark.createDataFrame([(c, i, p, t) for c in idents for i, (p, t) in enumerate(entries)], schemas.FILES)
