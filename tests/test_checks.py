import pytest
from fixtures import CASE, DOMAIN, FILES, JUDGE, RUNTIME, candidate, candidates, files
from pyspark.sql import functions as F

from casemill import schemas
from casemill.operators import checks as C
from casemill.operators import leakage as L
from casemill.operators import workspace as W
from casemill.plans.batch import validate_candidates

FAILED = [("c", 1, "FAILED tests/test_sums.py::test_total - assert 3 == 1\n", "", False)]


def verdict(spark, row, entries=FILES, domain=DOMAIN, runs=FAILED):
    cands = candidates(spark, {**row, "id": "c"})
    results = spark.createDataFrame(runs, schemas.EXEC_RESULTS)
    checks = validate_candidates(cands, files(spark, "c", entries=entries), domain, results)
    return C.deterministic_verdict(checks).first()


def test_clean_candidate_is_accepted(spark):
    got = verdict(spark, candidate())
    assert (got["verdict"], got["route_code"], got["subcodes"]) == ("accept", "accept", [])


MUTATIONS = {
    "control character": (candidate(case={"prompt": "Debug the worker​ and explain the patch"}), "reject_schema", "malformed_text"),
    "escaped control character": (candidate(case={"setup": "a\u0007b"}), "reject_schema", "malformed_text"),
    "short prompt": (candidate(case={"prompt": "short"}), "reject_schema", "schema_violation"),
    "no environment": (candidate(env=None), "reject_schema", "missing_workspace"),
    "other environment": (candidate(env={"kind": "text_only", "payload": {}}), "reject_schema", "missing_workspace"),
    "no runtime": (candidate(runtime=None), "reject_schema", "missing_runtime_requirements"),
    "bad image": (
        candidate(runtime={**RUNTIME, "execution": {"mode": "container", "base_image": "python:2.7"}}),
        "reject_schema",
        "unsupported_runtime_requirements",
    ),
    "bad network": (candidate(runtime={**RUNTIME, "network": "open"}), "reject_schema", "unsupported_runtime_requirements"),
    "foreign package": (
        candidate(runtime={**RUNTIME, "dependencies": {"policy": "none", "packages": ["numpy"]}}),
        "reject_schema",
        "unsupported_runtime_requirements",
    ),
    "no command": (candidate(runtime={**RUNTIME, "commands": {}}), "reject_schema", "missing_runtime_requirements"),
    "other command": (candidate(runtime={**RUNTIME, "commands": {"test": "pytest"}}), "reject_schema", "runtime_contract_mismatch"),
    "leak in nested input": (
        candidate(case={"inputs": {"notes": ["fine", "The ROOT CAUSE: sign"]}}),
        "reject_leakage",
        "answer_leak_root_cause_disclosure",
    ),
    "unknown scenario": (candidate(cell={"scenario": "mystery"}), "reject_coverage_mismatch", "unknown_scenario"),
    "unknown case type": (candidate(cell={"case_type": "other"}), "reject_coverage_mismatch", "unknown_case_type"),
    "short proxy": (candidate(judge={"proxy_claim": "too short"}), "reject_criteria_mismatch", "weak_proxy_validity"),
    "one pressure": (candidate(judge={"diagnostic_pressure": ["x"]}), "reject_criteria_mismatch", "weak_diagnostic_pressure"),
    "no risks": (candidate(judge={"leakage_risks": []}), "reject_leakage", "shortcut_leakage"),
    "no limits": (candidate(judge={"known_limits": []}), "reject_criteria_mismatch", "missing_known_limits"),
    "no control": (candidate(judge={"negative_controls": []}), "reject_criteria_mismatch", "missing_negative_control"),
    "no score type": (candidate(judge={"score_x": {**JUDGE["score_x"], "score_type": ""}}), "reject_criteria_mismatch", "unreliable_score"),
    "no dimensions": (candidate(judge={"score_x": {"score_type": "r", "dimensions": []}}), "reject_criteria_mismatch", "unreliable_score"),
    "no penalties": (
        candidate(judge={"scoring_contract": {"credit": ["a"], "penalties": []}}),
        "reject_criteria_mismatch",
        "vague_scoring_contract",
    ),
    "no ability": (candidate(ability_z="{}"), "reject_criteria_mismatch", "weak_proxy_validity"),
    "no environment name": (candidate(environment_y='{"name":""}'), "reject_criteria_mismatch", "irrelevant_environment"),
}


def test_one_failing_mutation_per_rule(spark):
    rows = [{**row, "id": name} for name, (row, _, _) in MUTATIONS.items()]
    cands = candidates(spark, *rows)
    runs = spark.createDataFrame([(n, *FAILED[0][1:]) for n in MUTATIONS], schemas.EXEC_RESULTS)
    checks = validate_candidates(cands, files(spark, *MUTATIONS), DOMAIN, runs)
    got = {r["candidate_id"]: (r["route_code"], r["subcodes"]) for r in C.deterministic_verdict(checks).collect()}
    assert got == {name: (route, [code]) for name, (_, route, code) in MUTATIONS.items()}


FILE_MUTATIONS = {
    "missing_workspace": FILES[:2],
    "invalid_workspace_path": [*FILES, ("../x.py", "pass")],
    "duplicate_workspace_path": [*FILES, ("billing/sums.py", "pass")],
    "invalid_workspace_file": [*FILES, ("empty.py", "  \n")],
    "placeholder_workspace_file": [*FILES, ("todo.py", "# TODO")],
}


@pytest.mark.parametrize("code", FILE_MUTATIONS)
def test_workspace_rules(spark, code):
    got = W.check_workspace(spark.createDataFrame([("c",)], "id string"), files(spark, "c", entries=FILE_MUTATIONS[code])).first()
    assert (got["passed"], got["subcode"]) == (False, code)


def test_workspace_accepts_empty_package_marker_and_reports_first_bad_file(spark):
    ids = spark.createDataFrame([("c",)], "id string")
    assert W.check_workspace(ids, files(spark, "c", entries=[*FILES, ("billing/__init__.py", "")])).first()["passed"]
    two = W.check_workspace(ids, files(spark, "c", entries=[*FILES, ("/abs.py", "x"), ("todo.py", "tbd")])).first()
    assert two["evidence"][0]["path"] == "environment_artifact.payload.files.3.path"


def test_recorded_runs(spark):
    many = "".join(f"FAILED tests/t{i}.py::a\n" for i in range(3))
    rows = [
        ("fails as wanted", 1, "FAILED tests/a.py::x", "", False),
        ("too many files", 1, many, "", False),
        ("already passes", 0, "1 passed", "", False),
        ("collection error", 2, "", "boom", False),
        ("timeout", None, "", "", True),
    ]
    got = {r["candidate_id"]: r for r in C.check_exec_results(spark.createDataFrame(rows, schemas.EXEC_RESULTS), DOMAIN).collect()}
    assert {k: v["subcode"] for k, v in got.items()} == {
        "fails as wanted": None,
        "too many files": "workspace_test_command_failed",
        "already passes": "workspace_tests_do_not_reproduce_failure",
        "collection error": "workspace_test_command_failed",
        "timeout": "workspace_test_timeout",
    }
    assert got["fails as wanted"]["evidence"][0]["value"] == "FAILED tests/a.py::x"
    assert "tests/t0.py, tests/t1.py, tests/t2.py" in got["too many files"]["evidence"][0]["value"]


def test_long_output_is_cut(spark):
    row = spark.createDataFrame([("x" * 2000, "")], "o string, e string").select(C.command_output(F.col("o"), F.col("e"))).first()
    assert row[0] == "x" * 1600 + "\n...[truncated]"


def test_hygiene_evidence_is_the_first_path_in_document_order(spark):
    doc = '{"a":["ok","b\\u200bad"],"k\\u0000ey":1,"z":"\\u00ad"}'
    got = C.check_text_hygiene(spark.createDataFrame([("d", doc)], "id string, body string"), "body").first()
    assert got["evidence"][0]["path"] == "candidate.a[1]"
    assert got["evidence"][0]["value"] == "U+200B ZERO WIDTH SPACE"
    keyed = '{"k\\u0000ey":1}'
    key = C.check_text_hygiene(spark.createDataFrame([("d", keyed)], "id string, body string"), "body").first()
    assert key["evidence"][0]["value"] == "U+0000 UNKNOWN"


def test_leak_order_is_text_then_marker(spark):
    row = candidate(case={"prompt": "see the starter code, then the intended fix, please"})
    cands = candidates(spark, row)
    tree = files(spark, "c1", entries=[*FILES, ("a_note.md", "BUG: here")])
    hit = L.leak_hits(L.candidate_texts(cands, tree)).first()
    assert (hit["path"], hit["subcode"]) == ("benchmark_case.prompt", "answer_leak_fix_instruction")
    clean = candidates(spark, candidate())
    late = L.leak_hits(L.candidate_texts(clean, tree)).first()
    assert (late["path"], late["subcode"]) == ("environment_artifact.workspace.a_note.md", "answer_leak_explicit_bug_label")


def test_passages_match_brute_force(spark):
    import random

    rng = random.Random(7)
    words = ["ab", "abc", "b", "cab", "ba", "aa"]
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 12)))) for i in range(60)]
    passages = [(i, p) for i, p in enumerate(["ab", "b c", "a", "ab abc", "b ba aa", "ba b cab", "zz zz zz", "aa aa aa aa", "Cab", " b", "a ", " ab c", "b cab ba a", "", "  "])]
    expect = {(i, j) for i, t in texts for j, p in passages if p.strip() and p.lower() in t.lower()}
    got = L.passage_hits(spark.createDataFrame(texts, "id int, text string"), spark.createDataFrame(passages, "passage_id int, passage string"))
    rows = [(r["id"], r["passage_id"]) for r in got.collect()]
    assert set(rows) == expect and len(rows) == len(expect)


def test_marker_tables_of_any_size_give_the_first_marker(spark):
    texts = [("c", (1, "second holds m90 and m70")), ("c", (0, "first holds M99 then m80")), ("d", (0, "nothing")), ("e", (0, "a m070x b"))]
    rows = [(c, {"section": 0, "ord": o, "file": "", "part": 0}, f"p{o}", t) for c, (o, t) in texts]
    frame = spark.createDataFrame(rows, "candidate_id string, text_key struct<section:int,ord:int,file:string,part:int>, path string, text string")
    markers = [(f"s{i}", f"m{i}") for i in range(100)] + [("blank", " ")]
    table = spark.createDataFrame([(i, s, p) for i, (s, p) in enumerate(markers)], "ord int, subcode string, pattern string")
    got = {r["candidate_id"]: (r["path"], r["subcode"]) for r in L.leak_hits(frame, table).collect()}
    assert got == {"c": ("p0", "s8"), "e": ("p0", "s0")}
    assert got == {r["candidate_id"]: (r["path"], r["subcode"]) for r in L.leak_hits(frame, markers[:-1]).collect()}


def design(ident, ord_, **over):
    cell = {"case_type": "proxy_strong", "difficulty": 2, "scenario": "nominal", **over.pop("cell", {})}
    row = {f.name: None for f in schemas.DESIGNS.fields}
    premise = {
        f: "stateful worker"
        for f in (
            "product_context", "codebase_shape", "state_model", "core_invariant", "failure_surface", "tempting_wrong_fix",
            "actual_causal_region", "required_depth",
        )
    }
    import json

    row.update({f.name: ["x"] for f in schemas.DESIGNS.fields if f.dataType == schemas.STRINGS})
    row.update(id=ident, ord=ord_, cell=cell, content_hash=ident, environment_premise=json.dumps(premise), runtime_requirements=json.dumps(RUNTIME))
    row.update(over)
    return row


def test_partition_keeps_first_valid_design(spark):
    rows = [
        design("bad-first", 0, content_hash="h", cell={"scenario": "mystery"}),
        design("good", 1, content_hash="h"),
        design("again", 2, content_hash="h"),
        design("bad-again", 3, content_hash="h", cell={"difficulty": 9}),
        design("toy", 4, environment_premise='{"product_context":"a typo"}'),
        design("other", 5),
    ]
    got = C.partition_designs(spark.createDataFrame(rows, schemas.DESIGNS), DOMAIN)
    assert {r["id"]: r["subcode"] for r in got.collect()} == {
        "bad-first": "unknown_scenario",
        "good": None,
        "again": "duplicate_design",
        "bad-again": "duplicate_design",
        "toy": "weak_diagnostic_pressure",
        "other": None,
    }


def test_gate_verdicts_are_made_consistent(spark):
    rows = [
        ("a", "accept", "accept", ["weak_proxy_validity"], []),
        ("b", "accept", "accept", ["answer_leak_fix_instruction"], [("candidate", "prompt", "x")]),
        ("c", "accept", "accept", ["answer_leak_fix_instruction"], [("rubric", "judge_artifact.x", "x")]),
        ("d", "maybe", "nonsense", [], []),
        ("e", "reject", "reject_leakage", ["unreliable_score"], []),
    ]
    df = spark.createDataFrame(
        rows, "id string, verdict string, route_code string, subcodes array<string>, evidence array<struct<source:string,path:string,value:string>>"
    )
    got = {r["id"]: (r["verdict"], r["route_code"]) for r in C.coerce_gate_verdicts(C.sanitize_leak_claims(df)).collect()}
    assert got == {
        "a": ("reject", "reject_semantic_mismatch"),
        "b": ("reject", "reject_leakage"),
        "c": ("accept", "accept"),
        "d": ("reject", "reject_semantic_mismatch"),
        "e": ("reject", "reject_semantic_mismatch"),
    }


def test_private_leak_claims_are_relabelled(spark):
    attack = lambda kind, evidence: (("target", kind, "", evidence, "high", ""),)
    rows = [("a", attack("answer_leakage", "README names it")), ("b", attack("answer_leakage", "score_x in README")), ("c", attack("answer_leakage", "the proxy"))]
    df = spark.createDataFrame([(i, list(a)) for i, a in rows], "id string, attacks array<" + schemas.ATTACK.simpleString() + ">")
    got = {r["id"]: r["attacks"][0]["attack_type"] for r in C.sanitize_attacks(df).collect()}
    assert got == {"a": "answer_leakage", "b": "scoring_ambiguity", "c": "proxy_overclaim"}
    assert CASE
