import json

import pytest
from pyspark.sql import functions as F

from casemill import fixed, schemas
from casemill.operators import audit as U
from casemill.operators import grade as G
from casemill.operators import joins as J
from casemill.operators import workspace as W

EXPOSURE = {"revenue_at_risk": 100, "affected_orders": ["SO-1"], "affected_customers": ["Acme"], "constrained_inventory": True}
EXPECTED = {
    "id": "T1", "source_headlines": ["H01"], "required_concepts": ["resin", "flux", "solder"],
    "hidden_dependency_path": ["rosin", "ASM-1"], "business_exposure": EXPOSURE,
}
ALERT = {
    "id": "a1", "confidence": "low", "source_headlines": ["H01"], "latent_edge_hypothesis": "Resin and flux shortage",
    "real_world_prior": "", "enterprise_path": ["Rosin paste", "ASM-1"], "business_exposure": EXPOSURE, "reasoning": "",
    "citations": {"headlines": ["H01"], "records": ["records/bom.yaml"]}, "uncertainty": ["not confirmed"],
}
OTHER = {**ALERT, "id": "a2", "source_headlines": ["H09"], "enterprise_path": [], "latent_edge_hypothesis": "x", "uncertainty": []}


def scan(alerts, result="alerts_found", rationale=None):
    return {"scan": {"run_id": "k", "result": result, "alerts": alerts, "no_alert_rationale": rationale}}


SCANS = {
    "exact": (scan([ALERT]), False, 1.0, True, 0),
    "extra alert": (scan([OTHER, ALERT]), False, 0.8, False, 1),
    "wrong revenue": (scan([{**ALERT, "business_exposure": {**EXPOSURE, "revenue_at_risk": 1}}]), False, 0.85, False, 0),
    "more orders than needed": (
        scan([{**ALERT, "business_exposure": {**EXPOSURE, "affected_orders": ["SO-1", "SO-2"]}}]), False, 1.0, True, 0,
    ),
    "no hedging": (scan([{**ALERT, "uncertainty": ["sure"], "latent_edge_hypothesis": "resin flux"}]), False, 0.95, True, 0),
    "invented record": (scan([{**ALERT, "citations": {"headlines": ["H01"], "records": ["memo"]}}]), False, 0.0, False, 0),
    "silent": (scan([], "no_alert", "none"), False, 0.0, False, 0),
    "broken": ({"scan": {"run_id": "k"}}, False, 0.0, False, 0),
    "zero and silent": (scan([], "no_alert", "none"), True, 1.0, True, 0),
    "zero without reason": (scan([], "no_alert"), True, 0.85, True, 0),
    "zero with alert": (scan([ALERT]), True, 0.0, False, 1),
}


def scan_frames(spark):
    raw = spark.createDataFrame([(k, json.dumps(v[0])) for k, v in SCANS.items()], "case_id string, raw string")
    oracles = spark.createDataFrame([(k, v[1], [] if v[1] else [EXPECTED]) for k, v in SCANS.items()], schemas.SCAN_ORACLES)
    return G.parse_scans(raw), oracles


def test_scan_grades(spark):
    got = {r["case_id"]: r for r in G.grade_scans(*scan_frames(spark)).collect()}
    for name, (_, _, score, passed, extra) in SCANS.items():
        assert (got[name]["score"], got[name]["passed"], got[name]["false_positive_count"]) == (score, passed, extra), name
    assert got["broken"]["schema_violation"] and got["invented record"]["invented_company_record"]


def test_simple_grade_looks_at_the_first_alert_only(spark):
    got = {r["case_id"]: r for r in G.grade_scans_simple(*scan_frames(spark)).collect()}
    assert got["exact"]["score"] == 1.0 and got["no hedging"]["score"] == 1.0
    assert got["extra alert"]["false_positive_count"] == 1 and not got["extra alert"]["passed"]
    assert got["silent"]["score"] == 0.0 and got["zero and silent"]["passed"]


def test_best_match_prefers_the_first_alert_on_ties(spark):
    raw = spark.createDataFrame([("k", json.dumps(scan([{**ALERT, "id": "b"}, ALERT])))], "case_id string, raw string")
    oracles = spark.createDataFrame([("k", False, [EXPECTED])], schemas.SCAN_ORACLES)
    best = G.best_alert_match(G.parse_scans(raw), oracles).first()
    assert (best["submitted_alert_id"], best["match_score"], best["matched"]) == ("b", 6, True)
    assert G.false_positives(G.parse_scans(raw), oracles).count() == 0


ANSWER = {
    "decision": "hold", "primary_reason": "The bank account changed", "required_next_step": ["call the vendor"],
    "evidence": [
        {"key": "result.amount", "source": "records/invoice.json", "value": 1},
        {"key": "audit.change_history.result.bank", "source": "", "value": "new"},
    ],
    "confidence": 0.8, "memo_summary": "The account changed last week.",
}


def test_decision_grades(spark):
    answers = {
        "good": ANSWER,
        "wrong": {**ANSWER, "decision": "approve"},
        "forbidden": {**ANSWER, "memo_summary": "We simply TRUST THE EMAIL thread."},
        "missing": {**ANSWER, "evidence": [{**ANSWER["evidence"][0]}] * 2},
        "blank step": {**ANSWER, "required_next_step": ["        "]},
        "invalid": {**ANSWER, "extra": 1},
    }
    raw = spark.createDataFrame([(k, json.dumps({"output": v})) for k, v in answers.items()], "case_id string, raw string")
    oracles = spark.createDataFrame(
        [(k, "hold", ["invoice.amount", "audit_vendor.change_history.bank"], ["trust the email"]) for k in answers], schemas.VENDOR_ORACLES
    )
    got = {r["case_id"]: (r["score"], r["passed"]) for r in G.grade_vendor(G.parse_decisions(raw), oracles).collect()}
    assert got == {
        "good": (1.0, True), "wrong": (0.55, False), "forbidden": (1.0, False), "missing": (0.825, False),
        "blank step": (0.85, True), "invalid": (0.0, False),
    }


def test_exposure_counts_entities_as_products(spark):
    boms = spark.createDataFrame(
        [("P1", [("C1", ["I1", "I2"])]), ("P2", [("C2", [])]), ("P3", [("C3", ["I1"])])],
        "product_id string, components array<struct<component_id:string,inputs:array<string>>>",
    )
    orders = spark.createDataFrame(
        [("o1", "Acme", "P1", 5, 10, "open"), ("o2", "Bolt", "P3", 1, 7, "open"), ("o3", "Acme", "P1", 9, 10, "closed"), ("o4", "Cog", "P2", 2, 3, "open")],
        "id string, customer string, product_id string, quantity bigint, unit_revenue bigint, status string",
    )
    stock = spark.createDataFrame([("P1", 2), ("P1", 3), ("P3", 9)], "product_id string, quantity_available bigint")
    asks = spark.createDataFrame([("r", "I1"), ("s", "P2"), ("t", "none")], "request_id string, entity_id string")
    links = J.bom_links(boms)
    got = {r["request_id"]: tuple(r)[1:] for r in J.calculate_exposure(asks, links, orders, stock).collect()}
    assert got == {"r": (3, 2, 57, False), "s": (1, 1, 6, True), "t": (1, 0, 0, False)}
    assert {tuple(r) for r in J.exposed_customers(asks, links, orders).collect()} == {("r", "Acme"), ("r", "Bolt"), ("s", "Cog")}
    assert J.exposed_orders(asks, links, orders).where("request_id = 'r'").count() == 2


def test_audit_views(spark):
    views = spark.createDataFrame(
        [("v1", "tax", '{"vendor_id":"v1"}'), ("v1", "other", '{"vendor_id":"v9"}'), ("v1", "plain", "[1]")], "vendor_id string, view string, result string"
    )
    asks = spark.createDataFrame([(1, "v1", "tax"), (2, "v1", "other"), (3, "v1", "none"), (4, "v1", "plain")], "request_id int, vendor_id string, view string")
    got = {r["request_id"]: r for r in J.audit_view(asks, views).collect()}
    assert [got[i]["status"] for i in (1, 2, 3, 4)] == ["result", "vendor_mismatch", "unknown_view", "result"]
    assert got[3]["available_views"] == ["other", "plain", "tax"]


def test_retry_guidance_keeps_order(spark):
    df = spark.createDataFrame([(["missing_oracle", "weak_proxy_validity", "private_oracle_integrity", "x"],)], "subcodes array<string>")
    row = J.retry_guidance(df).first()
    assert row["safe_subcodes"] == ["weak_judge_confidence", "weak_proxy_validity", "x"]
    assert row["guidance"] == [fixed.GENERATOR_GUIDANCE["weak_proxy_validity"]]
    design = J.retry_guidance(spark.createDataFrame([(["missing_runtime_requirements"],)], "subcodes array<string>"), fixed.DESIGN_GUIDANCE)
    assert len(design.first()["guidance"]) == 1


def patch(ident, *ops, case="{}", meta="{}"):
    full = [{"op": "edit_file", "old_text": None, "replace_all": False, "create_if_missing": False, **o} for o in ops]
    return (ident, case, meta, full, "why")


def test_revisions(spark):
    from fixtures import candidate, candidates

    edit = lambda old, new, **kw: {"path": "a.py", "old_text": old, "new_text": new, **kw}
    patches = {
        "chain": patch("chain", edit("one", "two"), edit("two\n", "three\n")),
        "all": patch("all", edit("x", "y", replace_all=True)),
        "create": patch("create", {"path": "b.py", "new_text": "new", "create_if_missing": True}, {"path": "b.py", "old_text": "new", "new_text": "newer"}),
        "meta": patch("meta", case='{"prompt":"changed"}', meta='{"known_limits":["n"]}'),
        "ambiguous": patch("ambiguous", edit("x", "y")),
        "no match": patch("no match", edit("absent", "y")),
        "second fails": patch("second fails", edit("one", "two"), edit("one", "z")),
        "exists": patch("exists", {"path": "a.py", "new_text": "n", "create_if_missing": True}),
        "escape": patch("escape", {"path": "../a.py", "old_text": "one", "new_text": "n"}),
        "nothing": patch("nothing"),
        "unknown key": patch("unknown key", case='{"oracle":{}}'),
        "placeholder": patch("placeholder", edit("one", "TODO")),
    }
    cands = candidates(spark, *[candidate(k, i) for i, k in enumerate(patches)])
    files = spark.createDataFrame([(k, 0, "a.py", "one\nx x\n") for k in patches], schemas.FILES)
    table = spark.createDataFrame(list(patches.values()), schemas.PATCHES)
    runtime = json.loads(candidate("x", 0)["agent_artifact"]["runtime_requirements"])
    same, other = json.dumps(dict(reversed(runtime.items()))), json.dumps({**runtime, "kind": "other"})
    stated = table.withColumn("runtime_requirements", F.lit(same)).withColumn("unknown_keys", F.array().cast("array<string>"))
    assert W.apply_revisions(cands, files, stated)[2].count() == 8
    refused = stated.withColumn("runtime_requirements", F.lit(other)).where("candidate_id = 'chain'")
    assert "runtime_requirements" in W.apply_revisions(cands, files, refused)[2].first()["error"]
    named = stated.withColumn("unknown_keys", F.array(F.lit("b"), F.lit("a"))).where("candidate_id = 'chain'")
    assert W.apply_revisions(cands, files, named)[2].first()["error"] == "unsupported patch keys: a, b"
    assert W.apply_revisions(cands.where("id <> 'chain'"), files, table)[2].where("candidate_id = 'chain'").count() == 1
    revised, tree, errors = W.apply_revisions(cands, files, table)
    assert {r["candidate_id"]: r["content"] for r in tree.where("path = 'a.py'").collect()} == {
        "chain": "three\nx x\n", "all": "one\ny y\n", "create": "one\nx x\n", "meta": "one\nx x\n",
    }
    assert tree.where("path = 'b.py'").first()["content"] == "newer"
    bad = {r["candidate_id"]: r["error"] for r in errors.collect()}
    assert set(bad) == {"ambiguous", "no match", "second fails", "exists", "escape", "nothing", "unknown key", "placeholder"}
    assert bad["second fails"] == "environment_ops.1.old_text did not match file" and "matched 2 times" in bad["ambiguous"]
    rows = {r["provenance"]["revision_of"]: r for r in revised.collect()}
    assert json.loads(rows["meta"]["agent_artifact"]["benchmark_case"])["prompt"] == "changed"
    assert rows["meta"]["judge_artifact"]["known_limits"] == ["n"] and rows["meta"]["id"] == "meta-rev"
    assert rows["meta"]["judge_artifact"]["proxy_claim"] and len(rows) == 4


def test_revision_metrics(spark):
    ops = [
        {"path": "a", "old_text": "éé", "new_text": "abc", "replace_all": True},
        {"path": "b", "new_text": "n", "create_if_missing": True},
        {"path": "a", "old_text": "x", "new_text": "y"},
    ]
    row = W.revision_metrics(spark.createDataFrame([patch("c", *ops), patch("none")], schemas.PATCHES)).orderBy("candidate_id").collect()
    got = row[0].asDict()
    assert (got["revision_bytes_added"], got["revision_bytes_removed"], got["revision_bytes_changed"]) == (5, 5, 10)
    assert (got["revision_files_touched_list"], got["revision_full_rewrite_count"], got["revision_replace_all_count"]) == (["a", "b"], 1, 1)
    assert got["revision_full_rewrite_ratio"] == pytest.approx(1 / 3) and row[1]["revision_full_rewrite_ratio"] == 0.0


def test_eval_prompt_and_search(spark):
    from fixtures import FILES, candidate, candidates, files

    cands = candidates(spark, candidate("c1"), candidate("c2", 1, env=None))
    got = {r["candidate_id"]: r["prompt"] for r in W.eval_prompts(cands, files(spark, "c1", "c2")).collect()}
    assert got["c2"] == "Debug the reconciliation worker and explain the patch."
    parts = got["c1"].split("\n\n")
    assert parts[0] == "SETUP\nA small service." and parts[1] == 'COMMANDS\n{\n  "test": "python -m pytest -q"\n}'
    assert parts[2] == "REPOSITORY FILES" and parts[3].startswith("--- billing/parser.py ---\n```python\ndef parse")
    assert got["c1"].endswith("BENCHMARK PROMPT\nDebug the reconciliation worker and explain the patch.")
    assert "refund" not in got["c1"]
    hits = W.search_records(files(spark, "c1", entries=FILES), "TOTAL").collect()
    assert {h["path"] for h in hits} == {"billing/sums.py", "tests/test_sums.py"}


PACK = "# External Event Feed\n# Date: x\n\n" + "".join(f"## H{i:02d}\nnews\n\n" for i in range(1, 9))
ORACLES = {
    "k1": {"true_alerts": [EXPECTED], "zero_alert_run": False},
    "k2": {"true_alerts": [EXPECTED], "zero_alert_run": False},
    "k3": {"true_alerts": [], "zero_alert_run": True, "note": "no current Exposure"},
    "k4": {"true_alerts": [], "zero_alert_run": True},
}


def case_frames(spark):
    ids = spark.createDataFrame([(k,) for k in ORACLES], "case_id string")
    oracles = spark.createDataFrame([(k, json.dumps(v)) for k, v in ORACLES.items()], "case_id string, oracle string")
    tree = [(k, p, PACK if p.endswith("pack.md") else "x") for k in ORACLES for p in fixed.REQUIRED_WORKSPACE_FILES]
    return ids, oracles, spark.createDataFrame(tree, "case_id string, path string, content string")


def test_corpus_and_workspace_audits(spark):
    ids, oracles, tree = case_frames(spark)
    assert U.audit_corpus(ids, oracles).count() == 0 and U.audit_workspaces(ids, tree).count() == 0
    few = oracles.where("case_id <> 'k3'")
    found = {(r["scope"], r["failure"]) for r in U.audit_corpus(ids.union(ids.limit(1)), few).collect()}
    assert ("k3", "task rows and hidden oracles differ") in found
    assert {"task rows contain duplicate ids", "corpus has fewer than four cases", "corpus has no explicit no-current-exposure control"} <= {f for _, f in found}
    spoiled = tree.where("case_id <> 'k4'").unionByName(
        spark.createDataFrame([("k1", "x/hidden-key.yaml", ""), ("k2", "evaluation/a.md", "")], tree.schema)
    ).withColumn(
        "content", F.when((F.col("case_id") == "k3") & (F.col("path") == "events/headline-pack.md"), F.lit("## H01\nSO-7731 late")).otherwise(F.col("content"))
    ).where("NOT (case_id = 'k2' AND path = 'records/bom.yaml')")
    found = {(r["scope"], r["failure"]) for r in U.audit_workspaces(ids, spoiled).collect()}
    assert found == {
        ("k4", "workspace missing"),
        ("k1", "hidden/evaluation file leaked into workspace x/hidden-key.yaml"),
        ("k2", "hidden/evaluation file leaked into workspace evaluation/a.md"),
        ("k2", "missing public workspace file records/bom.yaml"),
        ("k3", "headline pack has 1 items, expected 8-12"),
        ("k3", "headline pack leaks internal ids SO-7731"),
    }


def trial_frames(spark):
    run = lambda c: json.dumps({"command": f"python3 tools/risk_tools.py {c} "})
    events, trials = [], []
    for n, (case, variant) in enumerate((c, v) for c in ORACLES for v in fixed.VARIANTS):
        zero = ORACLES[case]["zero_alert_run"]
        answer = scan([], "no_alert", "r") if zero or variant == "baseline" else scan([ALERT])
        trials.append((n, case, variant, "0", zero or variant == "evidence_first", 1.0, json.dumps(answer), None))
        calls = ["read_headline_pack", "read_record x", "calculate_exposure --entity-id rosin", "submit_risk_scan y"]
        events += [(n, i, "tool_call_end", "Bash", run(c), '{"ok":1}') for i, c in enumerate(calls, 1)]
    oracles = spark.createDataFrame([(k, v["zero_alert_run"], v["true_alerts"]) for k, v in ORACLES.items()], schemas.SCAN_ORACLES)
    return spark.createDataFrame(trials, schemas.TRIALS), spark.createDataFrame(events, schemas.TRACE_EVENTS), oracles


def test_clean_experiment_verifies_and_faults_surface(spark):
    ids, oracles, tree = case_frames(spark)
    trials, events, typed = trial_frames(spark)
    cases = ids.withColumn("benchmark_case", F.lit('{"prompt":"p"}'))
    schema = {"type": "object", "required": ["prompt"], "properties": {}}
    args = (cases, ids, oracles, tree, schema)
    assert U.verify_experiment(*args, trials, events, typed).count() == 0
    spoiled = (
        trials.where("trial <> 7")
        .withColumn("exit_status", F.when(F.col("trial") == 0, F.lit("1")).otherwise(F.col("exit_status")))
        .withColumn("passed", F.when(F.col("trial") == 1, F.lit(False)).otherwise(F.col("passed")))
    )
    noisy = events.where("NOT (trial = 3 AND line_no = 3)").unionByName(
        spark.createDataFrame([(2, 9, "tool_call_end", "Read", '{"path":"records/bom.yaml"}', "")], schemas.TRACE_EVENTS)
    )
    found = {(r["section"], r["scope"], r["failure"]) for r in U.verify_experiment(*args, spoiled, noisy, typed).collect()}
    assert found == {
        ("run", "run", "run has 7 trials, expected 8"),
        ("trial", "k1:baseline", "agent runtime failed"),
        ("trial", "k1:evidence_first", "evidence-first did not pass hidden oracle"),
        ("trial", "k2:baseline", "trace access violations: 1"),
        ("trial", "k2:evidence_first", "evidence-first trace did not call calculate_exposure"),
        ("trial", "k2:evidence_first", "evidence-first exposure call did not target expected dependency rosin"),
    }


def test_trials_meet_their_logs_once(spark):
    trials, events, typed = trial_frames(spark)
    schema = {"type": "object", "required": ["scan"], "properties": {"scan": {"type": "object"}}}
    odd = trials.withColumn("response", F.when(F.col("trial") == 0, F.lit(None)).when(F.col("trial") == 2, F.lit('{"scan":1}')).otherwise(F.col("response")))
    # a log of many repeated calls, one of none, and events of a trial nobody knows
    more = events.where("trial <> 4").unionByName(events.where("trial = 3").withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("x"))
    stray = events.where("trial = 1").withColumn("trial", F.lit(99))
    found = {(r["scope"], r["failure"]) for r in U.audit_trials(odd, typed, more.unionByName(stray), schema).collect()}
    assert found == {
        ("k1:baseline", "final response is not schema-valid"),
        ("k2:baseline", "final response is not schema-valid"),
        ("k3:baseline", "trace access violations: 1"),
        ("k3:baseline", "trace does not use required workspace API/read/submit path"),
    }
    assert U.audit_trials(trials.limit(0), typed, events).count() == 0
    assert U.audit_trials(trials, typed.where("case_id = 'k1'"), events.limit(0)).select("scope").distinct().count() == 2


def test_demo_artifact_pairs_variants(spark):
    trials, events, _ = trial_frames(spark)
    row = U.demo_artifact(trials, "k1").first()
    assert (row["baseline_label"], row["evidence_first_label"], row["diverges"]) == ("no_alert", "alert_found", True)
    assert (row["world_event"], row["final_result"], row["enterprise_path"]) == ("H01", "alerts_found", ["Rosin paste", "ASM-1"])
    assert U.demo_artifact(trials.where("variant = 'baseline'"), "k1").count() == 0
    per_trial = U.variant_artifact(trials, events).where("trial = 1").first()
    assert (per_trial["risk_tool_calls"], per_trial["exposure_calls"], per_trial["submit_calls"]) == (4, 1, 1)
    silent = U.trace_violations(events.where("trial > 0"), trials)
    assert [tuple(r) for r in silent.collect()] == [(0, 0, "missing events log")]


def test_workspace_audits_broadcast_no_file_table(spark):
    from casemill.operators.audit import audit_workspaces

    cases = spark.createDataFrame([("a",), ("b",), (None,)], "case_id string")
    files = spark.createDataFrame([("a", "events/headline-pack.md", "x")], "case_id string, path string, content string")
    found = audit_workspaces(cases, files)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(str(r.scope) for r in found.where("failure = 'workspace missing'").collect()) == ["None", "b"]


def test_scans_of_wrong_kinds_are_invalid(spark):
    from casemill.operators.grade import parse_scans

    alert = {k: [] for k in ("source_headlines", "enterprise_path", "uncertainty")}
    rows = ["null", "[]", '{"scan":[]}', '{"scan":{}}', '{"scan":{"alerts":{}}}', '{"scan":{"result":"no_alert","alerts":"x"}}', json.dumps({"scan": {"alerts": [alert]}})]
    df = spark.createDataFrame([(str(i), r) for i, r in enumerate(rows)] + [("n", None)], "case_id string, raw string")
    assert not any(r.schema_valid for r in parse_scans(df).collect())
