import json

from fixtures import DOMAIN, candidate, candidates, files
from test_checks import FAILED, design

from casemill import schemas
from casemill.plans.batch import BatchInputs, run_batch, run_batches
from casemill.operators.joins import join_gates
from casemill.operators.route import route

VERDICT = "candidate_id string, check_kind string, verdict string, route_code string, subcodes array<string>"


def test_retry_ceiling(spark):
    rows = [("validation", "reject", "reject_schema", 1), ("validation", "reject", "reject_schema", 2), ("generation", "reject", "retry_parse", 0),
            ("generation", "reject", "reject_schema", 0), ("curation", "reject", "reject_schema", 0), ("design", "accept", "accept", 0)]
    df = spark.createDataFrame(rows, "stage_kind string, verdict string, route_code string, retry_index int")
    got = [(r["next_stage"], r["context_policy_out"], r["terminal"], r["final_route"]) for r in route(df).collect()]
    assert got == [
        ("generation", "criteria_plus_route_code", False, "reject_schema"),
        (None, "fresh", True, "drop_retry_exhausted"),
        ("generation", "same_input_retry", False, "retry_parse"),
        (None, "fresh", True, "drop_retry_exhausted"),
        (None, "fresh", True, "reject_duplicate"),
        ("design_audit", "fresh", False, "accept"),
    ]


def test_plain_gate_rejects_become_caveats(spark):
    quality = spark.createDataFrame([("a", "quality", "reject", "reject_semantic_mismatch", ["x", "y"]), ("b", "quality", "reject", "retry_parse", [])], VERDICT)
    rubric = spark.createDataFrame([("a", "rubric", "reject", "reject_leakage", ["y", "z"]), ("b", "rubric", "accept", "accept", [])], VERDICT)
    got = {r["candidate_id"]: (r["verdict"], r["route_code"], r["subcodes"]) for r in join_gates(quality, rubric).collect()}
    assert got == {
        "a": ("accept", "accept", ["quality_gate_rejected", "x", "y", "rubric_gate_rejected", "z"]),
        "b": ("reject", "retry_parse", ["quality_gate_rejected"]),
    }


def test_one_pass_over_a_batch(spark):
    names = ["keep", "copy", "leak", "nuked", "revised", "badpatch", "gate", "late", "orphan", "silent", "unpatched", "ungated"]
    prompts = {n: f"Case {n}: find why the {n} ledger drifts from its {n} journal and repair {n} causes." for n in names}
    prompts["copy"] = prompts["keep"]
    prompts["leak"] = "The root cause: a sign. Please repair the ledger now."
    rows = [candidate(n, i, design=f"d-{n}", case={"prompt": prompts[n]}) for i, n in enumerate(names)]
    # vectors must differ beyond the shared template, so each case carries its own vocabulary
    for row in rows:
        body = json.loads(row["agent_artifact"]["benchmark_case"])
        body["setup"] = " ".join(f"{'keep' if row['id'] == 'copy' else row['id']}{i}" for i in range(400))
        row["agent_artifact"]["benchmark_case"] = json.dumps(body)
    designs = [design(f"d-{n}", i) for i, n in enumerate(names) if n != "orphan"] + [design("d-dup", 50, content_hash="d-keep")]
    dispositions = {"nuked": "nuke", "revised": "revise", "badpatch": "revise", "unpatched": "revise"}
    reports = spark.createDataFrame([(n, dispositions.get(n, "pass")) for n in names if n != "silent"], "candidate_id string, revision_disposition string")
    edit = [{"op": "edit_file", "path": "billing/sums.py", "old_text": "abs(r)", "new_text": "r", "replace_all": False, "create_if_missing": False}]
    wrong = [{**edit[0], "old_text": "absent"}]
    patches = spark.createDataFrame([("revised", "{}", "{}", edit, "w"), ("badpatch", "{}", "{}", wrong, "w")], schemas.PATCHES)
    ready = ["keep", "copy", "revised-rev", "gate", "late"]
    quality = spark.createDataFrame([(n, "quality", "accept", "accept", []) for n in ready], VERDICT)
    rubric = spark.createDataFrame(
        [(n, "rubric", "reject", "retry_infra" if n == "gate" else "reject_semantic_mismatch", ["vague"]) for n in ready], VERDICT
    )
    runs = spark.createDataFrame([(n, *FAILED[0][1:]) for n in [*names, "revised-rev"]], schemas.EXEC_RESULTS)
    out = run_batch(
        BatchInputs("run", spark.createDataFrame(designs, schemas.DESIGNS), candidates(spark, *rows), files(spark, *names), reports, quality, rubric,
                    patches=patches, exec_results=runs, target_n=2),
        DOMAIN,
    )
    corpus = {r["id"]: r for r in out.corpus.collect()}
    assert set(corpus) == {"keep", "revised-rev"}  # "late" comes after the target was met
    assert corpus["keep"]["nn_distance"] is None and corpus["revised-rev"]["nn_distance"] > 0.08
    assert corpus["keep"]["caveats"] == ["rubric_gate_rejected", "vague"]
    found = {(r["design_id"], r["candidate_id"], r["route_code"]): r for r in out.decisions.collect()}
    assert found["d-dup", None, "reject_duplicate"]["terminal"]
    assert found["d-leak", "leak", "reject_leakage"]["next_stage"] == "generation"
    assert found["d-leak", "leak", "reject_leakage"]["guidance"]
    assert found["d-nuked", "nuked", "reject_semantic_mismatch"]["subcodes"] == ["adversary_nuke"]
    assert found["d-badpatch", "badpatch", "retry_parse"]["context_policy"] == "same_input_retry"
    assert found["d-gate", "gate", "retry_infra"]["from_stage"] == "validation"
    assert found["d-copy", "copy", "reject_duplicate"]["terminal"]
    assert found["d-keep", "keep", "accept"]["from_stage"] == "curation"
    assert found["d-orphan", "orphan", "reject_schema"]["terminal"]
    assert found["d-silent", "silent", "retry_provider_empty"]["context_policy"] == "same_input_retry"
    assert found["d-unpatched", "unpatched", "retry_provider_empty"]["subcodes"] == ["provider_error"]
    assert found["d-ungated", "ungated", "retry_provider_empty"]["from_stage"] == "validation"
    assert found["d-late", "late", "queue_full"]["verdict"] == "open"
    # every candidate leaves exactly one row that ends it here
    ends = [r for r in out.decisions.collect() if r["candidate_id"] and (r["verdict"] != "accept" or r["from_stage"] == "curation")]
    assert sorted(r["candidate_id"].removesuffix("-rev") for r in ends) == sorted(names)
    assert out.index_rows.count() == 2 and out.coverage.first()["n"] == 2
    assert out.rejections.count() == 10
    assert {r["candidate"]["id"] for r in out.committed.collect()} == {"keep", "revised-rev"}
    assert out.stage_records.count() == out.decisions.count() and out.snapshots.count() == len(names) - 1
    assert out.envelopes.count() == len(designs)
    kinds = {r["check_kind"]: r["n"] for r in out.validation.groupBy("check_kind").count().withColumnRenamed("count", "n").collect()}
    assert kinds["deterministic"] == 12 and kinds["quality"] == 5 and kinds["curation"] >= 3


def test_rejected_candidates_go_round_until_they_end(spark):
    def inputs(names, target, **prompts):
        rows = []
        for i, n in enumerate(names):
            design_name, word = n.split("-")[0], prompts.get(n.replace("-", "_"), n)
            row = candidate(n, i, design=f"d-{design_name}", case={"prompt": f"Case {word}: find why the {word} ledger drifts from its journal and repair it."})
            if word == "leak":
                row = candidate(n, i, design=f"d-{design_name}", case={"prompt": "The root cause: a sign. Please repair the ledger now."})
            body = json.loads(row["agent_artifact"]["benchmark_case"])
            body["setup"] = " ".join(f"{word}{j}" for j in range(400))
            row["agent_artifact"]["benchmark_case"] = json.dumps(body)
            rows.append(row)
        ids = [(n,) for n in names]
        accept = lambda kind: spark.createDataFrame([(n, kind, "accept", "accept", []) for n, in ids], VERDICT)
        return BatchInputs(
            "run", spark.createDataFrame([design(f"d-{n}", i) for i, n in enumerate(["good", "mended", "copied", "hopeless"])], schemas.DESIGNS),
            candidates(spark, *rows), files(spark, *names), spark.createDataFrame([(n, "pass") for n in names], "candidate_id string, revision_disposition string"),
            accept("quality"), accept("rubric"), exec_results=spark.createDataFrame([(n, *FAILED[0][1:]) for n in names], schemas.EXEC_RESULTS), target_n=target,
        )

    first = lambda target: inputs(["good", "mended", "copied", "hopeless"], target, mended="leak", copied="leak", hopeless="leak")
    asked = []

    def regenerate(open_rows, turn):
        asked.append(sorted(r["design_id"] for r in open_rows.collect()))
        # "good" is not open: what comes for it is left out
        return inputs([f"{n}-{turn}" for n in ("good", "mended", "copied", "hopeless")], None, copied_1="good", **{f"hopeless_{turn}": "leak"})

    out = run_batches(first(None), DOMAIN, regenerate)
    assert asked == [["d-copied", "d-hopeless", "d-mended"], ["d-hopeless"]]
    assert {r["id"]: r["retry_index"] for r in out.corpus.collect()} == {"good": 0, "mended-1": 1}
    assert sorted(r["candidate_id"] for r in out.index_rows.collect()) == ["good", "mended-1"]
    ends = {r["candidate_id"]: (r["route_code"], r["retry_index"]) for r in out.rejections.where("terminal").collect()}
    assert ends == {"copied-1": ("reject_duplicate", 1), "hopeless-2": ("drop_retry_exhausted", 2)}
    assert out.coverage.first()["n"] == 2 and out.envelopes.count() == 4 and out.snapshots.count() == 4 + 3 + 1

    asked.clear()
    out = run_batches(first(1), DOMAIN, regenerate)
    assert asked == [] and [r["id"] for r in out.corpus.collect()] == ["good"]
