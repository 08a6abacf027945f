import json
import threading

import pytest
from fixtures import CASE, candidate, candidates
from pyspark.sql import functions as F

from casemill import schemas
from casemill.operators import project as P
from casemill.operators.metrics import compare_variants, merge_coverage, pointer, pointer_metrics, select_cases
from casemill.plans.reports import perf_report, run_report
from casemill.sources import artifacts as A
from casemill.sources import cases as K
from casemill.sources import headlines as H
from casemill.sources import lines
from casemill.streaming import streams as T

STAGE = {"run_id": "r", "role": "audit_design", "stage_kind": "design_audit", "verdict": "accept", "route_code": "accept", "latency_ms": 5}


def write_lines(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))


def test_missing_log_is_empty_blank_lines_skip_and_bad_lines_fail(spark, tmp_path):
    root = str(tmp_path)
    assert A.read_artifact(spark, root, "stage_records", "r").count() == 0
    write_lines(tmp_path / "r" / "stage_records.jsonl", [STAGE, "", STAGE])
    assert A.read_artifact(spark, root, "stage_records", "r").count() == 2
    write_lines(tmp_path / "bad" / "stage_records.jsonl", ["{oops"])
    with pytest.raises(Exception):
        A.read_artifact(spark, root, "stage_records", "bad").collect()


def test_scan_runs_tags_rows_and_skips_runs_without_a_stage_log(spark, tmp_path):
    event = {"run_id": "x", "stage_event": "model_request_body", "body_bytes": 3}
    write_lines(tmp_path / "r1" / "stage_records.jsonl", [STAGE])
    write_lines(tmp_path / "r1" / "stage_events.jsonl", [event])
    write_lines(tmp_path / "r2" / "stage_records.jsonl", [STAGE, STAGE])
    write_lines(tmp_path / "r3" / "stage_events.jsonl", [event, event])
    records, events = A.scan_runs(spark, str(tmp_path), all_runs=True)
    assert {r["_run_id"]: r["count"] for r in records.groupBy("_run_id").count().collect()} == {"r1": 1, "r2": 2}
    assert [r["_run_id"] for r in events.collect()] == ["r1"]
    one, _ = A.scan_runs(spark, str(tmp_path), run_id="r2")
    assert one.count() == 2
    none, _ = A.scan_runs(spark, str(tmp_path))
    assert none.count() == 0
    report = perf_report(records.withColumn("ord", F.lit(0)), events, run_col="_run_id")
    assert report["totals"].first()["runs"] == 2 and report["request_sizes"].first()["total_bytes"] == 3
    assert report["by_role"].first()["median_ms"] == 5 and report["slowest"].count() == 3


def test_lenient_events_keep_line_numbers(spark, tmp_path):
    write_lines(tmp_path / "trial_1" / "events.jsonl", ['{"event_type":"a"}', "{oops", '{"event_type":"b"}'])
    got = A.read_events_lenient(spark, str(tmp_path / "trial_1" / "events.jsonl"))
    rows = got.select("line_no", F.variant_get("event", "$.event_type", "string").alias("t")).orderBy("line_no").collect()
    assert [tuple(r) for r in rows] == [(1, "a"), (3, "b")]
    assert A.read_events_lenient(spark, str(tmp_path / "none.jsonl")).count() == 0


def test_lines_are_numbered_across_splits(spark, tmp_path):
    lines = [f'{{"n": {n}, "pad": "{"x" * (n % 50)}"}}' if n % 7 else "no json" for n in range(1, 4001)]
    write_lines(tmp_path / "a.jsonl", lines)
    got = A.read_events_lenient(spark, str(tmp_path / "a.jsonl"), split=2**14)
    rows = got.select("line_no", F.variant_get("event", "$.n", "int").alias("n")).collect()
    assert sorted((r["line_no"], r["n"]) for r in rows) == [(n, n) for n in range(1, 4001) if n % 7]


def test_appended_logs_are_found(spark, tmp_path):
    root = str(tmp_path)
    records = spark.createDataFrame([("r1", "accept"), ("7", "reject")], "run_id string, verdict string")
    A.append_artifact(records, root, "stage_records")
    A.append_artifact(spark.createDataFrame([("r1", 3), ("r9", 4)], "run_id string, body_bytes bigint"), root, "stage_events")
    write_lines(tmp_path / "r2" / "stage_records.jsonl", [STAGE])
    found, events = A.scan_runs(spark, root, all_runs=True)
    assert sorted(r["_run_id"] for r in found.collect()) == ["7", "r1", "r2"]
    assert [(r["_run_id"], r["body_bytes"]) for r in events.collect()] == [("r1", 3)]
    assert A.scan_runs(spark, root, run_id="7")[0].count() == 1
    assert A.read_artifact(spark, root, "stage_records", "r1").first()["run_id"] == "r1"


def test_trials_join_in_numeric_order(spark, tmp_path):
    for n in (2, 10):
        base = tmp_path / "trials" / f"trial_{n}"
        write_lines(base / "summary.json", [{"ids": {"task_id": f"case{n}", "variant_id": "baseline"}, "agent": {"exit_status": 0}}])
        write_lines(base / "grader" / "mapped_output.json", [{"payload": {"pass_rate": 1 if n == 2 else 0, "score": 0.5}}])
        write_lines(base / "agent" / "result.json", [{"response": '{"scan":{}}'}])
    got = A.read_trials(spark, str(tmp_path)).orderBy("trial").collect()
    assert [(r["trial"], r["case_id"], r["passed"], r["exit_status"]) for r in got] == [(2, "case2", True, "0"), (10, "case10", False, "0")]
    assert got[0]["response"] == '{"scan":{}}'


def test_append_guarded_write_and_overwrite(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([("r1", "accept"), ("r2", "reject")], "run_id string, verdict string")
    A.append_artifact(rows, root, "validation")
    A.append_artifact(rows, root, "validation")
    assert A.read_appended(spark, root, "validation").count() == 4
    assert A.read_appended(spark, root, "adversary").count() == 0
    out = f"{root}/corpus"
    A.write_run(rows, out, "r1")
    A.write_run(rows.limit(1), out, "r2")
    with pytest.raises(A.RunExists):
        A.write_run(rows, out, "r1")
    A.write_run(rows.limit(1), out, "r1", overwrite=True)
    assert {r["run_id"]: r["count"] for r in A.read_run(spark, out).groupBy("run_id").count().collect()} == {"r1": 1, "r2": 1}
    assert A.read_run(spark, out, "r2").count() == 1 and A.read_run(spark, out, "none", "verdict string").count() == 0
    assert A.drop_superseded(spark, out) == 1 and A.drop_superseded(spark, out) == 0


def test_of_racing_writers_exactly_one_wins(spark, tmp_path):
    out, start, results = f"{tmp_path}/corpus", threading.Barrier(3), []

    def write(n):
        rows = spark.range(n).withColumn("writer", F.lit(n))
        start.wait()
        try:
            A.write_run(rows, out, "r", token=f"writer-{n}")
            results.append(n)
        except A.RunExists:
            results.append(0)

    threads = [threading.Thread(target=write, args=(n,)) for n in (1, 2, 3)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    (winner,) = [n for n in results if n]
    assert len(results) == 3 and [r["writer"] for r in A.read_run(spark, out).collect()] == [winner] * winner
    A.write_run(spark.range(9).withColumn("writer", F.lit(9)), out, "r", token=f"writer-{winner}")  # a replay
    assert A.read_run(spark, out).count() == winner and len(list((tmp_path / "corpus" / "run_id=r").iterdir())) == 1
    assert not A._publish(spark, f"{out}/_manifests/run_id=r/version=00000001.json", "{}")


def test_index_and_coverage_round_trip(spark, tmp_path):
    root = str(tmp_path)
    assert A.read_index(spark, root, "d").count() == 0 and A.coverage_snapshot(spark, root, "d").count() == 0
    rows = spark.createDataFrame([("e", "c", [1.0])], "embedding_ref string, candidate_id string, vector array<double>")
    A.append_index(rows, root, "d", batch="1")
    A.append_index(rows, root, "d", batch="1")
    A.append_index(rows, root, "d", batch="2")
    assert A.read_index(spark, root, "d").count() == 2
    commits = spark.createDataFrame([(("a", 1, "s"),)], "cell struct<case_type:string,difficulty:int,scenario:string>")
    for version in (1, 2):
        merged = merge_coverage(A.coverage_snapshot(spark, f"{root}/coverage", "d"), commits)
        A.write_coverage(merged, f"{root}/coverage", "d", version)
    assert [tuple(r) for r in A.coverage_snapshot(spark, f"{root}/coverage", "d").collect()] == [("a|1|s", 2)]


def test_headline_packs_round_trip(spark):
    rows = spark.createDataFrame([("c", ["one", "two\nlines", "three"])], "case_id string, items array<string>")
    packs = H.render_headlines(H.headline_rows(rows, "case_id", "items").withColumn("date", F.lit("2026-01-01")))
    assert packs.first()["pack"] == "# External Event Feed\n# Date: 2026-01-01\n\n## H01\none\n\n## H02\ntwo\nlines\n\n## H03\nthree\n"
    back = H.parse_headlines(packs).orderBy("headline_id").collect()
    assert [(r["headline_id"], r["date"], r["headline"]) for r in back][1] == ("H02", "2026-01-01", "two\nlines")


CASE_DOC = {
    "prompt": "task", "setup": "s", "inputs": {"vendor": "v", "amount": 3, "edge_classes": ["x"]},
    "environment": {"name": "e", "hidden_files": ["k"]}, "workspace": {"public": {"note": "text", "po": {"a": 1}}},
    "hidden_evaluation": {"true_alerts": [{"id": "a"}], "zero_alert_run": False}, "grader_contract": {"w": 1},
}


def test_case_set_splits_public_from_private(spark):
    schema = {"type": "object", "required": ["prompt"], "properties": {"prompt": {"type": "string"}}}
    cases = spark.createDataFrame([("k1", 3, "edge", json.dumps(CASE_DOC))], "case_id string, difficulty int, scenario string, benchmark_case string")
    corpus, public, oracles = K.build_case_set(cases, schema)
    assert corpus.first()["true_alert_count"] == 1
    row = public.first().asDict()
    assert json.loads(row["inputs"]) == {"vendor": "v", "amount": 3} and json.loads(row["environment"]) == {"name": "e"}
    assert "hidden" not in json.dumps(row) and json.loads(oracles.first()["grader_contract"]) == {"w": 1}
    tasks = K.trial_inputs(public, "go", ["a.md"]).first()
    assert tasks["case"]["vendor"] == "v" and tasks["case"]["amount"] == "3"
    tree = K.workspace_files(cases, {"note.md": "$.workspace.public.note", "po.json": "$.workspace.public.po", "no.md": "$.none"})
    assert {r["path"]: r["content"] for r in tree.collect()} == {"note.md": "text\n", "po.json": '{"a":1}\n'}
    bad = cases.withColumn("benchmark_case", F.lit("{}"))
    with pytest.raises(K.InvalidCase):
        K.build_case_set(bad, schema)


def test_role_views_hide_what_the_role_must_not_see(spark):
    cands = candidates(spark, candidate(judge={"leakage_risks": ["r"] * 9}))
    quality = P.role_view(cands, "quality").first()["view"].asDict(True)
    assert "evaluator_private_context" not in quality and set(quality) == {"agent_visible_artifact", "benchmark_context"}
    adversary = P.role_view(cands, "adversary").first()["view"].asDict(True)["evaluator_private_context"]["judge_artifact"]
    assert len(adversary["leakage_risks"]) == 4 and "expected_fix_properties" not in adversary
    assert "judge_artifact" in P.role_view(cands, "candidate").first()["view"]["evaluator_private_context"].asDict()
    report = spark.createDataFrame([("c1", "revise")], "candidate_id string, revision_disposition string")
    full = report.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.ADVERSARY_REPORTS.fields[2:]])
    assert "candidate_id" not in P.role_view(full, "report").first()["view"].asDict()
    with pytest.raises(ValueError):
        P.role_view(cands, "other")


def test_candidate_from_payload_fills_defaults_and_drops_nulls(spark):
    payload = {
        "agent_artifact": {"benchmark_case": {**CASE, "setup": None}, "environment_artifact": {"kind": "k", "payload": {"a": 1}}},
        "judge_artifact": {"proxy_claim": "p", "score_x": {"score_type": "s"}},
        "ability_z": {"name": "n"},
    }
    designs = spark.createDataFrame([("d1", ("t", 2, "s"))], "id string, cell struct<case_type:string,difficulty:int,scenario:string>")
    rows = [("d1", "e1", 1, "Gen", 0, json.dumps(payload)), ("d1", "e1", 2, "Gen", 1, json.dumps({"agent_artifact": {}}))]
    df = spark.createDataFrame(rows, "design_id string, envelope_id string, attempt int, role_name string, ord bigint, payload string")
    got = P.candidates_from_payload(df, designs, "run").collect()
    assert [r["id"] for r in got] == ["run-candidate-d1-1"]
    row = got[0]
    assert "setup" not in json.loads(row["agent_artifact"]["benchmark_case"])
    assert row["judge_artifact"]["leakage_risks"] == [] and row["judge_artifact"]["private_root_cause"] == ""
    assert (row["difficulty"], row["case_type"], row["provenance"]["generator"]) == (2, "t", "Gen")
    assert row["environment_y"] == "{}" and len(row["content_hash"]) == 64
    snap = P.candidate_snapshots(P.candidates_from_payload(df, designs, "run"), "run", "generation", "gen").first()
    assert json.loads(snap["candidate"])["id"] == "run-candidate-d1-1"


def test_designs_from_instructions_take_the_middle_level(spark):
    from fixtures import DOMAIN

    df = spark.createDataFrame([("r1", "do it", 0), ("r2", "do more", 1)], "run_id string, instruction string, ord bigint")
    got = P.designs_from_instructions(df, DOMAIN).orderBy("ord").collect()
    assert got[0]["id"] == "r1-instruction-design" and got[0]["cell"]["difficulty"] == 3
    assert got[0]["content_hash"] != got[1]["content_hash"] and json.loads(got[0]["environment_premise"]) == {"user_instruction": "do it"}
    assert P.envelope_rows(P.designs_from_instructions(df, DOMAIN), "r1", "gen").first()["envelope_id"] == "r1-instruction-design"


def test_stage_records_fill_defaults(spark):
    verdicts = spark.createDataFrame(
        [("a1", "r", "role", "validation", "accept", "accept", '{"b":1}')],
        "artifact_id string, run_id string, role string, stage_kind string, verdict string, route_code string, stage_input string",
    )
    meta = spark.createDataFrame([("a1", "m", 7)], "artifact_id string, model string, input_tokens bigint")
    row = P.stage_records_from(verdicts, meta).first()
    assert (row["stage_id"], row["model"], row["provider"], row["input_tokens"], row["latency_ms"]) == ("validation:a1", "m", "local", 7, 0)
    assert row["trace_ref"] == "stage_io.jsonl" and len(row["input_hash"]) == 64 and row["subcodes"] == []


def test_envelope_is_stamped(spark):
    raw = json.dumps({"response": json.dumps({"scan": {"result": "no_alert"}}), "x": 1})
    df = spark.createDataFrame([("k1", raw), ("k2", "[1]")], "case_id string, raw string")
    got = {r["case_id"]: r["raw"] for r in P.normalize_envelope(df).collect()}
    out = json.loads(got["k1"])
    assert out["case_id"] == "k1" and out["x"] == 1 and got["k2"] == "[1]"
    assert json.loads(out["response"])["scan"] == {"result": "no_alert", "run_id": "k1", "no_alert_rationale": None}


def test_select_cases(spark):
    df = spark.createDataFrame([(i, f"c{i}") for i in range(5)], "ord bigint, id string")
    assert [(r["id"], r["row_index"]) for r in select_cases(df, limit=2).orderBy("ord").collect()] == [("c3", 3), ("c4", 4)]
    assert [(r["id"], r["row_index"]) for r in select_cases(df, index=1).collect()] == [("c1", 1)]
    assert select_cases(df, limit=0).count() == 1
    with pytest.raises(IndexError):
        select_cases(df, index=5)


def test_run_report_tables(spark):
    stages = spark.createDataFrame(
        [(0, "c-1", None, "reject", "reject_schema", ["x"], "2026-01-01T00:00:02+00:00"), (1, "a", "c-2", "accept", "accept", [], "2026-01-01T00:00:01+00:00")],
        "ord bigint, artifact_id string, parent_artifact_id string, verdict string, route_code string, subcodes array<string>, wallclock_ts string",
    ).withColumns({"stage_kind": F.lit("validation"), "role": F.lit("r"), "retry_index": F.lit(0)})
    shape = "id string, design_id string, case_type string, ability string, prompt string, proxy_claim string, ord bigint"
    accepted = spark.createDataFrame([("c-2", "d", "t", "a", "p  q", "", 1)], shape)
    rejected = spark.createDataFrame([("c-1", "d", "t", "a", "first", "", 0)], shape).withColumns(
        {"route_code": F.lit("reject_schema"), "subcodes": F.array(F.lit("x"))}
    )
    report = run_report(stages, rejected, accepted)
    story = report["stories"].first()
    assert (story["final_status"], story["attempts"], story["prompt"], story["first_seen"]) == ("accepted", 2, "first", "2026-01-01T00:00:01+00:00")
    assert report["timeline"].first()["ts"] == "2026-01-01 00:00:02"
    assert [r["line"] for r in report["story_lines"].orderBy("position").collect()] == [
        "attempt 1: rejected route=reject_schema codes=x", "attempt 2: accepted route=accept codes=-",
    ]


def test_stream_ingest_and_curation_equal_batch(spark, tmp_path):
    root = str(tmp_path)
    A.append_artifact(spark.createDataFrame([("r1", "accept", "accept")], "run_id string, verdict string, route_code string"), root, "stage_records")
    query = T.stream_artifact(spark, root, "stage_records").writeStream.format("memory").queryName("ingested").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("ingested").count() == 1

    shape = "id string, ord bigint, vector array<double>, cell struct<case_type:string,difficulty:int,scenario:string>"
    cell = ("t", 1, "s")
    first = spark.createDataFrame([("a", 0, [1.0, 0.0], cell), ("b", 1, [1.0, 0.01], cell)], shape)
    second = spark.createDataFrame([("c", 2, [1.0, 0.02], cell), ("d", 3, [0.0, 1.0], cell)], shape)
    for n, batch in ((0, first), (1, second), (1, second)):  # the last one is a replay
        T.curate_batch(batch, n, root, "dom", 0.08)
    verdicts = {r["id"]: r["verdict"] for r in spark.read.parquet(f"{root}/verdicts").collect()}
    assert verdicts == {"a": "accept", "b": "reject", "c": "reject", "d": "accept"}
    assert A.read_index(spark, f"{root}/index", "dom").count() == 2
    assert A.coverage_snapshot(spark, f"{root}/coverage", "dom").first()["n"] == 2


def test_streamed_curation_runs_as_a_query(spark, tmp_path):
    shape = "id string, ord bigint, vector array<double>, cell struct<case_type:string,difficulty:int,scenario:string>"
    rows = [("a", 0, [1.0, 0.0], ("t", 1, "s")), ("b", 1, [1.0, 0.01], ("t", 1, "s"))]
    spark.createDataFrame(rows, shape).write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(shape).parquet(f"{tmp_path}/in")
    writer = T.stream_curate(source, f"{tmp_path}/out", "dom").option("checkpointLocation", f"{tmp_path}/state")
    writer.trigger(availableNow=True).start().awaitTermination()
    assert A.read_index(spark, f"{tmp_path}/out/index", "dom").count() == 1


def test_batches_reach_only_groups_that_can_hold_a_near_vector(spark, tmp_path):
    import random

    import numpy as np

    from casemill.operators import neighbors as N
    from casemill.operators.curate import curate

    draw = random.Random(5)
    centres = [[draw.gauss(0, 1) for _ in range(16)] for _ in range(6)]
    near = lambda c, spread: [x + draw.gauss(0, spread) for x in c]
    rows = [(f"v{n}", n, near(centres[n % 6], 0.2)) for n in range(90)] + [("z", 90, [0.0] * 16), ("short", 91, centres[1][:9])]
    vectors = spark.createDataFrame(rows, "id string, ord bigint, vector array<double>")
    pivots = N.unit_rows(centres, 16)
    within = 0.2
    placed = {r["id"]: r["p"] for r in vectors.select("id", N.nearest_pivot(F.col("vector"), pivots).alias("p")).collect()}
    assert placed["v7"] == 1 and placed["z"] == -1
    units = N.unit_rows([v for _, _, v in rows], 16)
    for probe in (7, 8, 91):
        got = N.reached_pivots(vectors.where(F.col("ord") == probe).withColumn("within", F.lit(within)), pivots)
        angle = np.arccos(np.clip(units @ units[probe], -1, 1))
        must = {placed[rows[i][0]] for i in range(90) if angle[i] <= within}
        assert must <= set(got)
    assert N.reached_pivots(vectors.where("id = 'v7'").withColumn("within", F.lit(within)), pivots) == [1]
    assert N.reached_pivots(vectors.where("id = 'z'").withColumn("within", F.lit(0.0)), pivots) == list(range(6))
    assert N.reached_pivots(vectors.limit(0).withColumn("within", F.lit(0.0)), pivots) == []

    root = f"{tmp_path}/out"
    cell = F.struct(F.lit("t").alias("case_type"), F.lit(1).alias("difficulty"), F.lit("s").alias("scenario"))
    for n, (low, high) in enumerate(((0, 40), (40, 92))):
        T.curate_batch(vectors.where((F.col("ord") >= low) & (F.col("ord") < high)).withColumn("cell", cell), n, root, "dom", 0.08)
    columns = ("id", "verdict", "nn_distance")
    told = lambda df: {r["id"]: (r["verdict"], r["nn_distance"] and round(r["nn_distance"], 9)) for r in df.select(*columns).collect()}
    assert told(spark.read.parquet(f"{root}/verdicts")) == told(curate(vectors, threshold=0.08))
    stored = A.read_index(spark, f"{root}/index", "dom")
    assert stored.select("pivot").distinct().count() > 2 and stored.where("pivot = -1").count() == 1
    assert stored.count() == spark.read.parquet(f"{root}/verdicts").where("verdict = 'accept'").count()


def test_board_follows_starts_and_results(spark):
    shape = "run_id string, ord bigint, stage string, stage_event string, role string, verdict string, provider string"
    rows = [
        ("r", 0, "run", "start_from_generation", None, None, None),
        ("r", 1, "generation", "revise", None, None, None),
        ("r", 2, "quality_gate", "start", None, None, None),
        ("r", 3, "rubric_gate", "start", None, None, None),
        ("s", 0, "validation_det", "start", None, None, None),
        ("s", 1, "join_gates", "start", None, None, None),
        ("s", 2, None, None, "join_quality_rubric_gates", "accept", "local"),
    ]
    got = {(r["run_id"], r["node"]): r["status"] for r in T.node_status(spark.createDataFrame(rows, shape)).collect()}
    assert got["r", "design"] == "skipped" and got["r", "revise_from_adversary"] == "pending" and got["r", "generate"] == "pending"
    assert got["r", "quality_gate"] == "running" and got["r", "rubric_gate"] == "running"
    assert got["s", "validate_det"] == "local" and got["s", "join_gates"] == "local" and len(got) == 24


def test_small_helpers(spark):
    from casemill.functions import scalars as S
    from casemill.operators.curate import committed_record, embedding_text
    from casemill.operators.joins import missing_items

    row = spark.createDataFrame([((("raw",), "c1"),)], "candidate struct<output:struct<a:string>,id:string>")
    assert committed_record(row).first()["candidate"].asDict() == {"id": "c1"}
    need, have = (spark.createDataFrame([(k,) for k in keys], "path string") for keys in ("abc", "bd"))
    assert {r["path"] for r in missing_items(need, have, "path").collect()} == {"a", "c"}
    sets = spark.createDataFrame([(["a", "b", "a"], ["b", "a"], ["z"])], "a array<string>, b array<string>, c array<string>")
    got = sets.select(S.ordered_distinct(F.col("a")), S.is_subset(F.col("a"), F.col("b")), S.overlaps(F.col("a"), F.col("c"))).first()
    assert tuple(got) == (["a", "b"], True, False)
    fields = spark.createDataFrame([({"prompt": "p", "x": "1"},)], "f map<string,string>")
    assert fields.select(S.safe_event_fields(F.col("f"))).first()[0] == {"x": "1"}
    numbers = spark.createDataFrame([("12",), (" 7 ",), ("1.5",), ("x",), (None,)], "v string")
    assert [r[0] for r in numbers.select(S.safe_int(F.col("v"))).collect()] == [12, 7, 0, 0, 0]
    assert spark.range(1).select(S.round4(F.lit(0.82505)), S.round4(F.lit(2 / 3))).first()[1] == 0.6667
    lines = embedding_text(candidates(spark, candidate())).first()["embedding_text"].split("\n")
    assert json.loads(lines[0])["prompt"] == CASE["prompt"] and lines[-1] == "billing" and json.loads(lines[3]) == {"name": "tracing"}


def test_stream_follows_files_that_grow(spark, tmp_path):
    root, log = tmp_path / "logs", tmp_path / "logs" / "r1" / "stage_records.jsonl"
    line = lambda n: json.dumps({"role": f"role {n} é", "latency_ms": n}) + "\n"
    write_lines(root / "r2" / "stage_records.jsonl", [line(9).strip(), "", line(10).strip()])
    log.parent.mkdir(parents=True)
    log.write_text(line(1) + line(2)[:7])

    def drain():
        writer = T.stream_artifact(spark, str(root), "stage_records", split=16).writeStream.format("parquet")
        writer = writer.option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state")
        writer.trigger(availableNow=True).start().awaitTermination()
        return sorted((r["run_id"], r["latency_ms"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert drain() == [("r1", 1), ("r2", 9), ("r2", 10)]
    log.write_text(line(1) + line(2) + line(3))
    (root / "stage_records" / "run_id=r3").mkdir(parents=True)
    (root / "stage_records" / "run_id=r3" / "part-0.json").write_text(line(4))
    assert drain() == [("r1", 1), ("r1", 2), ("r1", 3), ("r2", 9), ("r2", 10), ("r3", 4)]
    with pytest.raises(ValueError):
        lines.LineStream({"path": str(root), "kind": "x"}).partitions({"f": 9}, {"f": 5})


def test_pointers_escape_and_reach_into_arrays(spark):
    grades = spark.createDataFrame(
        [("a", json.dumps({"x/y": {"~": [1, {"0": True}]}, "0": "2.5"})), ("a", "not json"), ("b", json.dumps({"0": 4}))], "variant string, grade string"
    )
    rows = [("deep", "/x~1y/~0/1/0", "higher"), ("name", "/0", "lower"), ("none", "/x~1y/~0/01", "higher")]
    found = pointer_metrics(grades, spark.createDataFrame(rows, "metric string, pointer string, direction string"))
    got = {(r["variant"], r["metric"]): (r["trials"], r["n"], r["value"]) for r in found.collect()}
    assert got["a", "deep"] == (2, 1, 1.0) and got["a", "name"] == (2, 1, 2.5) and got["b", "name"] == (1, 1, 4.0) and got["a", "none"] == (2, 0, None)
    outcomes = {r["metric"]: (r["change"], r["outcome"]) for r in compare_variants(found, "a").collect()}
    assert outcomes == {"deep": (None, "unknown"), "name": (-1.5, "worse"), "none": (None, "unknown")}
    with pytest.raises(ValueError):
        pointer(F.col("v"), "no/slash")


def test_a_stream_reads_a_table_in_a_folder_of_files(spark, tmp_path):
    from casemill.plans.queries_joins import QUERIES

    spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    rows = [(i, f"text {i % 7}", "en", "src0", 6) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/t/documents.parquet")
    got = QUERIES["streamed_dedup"](spark, f"{tmp_path}/t").collect()
    assert len(got) == 7 and all(r.kept == 1 and r.one_of_its_rows for r in got)


def test_small_splits_share_tasks(tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.jsonl").write_bytes(b'{"x": 1}\n' * 9000)
    tasks = lines.LineReader({"path": str(tmp_path), "split": "64"}).partitions()
    parts = [p for t in tasks for p in t.parts]
    assert len(parts) > 2000 and len(tasks) <= lines.TASKS + 2
    assert [(p.file, p.low) for p in parts] == sorted((p.file, p.low) for p in parts)
    rows = [r for t in tasks for b in lines.LineReader({"path": str(tmp_path)}).read(t) for r in b.to_pylist()]
    assert len(rows) == 18000 and len({(r["file"], r["at"]) for r in rows}) == 18000


def test_inputs_of_few_splits_are_spread(spark):
    from casemill.session import spread

    before = spark.conf.get("spark.casemill.spread")
    spark.conf.unset("spark.casemill.spread")
    try:
        cores = spark.sparkContext.defaultParallelism
        assert spread(spark.range(100).coalesce(1), 4).rdd.getNumPartitions() == 4 * cores
        assert spread(spark.range(0, 100, 1, 4 * cores + 1), 4).rdd.getNumPartitions() == 4 * cores + 1
    finally:
        spark.conf.set("spark.casemill.spread", before)
