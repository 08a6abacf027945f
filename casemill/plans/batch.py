"""Batch validation and the one-pass curation run over tables of designs, candidates and verdicts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill import schemas
from casemill.operators import checks as C
from casemill.operators.curate import committed_record, curate, embedding_text, index_rows
from casemill.operators.document_schema import check_schema, compile_schema
from casemill.operators.joins import join_gates, retry_guidance
from casemill.operators.leakage import candidate_texts, check_leakage
from casemill.operators.metrics import merge_coverage
from casemill.operators.project import candidate_snapshots, envelope_rows, stage_records_from
from casemill.operators.route import decision, route_adversary
from casemill.operators.workspace import apply_revisions, check_workspace
from casemill.session import checkpointed
from casemill.sources.domain import Domain

# order in which checks decide a verdict; the executable ones only exist for executable domains
CHECK_ORDER = [
    "text_hygiene", "output_schema", "benchmark_case_schema", "environment_artifact", "runtime_requirements",
    "answer_leakage", "taxonomy_cell", "benchmark_contract", "benchmark_oracle",
]


def _output_document() -> Column:
    raw = lambda c: F.coalesce(c, F.lit("null"))
    agent = F.col("agent_artifact")
    env = agent["environment_artifact"]
    quoted = F.regexp_extract(F.to_json(F.struct(env["kind"].alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)
    parts = F.concat_ws(
        ",",
        F.concat(F.lit('"benchmark_case":'), raw(agent["benchmark_case"])),
        F.when(agent["runtime_requirements"].isNotNull(), F.concat(F.lit('"runtime_requirements":'), agent["runtime_requirements"])),
        F.when(
            env.isNotNull(),
            F.concat(F.lit('"environment_artifact":{"kind":'), quoted, F.lit(',"payload":'), raw(env["payload"]), F.lit("}")),
        ),
    )
    return F.concat(
        F.lit('{"agent_artifact":{'), parts, F.lit('},"judge_artifact":'), raw(F.to_json("judge_artifact")),
        F.lit(',"ability_z":'), raw(F.col("ability_z")), F.lit(',"environment_y":'), raw(F.col("environment_y")), F.lit("}"),
    )


def validate_candidates(
    cands: DataFrame, files: DataFrame, domain: Domain, exec_results: DataFrame | None = None
) -> DataFrame:
    """All checks of a candidate batch as rows of the checks table, in verdict order.

    Rules over the candidate row itself are computed together in one pass; rules over its document and
    its files each aggregate by candidate.
    """
    ids = cands.select(F.col("id").alias("candidate_id"))
    parts = [C.check_text_hygiene(cands)]
    documents = cands.select("id", _output_document().alias("output_doc"), F.col("agent_artifact.benchmark_case").alias("case_doc"))
    if domain.output_schema:
        parts.append(check_schema(documents, "output_doc", compile_schema(domain.output_schema), "output_schema", path_prefix="output."))
    if domain.case_schema:
        parts.append(check_schema(documents, "case_doc", compile_schema(domain.case_schema), "benchmark_case_schema"))
    row_rules = [C.taxonomy_outcome(domain), C.contract_outcome(domain), C.oracle_outcome(domain)]
    if domain.executable:
        row_rules.append(C.runtime_outcome(domain))
        structure = check_workspace(cands, files)
        if domain.required("execute_workspace_tests") and exec_results is not None:
            ran = C.check_exec_results(exec_results, domain)
            sound = structure.where("passed").select("candidate_id")
            # a run only decides when the structure is sound and the runtime is one that could execute
            runtime = F.try_parse_json(F.col("agent_artifact.runtime_requirements"))
            runnable = cands.where(C.container_problem(runtime).isNull()).select(F.col("id").alias("candidate_id"))
            ran = ran.join(sound, "candidate_id", "left_semi").join(runnable, "candidate_id", "left_semi")
            structure = structure.join(ran.select("candidate_id"), "candidate_id", "left_anti").unionByName(ran)
        parts.append(structure)
        parts.append(check_leakage(candidate_texts(cands, files), ids=ids))
    parts.append(C.as_checks(C.prepared(cands), *row_rules))
    every = reduce(DataFrame.unionByName, parts)
    position = F.lit(len(CHECK_ORDER))
    for at, name in enumerate(CHECK_ORDER):
        position = F.when(F.col("check_id") == name, F.lit(at)).otherwise(position)
    return every.withColumn("check_ord", position.cast("int")).select(*schemas.CHECK.names)


@dataclass
class BatchInputs:
    """Tables of one batch. ``candidates`` may carry ``retry_index`` (0 when absent)."""

    run_id: str
    designs: DataFrame
    candidates: DataFrame
    files: DataFrame
    adversary_reports: DataFrame
    quality: DataFrame
    rubric: DataFrame
    patches: DataFrame | None = None
    exec_results: DataFrame | None = None
    index: DataFrame | None = None
    coverage: DataFrame | None = None
    target_n: int | None = 5  # None: no target, the whole queue is curated
    meta: DataFrame | None = None  # (artifact_id, model and revision columns) for the stage records


@dataclass
class BatchOutputs:
    corpus: DataFrame
    index_rows: DataFrame
    rejections: DataFrame
    decisions: DataFrame
    validation: DataFrame
    coverage: DataFrame
    committed: DataFrame
    stage_records: DataFrame
    snapshots: DataFrame
    envelopes: DataFrame


def _decisions(df: DataFrame, stage: str, domain: Domain, run_id: str, kind: str) -> DataFrame:
    """Decision rows from (candidate_id, design_id, verdict, route_code, subcodes, retry_index)."""
    d = decision(
        F.lit(stage), F.col("verdict"), F.col("route_code"), F.col("retry_index"),
        F.lit(domain.max_design_retries), F.lit(domain.max_generation_retries),
    )
    return df.withColumn("_d", d).select(
        F.lit(run_id).alias("run_id"), "candidate_id", "design_id", F.lit(stage).alias("from_stage"), F.lit(kind).alias("check_kind"), "verdict",
        F.col("_d.route_code").alias("route_code"), "subcodes", F.col("_d.next_stage").alias("next_stage"),
        F.col("_d.context_policy").alias("context_policy"), F.col("retry_index").cast("int").alias("retry_index"),
        F.col("_d.terminal").alias("terminal"),
    )


def run_batch(inputs: BatchInputs, domain: Domain) -> BatchOutputs:
    """Designs to committed cases in one pass.

    Designs are partitioned, candidates of accepted designs validated, adversary dispositions applied
    (revisions are validated again), gates joined, and what remains is curated in queue order up to
    the target. Items that would be regenerated leave as decision rows with their next stage and retry
    advice; the caller's next batch holds whatever was regenerated.

    No candidate is lost: each leaves exactly one row that ends it here, a reject (terminal or for retry), an accept
    at curation, or ``open`` with ``queue_full`` when the target was met before its turn. A report, a patch or a gate
    verdict that never came counts as an empty answer of the provider. Accepted checks and gates leave rows as well.
    A revision goes on under its own id, the original's with ``-rev``.
    """
    run_id = inputs.run_id
    cands = inputs.candidates
    if "retry_index" not in cands.columns:
        cands = cands.withColumn("retry_index", F.lit(0))

    parted = C.partition_designs(inputs.designs, domain)
    design_rows = parted.where(F.col("verdict") == "reject").select(
        F.lit(run_id).alias("run_id"), F.lit(None).cast("string").alias("candidate_id"), F.col("id").alias("design_id"),
        F.lit("design_audit").alias("from_stage"), F.lit("design").alias("check_kind"), "verdict", "route_code",
        F.array_compact(F.array("subcode")).alias("subcodes"), F.lit(None).cast("string").alias("next_stage"),
        F.lit("criteria_only").alias("context_policy"), F.lit(0).alias("retry_index"), F.lit(True).alias("terminal"),
    )
    usable = parted.where(F.col("verdict") == "accept").select(F.col("id").alias("design_id"))
    live = checkpointed(cands.join(usable, "design_id", "left_semi"))
    failed_designs = parted.where(F.col("verdict") == "reject").select(
        F.col("id").alias("design_id"), F.col("route_code").alias("design_route"), F.col("subcode").alias("design_subcode")
    )
    without_design = cands.join(usable, "design_id", "left_anti").join(failed_designs, "design_id", "left").select(
        F.lit(run_id).alias("run_id"), F.col("id").alias("candidate_id"), "design_id", F.lit("design_audit").alias("from_stage"),
        F.lit("design").alias("check_kind"), F.lit("reject").alias("verdict"), F.coalesce("design_route", F.lit("reject_schema")).alias("route_code"),
        F.array(F.coalesce("design_subcode", F.lit("schema_violation"))).alias("subcodes"), F.lit(None).cast("string").alias("next_stage"),
        F.lit("criteria_only").alias("context_policy"), F.col("retry_index").cast("int").alias("retry_index"), F.lit(True).alias("terminal"),
    )

    def unanswered(ids: DataFrame, facts: DataFrame) -> DataFrame:
        """Rows for candidates (candidate_id) about which no answer came."""
        return ids.join(facts, "candidate_id").select(
            "candidate_id", "design_id", F.lit("reject").alias("verdict"), F.lit("retry_provider_empty").alias("route_code"),
            F.array(F.lit("provider_error")).alias("subcodes"), "retry_index",
        )

    def validated(batch: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
        found = checkpointed(validate_candidates(batch, files, domain, inputs.exec_results))
        verdicts = C.deterministic_verdict(found)
        facts = batch.select(F.col("id").alias("candidate_id"), "design_id", "retry_index")
        return checkpointed(verdicts.join(facts, "candidate_id")), found

    verdicts, _ = validated(live, inputs.files)
    decisions = [design_rows, without_design, _decisions(verdicts, "validation", domain, run_id, "deterministic")]
    passed = live.join(
        verdicts.where(F.col("verdict") == "accept").select(F.col("candidate_id").alias("id")), "id", "left_semi"
    )

    reviewed = checkpointed(route_adversary(passed, inputs.adversary_reports, domain.max_generation_retries))
    facts = live.select(F.col("id").alias("candidate_id"), "design_id", "retry_index")
    nuked = reviewed.where(F.col("action") == "reject").join(facts, "candidate_id").select(
        "candidate_id", "design_id", F.lit("reject").alias("verdict"), F.lit("reject_semantic_mismatch").alias("route_code"),
        "subcodes", "retry_index",
    )
    decisions.append(_decisions(nuked, "validation", domain, run_id, "adversary"))
    silent = passed.select(F.col("id").alias("candidate_id")).join(reviewed.select("candidate_id"), "candidate_id", "left_anti")
    decisions.append(_decisions(unanswered(silent, facts), "generation", domain, run_id, "adversary"))
    ready = passed.join(reviewed.where(F.col("action") == "gates").select(F.col("candidate_id").alias("id")), "id", "left_semi")
    validation = [verdicts]
    wanted = reviewed.where(F.col("action") == "revise").select("candidate_id")
    unpatched = wanted if inputs.patches is None else wanted.join(inputs.patches.select("candidate_id"), "candidate_id", "left_anti")
    decisions.append(_decisions(unanswered(unpatched, facts), "generation", domain, run_id, "revision"))
    if inputs.patches is not None:
        patches = inputs.patches.join(wanted, "candidate_id", "left_semi")
        revised, revised_files, errors = apply_revisions(passed.drop("retry_index"), inputs.files, patches)
        failed = errors.join(facts, "candidate_id").select(
            "candidate_id", "design_id", F.lit("reject").alias("verdict"), F.lit("retry_parse").alias("route_code"),
            F.array(F.lit("provider_error")).alias("subcodes"), "retry_index",
        )
        decisions.append(_decisions(failed, "generation", domain, run_id, "revision"))
        revised = checkpointed(
            revised.join(facts.select(F.concat("candidate_id", F.lit("-rev")).alias("id"), "retry_index"), "id")
        )
        again_files = revised_files.withColumn("candidate_id", F.concat("candidate_id", F.lit("-rev")))
        again, _ = validated(revised, again_files)
        validation.append(again)
        decisions.append(_decisions(again, "validation", domain, run_id, "deterministic"))
        good = revised.join(again.where(F.col("verdict") == "accept").select(F.col("candidate_id").alias("id")), "id", "left_semi")
        ready = ready.unionByName(good.select(*ready.columns))

    ready = checkpointed(ready)
    ready_facts = ready.select(F.col("id").alias("candidate_id"), "design_id", "retry_index", "ord")
    gated = checkpointed(join_gates(inputs.quality, inputs.rubric).join(ready_facts, "candidate_id"))
    decisions.append(_decisions(gated.drop("ord"), "validation", domain, run_id, "gates"))
    ungated = ready_facts.select("candidate_id").join(gated.select("candidate_id"), "candidate_id", "left_anti")
    decisions.append(_decisions(unanswered(ungated, ready_facts.drop("ord")), "validation", domain, run_id, "gates"))
    cleared = gated.where(F.col("verdict") == "accept").select(
        F.col("candidate_id").alias("id"), F.col("subcodes").alias("caveats")
    )
    queue = embedding_text(ready.join(cleared, "id"))
    curated = checkpointed(curate(queue.select("id", "ord", "embedding_text"), inputs.index, domain.novelty_threshold, inputs.target_n))
    curated_facts = curated.select(F.col("id").alias("candidate_id"), "verdict", "route_code", "subcodes").join(
        ready_facts.drop("ord"), "candidate_id"
    )
    decisions.append(_decisions(curated_facts, "curation", domain, run_id, "curation"))
    waiting = queue.select(F.col("id").alias("candidate_id"), "design_id", "retry_index").join(
        curated.select(F.col("id").alias("candidate_id")), "candidate_id", "left_anti"
    )
    decisions.append(
        waiting.select(
            F.lit(run_id).alias("run_id"), "candidate_id", "design_id", F.lit("curation").alias("from_stage"), F.lit("curation").alias("check_kind"),
            F.lit("open").alias("verdict"), F.lit("queue_full").alias("route_code"), F.array().cast("array<string>").alias("subcodes"),
            F.lit("curation").alias("next_stage"), F.lit("criteria_only").alias("context_policy"),
            F.col("retry_index").cast("int").alias("retry_index"), F.lit(False).alias("terminal"),
        )
    )

    accepted = curated.where(F.col("verdict") == "accept").select("id", "nn_distance")
    corpus = queue.drop("embedding_text").join(accepted, "id").withColumn(
        "committed_id", F.concat(F.lit(f"{run_id}-committed-"), "id")
    )
    all_decisions = checkpointed(retry_guidance(reduce(DataFrame.unionByName, decisions)))
    rejections = all_decisions.where(F.col("verdict") == "reject").select(
        "run_id", "candidate_id", "design_id", "route_code", "subcodes", "retry_index", "terminal"
    )
    snapshot = inputs.coverage
    if snapshot is None:
        snapshot = corpus.sparkSession.createDataFrame([], "cell_key string, n bigint")
    curation_rows = curated.select(
        F.col("id").alias("candidate_id"), F.lit("curation").alias("check_kind"), "verdict", "route_code", "subcodes"
    )
    gate_rows = [
        df.join(ready_facts.select("candidate_id"), "candidate_id", "left_semi").select(
            "candidate_id", F.lit(kind).alias("check_kind"), "verdict", "route_code", "subcodes"
        )
        for kind, df in (("quality", inputs.quality), ("rubric", inputs.rubric))
    ]
    det_rows = [
        v.select("candidate_id", F.lit("deterministic").alias("check_kind"), "verdict", "route_code", "subcodes") for v in validation
    ]
    records = all_decisions.select(
        "run_id", F.coalesce("candidate_id", "design_id").alias("artifact_id"), F.col("design_id").alias("parent_artifact_id"),
        F.col("from_stage").alias("stage_kind"), F.col("check_kind").alias("role"), "verdict", "route_code", "subcodes", "retry_index",
    )
    meta = inputs.meta if inputs.meta is not None else corpus.sparkSession.createDataFrame([], "artifact_id string")
    body = F.struct(*[c for c in ready.columns if c not in ("retry_index", "ord")])
    return BatchOutputs(
        corpus=corpus,
        committed=committed_record(corpus.select(F.lit(run_id).alias("run_id"), "committed_id", "nn_distance", "caveats", body.alias("candidate"))),
        stage_records=stage_records_from(records, meta, domain),
        snapshots=candidate_snapshots(live, run_id, "validation", "generator"),
        envelopes=envelope_rows(inputs.designs, run_id, "designer"),
        index_rows=index_rows(curated, run_id),
        rejections=rejections,
        decisions=all_decisions,
        validation=reduce(DataFrame.unionByName, [*det_rows, *gate_rows, curation_rows]),
        coverage=merge_coverage(snapshot, corpus),
    )


def run_batches(first: BatchInputs, domain: Domain, regenerate: Callable[[DataFrame, int], BatchInputs]) -> BatchOutputs:
    """``first`` and the batches that follow from it, until nothing is to be regenerated or the target is met.

    ``regenerate(open_rows, turn)`` gets the decision rows of the last batch that send a candidate back to generation, with
    their guidance, and gives the inputs of batch number ``turn``: candidates under ids of their own and what providers say
    about them. Their designs, run id, index, coverage and target are set here, as is the retry index, one more than that of
    the design's rejected candidate; candidates of designs that are not open are left out. So every batch works on what
    the last one rejected and on nothing else, and routing ends a design after the domain's generation retries whatever
    ``regenerate`` gives. A design for which nothing comes stays open. An empty first batch gives empty tables.

    Outputs are those of all batches stacked; coverage is the ledger after the last and envelopes are the first's designs.
    """
    outputs, inputs, left = [], first, first.target_n
    index = None if first.index is None else first.index.select("candidate_id", "vector")
    for turn in range(1, domain.max_generation_retries + 2):
        out = run_batch(inputs, domain)
        out = replace(out, index_rows=checkpointed(out.index_rows), coverage=checkpointed(out.coverage))
        outputs.append(out)
        if left is not None:
            left -= out.index_rows.count()
        open_rows = out.decisions.where((F.col("verdict") == "reject") & ~F.col("terminal") & (F.col("next_stage") == "generation"))
        open_rows = checkpointed(open_rows.where(F.col("candidate_id").isNotNull()))
        if (left is not None and left <= 0) or open_rows.isEmpty():
            break
        taken = out.index_rows.select("candidate_id", "vector")
        index = taken if index is None else index.unionByName(taken)
        again = open_rows.groupBy("design_id").agg((F.max("retry_index") + 1).cast("int").alias("retry_index"))
        inputs = regenerate(open_rows, turn)
        inputs = replace(
            inputs,
            run_id=first.run_id,
            designs=first.designs.join(again.select(F.col("design_id").alias("id")), "id", "left_semi").select(*first.designs.columns),
            candidates=inputs.candidates.drop("retry_index").join(again, "design_id"),
            index=index,
            coverage=out.coverage,
            target_n=left,
        )
    stacked = {f.name: reduce(DataFrame.unionByName, [getattr(out, f.name) for out in outputs]) for f in fields(BatchOutputs)}
    return BatchOutputs(**stacked | {"coverage": outputs[-1].coverage, "envelopes": outputs[0].envelopes})
