"""The given tables as the library's tables: pure projections, so their work grows with the data.

``SQL`` holds the same mappings as text for the side-by-side check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill import fixed, schemas
from casemill.functions.scalars import strings
from casemill.session import spread


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents for work that is heavy per row: spread when they arrive as one unsplittable file."""
    return spread(table(spark, sf, "documents"))


def choose(value: Column, options: dict, default: str) -> Column:
    out = F.lit(default)
    for key, text in options.items():
        out = F.when(value == key, F.lit(text)).otherwise(out)
    return out


# ------------------------------------------------------------------ events

ROLES = {
    "click": "generate_candidate_sample",
    "view": "validate_candidate_deterministically",
    "purchase": "curate_committed_sample",
    "signup": "quality_gate_candidate",
}
KINDS = {"click": "generation", "purchase": "curation"}


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def stage_records(spark: SparkSession, sf: str) -> DataFrame:
    return stage_records_from(table(spark, sf, "events"))


def stage_records_from(events: DataFrame) -> DataFrame:
    """Stage records of an events table, read as a batch or as a stream."""
    e = events.withColumn("k", _k())
    reject = F.col("k") % 4 == 0
    route = choose(F.col("k") % 3, {0: "reject_schema", 1: "reject_leakage"}, "reject_duplicate")
    code = choose(F.col("k") % 3, {0: "schema_violation", 1: "shortcut_leakage"}, "near_duplicate")
    slow = F.col("k") % 10 == 0
    return e.select(
        F.concat(F.lit("run-"), (F.col("user_id") % 10).cast("string")).alias("run_id"),
        F.col("event_id").alias("ord"),
        F.concat(F.lit("art-"), F.col("event_id").cast("string")).alias("artifact_id"),
        F.when(F.col("event_type") != "signup", F.concat(F.lit("cand-"), F.col("user_id").cast("string"))).alias(
            "parent_artifact_id"
        ),
        choose(F.col("event_type"), ROLES, "rubric_gate_candidate").alias("role"),
        choose(F.col("event_type"), KINDS, "validation").alias("stage_kind"),
        F.when(reject, F.lit("reject")).otherwise(F.lit("accept")).alias("verdict"),
        F.when(reject, route).otherwise(F.lit("accept")).alias("route_code"),
        F.when(reject, F.array(code)).otherwise(strings()).alias("subcodes"),
        F.when(slow, F.lit(0)).otherwise(F.floor(F.col("value") * 100)).cast("bigint").alias("latency_ms"),
        F.when(slow, F.concat(F.lit("provider failed elapsed_ms="), (F.col("k") * 10).cast("string"))).alias("error"),
        (F.col("k") * 10).cast("bigint").alias("input_tokens"),
        F.col("k").cast("bigint").alias("output_tokens"),
        (F.col("event_id") % 4).alias("retry_index"),
        _iso(F.col("ts")).alias("wallclock_ts"),
    )


def stage_events(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("k", _k())
    role = F.when(F.col("event_type") == "click", F.when(F.col("k") % 2 == 0, F.lit("generate_candidate_sample")))
    return e.select(
        F.concat(F.lit("run-"), (F.col("user_id") % 10).cast("string")).alias("run_id"),
        F.col("event_id").alias("ord"),
        F.when(F.col("event_type") == "click", F.lit("model_request_body")).otherwise(F.lit("progress")).alias("stage_event"),
        role.alias("role"),
        F.when(F.col("k") % 3 == 0, F.lit("generation")).alias("stage"),
        (F.length("props") * F.col("k")).cast("bigint").alias("body_bytes"),
    )


def board_events(spark: SparkSession, sf: str) -> DataFrame:
    return board_events_from(table(spark, sf, "events"))


def board_events_from(events: DataFrame, *keep: Column | str) -> DataFrame:
    """Progress starts and results per run, as a board sees them."""
    e = events.withColumn("k", _k())
    begins = F.col("event_type").isin("view", "signup")
    stage = choose(
        F.col("k") % 6,
        {0: "generation", 1: "validation_det", 2: "quality_gate", 3: "rubric_gate", 4: "adversary"},
        "curation",
    )
    role = choose(
        F.col("k") % 6,
        {
            0: "generate_candidate_sample",
            1: "validate_candidate_deterministically",
            2: "quality_gate_candidate",
            3: "rubric_gate_candidate",
            4: "adversary_attack_report",
        },
        "curate_committed_sample",
    )
    return e.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        F.col("event_id").alias("ord"),
        F.when(begins, stage).alias("stage"),
        F.when(begins, F.lit("start")).alias("stage_event"),
        F.when(~begins, role).alias("role"),
        F.when(~begins, F.when(F.col("k") % 4 == 0, F.lit("reject")).otherwise(F.lit("accept"))).alias("verdict"),
        F.when(~begins, F.when(F.col("k") % 5 == 0, F.lit("local")).otherwise(F.lit("remote"))).alias("provider"),
        *keep,
    )


# ------------------------------------------------------------------ documents


def cell() -> Column:
    return F.struct(
        F.col("lang").alias("case_type"),
        (1 + F.col("n_chars") % 5).cast("int").alias("difficulty"),
        F.col("source").alias("scenario"),
    ).alias("cell")


def designs(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.select(
        F.concat(F.lit("design-"), F.col("doc_id").cast("string")).alias("id"),
        cell(),
        F.sha2("text", 256).alias("content_hash"),
        F.col("doc_id").alias("ord"),
    )


def candidates(spark: SparkSession, sf: str, turn: int = 0) -> DataFrame:
    """Documents as candidates: what the rules look at varies with the document's length plus ``turn``, and its id."""
    d = spread(table(spark, sf, "documents"))
    n = F.col("n_chars") + turn
    listed = lambda text, count: F.array_repeat(F.lit(text), count)
    criterion = lambda when: F.when(when, F.lit("")).otherwise(F.lit("criterion"))
    judge = F.struct(
        F.struct(
            F.when(n % 11 == 0, F.lit("")).otherwise(F.lit("rubric")).alias("score_type"),
            F.array(
                F.struct(
                    F.lit("d1").alias("name"),
                    F.lit(0.5).alias("weight"),
                    F.lit("criterion").alias("high_score_criterion"),
                    criterion(n % 13 == 0).alias("low_score_criterion"),
                )
            ).alias("dimensions"),
        ).alias("score_x"),
        F.lit("cause").alias("private_root_cause"),
        listed("fix", F.lit(1)).alias("expected_fix_properties"),
        listed("mode", F.lit(1)).alias("hidden_failure_modes"),
        listed("trap", F.lit(1)).alias("shallow_solution_traps"),
        listed("bound", F.lit(1)).alias("candidate_visibility_boundaries"),
        F.col("text").alias("proxy_claim"),
        listed("pressure", (n % 4).cast("int")).alias("diagnostic_pressure"),
        F.struct(
            listed("credit", F.lit(1)).alias("credit"),
            listed("penalty", F.when(n % 17 == 0, 0).otherwise(1)).alias("penalties"),
            F.lit("none").alias("uncertainty_policy"),
        ).alias("scoring_contract"),
        listed("risk", (n % 5).cast("int")).alias("leakage_risks"),
        listed("limit", (n % 6).cast("int")).alias("known_limits"),
        F.array(F.col("lang"), F.col("source")).alias("coverage_tags"),
        F.array_repeat(F.struct(F.lit("out").alias("output"), F.lit("because").alias("should_fail_because")), F.when(n % 7 == 0, 0).otherwise(1)).alias(
            "negative_controls"
        ),
    )
    oracle = F.struct(
        listed("repairs", F.when(n % 3 == 0, 0).otherwise(1)).alias("expected_repair_characteristics"),
        listed("hidden", (n % 4).cast("int")).alias("hidden_tests"),
        listed("shallow", (n % 5).cast("int")).alias("shallow_fix_failures"),
    )
    case = F.to_json(
        F.struct(F.col("text").alias("prompt"), F.col("source").alias("setup"), F.when(n % 37 != 0, oracle).alias("oracle"))
    )
    image = choose(n % 4, {0: "python:3.9-slim", 1: "python:3.10-slim", 2: "python:3.11-slim"}, "python:3.12-slim")
    runtime = F.concat(
        F.lit('{"kind":"'), F.when(n % 19 == 0, F.lit("text_only")).otherwise(F.lit("filesystem_task")),
        F.lit('","execution":{"mode":"container","base_image":"'), image,
        F.lit('"},"language":{"name":"Python"},"dependencies":{"policy":"none","packages":["pytest"]},"commands":{"test":"'),
        F.when(n % 5 == 0, F.lit(" ")).otherwise(F.lit("pytest -q")), F.lit('"},"network":"disabled_during_eval"}'),
    )
    return d.select(
        F.concat(F.lit("cand-"), F.col("doc_id").cast("string")).alias("id"),
        F.concat(F.lit("design-"), F.col("doc_id").cast("string")).alias("design_id"),
        F.sha2("text", 256).alias("content_hash"),
        cell(),
        F.struct(
            case.alias("benchmark_case"),
            F.when(n % 23 != 0, runtime).alias("runtime_requirements"),
            F.lit(None).cast(schemas.AGENT["environment_artifact"].dataType).alias("environment_artifact"),
        ).alias("agent_artifact"),
        judge.alias("judge_artifact"),
        F.when(n % 29 == 0, F.lit("{}")).otherwise(F.lit('{"name":"skill"}')).alias("ability_z"),
        F.lit('{"name":"single_turn"}').alias("environment_y"),
        (1 + F.col("n_chars") % 5 + F.when(n % 31 == 0, 1).otherwise(0)).cast("int").alias("difficulty"),
        F.col("lang").alias("case_type"),
        F.create_map(F.lit("source"), F.col("source")).alias("provenance"),
        F.col("doc_id").alias("ord"),
    )


def executable_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """``candidates`` that bring a workspace; some declare another test command or hold a control character."""
    payload = F.when(F.col("ord") % 41 == 0, F.lit('{"commands":{"test":"pytest"}}')).otherwise(F.lit('{"commands":{"test":"pytest -q"}}'))
    artifact = F.struct(F.lit(fixed.WORKSPACE_KIND).alias("kind"), payload.alias("payload"))
    source = F.col("provenance")["source"]
    marked = F.when(F.col("ord") % 43 == 0, F.concat(source, F.lit("\x07"))).otherwise(source)
    rows = candidates(spark, sf).withColumn("provenance", F.create_map(F.lit("source"), marked))
    return rows.withColumn("agent_artifact", F.col("agent_artifact").withField("environment_artifact", artifact))


def executable_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as the first file of the candidate with its number, beside a module and, for most, a test."""
    p = table(spark, sf, "pages")
    key = F.col("page_id")
    path = F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1)
    path = F.when(key % 17 == 0, F.concat(F.lit("../"), path)).otherwise(path)
    note = choose(key % 30, {4: " Root cause: the cache", 11: " see Starter Code, the intended fix", 19: " BUG: off"}, "")
    content = F.when(key % 13 == 0, F.lit("# TODO")).otherwise(F.concat("html", note))
    entry = lambda path, content: F.struct(path.alias("path"), content.alias("content"))
    listed = F.array(entry(path, content), entry(F.lit("src/main.py"), F.lit("x = 1")), entry(F.lit("tests/test_main.py"), F.lit("assert x == 2")))
    kept = F.slice(listed, 1, F.when(key % 6 == 0, 2).otherwise(3))
    rows = p.select(F.concat(F.lit("cand-"), key.cast("string")).alias("candidate_id"), F.posexplode(kept).alias("ord", "file"))
    return rows.select("candidate_id", "ord", "file.path", "file.content")


def executable_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Recorded test runs of three in four candidates, with up to four failing files."""
    d = table(spark, sf, "documents").where(F.col("doc_id") % 4 != 1)
    lines = F.transform(
        F.slice(F.sequence(F.lit(1), F.lit(5)), 1, (F.col("n_chars") % 5).cast("int")),
        lambda i: F.concat(F.lit("FAILED tests/test_"), i.cast("string"), F.lit(".py::test_a - assert 1")),
    )
    return d.select(
        F.concat(F.lit("cand-"), F.col("doc_id").cast("string")).alias("candidate_id"), (F.col("doc_id") % 3).cast("int").alias("returncode"),
        F.array_join(lines, "\n").alias("stdout"), F.lit("").alias("stderr"), (F.col("doc_id") % 9 == 0).alias("timed_out"),
    )


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Committed rows with the facts the run metrics look at."""
    d = table(spark, sf, "documents")
    n = F.col("n_chars")
    return d.select(
        F.concat(F.lit("run-"), (F.col("doc_id") % 10).cast("string")).alias("run_id"),
        F.col("doc_id").alias("ord"),
        cell(),
        F.when(n % 9 != 0, F.concat(F.lit("ability-"), (n % 4).cast("string"))).alias("ability"),
        F.concat(F.lit("env-"), (n % 3).cast("string")).alias("environment"),
        F.when(n % 2 == 0, F.lit("rubric")).otherwise(F.lit("deterministic_execution")).alias("score_type"),
        F.array(F.col("lang"), F.when(n % 3 == 0, F.col("lang")).otherwise(F.col("source"))).alias("diagnostic_pressure"),
        F.array_repeat(F.lit("risk"), (n % 5).cast("int")).alias("leakage_risks"),
        F.array_repeat(F.lit("limit"), (n % 6).cast("int")).alias("known_limits"),
    )


def verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """Gate verdicts of labelled documents: quality from quality, rubric from toxicity."""
    label = table(spark, sf, "labels")
    one = lambda kind, ok, code: F.struct(
        F.lit(kind).alias("check_kind"),
        F.when(ok, F.lit("accept")).otherwise(F.lit("reject")).alias("verdict"),
        F.when(ok, F.lit("accept"))
        .when(F.col("doc_id") % 5 == 0, F.lit("retry_infra"))
        .otherwise(F.lit("reject_semantic_mismatch"))
        .alias("route_code"),
        F.when(ok, strings()).otherwise(F.array(F.lit(code), F.lit("ambiguous_success_criteria"))).alias("subcodes"),
    )
    both = F.array(
        one("quality", F.col("quality") == 1, "weak_diagnostic_pressure"), one("rubric", F.col("toxic") == 0, "unreliable_score")
    )
    return label.select(
        F.concat(F.lit("run-"), (F.col("doc_id") % 10).cast("string")).alias("run_id"),
        F.concat(F.lit("cand-"), F.col("doc_id").cast("string")).alias("candidate_id"),
        F.explode(both).alias("v"),
    ).select("run_id", "candidate_id", "v.*")


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return e.select(
        F.col("vec_id").cast("string").alias("id"), F.col("vec_id").alias("ord"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )


# ------------------------------------------------------------------ orders


def bom_links(spark: SparkSession, sf: str) -> DataFrame:
    """(entity_id, product_id): a part is made from its suppliers' inputs."""
    item = table(spark, sf, "lineitem")
    return item.select(
        F.concat(F.lit("S-"), F.col("l_suppkey").cast("string")).alias("entity_id"),
        F.concat(F.lit("P-"), F.col("l_partkey").cast("string")).alias("product_id"),
    ).distinct()


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with their customer; an order with status O is open."""
    item, order, customer = (table(spark, sf, t) for t in ("lineitem", "orders", "customer"))
    return (
        item.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.concat(F.lit("SO-"), F.col("o_orderkey").cast("string")).alias("id"),
            F.col("c_name").alias("customer"),
            F.concat(F.lit("P-"), F.col("l_partkey").cast("string")).alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.floor("l_extendedprice").cast("bigint").alias("unit_revenue"),
            F.when(F.col("o_orderstatus") == "O", F.lit("open")).otherwise(F.lit("closed")).alias("status"),
        )
    )


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.concat(F.lit("P-"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_size").cast("bigint").alias("quantity_available"),
    )


def supplier_requests(spark: SparkSession, sf: str) -> DataFrame:
    """One exposure request per supplier."""
    entity = F.concat(F.lit("S-"), F.col("s_suppkey").cast("string"))
    return table(spark, sf, "supplier").select(F.col("s_name").alias("request_id"), entity.alias("entity_id"))


def region_requests(spark: SparkSession, sf: str) -> DataFrame:
    """One exposure request per region, naming all its suppliers."""
    supplier, nation, region = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    entity = F.concat(F.lit("S-"), F.col("s_suppkey").cast("string"))
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("r_name").alias("request_id"), entity.alias("entity_id"))
    )


# ------------------------------------------------------------------ scans and oracles, one case per order


def _order_facts(spark: SparkSession, sf: str) -> DataFrame:
    order = spread(table(spark, sf, "orders"), 4)
    key = F.col("o_orderkey")
    return order.select(
        F.concat(F.lit("SO-"), key.cast("string")).alias("case_id"),
        key.alias("k"),
        (key % 8).alias("style"),
        (F.col("o_orderstatus") == "F").alias("zero"),
        F.concat(F.lit("C-"), F.col("o_custkey").cast("string")).alias("customer"),
        F.floor("o_totalprice").cast("bigint").alias("revenue"),
        F.concat(F.lit("H0"), (1 + key % 9).cast("string")).alias("headline"),
        (F.col("o_orderpriority") == "1-URGENT").alias("constrained"),
    )


def scan_oracles(spark: SparkSession, sf: str) -> DataFrame:
    f = _order_facts(spark, sf)
    alert = F.struct(
        F.concat(F.lit("A-"), F.col("k").cast("string")).alias("id"),
        F.array("headline").alias("source_headlines"),
        F.array(F.lit("resin"), F.lit("Flux"), F.lit("solder")).alias("required_concepts"),
        F.array(F.lit("flux"), F.col("case_id")).alias("hidden_dependency_path"),
        F.struct(
            F.col("revenue").alias("revenue_at_risk"),
            F.array("case_id").alias("affected_orders"),
            F.array("customer").alias("affected_customers"),
            F.col("constrained").alias("constrained_inventory"),
        ).alias("business_exposure"),
    )
    none = F.array().cast("array<" + schemas.EXPECTED_ALERT.simpleString() + ">")
    return f.select("case_id", F.col("zero").alias("zero_alert_run"), F.when(F.col("zero"), none).otherwise(F.array(alert)).alias("true_alerts"))


def raw_scans(spark: SparkSession, sf: str) -> DataFrame:
    """(case_id, raw): submitted scan documents as JSON text, in eight styles of answer.

    0 exact, 1 wrong revenue, 2 no alert, 3 an extra alert, 4 an invented record, 5 a missing key,
    6 hedging left out and one concept only, 7 exact inside a text envelope.
    """
    f = _order_facts(spark, sf)
    style = F.col("style")

    def alert(ident: Column, headline: Column, orders: Column, extra: bool) -> Column:
        hedge = F.when(style == 6, strings()).otherwise(F.array(F.lit("supplier impact not confirmed")))
        exposure = F.struct(
            (F.col("revenue") + F.when((style == 1) | F.lit(extra), 1).otherwise(0)).alias("revenue_at_risk"),
            orders.alias("affected_orders"),
            F.array("customer").alias("affected_customers"),
            F.col("constrained").alias("constrained_inventory"),
        )
        record = F.when(style == 4, F.lit("memo.txt")).otherwise(F.lit("records/orders.yaml"))
        hypothesis = F.when(style == 6, F.lit("resin outage")).otherwise(F.lit("Resin outage hits solder lines"))
        return F.struct(
            ident.alias("id"),
            F.lit("medium").alias("confidence"),
            F.array(headline).alias("source_headlines"),
            (F.lit("unrelated") if extra else hypothesis).alias("latent_edge_hypothesis"),
            F.lit("prior").alias("real_world_prior"),
            (F.array(F.lit("none")) if extra else F.array(F.lit("rosin flux"), F.col("case_id"))).alias("enterprise_path"),
            exposure.alias("business_exposure"),
            F.lit("reasoning").alias("reasoning"),
            F.struct(F.array(headline).alias("headlines"), F.array(record).alias("records")).alias("citations"),
            (strings() if extra else hedge).alias("uncertainty"),
        )

    good = alert(F.lit("a1"), F.col("headline"), F.array("case_id"), False)
    extra = alert(F.lit("a2"), F.lit("H99"), F.array(F.lit("SO-none")), True)
    silent = (style == 2) | F.col("zero") & (style != 3)
    alerts = F.when(silent, F.array().cast("array<" + schemas.ALERT.simpleString() + ">")).when(style == 3, F.array(extra, good)).otherwise(F.array(good))
    result = F.when(silent, F.lit("no_alert")).otherwise(F.lit("alerts_found"))
    rationale = F.when(silent, F.lit("no dependency found"))
    full = F.to_json(
        F.struct(F.struct(F.col("case_id").alias("run_id"), result.alias("result"), alerts.alias("alerts"), rationale.alias("no_alert_rationale")).alias("scan")),
        {"ignoreNullFields": "false"},
    )
    partial = F.to_json(F.struct(F.struct(F.col("case_id").alias("run_id"), result.alias("result"), alerts.alias("alerts")).alias("scan")))
    raw = F.when(style == 5, partial).when(style == 7, F.to_json(F.struct(full.alias("response")))).otherwise(full)
    return f.select("case_id", raw.alias("raw"))


# ------------------------------------------------------------------ payment decisions, one case per customer


def vendor_oracles(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    decision = choose(F.col("c_custkey") % 3, {0: "approve", 1: "hold"}, "escalate")
    return c.select(
        F.col("c_name").alias("case_id"),
        decision.alias("expected_decision"),
        F.array(F.lit("invoice.amount"), F.lit("audit_vendor.change_history.bank"), F.lit("ap_policy.limit")).alias("must_cite"),
        F.array(F.lit("Trust the email")).alias("forbidden_reasoning"),
    )


def raw_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """(case_id, raw): decision documents, varying by customer key and balance."""
    c = spread(table(spark, sf, "customer"), 4)
    k = F.col("c_custkey")
    decision = choose(k % 4, {0: "approve", 1: "Hold", 2: "escalate"}, "hold")
    item = lambda key, source, value: F.struct(
        F.lit(key).alias("key"), F.lit(source).alias("source"), F.lit(value).alias("value")
    )
    base = [
        item("result.amount", "records/invoice.json", "10"),
        item("audit.change_history.result.bank", "audit_vendor change_history", "changed"),
    ]
    evidence = (
        F.when(k % 5 == 0, F.array(base[0]))
        .when(k % 5 == 1, F.array(*base))
        .otherwise(F.array(*base, item("limit", "records/ap_policy.json", "500")))
    )
    reason = F.when(k % 7 == 0, F.lit("We trust the email thread")).otherwise(F.lit("Amount differs from order"))
    body = F.struct(
        decision.alias("decision"),
        reason.alias("primary_reason"),
        F.array(F.when(k % 11 == 0, F.lit("      ")).otherwise(F.lit("call the vendor"))).alias("required_next_step"),
        evidence.alias("evidence"),
        F.when(k % 13 == 0, F.lit(1.5)).otherwise(F.lit(0.9)).alias("confidence"),
        F.lit("The invoice needs a second look").alias("memo_summary"),
    )
    text = F.to_json(body)
    wrapped = F.to_json(F.struct(text.alias("answer")))
    return c.select(F.col("c_name").alias("case_id"), F.when(k % 2 == 0, text).otherwise(wrapped).alias("raw"))


# ------------------------------------------------------------------ files and traces


def files(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as workspace files, five per candidate; the path is the page's URL path."""
    p = table(spark, sf, "pages")
    path = F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1)
    return p.select(
        F.concat(F.lit("ws-"), F.floor(F.col("page_id") / 5).cast("string")).alias("candidate_id"),
        (F.col("page_id") % 5).cast("int").alias("ord"),
        F.when(F.col("page_id") % 17 == 0, F.concat(F.lit("../"), path)).otherwise(path).alias("path"),
        F.when(F.col("page_id") % 13 == 0, F.lit("# TODO")).otherwise(F.col("html")).alias("content"),
    )


def trace_events(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as tool calls of a trial."""
    c = table(spark, sf, "conversations")
    tool = choose(F.col("turn") % 4, {0: "Bash", 1: "Read", 2: "Grep"}, "Bash")
    n = F.col("conv_id") + F.col("turn")
    command = choose(
        n % 5,
        {
            0: "python3 tools/risk_tools.py read_headline_pack",
            1: "cat records/orders.yaml",
            2: "python3 tools/risk_tools.py calculate_exposure --entity-id X",
            3: "python3 tools/risk_tools.py read_record records/bom.yaml",
        },
        "ls hidden",
    )
    body = F.to_json(F.struct(command.alias("command")))
    return c.select(
        F.col("conv_id").alias("trial"),
        (F.col("turn") + 1).alias("line_no"),
        F.when(F.col("role") == "user", F.lit("message")).otherwise(F.lit("tool_call_end")).alias("event_type"),
        tool.alias("tool_name"),
        body.alias("arguments"),
        F.col("text").alias("output_text"),
    )


# ------------------------------------------------------------------ an experiment: customers are cases, orders trials, line items logs


def _case_id(key: str) -> Column:
    return F.concat(F.lit("case-"), F.col(key).cast("string"))


def experiment_cases(spark: SparkSession, sf: str) -> DataFrame:
    """(case_id, benchmark_case): one in eight lacks its prompt."""
    c = table(spark, sf, "customer")
    prompt = F.to_json(F.struct(F.col("c_name").alias("prompt")))
    return c.select(_case_id("c_custkey").alias("case_id"), F.when(F.col("c_custkey") % 8 == 3, F.lit("{}")).otherwise(prompt).alias("benchmark_case"))


def experiment_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """(case_id): one in nine customers has no task, one in nine has two."""
    k = F.col("c_custkey") % 9
    times = F.when(k == 5, 0).when(k == 6, 2).otherwise(1)
    c = table(spark, sf, "customer").select("c_custkey", F.explode(F.array_repeat(F.lit(1), times)))
    return c.select(_case_id("c_custkey").alias("case_id"))


def experiment_oracles(spark: SparkSession, sf: str) -> DataFrame:
    """(case_id, oracle JSON, zero_alert_run, true_alerts): every fourth case expects no alert."""
    k = F.col("c_custkey")
    alert = F.concat(F.lit('{"hidden_dependency_path":["E-'), (k % 3).cast("string"), F.lit('","asm"]}'))
    text = F.when(k % 4 == 0, F.lit('{"true_alerts":[],"zero_alert_run":true,"note":"no current exposure"}')).otherwise(
        F.concat(F.lit('{"true_alerts":['), alert, F.lit('],"zero_alert_run":false}'))
    )
    typed = F.from_json("oracle", f"zero_alert_run boolean, true_alerts array<{schemas.EXPECTED_ALERT.simpleString()}>")
    rows = table(spark, sf, "customer").select(_case_id("c_custkey").alias("case_id"), text.alias("oracle"))
    return rows.withColumn("typed", typed).select("case_id", "oracle", "typed.*")


def experiment_files(spark: SparkSession, sf: str) -> DataFrame:
    """(case_id, path, content): every required file of every case, with five kinds of fault by customer key."""
    kind = F.col("c_custkey") % 10
    required = fixed.REQUIRED_WORKSPACE_FILES
    extra = F.when(kind == 3, F.array(F.lit("evaluation/notes.md"))).otherwise(strings())
    paths = F.concat(F.array(*[F.lit(p) for p in required]), extra)
    c = table(spark, sf, "customer").where(kind != 1).select("c_custkey", F.explode(paths).alias("path"))
    heads = lambda n: F.lit("".join(f"## H{i:02d}\nnews\n\n" for i in range(1, n + 1)))
    pack = F.when(kind == 4, heads(2)).when(kind == 5, F.concat(heads(8), F.lit("SO-7731 late"))).otherwise(heads(8))
    content = F.when(F.col("path") == "events/headline-pack.md", pack).otherwise(F.lit("text"))
    lacking = (kind == 2) & (F.col("path") == required[0])
    return c.where(~lacking).select(_case_id("c_custkey").alias("case_id"), "path", content.alias("content"))


def experiment_trials(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    answer = F.when(k % 17 == 0, F.lit("no JSON")).when(k % 19 == 0, F.lit('{"scan":1}')).otherwise(F.lit('{"scan":{"alerts":[]}}'))
    return table(spark, sf, "orders").select(
        k.alias("trial"), _case_id("o_custkey").alias("case_id"),
        F.when(k % 2 == 0, F.lit("baseline")).otherwise(F.lit("evidence_first")).alias("variant"),
        F.when(k % 11 == 0, F.lit("1")).otherwise(F.lit("0")).alias("exit_status"), (F.col("o_orderstatus") == "F").alias("passed"),
        F.col("o_totalprice").alias("score"), answer.alias("response"), F.when(k % 13 == 0, F.lit("timed out")).alias("error"),
    )


def experiment_events(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as log lines of their order: risk-tool calls, and now and then a call that reads what it must not."""
    part = F.col("l_partkey")
    kind, odd = (F.col("l_linenumber") + F.col("l_orderkey") % 3) % 6, part % 10 == 0
    tool = f"python3 {fixed.RISK_TOOL_PATH} "
    command = (
        F.when(kind == 3, F.concat(F.lit(tool + "calculate_exposure --entity-id E-"), (part % 3).cast("string")))
        .when((kind == 4) & odd, F.lit("cat records/orders.yaml"))
        .when((kind == 5) & odd, F.lit("ls hidden"))
        .otherwise(choose(kind, {0: tool + "read_headline_pack", 1: tool + "read_record records/bom.yaml", 2: tool + "submit_risk_scan out.json"}, "ls"))
    )
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("trial"), F.col("l_linenumber").alias("line_no"),
        F.when(part % 13 == 0, F.lit("message")).otherwise(F.lit("tool_call_end")).alias("event_type"),
        F.when(F.col("l_suppkey") % 20 == 0, F.lit("Grep")).otherwise(F.lit("Bash")).alias("tool_name"),
        F.to_json(F.struct(command.alias("command"))).alias("arguments"), F.lit("").alias("output_text"),
    )
