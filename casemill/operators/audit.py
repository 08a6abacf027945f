"""Audits of case sets, workspaces, agent traces and experiment trials."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill import fixed
from casemill.functions.scalars import contains_any, field, is_json_object
from casemill.operators.document_schema import compile_schema, schema_errors, violations
from casemill.operators.joins import divergence_label, paired_variants


def failures(df: DataFrame, scope: Column, message: Column | str) -> DataFrame:
    """(scope, failure) rows."""
    text = message if isinstance(message, Column) else F.lit(message)
    return df.select(scope.cast("string").alias("scope"), text.alias("failure"))


def audit_corpus(tasks: DataFrame, oracles: DataFrame) -> DataFrame:
    """Failures in a case set's shape: ids, size, positives, zero-alert and no-exposure controls.

    ``oracles`` is (case_id, oracle) with the oracle as JSON text.
    """
    counted = tasks.groupBy("case_id").agg(F.count("*").alias("n"))
    duplicate = failures(counted.where("n > 1"), F.col("case_id"), "task rows contain duplicate ids")
    sides = counted.select("case_id", F.lit(True).alias("task")).join(
        oracles.select("case_id", F.lit(True).alias("oracle_row")), "case_id", "full"
    )
    unmatched = failures(
        sides.where(F.col("task").isNull() | F.col("oracle_row").isNull()), F.col("case_id"), "task rows and hidden oracles differ"
    )
    v = F.try_parse_json("oracle")
    alerts = F.coalesce(F.size(F.try_variant_get(v, "$.true_alerts", "array<variant>")), F.lit(0))
    zero = F.coalesce(F.try_variant_get(v, "$.zero_alert_run", "boolean"), F.lit(False))
    shape = oracles.agg(
        F.count("*").alias("cases"),
        F.count_if(alerts > 0).alias("positives"),
        F.count_if(zero).alias("zero_alert"),
        F.count_if(zero & F.contains(F.lower("oracle"), F.lit("exposure"))).alias("no_exposure"),
    )
    rules = [
        (F.col("cases") < 4, "corpus has fewer than four cases"),
        (F.col("positives") < 2, "corpus has fewer than two positive latent-risk cases"),
        (F.col("zero_alert") == 0, "corpus has no zero-alert case"),
        (F.col("no_exposure") == 0, "corpus has no explicit no-current-exposure control"),
    ]
    found = F.array_compact(F.array(*[F.when(bad, F.lit(why)) for bad, why in rules]))
    overall = shape.select(F.explode(found).alias("failure")).select(F.lit("corpus").alias("scope"), "failure")
    return duplicate.unionByName(unmatched).unionByName(overall)


def audit_case_schema(cases: DataFrame, schema: dict, case_col: str = "benchmark_case") -> DataFrame:
    """One failure per case that violates its schema, naming the first violation."""
    errors = schema_errors(cases, case_col, compile_schema(schema), "case_id")
    first = errors.groupBy("case_id").agg(F.min(F.struct("sort_path", "rule_ord", "path", "message")).alias("e"))
    why = F.concat(F.lit("violates domain schema: "), F.replace("e.path", F.lit("."), F.lit("/")), F.lit(": "), F.col("e.message"))
    return failures(first, F.col("case_id"), why)


def _many(df: DataFrame) -> DataFrame:
    """A join's right side that must not pass the driver: Catalyst takes rows made from few bytes for few and broadcasts them."""
    return df.hint("merge")


def missing_workspace_files(cases: DataFrame, files: DataFrame, required: list[str] | None = None) -> DataFrame:
    """(case_id, path) of required files a case's workspace lacks."""
    wanted = F.array(*[F.lit(p) for p in (required or fixed.REQUIRED_WORKSPACE_FILES)])
    return cases.select("case_id", F.explode(wanted).alias("path")).join(_many(files.select("case_id", "path")), ["case_id", "path"], "left_anti")


def leaked_files(files: DataFrame) -> DataFrame:
    """(case_id, path) of hidden, oracle or evaluation files inside a workspace."""
    name = F.element_at(F.split("path", "/"), -1)
    lowered = F.lower(name)
    leaked = (
        F.contains(lowered, F.lit("hidden"))
        | F.contains(lowered, F.lit("oracle"))
        | F.array_contains(F.split("path", "/"), "evaluation")
        | (name == "trial_input.json")
    )
    return files.where(leaked).select("case_id", "path")


def internal_ids(text: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(fixed.INTERNAL_ID_PATTERN), F.lit(0))))


def audit_workspaces(cases: DataFrame, files: DataFrame) -> DataFrame:
    """Failures in workspace file tables: missing and leaked files, headline count, internal ids."""
    present = cases.join(_many(files), "case_id", "left_semi")
    absent = failures(cases.join(_many(files), "case_id", "left_anti"), F.col("case_id"), "workspace missing")
    lacking = missing_workspace_files(present, files)
    missing = failures(lacking, F.col("case_id"), F.concat(F.lit("missing public workspace file "), "path"))
    leaked = failures(leaked_files(files), F.col("case_id"), F.concat(F.lit("hidden/evaluation file leaked into workspace "), "path"))
    packs = files.where(F.col("path") == "events/headline-pack.md").select(
        "case_id",
        F.size(F.regexp_extract_all("content", F.lit(r"(?m)^## H[0-9]{2}$"), F.lit(0))).alias("items"),
        internal_ids(F.col("content")).alias("ids"),
    )
    count = failures(
        packs.where(~F.col("items").between(8, 12)),
        F.col("case_id"),
        F.concat(F.lit("headline pack has "), F.col("items").cast("string"), F.lit(" items, expected 8-12")),
    )
    ids = failures(
        packs.where(F.size("ids") > 0), F.col("case_id"), F.concat(F.lit("headline pack leaks internal ids "), F.array_join("ids", ", "))
    )
    return reduce(DataFrame.unionByName, [absent, missing, leaked, count, ids])


# ------------------------------------------------------------------ traces


def trace_rows(events: DataFrame) -> DataFrame:
    """(trial, line_no, event_type, tool_name, arguments, output_text) from parsed log events."""
    get = lambda p: F.try_variant_get("event", p, "string")
    return events.select(
        "trial",
        "line_no",
        get("$.event_type").alias("event_type"),
        get("$.tool.name").alias("tool_name"),
        field(F.col("event"), "$.input.arguments").cast("string").alias("arguments"),
        get("$.output.text").alias("output_text"),
    )


def _command() -> Column:
    return F.try_variant_get(F.try_parse_json("arguments"), "$.command", "string")


def _trespasses() -> Column:
    """What a tool call touches that it must not, as an array of texts; empty for other events."""
    arguments = F.coalesce("arguments", F.lit("{}"))
    command = F.coalesce(_command(), F.lit(""))
    direct = F.lit(False)
    for pattern in fixed.DIRECT_READ_PATTERNS:
        direct = direct | command.rlike(pattern)
    found = F.array_compact(
        F.array(
            F.when(
                contains_any(F.lower(arguments), fixed.HIDDEN_TRACE_MARKERS),
                F.lit("tool input references hidden/evaluation material"),
            ),
            F.when(
                F.col("tool_name").isin("Read", "Grep", "Glob") & contains_any(arguments, fixed.PUBLIC_RECORD_MARKERS),
                F.concat("tool_name", F.lit(" accessed public records/headlines outside risk_tools API")),
            ),
            F.when(
                (F.col("tool_name") == "Bash") & direct & ~F.contains(command, F.lit(fixed.RISK_TOOL_PATH)),
                F.lit("Bash command accessed public records/headlines outside risk_tools API"),
            ),
        )
    )
    return F.when(F.col("event_type") == "tool_call_end", found).otherwise(F.array().cast("array<string>"))


def trace_violations(events: DataFrame, trials: DataFrame | None = None) -> DataFrame:
    """(trial, line_no, violation) of tool calls that touch hidden material or read records directly.

    With ``trials``, a trial without any event is a violation of its own (line 0).
    """
    rows = events.select("trial", "line_no", F.explode(_trespasses()).alias("violation"))
    if trials is None:
        return rows
    silent = trials.select("trial").join(events.select("trial").distinct(), "trial", "left_anti")
    return rows.unionByName(silent.select("trial", F.lit(0).alias("line_no"), F.lit("missing events log").alias("violation")))


def tool_calls(events: DataFrame) -> DataFrame:
    """(trial, line_no, command_name, command, output) of risk-tool calls, in log order per trial."""
    command = _command()
    name = F.lit("unknown")
    for known in reversed(fixed.RISK_TOOL_COMMANDS):
        name = F.when(F.contains(command, F.lit(f" {known}")), F.lit(known)).otherwise(name)
    parsed = F.try_parse_json("output_text")
    output = F.when(parsed.isNotNull(), F.to_json(parsed)).otherwise(F.substring("output_text", 1, 1200))
    calls = events.where((F.col("event_type") == "tool_call_end") & (F.col("tool_name") == "Bash"))
    return calls.where(F.contains(command, F.lit(fixed.RISK_TOOL_PATH))).select(
        "trial", "line_no", name.alias("command_name"), command.alias("command"), output.alias("output")
    )


def scan_facts(trials: DataFrame) -> DataFrame:
    """Adds the response's scan: result, alert count, divergence label and first alert."""
    v = field(F.try_parse_json("response"), "$.scan")
    alerts = F.try_variant_get(v, "$.alerts", "array<variant>")
    scan = F.struct(F.try_variant_get(v, "$.result", "string").alias("result"), F.coalesce(alerts, F.array().cast("array<variant>")).alias("alerts"))
    return (
        trials.withColumn("scan", scan)
        .withColumn("label", divergence_label())
        .withColumn("alert_count", F.size("scan.alerts"))
        .withColumn("first_alert", F.get("scan.alerts", F.lit(0)))
        .withColumn("scan_result", F.col("scan.result"))
        .drop("scan")
    )


def variant_artifact(trials: DataFrame, events: DataFrame) -> DataFrame:
    """One row per trial: outcome, divergence label and how often each risk tool was called.

    The calls themselves stay rows (``tool_calls``); a trial's log has no bound worth collecting.
    """
    calls = tool_calls(events).groupBy("trial").agg(
        F.count("*").alias("risk_tool_calls"),
        F.count_if(F.col("command_name") == "calculate_exposure").alias("exposure_calls"),
        F.count_if(F.col("command_name") == "submit_risk_scan").alias("submit_calls"),
    )
    facts = scan_facts(trials).join(calls, "trial", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return facts.select(
        "trial", "case_id", "variant", "exit_status", "passed", "score", "label", "scan_result", "alert_count",
        zero("risk_tool_calls"), zero("exposure_calls"), zero("submit_calls"),
    )


# ------------------------------------------------------------------ trials


def _log_facts(events: DataFrame) -> DataFrame:
    """(trial, exposure, trespasses, one flag per required command): a log in as many rows as it has exposure commands.

    One pass over the events; they combine before the shuffle, so a log with a third of all events stays small.
    """
    used = (F.col("event_type") == "tool_call_end") & (F.col("tool_name") == "Bash") & F.contains(_command(), F.lit(fixed.RISK_TOOL_PATH))
    calls = events.select(
        "trial", F.size(_trespasses()).alias("trespasses"), F.when(used, F.concat(F.lit(" "), _command(), F.lit(" "))).alias("command")
    )
    calls = calls.withColumn("exposure", F.when(F.contains("command", F.lit(" calculate_exposure ")), F.col("command")))
    did = lambda text: F.coalesce(F.bool_or(F.contains("command", F.lit(text))), F.lit(False))
    return calls.groupBy("trial", "exposure").agg(
        F.sum("trespasses").alias("trespasses"),
        did(" read_headline_pack").alias("read_headlines"),
        did(" read_record ").alias("read_record"),
        did(" submit_risk_scan ").alias("submitted"),
    )


def audit_trials(trials: DataFrame, oracles: DataFrame, events: DataFrame, response_schema: dict | None = None) -> DataFrame:
    """Failures of experiment trials: runtime, schema, tool path, exposure target, expected outcome.

    ``trials`` has one row a trial; ``oracles`` is (case_id, zero_alert_run, true_alerts typed). A response is judged
    inside its row, logs are read once, and all that is known of a trial meets in one grouping by trial. Trials of a
    case without an oracle are left out, as are events of unknown trials; a trial without events has one violation.
    """
    unreadable = ~is_json_object(F.try_parse_json("response"))
    if response_schema:
        unreadable = unreadable | (F.size(violations(F.col("response"), compile_schema(response_schema))) > 0)
    target = F.get(F.get("true_alerts", F.lit(0))["hidden_dependency_path"], F.lit(0))
    hidden = oracles.select("case_id", F.coalesce("zero_alert_run", F.lit(False)).alias("zero"), target.alias("entity"))
    stated = trials.select(
        "trial", "case_id", "variant", "passed",
        F.coalesce((F.col("exit_status") != "0") | F.col("error").isNotNull(), F.lit(False)).alias("crashed"),
        F.coalesce(unreadable, F.lit(True)).alias("unreadable"),
    ).join(_many(hidden), "case_id")
    known = stated.columns
    yes = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    met = stated.join(_log_facts(events), "trial", "left").groupBy(*known).agg(
        F.coalesce(F.sum("trespasses"), F.lit(1)).alias("violations"),
        yes("read_headlines").alias("read_headlines"),
        yes("read_record").alias("read_record"),
        yes("submitted").alias("submitted"),
        yes(F.col("exposure").isNotNull()).alias("exposed"),
        yes(F.contains("exposure", F.col("entity"))).alias("hit_target"),
    )
    first, baseline = F.col("variant") == "evidence_first", F.col("variant") == "baseline"
    rules = [
        (F.col("crashed"), F.lit("agent runtime failed")),
        (F.col("violations") > 0, F.concat(F.lit("trace access violations: "), F.col("violations").cast("string"))),
        (F.col("unreadable"), F.lit("final response is not schema-valid")),
        (
            ~(F.col("read_headlines") & F.col("read_record") & F.col("submitted")),
            F.lit("trace does not use required workspace API/read/submit path"),
        ),
        (first & ~F.col("exposed"), F.lit("evidence-first trace did not call calculate_exposure")),
        (
            first & F.col("entity").isNotNull() & ~F.col("hit_target"),
            F.concat(F.lit("evidence-first exposure call did not target expected dependency "), "entity"),
        ),
        (first & ~F.col("passed"), F.lit("evidence-first did not pass hidden oracle")),
        (
            baseline & (F.col("passed") != F.col("zero")),
            F.concat(F.lit("baseline pass="), F.col("passed").cast("string"), F.lit(" expected "), F.col("zero").cast("string")),
        ),
    ]
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), why) for bad, why in rules]))
    label = F.concat_ws(":", "case_id", "variant")
    return met.select(label.alias("scope"), F.explode(found).alias("failure"))


def verify_experiment(
    cases: DataFrame, tasks: DataFrame, oracles: DataFrame, files: DataFrame, case_schema: dict,
    trials: DataFrame | None = None, events: DataFrame | None = None, typed_oracles: DataFrame | None = None,
    response_schema: dict | None = None,
) -> DataFrame:
    """(section, scope, failure): every failure of a case set and, when given, of its run. Empty is good."""
    tag = lambda df, section: df.select(F.lit(section).alias("section"), "scope", "failure")
    parts = [
        tag(audit_case_schema(cases, case_schema), "case_schema"),
        tag(audit_corpus(tasks, oracles), "corpus"),
        tag(audit_workspaces(oracles.select("case_id"), files), "workspace"),
    ]
    if trials is not None:
        # both counts in one aggregate over the stacked rows
        each = lambda df, n, want: df.select(F.lit(n).alias("n"), F.lit(want).alias("expected"))
        run = each(trials, 1, 0).unionByName(each(oracles, 0, len(fixed.VARIANTS))).agg(
            F.sum("n").alias("n"), F.sum("expected").alias("expected")
        )
        off = run.where("n != expected")
        why = F.concat(F.lit("run has "), F.col("n").cast("string"), F.lit(" trials, expected "), F.col("expected").cast("string"))
        parts.append(tag(failures(off, F.lit("run"), why), "run"))
        parts.append(tag(audit_trials(trials, typed_oracles, events, response_schema), "trial"))
    return reduce(DataFrame.unionByName, parts)


def demo_artifact(trials: DataFrame, case_id: str | None = None) -> DataFrame:
    """Paired variants of a case with the evidence-first trial's first alert as the path to show."""
    facts = scan_facts(trials)
    pairs = paired_variants(facts, case_id)
    alert = F.col("first_alert")
    get = lambda p: F.try_variant_get(alert, p, "string")
    hot = facts.where(F.col("variant") == "evidence_first").select(
        F.col("trial").alias("evidence_first_trial"),
        F.array_join(F.try_variant_get(alert, "$.source_headlines", "array<string>"), ", ").alias("world_event"),
        get("$.latent_edge_hypothesis").alias("latent_edge"),
        F.coalesce(F.try_variant_get(alert, "$.enterprise_path", "array<string>"), F.array().cast("array<string>")).alias("enterprise_path"),
        field(alert, "$.business_exposure").cast("string").alias("business_exposure"),
        F.when(alert.isNotNull(), F.col("scan_result")).alias("final_result"),
    )
    return pairs.join(hot, "evidence_first_trial")
