"""Graders: submitted answers against hidden oracles. One join by case, then row-local expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill import fixed, schemas
from casemill.functions.scalars import (
    concept_hits,
    evidence_aliases,
    exposure_matches,
    field,
    has_marker,
    invented_record,
    is_json_object,
    let,
    overlaps,
    round4,
    strings,
    unwrap_answer,
    unwrap_response,
)
from casemill.operators.document_schema import compile_schema, violations
from casemill.operators.joins import join_oracles

ALERT_CHECKS = ["source_headline", "latent_edge", "enterprise_path", "business_exposure", "citations", "calibrated_uncertainty"]
NO_ALERTS = "array<" + schemas.ALERT.simpleString() + ">"


# ------------------------------------------------------------------ reading submitted scans


def _object(v: Column) -> Column:
    """An object (VARIANT) as a map of its fields, each copied out once; null for any other value."""
    return F.try_variant_get(v, "$", "map<string, variant>")


def _has_keys(fields: Column, keys: list[str]) -> Column:
    ok = F.lit(True)
    for key in keys:
        ok = ok & F.map_contains_key(fields, key)
    return ok


def _is_list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>").isNotNull()


def scan_schema_valid(scan: Column) -> Column:
    """Structure of a submitted scan (VARIANT): required keys, and lists and objects where expected."""
    get = lambda fields, key: F.try_element_at(fields, F.lit(key))

    def alert_ok(alert: Column) -> Column:
        def ok(a: Column) -> Column:
            exposure = let(_object(get(a, "business_exposure")), lambda e: F.coalesce(_has_keys(e, fixed.EXPOSURE_REQUIRED_KEYS), F.lit(False)))
            cited = let(_object(get(a, "citations")), lambda c: _is_list(get(c, "headlines")) & _is_list(get(c, "records")))
            lists = _is_list(get(a, "source_headlines")) & _is_list(get(a, "enterprise_path")) & _is_list(get(a, "uncertainty"))
            return _has_keys(a, fixed.ALERT_REQUIRED_KEYS) & exposure & cited & lists

        return F.coalesce(let(_object(alert), ok), F.lit(False))

    def ok(fields: Column) -> Column:
        alerts = F.try_variant_get(get(fields, "alerts"), "$", "array<variant>")
        return (
            _has_keys(fields, fixed.SCAN_REQUIRED_KEYS)
            & F.try_variant_get(get(fields, "result"), "$", "string").isin("alerts_found", "no_alert")
            & F.forall(alerts, alert_ok)
        )

    return F.coalesce(let(_object(scan), ok), F.lit(False))


def _alert(a: Column) -> Column:
    """An alert (VARIANT) as the typed struct; values of the wrong type become null."""
    text = lambda p: F.try_variant_get(a, p, "string")
    many = lambda p: F.coalesce(F.try_variant_get(a, p, "array<string>"), strings())
    return F.struct(
        text("$.id").alias("id"),
        text("$.confidence").alias("confidence"),
        many("$.source_headlines").alias("source_headlines"),
        text("$.latent_edge_hypothesis").alias("latent_edge_hypothesis"),
        text("$.real_world_prior").alias("real_world_prior"),
        many("$.enterprise_path").alias("enterprise_path"),
        F.struct(
            F.try_variant_get(a, "$.business_exposure.revenue_at_risk", "bigint").alias("revenue_at_risk"),
            many("$.business_exposure.affected_orders").alias("affected_orders"),
            many("$.business_exposure.affected_customers").alias("affected_customers"),
            F.try_variant_get(a, "$.business_exposure.constrained_inventory", "boolean").alias("constrained_inventory"),
        ).alias("business_exposure"),
        text("$.reasoning").alias("reasoning"),
        F.struct(many("$.citations.headlines").alias("headlines"), many("$.citations.records").alias("records")).alias("citations"),
        many("$.uncertainty").alias("uncertainty"),
    )


def parse_scans(df: DataFrame, raw_col: str = "raw") -> DataFrame:
    """(case_id, schema_valid, has_scan, scan) from submitted JSON text, envelope included."""
    kept = [c for c in df.columns if c != raw_col]
    v = F.col("_scan")
    read = df.select(*kept, field(unwrap_response(F.col(raw_col)), "$.scan").alias("_scan"))
    alerts = F.coalesce(F.try_variant_get(v, "$.alerts", "array<variant>"), F.array().cast("array<variant>"))
    scan = F.struct(
        F.try_variant_get(v, "$.result", "string").alias("result"),
        F.try_variant_get(v, "$.no_alert_rationale", "string").alias("no_alert_rationale"),
        F.transform(alerts, _alert).alias("alerts"),
    )
    return read.select(
        *kept,
        scan_schema_valid(v).alias("schema_valid"),
        F.coalesce(is_json_object(v) & (F.to_json(v) != "{}"), F.lit(False)).alias("has_scan"),
        scan.alias("scan"),
    )


# ------------------------------------------------------------------ alert scoring


def _latent_text(alert: Column) -> Column:
    parts = ("latent_edge_hypothesis", "real_world_prior", "reasoning")
    return F.lower(F.concat_ws(" ", *[F.coalesce(alert[f], F.lit("")) for f in parts]))


def alert_checks(alert: Column, expected: Column) -> Column:
    """Six booleans: how a submitted alert meets an expected one."""
    concepts = F.coalesce(expected["required_concepts"], strings())
    path = F.coalesce(alert["enterprise_path"], strings())
    on_path = let(
        F.lower(F.array_join(path, " ")),
        lambda text: F.forall(
            F.coalesce(expected["hidden_dependency_path"], strings()),
            lambda item: F.array_contains(path, item) | F.contains(text, F.lower(item)),
        ),
    )
    latent = _latent_text(alert)
    enough = let(latent, lambda text: concept_hits(concepts, text)) >= F.greatest(F.lit(2), F.size(concepts) - 1)
    uncertainty = F.coalesce(alert["uncertainty"], strings())
    hedged = let(F.concat(latent, F.lit(" "), F.lower(F.array_join(uncertainty, " "))), has_marker)
    cited = lambda f: F.size(F.coalesce(alert["citations"][f], strings())) > 0
    return F.struct(
        overlaps(alert["source_headlines"], expected["source_headlines"]).alias("source_headline"),
        enough.alias("latent_edge"),
        on_path.alias("enterprise_path"),
        exposure_matches(alert["business_exposure"], expected["business_exposure"]).alias("business_exposure"),
        (cited("headlines") & cited("records")).alias("citations"),
        ((F.size(uncertainty) > 0) & hedged).alias("calibrated_uncertainty"),
    )


def check_count(checks: Column) -> Column:
    total = F.lit(0)
    for name in ALERT_CHECKS:
        total = total + checks[name].cast("int")
    return total


def _scored(alerts: Column, expected: Column) -> Column:
    """Every alert with its checks and score against one expected alert, best first."""

    def score(a: Column, i: Column) -> Column:
        return let(
            alert_checks(a, expected),
            lambda c: F.struct(
                check_count(c).alias("score"), (-i).alias("earlier"), F.coalesce(a["id"], F.lit("")).alias("id"), c.alias("checks")
            ),
        )

    return F.transform(alerts, score)


def _best(scored: Column, expected_id: Column) -> Column:
    """The best of an expected alert's scored alerts; the first alert wins ties."""
    none = F.struct(*[F.lit(False).alias(c) for c in ALERT_CHECKS])
    return let(
        F.array_max(scored),
        lambda best: F.struct(
            expected_id.alias("expected_alert_id"),
            best["id"].alias("submitted_alert_id"),
            (F.coalesce(best["score"], F.lit(0)) >= fixed.ALERT_MATCH_SCORE).alias("matched"),
            F.coalesce(best["score"], F.lit(0)).alias("match_score"),
            F.coalesce(best["checks"], none).alias("checks"),
        ),
    )


def with_matches(df: DataFrame) -> DataFrame:
    """Adds ``best`` (one match per expected alert) and ``extra`` (alerts no expected alert accounts for).

    ``df`` has ``alerts`` and ``expected``. Every alert is scored against every expected alert of its own
    document once; both columns are read off that table.
    """
    table = F.transform("expected", lambda e: F.struct(e["id"].alias("id"), _scored(F.col("alerts"), e).alias("row")))
    best = F.transform("_scores", lambda s: _best(s["row"], s["id"]))
    ids = F.transform(F.filter("best", lambda b: b["matched"]), lambda b: b["submitted_alert_id"])

    def accounted(i: Column) -> Column:
        return F.exists("_scores", lambda s: F.get(s["row"], i)["score"] >= fixed.ALERT_MATCH_SCORE)

    extra = F.filter(
        "alerts", lambda a, i: ~F.array_contains(ids, F.coalesce(a["id"], F.lit("None"))) & ~accounted(i)
    )
    return df.withColumn("_scores", table).withColumn("best", best).withColumn("extra", extra).drop("_scores")


def best_alert_match(scans: DataFrame, oracles: DataFrame) -> DataFrame:
    """(case_id, expected_alert_id, submitted_alert_id, matched, match_score, checks) per expected alert.

    ``scans`` has case_id, schema_valid and the typed scan; a scan that fails its structure is not matched. Only
    alerts of the same document meet an expected alert, so the pairing stays inside the joined row.
    """
    pairs = _documents(scans, oracles)
    return with_matches(pairs).select("case_id", F.explode("best").alias("m")).select("case_id", "m.*")


def false_positives(scans: DataFrame, oracles: DataFrame) -> DataFrame:
    """(case_id, alert_id) of submitted alerts no expected alert accounts for, in scans of valid structure."""
    pairs = _documents(scans, oracles)
    return with_matches(pairs).select("case_id", F.explode("extra").alias("a")).select("case_id", F.col("a.id").alias("alert_id"))


def _documents(scans: DataFrame, oracles: DataFrame) -> DataFrame:
    joined = join_oracles(scans.where("schema_valid").select("case_id", "scan.alerts"), oracles.select("case_id", "true_alerts"))
    return joined.withColumnRenamed("true_alerts", "expected")


# ------------------------------------------------------------------ scan grades


def _points(checks: dict[str, Column]) -> Column:
    total = F.lit(0)
    for name, weight in fixed.SCAN_WEIGHTS.items():
        total = total + F.when(checks[name], F.lit(weight)).otherwise(F.lit(0))
    return total


def _score(points: Column, extra: Column) -> Column:
    return F.greatest(F.lit(0.0), (points - fixed.FALSE_POSITIVE_PENALTY * extra) / F.lit(float(sum(fixed.SCAN_WEIGHTS.values()))))


def _zero_alert_checks(alerts: Column, rationale: Column) -> dict[str, Column]:
    none = F.size(alerts) == 0
    argued = F.coalesce(rationale, F.lit("")) != ""
    return {
        "source_headline": none,
        "latent_edge": none,
        "enterprise_path": none,
        "business_exposure": none,
        "citations": argued,
        "calibrated_uncertainty": argued,
    }


def _meets(check: str):
    return lambda b: b["checks"][check]


def grade_scans(scans: DataFrame, oracles: DataFrame) -> DataFrame:
    """One grade per submitted scan: score, pass, the seven checks, false positives and hard failures.

    ``scans`` is what ``parse_scans`` returns; further columns (trial, variant) are kept. Each check is
    met when any expected alert's best match meets it.
    """
    extra_cols = [c for c in scans.columns if c not in ("case_id", "schema_valid", "has_scan", "scan")]
    joined = join_oracles(scans, oracles.select("case_id", "zero_alert_run", "true_alerts"))
    alerts = F.coalesce("scan.alerts", F.array().cast(NO_ALERTS))
    zero = F.coalesce("zero_alert_run", F.lit(False))
    base = joined.select(
        "case_id",
        *extra_cols,
        "schema_valid",
        "has_scan",
        zero.alias("zero"),
        F.col("scan.result").alias("result"),
        F.col("scan.no_alert_rationale").alias("rationale"),
        alerts.alias("alerts"),
        F.coalesce("true_alerts", F.array().cast("array<" + schemas.EXPECTED_ALERT.simpleString() + ">")).alias("expected"),
    )
    base = with_matches(base)
    on_zero = _zero_alert_checks(F.col("alerts"), F.col("rationale"))
    checks = {
        name: F.when(F.col("zero"), on_zero[name]).otherwise(F.exists("best", _meets(name)))
        for name in ALERT_CHECKS
    }
    checks["result_correct"] = F.col("result").eqNullSafe(
        F.when(F.col("zero"), F.lit("no_alert")).otherwise(F.lit("alerts_found"))
    )
    extra = F.when(F.col("zero"), F.size("alerts")).otherwise(F.size("extra"))
    valid = F.col("schema_valid")
    graded = base.select(
        "case_id",
        *extra_cols,
        "schema_valid",
        "has_scan",
        *[(valid & F.coalesce(checks[n], F.lit(False))).alias(n) for n in fixed.SCAN_WEIGHTS],
        F.when(valid, extra).otherwise(F.lit(0)).alias("false_positive_count"),
        (valid & F.exists("alerts", lambda a: invented_record(a["citations"]["records"]))).alias("invented_company_record"),
    )
    score = F.when(~F.col("schema_valid") | F.col("invented_company_record"), F.lit(0.0)).otherwise(
        _score(_points({n: F.col(n) for n in fixed.SCAN_WEIGHTS}), F.col("false_positive_count"))
    )
    scored = graded.withColumn("raw_score", score)
    passed = (
        (F.col("raw_score") >= fixed.SCAN_PASS_SCORE)
        & F.col("business_exposure")
        & (F.col("false_positive_count") == 0)
        & ~F.col("invented_company_record")
        & F.col("schema_valid")
    )
    return scored.select(
        "case_id",
        *extra_cols,
        passed.alias("passed"),
        round4(F.col("raw_score")).alias("score"),
        *fixed.SCAN_WEIGHTS,
        "false_positive_count",
        "invented_company_record",
        (F.col("false_positive_count") > 0).alias("unsupported_major_false_positive"),
        (~F.col("has_scan")).alias("missing_scan_object"),
        (~F.col("schema_valid")).alias("schema_violation"),
    )


def grade_scans_simple(scans: DataFrame, oracles: DataFrame) -> DataFrame:
    """First alert against first expected alert; every further alert is a false positive."""
    joined = join_oracles(scans.select("case_id", "scan"), oracles.select("case_id", "zero_alert_run", "true_alerts"))
    alerts = F.coalesce("scan.alerts", F.array().cast(NO_ALERTS))
    base = joined.select(
        "case_id",
        F.coalesce("zero_alert_run", F.lit(False)).alias("zero"),
        F.col("scan.result").alias("result"),
        F.col("scan.no_alert_rationale").alias("rationale"),
        alerts.alias("alerts"),
        F.get(alerts, F.lit(0)).alias("alert"),
        F.get("true_alerts", F.lit(0)).alias("expected"),
    ).withColumn("first", alert_checks(F.col("alert"), F.col("expected")))
    on_zero = _zero_alert_checks(F.col("alerts"), F.col("rationale"))
    submitted = F.col("alert").isNotNull()
    plain = {n: submitted & F.col("first")[n] for n in ALERT_CHECKS if n != "calibrated_uncertainty"}
    plain["calibrated_uncertainty"] = submitted & (F.size(F.coalesce("alert.uncertainty", strings())) > 0)
    checks = {n: F.when(F.col("zero"), on_zero[n]).otherwise(F.coalesce(plain[n], F.lit(False))) for n in ALERT_CHECKS}
    checks["result_correct"] = F.col("result").eqNullSafe(
        F.when(F.col("zero"), F.lit("no_alert")).otherwise(F.lit("alerts_found"))
    )
    extra = F.when(F.col("zero"), F.size("alerts")).otherwise(F.greatest(F.lit(0), F.size("alerts") - 1))
    graded = base.select("case_id", *[checks[n].alias(n) for n in fixed.SCAN_WEIGHTS], extra.alias("false_positive_count"))
    score = _score(_points({n: F.col(n) for n in fixed.SCAN_WEIGHTS}), F.col("false_positive_count"))
    return graded.withColumn("raw_score", score).select(
        "case_id",
        (
            (F.col("raw_score") >= fixed.SCAN_PASS_SCORE) & (F.col("false_positive_count") == 0) & F.col("business_exposure")
        ).alias("passed"),
        round4(F.col("raw_score")).alias("score"),
        *fixed.SCAN_WEIGHTS,
        "false_positive_count",
    )


# ------------------------------------------------------------------ payment decisions

EVIDENCE_ITEMS = "array<struct<key:string,source:string,value:string>>"


def parse_decisions(df: DataFrame, raw_col: str = "raw") -> DataFrame:
    """(case_id, body, answer): the decision object as JSON text and as a typed struct."""
    read = df.select("case_id", unwrap_answer(F.col(raw_col)).alias("_answer"))
    v = F.col("_answer")
    item = lambda e: F.struct(
        F.try_variant_get(e, "$.key", "string").alias("key"),
        F.try_variant_get(e, "$.source", "string").alias("source"),
        F.to_json(field(e, "$.value")).alias("value"),
    )
    evidence = F.transform(F.coalesce(F.try_variant_get(v, "$.evidence", "array<variant>"), F.array().cast("array<variant>")), item)
    answer = F.struct(
        F.try_variant_get(v, "$.decision", "string").alias("decision"),
        F.try_variant_get(v, "$.primary_reason", "string").alias("primary_reason"),
        F.coalesce(F.try_variant_get(v, "$.required_next_step", "array<string>"), strings()).alias("required_next_step"),
        evidence.alias("evidence"),
        F.try_variant_get(v, "$.confidence", "double").alias("confidence"),
        F.try_variant_get(v, "$.memo_summary", "string").alias("memo_summary"),
    )
    return read.select("case_id", F.to_json(v).alias("body"), answer.alias("answer"))


def grade_vendor(answers: DataFrame, oracles: DataFrame) -> DataFrame:
    """One grade per payment decision: schema gate, decision, evidence share, next step, confidence."""
    counted = answers.withColumn("schema_errors", F.size(violations(F.col("body"), compile_schema(fixed.DECISION_SCHEMA))).cast("bigint"))
    joined = join_oracles(counted, oracles)
    a = lambda f: F.col(f"answer.{f}")
    cited = evidence_aliases(a("evidence"))
    required = F.array_distinct(F.coalesce("must_cite", strings()))
    missing = F.array_sort(F.array_except(required, cited))
    text = F.lower(F.concat_ws(" ", a("primary_reason"), a("memo_summary"), F.array_join(a("required_next_step"), " ")))
    forbidden = F.filter(F.coalesce("forbidden_reasoning", strings()), lambda p: F.contains(text, F.lower(p)))
    steps = F.exists(a("required_next_step"), lambda s: F.length(F.btrim(s)) > 0)
    valid = (F.col("schema_errors") == 0) & F.col("body").isNotNull()
    judged = joined.select(
        "case_id",
        valid.alias("schema_valid"),
        F.coalesce("schema_errors", F.lit(0)).alias("schema_error_count"),
        "expected_decision",
        a("decision").alias("actual_decision"),
        (F.lower(a("decision")) == F.col("expected_decision")).alias("decision_ok"),
        missing.alias("missing_evidence"),
        F.size(required).alias("n_required"),
        forbidden.alias("forbidden_hits"),
        F.coalesce(steps, F.lit(False)).alias("has_step"),
        F.coalesce(a("confidence").between(0, 1), F.lit(False)).alias("sure"),
    )
    share = (F.col("n_required") - F.size("missing_evidence")) / F.greatest(F.lit(1), F.col("n_required"))
    give = lambda cond, w: F.when(cond, F.lit(w)).otherwise(F.lit(0.0))
    score = round4(
        give(F.col("decision_ok"), fixed.DECISION_WEIGHT)
        + F.lit(fixed.EVIDENCE_WEIGHT) * share
        + give(F.col("has_step"), fixed.NEXT_STEP_WEIGHT)
        + give(F.col("sure"), fixed.CONFIDENCE_WEIGHT)
    )
    final = F.when(F.col("schema_valid"), score).otherwise(F.lit(0.0))
    scored = judged.withColumn("score", final)
    passed = (
        F.col("schema_valid")
        & F.coalesce("decision_ok", F.lit(False))
        & (F.size("missing_evidence") == 0)
        & (F.size("forbidden_hits") == 0)
        & (F.col("score") >= fixed.DECISION_PASS_SCORE)
    )
    return scored.select(
        "case_id", passed.alias("passed"), "score", "schema_valid", "schema_error_count", "expected_decision",
        "actual_decision", "missing_evidence", "forbidden_hits",
    )
