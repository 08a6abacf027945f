"""Run and performance reports as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.functions.scalars import attempt_number, clip, strings
from casemill.operators import metrics
from casemill.operators.joins import first_seen


def union_attempts(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    """Every attempt: rejected ones with their route, accepted ones as ``accept``. UNION ALL.

    Both sides have id, design_id, case_type, ability, prompt, proxy_claim, ord; the rejected side also
    route_code and subcodes, the accepted side optionally ``checks`` (gate verdict structs).
    """
    no_checks = F.array().cast("array<struct<check_kind:string,verdict:string,subcodes:array<string>,rationale:string>>")
    design = F.coalesce(F.nullif("design_id", F.lit("")), F.lit("unknown-design")).alias("design_id")
    plain = ["id", "case_type", "ability", "prompt", "proxy_claim"]
    left = rejected.select(
        design, *plain, "route_code", "subcodes", F.lit(False).alias("accepted"), no_checks.alias("checks"), "ord"
    )
    gates = F.col("checks") if "checks" in accepted.columns else no_checks
    right = accepted.select(
        design, *plain, F.lit("accept").alias("route_code"), strings().alias("subcodes"), F.lit(True).alias("accepted"),
        gates.alias("checks"), "ord",
    )
    return left.unionByName(right)


def _attempt_key() -> Column:
    return F.struct(F.col("id"), attempt_number(F.col("id"), F.lit(0)).alias("n"), F.col("accepted"), F.col("ord"))


def design_stories(rejected: DataFrame, accepted: DataFrame, stages: DataFrame) -> DataFrame:
    """One row per design: attempts, final status and route, what it tested, and when it first appeared.

    Attempts are never collected: the first and last of a design come from min_by and max_by, which
    combine map-side, so a design with very many attempts costs no more than a small one.
    """
    attempts = union_attempts(rejected, accepted)
    seen = first_seen(attempts.select("id").where(F.col("id").isNotNull()).distinct(), stages)
    timed = attempts.join(seen.where(F.col("first_seen") != ""), "id", "left")
    key = _attempt_key()
    about = F.struct("case_type", "ability", "prompt", "proxy_claim")
    stories = timed.groupBy("design_id").agg(
        F.count("*").alias("attempts"),
        F.count_if("accepted").alias("n_accepted"),
        F.max_by("route_code", key).alias("last_route"),
        F.min_by(about, key).alias("first"),
        F.coalesce(F.min("first_seen"), F.lit("")).alias("first_seen"),
    )
    route = F.coalesce("last_route", F.lit("unknown"))
    return stories.select(
        "design_id",
        F.when(F.col("n_accepted") > 0, F.lit("accepted")).otherwise(F.lit("failed")).alias("final_status"),
        "attempts",
        F.coalesce("first.case_type", F.lit("?")).alias("case_type"),
        F.coalesce("first.ability", F.lit("?")).alias("ability"),
        clip(F.coalesce("first.prompt", F.lit("")), 220).alias("prompt"),
        clip(F.coalesce("first.proxy_claim", F.lit("")), 220).alias("proxy_claim"),
        route.alias("final_route"),
        F.startswith(route, F.lit("drop_")).alias("dropped"),
        "first_seen",
    )


def _codes(col: Column, limit: int) -> Column:
    return F.coalesce(F.nullif(F.array_join(F.slice(col, 1, limit), ","), F.lit("")), F.lit("-"))


def story_lines(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    """(design_id, position, attempt, line, gates): the printable attempt lines of each story, as rows.

    Attempts without a design share one story, which may be very long; positions are ranked by ranges.
    """
    order = [F.col("id"), attempt_number(F.col("id"), F.lit(0)), F.col("accepted"), F.col("ord")]
    placed = metrics.ranked_by(union_attempts(rejected, accepted), ["design_id"], order)
    number = attempt_number(F.col("id"), F.col("position"))
    verdict = F.when(F.col("accepted"), F.lit("accepted")).otherwise(F.lit("rejected"))
    line = F.concat(
        F.lit("attempt "), number.cast("string"), F.lit(": "), verdict, F.lit(" route="),
        F.coalesce("route_code", F.lit("unknown")), F.lit(" codes="), _codes(F.col("subcodes"), 7),
    )

    def gate(c: Column) -> Column:
        rationale = clip(F.coalesce(c["rationale"], F.lit("")), 240)
        head = F.concat(
            F.coalesce(c["check_kind"], F.lit("gate")), F.lit(": "), F.coalesce(c["verdict"], F.lit("?")), F.lit(" codes="),
            _codes(F.coalesce(c["subcodes"], strings()), 5),
        )
        return F.when(rationale != "", F.concat(head, F.lit(' rationale="'), rationale, F.lit('"'))).otherwise(head)

    return placed.select(
        "design_id", "position", number.alias("attempt"), line.alias("line"), F.transform("checks", gate).alias("gates")
    )


def run_report(stages: DataFrame, rejected: DataFrame, accepted: DataFrame, limit: int = 12) -> dict[str, DataFrame]:
    """The tables of a run report: totals, routes, rejection codes, stories, recent items, timeline."""
    codes = stages.where(F.col("verdict") == "reject").select(F.explode("subcodes").alias("code"), "ord")
    stories = design_stories(rejected, accepted, stages)
    return {
        "totals": stages.agg(
            F.count("*").alias("stages"), F.min_by("wallclock_ts", "ord").alias("first_ts"), F.max_by("wallclock_ts", "ord").alias("last_ts")
        ),
        "routes": metrics.most_common(stages, "route_code"),
        "rejection_codes": metrics.most_common(codes, "code"),
        "stories": stories.orderBy(F.desc("first_seen"), F.desc("design_id")).limit(limit).orderBy("first_seen", "design_id"),
        "story_lines": story_lines(rejected, accepted),
        "accepted": metrics.recent(accepted, limit),
        "rejected": metrics.recent(rejected, limit),
        "timeline": metrics.timeline(stages),
    }


def perf_report(stages: DataFrame, events: DataFrame, top: int = 8, run_col: str = "run_id") -> dict[str, DataFrame]:
    """The tables of a performance report."""
    return {
        "totals": metrics.perf_totals(stages, run_col),
        "by_role": metrics.perf_by_role(stages).orderBy(F.desc("total_ms"), "role"),
        "request_sizes": metrics.request_sizes(events).orderBy(F.desc("total_bytes"), "label"),
        "slowest": metrics.slowest(stages, top),
        "rejection_waste": metrics.rejection_waste(stages, top),
        "routes": metrics.route_counts(stages).orderBy(F.desc("n"), "role", "route_code"),
    }
