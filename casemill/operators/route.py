"""Routing: what happens next to an item, as a decision table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill import fixed
from casemill.functions.scalars import strings


def decision(stage: Column, verdict: Column, route_code: Column, retry: Column, design_max: Column, gen_max: Column) -> Column:
    """Struct(next_stage, context_policy, terminal, route_code) for one stage result.

    One ordered table: (when, next stage, context policy, final route). A row without a next stage ends
    the item.
    """
    ok = verdict == "accept"
    no_stage, keep = F.lit(None).cast("string"), route_code
    exhausted = F.lit("drop_retry_exhausted")
    at = lambda name: stage == name
    table = [
        (at("design") & ok, F.lit("design_audit"), "fresh", keep),
        (at("design"), no_stage, "fresh", keep),
        (at("design_audit") & ok, F.lit("generation"), "criteria_only", keep),
        (at("design_audit") & (retry < design_max), F.lit("design"), "criteria_plus_route_code", keep),
        (at("design_audit"), no_stage, "fresh", exhausted),
        (at("generation") & ok, F.lit("validation"), "criteria_only", keep),
        (
            at("generation") & route_code.isin(*fixed.PROVIDER_ROUTES) & (retry < gen_max),
            F.lit("generation"),
            "same_input_retry",
            keep,
        ),
        (at("generation"), no_stage, "fresh", exhausted),
        (at("validation") & ok, F.lit("curation"), "criteria_only", keep),
        (at("validation") & (retry < gen_max), F.lit("generation"), "criteria_plus_route_code", keep),
        (at("validation"), no_stage, "fresh", exhausted),
        (at("curation") & ok, no_stage, "fresh", keep),
        (at("curation"), no_stage, "fresh", F.lit("reject_duplicate")),
    ]
    result = F.lit(None).cast("struct<next_stage:string,context_policy:string,terminal:boolean,route_code:string>")
    for when, next_stage, policy, final in reversed(table):
        result = F.when(
            F.coalesce(when, F.lit(False)),
            F.struct(
                next_stage.alias("next_stage"),
                F.lit(policy).alias("context_policy"),
                next_stage.isNull().alias("terminal"),
                final.alias("route_code"),
            ),
        ).otherwise(result)
    return result


def route(df: DataFrame, design_max: int = 2, generation_max: int = 2) -> DataFrame:
    """Adds the decision to stage results (stage_kind, verdict, route_code, retry_index)."""
    d = decision(
        F.col("stage_kind"), F.col("verdict"), F.col("route_code"), F.col("retry_index"), F.lit(design_max), F.lit(generation_max)
    )
    return df.withColumn("_d", d).select(
        "*",
        F.col("_d.next_stage").alias("next_stage"),
        F.col("_d.context_policy").alias("context_policy_out"),
        F.col("_d.terminal").alias("terminal"),
        F.col("_d.route_code").alias("final_route"),
    ).drop("_d")


def route_adversary(cands: DataFrame, reports: DataFrame, generation_max: int = 2) -> DataFrame:
    """(candidate_id, action, route_code, subcodes, next_stage, terminal) from adversary dispositions.

    ``pass`` goes on to the gates, ``revise`` to a revision and back to validation, ``nuke`` is a
    semantic reject. A disposition outside the three counts as ``revise``. ``cands`` has id, retry_index.
    """
    stated = F.lower("revision_disposition")
    disposition = F.when(stated.isin("pass", "revise", "nuke"), stated).otherwise(F.lit("revise"))
    joined = cands.select(F.col("id").alias("candidate_id"), "retry_index").join(
        reports.select("candidate_id", disposition.alias("disposition")), "candidate_id"
    )
    nuked = decision(
        F.lit("validation"), F.lit("reject"), F.lit("reject_semantic_mismatch"), F.col("retry_index"), F.lit(0), F.lit(generation_max)
    )
    nuke = F.col("disposition") == "nuke"
    action = F.when(nuke, F.lit("reject")).when(F.col("disposition") == "pass", F.lit("gates")).otherwise(F.lit("revise"))
    return joined.withColumn("_d", nuked).select(
        "candidate_id",
        action.alias("action"),
        F.when(nuke, F.col("_d.route_code")).alias("route_code"),
        F.when(nuke, F.array(F.lit("adversary_nuke"))).otherwise(strings()).alias("subcodes"),
        F.when(nuke, F.col("_d.next_stage")).when(F.col("disposition") == "revise", F.lit("validation")).alias("next_stage"),
        F.when(nuke, F.col("_d.terminal")).otherwise(F.lit(False)).alias("terminal"),
    )


def audit_routes(stages: DataFrame, decisions: DataFrame | None = None, design_max: int = 2, generation_max: int = 2) -> DataFrame:
    """Logged decisions that the routing table does not reproduce.

    ``stages`` holds the logged next_stage, context_policy, terminal and final_route next to their
    inputs (or ``decisions`` does, joined by ``stage_id``).
    """
    logged = stages if decisions is None else stages.join(decisions, "stage_id")
    d = decision(
        F.col("stage_kind"), F.col("verdict"), F.col("route_code"), F.col("retry_index"), F.lit(design_max), F.lit(generation_max)
    )
    said = F.struct("next_stage", "terminal", F.col("final_route").alias("route_code"))

    def differs(x: Column) -> Column:
        fields = ("next_stage", "terminal", "route_code")
        return ~(F.struct(*[x[f].alias(f) for f in fields]).eqNullSafe(said))

    # exploding the at most one disagreement evaluates the table once per row
    return logged.select("*", F.explode(F.filter(F.array(d), differs)).alias("_d")).select(
        *logged.columns,
        F.col("_d.next_stage").alias("expected_next_stage"),
        F.col("_d.terminal").alias("expected_terminal"),
        F.col("_d.route_code").alias("expected_route"),
    )


def run_outcome(decisions: DataFrame) -> DataFrame:
    """(run_id, final_status, committed, dropped, last_candidate, last_route, last_subcodes).

    ``decisions`` has run_id, ord, from_stage, verdict, route_code, subcodes, candidate_id, terminal.
    """
    committed = F.count_if((F.col("from_stage") == "curation") & (F.col("verdict") == "accept"))
    dropped = F.count_if(F.col("terminal") & (F.col("verdict") == "reject"))
    last = F.max_by(F.struct("candidate_id", "route_code", "subcodes"), "ord")
    totals = decisions.groupBy("run_id").agg(committed.alias("committed"), dropped.alias("dropped"), last.alias("last"))
    status = (
        F.when(F.col("committed") > 0, F.lit("committed"))
        .when(F.col("dropped") > 0, F.lit("dropped"))
        .otherwise(F.lit("incomplete"))
    )
    return totals.select(
        "run_id", status.alias("final_status"), "committed", "dropped",
        F.col("last.candidate_id").alias("last_candidate"), F.col("last.route_code").alias("last_route"),
        F.col("last.subcodes").alias("last_subcodes"),
    )
