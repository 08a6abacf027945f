"""Joins between candidates, verdicts, stages, orders, oracles and trials."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill import fixed
from casemill.functions.scalars import evidence_aliases


def join_oracles(answers: DataFrame, oracles: DataFrame) -> DataFrame:
    """Answers with the oracle of their case. Catalyst broadcasts the oracles when they are small."""
    return answers.join(oracles, "case_id")


def missing_items(required: DataFrame, present: DataFrame, key: str | list[str]) -> DataFrame:
    """Required rows whose key is not present."""
    return required.join(present, key, "left_anti")


def first_seen(candidates: DataFrame, stages: DataFrame) -> DataFrame:
    """(id, first_seen): the earliest stage that names a candidate as its artifact or its parent.

    Either reference counts, so stages are stacked as (reference, time), pre-aggregated per reference
    and then joined by equality.
    """
    refs = F.array_distinct(F.array_compact(F.array("artifact_id", "parent_artifact_id")))
    seen = (
        stages.select(F.explode(refs).alias("id"), "wallclock_ts")
        .groupBy("id")
        .agg(F.min("wallclock_ts").alias("first_seen"))
    )
    return candidates.select("id").join(seen, "id", "left").select("id", F.coalesce("first_seen", F.lit("")).alias("first_seen"))


# ------------------------------------------------------------------ exposure


def bom_links(boms: DataFrame) -> DataFrame:
    """(entity_id, product_id): what each product is made of, components and their inputs alike."""
    parts = boms.select("product_id", F.explode("components").alias("c"))
    ids = F.concat(F.array("c.component_id"), F.coalesce("c.inputs", F.array().cast("array<string>")))
    return parts.select("product_id", F.explode(F.array_compact(ids)).alias("entity_id")).distinct()


def exposed_products(requests: DataFrame, links: DataFrame) -> DataFrame:
    """(request_id, product_id): products built from a request's entities, and the entities themselves."""
    hits = requests.join(links, "entity_id").select("request_id", "product_id")
    return hits.unionByName(requests.select("request_id", F.col("entity_id").alias("product_id"))).distinct()


def product_demand(orders: DataFrame, inventory: DataFrame) -> DataFrame:
    """Per product: open orders, revenue and whether any single order exceeds its stock."""
    demand = (
        orders.where(F.col("status") == "open")
        .groupBy("product_id")
        .agg(
            F.count("*").alias("open_orders"),
            F.sum(F.col("quantity") * F.col("unit_revenue")).alias("revenue"),
            F.max("quantity").alias("largest"),
        )
    )
    stock = inventory.groupBy("product_id").agg(F.sum("quantity_available").alias("stock"))
    return demand.join(stock, "product_id", "left").select(
        "product_id", "open_orders", "revenue", (F.coalesce("stock", F.lit(0)) < F.col("largest")).alias("constrained")
    )


def calculate_exposure(requests: DataFrame, links: DataFrame, orders: DataFrame, inventory: DataFrame) -> DataFrame:
    """Per request: products, open orders, revenue at risk and whether inventory is constrained.

    Orders are aggregated per product before they meet the requests, so a product with very many orders
    is reduced map-side and never multiplied by the requests that touch it.
    """
    products = exposed_products(requests, links)
    facts = products.join(product_demand(orders, inventory), "product_id", "left")
    return facts.groupBy("request_id").agg(
        F.count("*").alias("products"),
        F.coalesce(F.sum("open_orders"), F.lit(0)).alias("open_orders"),
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue_at_risk"),
        F.coalesce(F.bool_or("constrained"), F.lit(False)).alias("constrained_inventory"),
    )


def exposed_orders(requests: DataFrame, links: DataFrame, orders: DataFrame) -> DataFrame:
    """(request_id, id, customer, product_id) of the open orders behind an exposure."""
    products = exposed_products(requests, links)
    return orders.where(F.col("status") == "open").join(products, "product_id").select("request_id", "id", "customer", "product_id")


def exposed_customers(requests: DataFrame, links: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct (request_id, customer). Customers are made distinct per product before the join."""
    buyers = orders.where(F.col("status") == "open").select("product_id", "customer").distinct()
    return buyers.join(exposed_products(requests, links), "product_id").select("request_id", "customer").distinct()


# ------------------------------------------------------------------ gates


def gate_caveats() -> Column:
    """Subcodes a rejecting gate leaves on an otherwise accepted candidate."""

    def of(gate: str) -> Column:
        codes = F.concat(F.array(F.lit(f"{gate}_gate_rejected")), F.coalesce(f"{gate}.subcodes", F.array().cast("array<string>")))
        return F.when(F.col(f"{gate}.verdict") == "reject", codes).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(of("quality"), of("rubric")))


def join_gates(quality: DataFrame, rubric: DataFrame) -> DataFrame:
    """(candidate_id, verdict, route_code, subcodes) from both gate verdicts of each candidate.

    Only a provider failure (the quality gate's first) stops a candidate. A plain reject becomes a caveat.
    """
    side = lambda df, name: df.select("candidate_id", F.struct("verdict", "route_code", "subcodes").alias(name))
    joined = side(quality, "quality").join(side(rubric, "rubric"), "candidate_id")
    provider = F.coalesce(
        F.when(F.col("quality.route_code").isin(*fixed.PROVIDER_ROUTES), F.col("quality.route_code")),
        F.when(F.col("rubric.route_code").isin(*fixed.PROVIDER_ROUTES), F.col("rubric.route_code")),
    )
    return joined.select(
        "candidate_id",
        F.when(provider.isNotNull(), F.lit("reject")).otherwise(F.lit("accept")).alias("verdict"),
        F.coalesce(provider, F.lit("accept")).alias("route_code"),
        gate_caveats().alias("subcodes"),
    )


def missing_evidence(answers: DataFrame, oracles: DataFrame) -> DataFrame:
    """(case_id, cited, missing): required evidence keys no alias of the cited evidence matches."""
    joined = join_oracles(answers.select("case_id", "evidence"), oracles.select("case_id", "must_cite"))
    cited = F.array_sort(evidence_aliases(F.col("evidence")))
    return joined.select(
        "case_id", cited.alias("cited"), F.array_sort(F.array_distinct(F.array_except("must_cite", cited))).alias("missing")
    )


# ------------------------------------------------------------------ trials


def divergence_label() -> Column:
    alerts = F.coalesce(F.size("scan.alerts"), F.lit(0))
    return (
        F.when((F.col("scan.result") == "alerts_found") & (alerts > 0), F.lit("alert_found"))
        .when(F.col("scan.result") == "no_alert", F.lit("no_alert"))
        .otherwise(F.lit("invalid_or_missing_scan"))
    )


def paired_variants(trials: DataFrame, case_id: str | None = None) -> DataFrame:
    """One row per case with both variants' facts; a case missing either variant is left out.

    The last trial of a variant counts. ``trials`` has trial, case_id, variant, passed, score and label.
    """
    scoped = trials if case_id is None else trials.where(F.col("case_id") == case_id)
    facts = F.struct("trial", "passed", "score", "label")
    newest = scoped.groupBy("case_id").agg(
        *[
            F.max_by(F.when(F.col("variant") == v, facts), F.when(F.col("variant") == v, F.col("trial"))).alias(v)
            for v in fixed.VARIANTS
        ]
    )
    both = newest.where(F.col("baseline").isNotNull() & F.col("evidence_first").isNotNull())
    return both.select(
        "case_id",
        *[F.col(f"{v}.{c}").alias(f"{v}_{c}") for v in fixed.VARIANTS for c in ("trial", "passed", "score", "label")],
        (F.col("baseline.label") != F.col("evidence_first.label")).alias("diverges"),
    )


def trial_matrix(cases: DataFrame, variants: list[str], repeats: int, seeds: list[int]) -> DataFrame:
    """Every (variant, case, repeat, seed) an experiment plans.

    The three plan dimensions are short literals, so each case row is expanded in place.
    """
    grid = F.explode(F.array(*[F.lit(v) for v in variants])).alias("variant")
    return (
        cases.select("case_id", grid)
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("repeat"))
        .select("*", F.explode(F.array(*[F.lit(s) for s in seeds])).alias("seed"))
    )


def missing_trials(matrix: DataFrame, trials: DataFrame) -> DataFrame:
    return matrix.join(trials, ["case_id", "variant"], "left_anti")


# ------------------------------------------------------------------ lookups


def audit_view(requests: DataFrame, views: DataFrame) -> DataFrame:
    """(request_id, status, result) of audit-view requests.

    ``views`` is (vendor_id, view, result) with the result as JSON text. An unknown view is reported with
    the views that exist; a view that belongs to another vendor is refused.
    """
    joined = requests.join(views, ["vendor_id", "view"], "left")
    # the names of a vendor's views are only gathered where a request missed
    missed = joined.where(F.col("result").isNull()).select("vendor_id").distinct()
    known = (
        views.select("vendor_id", "view").join(missed, "vendor_id", "left_semi")
        .groupBy("vendor_id").agg(F.array_sort(F.collect_set("view")).alias("available"))
    )
    joined = joined.join(known, "vendor_id", "left")
    owner = F.try_variant_get(F.try_parse_json("result"), "$.vendor_id", "string")
    status = (
        F.when(F.col("result").isNull(), F.lit("unknown_view"))
        .when(owner.isNotNull() & (owner != F.col("vendor_id")), F.lit("vendor_mismatch"))
        .otherwise(F.lit("result"))
    )
    return joined.select(
        "request_id",
        "vendor_id",
        "view",
        status.alias("status"),
        F.when(status == "result", F.col("result")).alias("result"),
        F.when(status == "unknown_view", F.coalesce("available", F.array().cast("array<string>"))).alias("available_views"),
    )


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])


def retry_guidance(decisions: DataFrame, guidance: dict[str, str] | None = None) -> DataFrame:
    """Adds ``safe_subcodes`` and ``guidance`` to decisions: generator-safe codes and their advice, in
    order and without repeats. Both tables are short constants, so no join is needed."""
    advice = _lookup(fixed.GENERATOR_GUIDANCE if guidance is None else guidance)
    renamed = _lookup(fixed.RETRY_CODE_MAP)
    safe = F.array_distinct(F.transform("subcodes", lambda c: F.coalesce(F.try_element_at(renamed, c), c)))
    return decisions.withColumn("safe_subcodes", safe).withColumn(
        "guidance", F.array_distinct(F.array_compact(F.transform("safe_subcodes", lambda c: F.try_element_at(advice, c))))
    )
