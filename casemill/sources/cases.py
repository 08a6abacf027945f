"""Curated case sets: corpus rows, public task rows, hidden oracles and workspace file tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.functions.scalars import field
from casemill.operators.document_schema import check_schema, compile_schema


def public_rows(cases: DataFrame, case_col: str = "benchmark_case") -> DataFrame:
    """Public task rows of cases held as JSON text.

    The hidden oracle and grader contract are never selected; ``edge_classes`` leaves the inputs and
    ``hidden_files`` leaves the environment.
    """
    v = F.parse_json(F.col(case_col))

    def without(path: str, key: str) -> Column:
        entries = F.try_variant_get(v, path, "map<string, variant>")
        kept = F.map_filter(entries, lambda k, _: k != key)
        return F.to_json(kept)

    def text(path: str) -> Column:
        return F.try_variant_get(v, path, "string")

    return cases.select(
        "case_id",
        text("$.prompt").alias("prompt"),
        text("$.setup").alias("setup"),
        without("$.inputs", "edge_classes").alias("inputs"),
        without("$.environment", "hidden_files").alias("environment"),
        field(v, "$.workspace").cast("string").alias("workspace"),
    )


def hidden_oracles(cases: DataFrame, case_col: str = "benchmark_case") -> DataFrame:
    """The private half: oracle (either spelling) and grader contract as JSON text."""
    v = F.parse_json(F.col(case_col))
    return cases.select(
        "case_id",
        F.coalesce(field(v, "$.hidden_oracle"), field(v, "$.hidden_evaluation")).cast("string").alias("oracle"),
        field(v, "$.grader_contract").cast("string").alias("grader_contract"),
    )


class InvalidCase(ValueError):
    """A case does not satisfy its domain's case schema."""


def build_case_set(cases: DataFrame, schema: dict) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(corpus rows, public task rows, oracle rows) of a case table.

    ``cases`` has case_id, difficulty, scenario and benchmark_case (JSON text). The whole set is refused
    when any case violates the schema; the error names the first one.
    """
    checks = check_schema(cases, "benchmark_case", compile_schema(schema), "case_schema", id_col="case_id")
    bad = checks.where(~F.col("passed")).orderBy("candidate_id").limit(1).collect()
    if bad:
        raise InvalidCase(f"{bad[0]['candidate_id']}: {bad[0]['evidence'][0]['path']}: {bad[0]['evidence'][0]['value']}")
    oracles = hidden_oracles(cases)
    alerts = F.try_variant_get(F.try_parse_json("oracle"), "$.true_alerts", "array<variant>")
    summary = oracles.select(
        "case_id",
        F.coalesce(F.size(alerts), F.lit(0)).alias("true_alert_count"),
        F.try_variant_get(F.try_parse_json("oracle"), "$.zero_alert_run", "boolean").alias("zero_alert_run"),
    )
    corpus = cases.select("case_id", "difficulty", "scenario", F.sha2("benchmark_case", 256).alias("content_hash")).join(
        summary, "case_id"
    )
    return corpus, public_rows(cases), oracles


def workspace_files(cases: DataFrame, layout: dict[str, str], id_col: str = "case_id", case_col: str = "benchmark_case") -> DataFrame:
    """(case_id, path, content): the files a case's workspace holds.

    ``layout`` maps a relative path to a JSON path inside the case. Text values are written as text,
    everything else as JSON; files whose value is missing are left out.
    """
    v = F.parse_json(F.col(case_col))
    entries = []
    for path, source in layout.items():
        value = field(v, source)
        content = F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(v, source, "string")).otherwise(
            value.cast("string")
        )
        entries.append(F.struct(F.lit(path).alias("path"), F.concat(content, F.lit("\n")).alias("content")))
    exploded = cases.select(id_col, F.explode(F.array(*entries)).alias("file"))
    return exploded.select(id_col, "file.path", "file.content").where(F.col("content").isNotNull())


def trial_inputs(tasks: DataFrame, prompt: str, files: list[str]) -> DataFrame:
    """Agent inputs from public task rows: the case facts an agent sees, and its workspace file list."""
    v = F.parse_json("inputs")

    def fact(name: str) -> Column:
        return F.try_variant_get(v, f"$.{name}", "string").alias(name)

    return tasks.select(
        F.col("case_id").alias("id"),
        F.lit(prompt).alias("prompt"),
        F.struct(
            F.col("case_id").alias("id"), fact("vendor"), fact("invoice_id"), fact("amount"), fact("requested_action")
        ).alias("case"),
        F.lit("output_schema.json").alias("output_schema_path"),
        F.array(*[F.lit(f) for f in files]).alias("workspace_files"),
    )
