"""Aggregates, orderings and windows over run logs and corpora."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from casemill.functions.scalars import attempt_number, cell_key, effective_latency
from casemill.session import checkpointed

MEDIAN_BUCKET = 4096
RANK_BLOCK = 1 << 20


# ------------------------------------------------------------------ distributions


def distribution(df: DataFrame, key: str | Column, name: str = "key") -> DataFrame:
    """(key, n); a null key is a group of its own."""
    col = F.col(key) if isinstance(key, str) else key
    return df.groupBy(col.alias(name)).agg(F.count("*").alias("n"))


def tag_distribution(df: DataFrame, arr: str, name: str = "tag") -> DataFrame:
    """(tag, n) over exploded arrays; a tag repeated within a row counts each time."""
    return df.select(F.explode(arr).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def size_distribution(df: DataFrame, arr: str, name: str = "size") -> DataFrame:
    """(size, rows) of arrays; a missing array has size 0."""
    size = F.greatest(F.coalesce(F.size(arr), F.lit(0)), F.lit(0))
    return df.groupBy(size.alias(name)).agg(F.count("*").alias("n"))


def coverage_entropy(corpus: DataFrame, cell: str = "cell") -> DataFrame:
    """One row: log2 entropy of the cell counts, 0 for an empty corpus.

    Counts per cell first; ``H = log2(N) - sum(n log2 n) / N`` then needs no second pass for N.
    """
    counts = corpus.groupBy(cell_key(F.col(cell)).alias("cell_key")).agg(F.count("*").cast("double").alias("n"))
    totals = counts.agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log2("n")).alias("weighted"))
    entropy = F.log2("total") - F.col("weighted") / F.col("total")
    return totals.select(F.coalesce(F.greatest(entropy, F.lit(0.0)), F.lit(0.0)).alias("coverage_entropy"))


CHECK_KINDS = ["deterministic", "quality", "rubric", "curation"]


def _pass_rate(kind: str) -> Column:
    scoped = F.col("check_kind") == kind
    accepted = F.when(scoped, (F.coalesce("verdict", F.lit("")) == "accept").cast("double"))
    return F.coalesce(F.avg(accepted), F.lit(0.0))


def pass_rates(validation: DataFrame) -> DataFrame:
    """One row: the accept share of each kind of check, 0 when a kind never ran."""
    return validation.agg(*[_pass_rate(k).alias(f"{k}_pass_rate") for k in CHECK_KINDS])


def run_metrics(stages: DataFrame, validation: DataFrame, corpus: DataFrame) -> DataFrame:
    """(run_id, metric, key, value): every run's metrics as long rows.

    One log pass per input and one shuffle each; the key sets (routes, stages, cells, tags) stay rows
    instead of being collected into one map per run.
    """

    def keyed(df: DataFrame, metric: str, key: Column) -> DataFrame:
        text = F.coalesce(key.cast("string"), F.lit("None"))
        return df.select("run_id", F.lit(metric).alias("metric"), text.alias("key"))

    def expand(df: DataFrame, *pairs: tuple[str, Column]) -> DataFrame:
        entries = [
            F.struct(F.lit(m).alias("metric"), F.coalesce(k.cast("string"), F.lit("None")).alias("key")) for m, k in pairs
        ]
        return df.select("run_id", F.explode(F.array(*entries)).alias("e")).select("run_id", "e.metric", "e.key")

    total = F.lit("")
    rows = expand(
        stages,
        ("stage_count", total),
        ("route_code_distribution", F.col("route_code")),
        ("stage_distribution", F.col("stage_kind")),
    )
    rows = rows.unionByName(expand(validation, ("validation_verdict_distribution", F.col("verdict"))))
    sizes = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    rows = rows.unionByName(
        expand(
            corpus,
            ("committed_count", total),
            ("coverage_cells", cell_key(F.col("cell"))),
            ("case_type_distribution", F.col("cell.case_type")),
            ("ability_distribution", F.col("ability")),
            ("environment_distribution", F.col("environment")),
            ("scoring_method_distribution", F.col("score_type")),
            ("leakage_risk_count_distribution", sizes("leakage_risks")),
            ("known_limit_count_distribution", sizes("known_limits")),
        )
    )
    tags = corpus.select("run_id", F.explode("diagnostic_pressure").alias("tag"))
    rows = rows.unionByName(keyed(tags, "diagnostic_pressure_distribution", F.col("tag")))
    counts = rows.groupBy("run_id", "metric", "key").agg(F.count("*").cast("double").alias("value"))

    rates = validation.groupBy("run_id").agg(*[_pass_rate(k).alias(k) for k in CHECK_KINDS])
    rate_names = ["deterministic_pass_rate", "quality_gate_pass_rate", "rubric_gate_pass_rate", "curator_accept_rate"]
    rate_rows = rates.select(
        "run_id",
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.lit("").alias("key"), F.col(k).alias("value")) for m, k in zip(rate_names, CHECK_KINDS)])
        ).alias("e"),
    ).select("run_id", "e.*")

    cells = counts.where(F.col("metric") == "coverage_cells")
    entropy = (
        cells.groupBy("run_id")
        .agg(F.sum("value").alias("total"), F.sum(F.col("value") * F.log2("value")).alias("weighted"))
        .select(
            "run_id",
            F.lit("coverage_entropy").alias("metric"),
            F.lit("").alias("key"),
            F.greatest(F.log2("total") - F.col("weighted") / F.col("total"), F.lit(0.0)).alias("value"),
        )
    )
    return counts.unionByName(rate_rows).unionByName(entropy)


# ------------------------------------------------------------------ performance


def grouped_medians(counted: DataFrame, group: list[str], value: str, n: str, bucket: int = MEDIAN_BUCKET) -> DataFrame:
    """(group, median): exact median of whole numbers, truncated, from (group, value, n) counts.

    The middle is found in two steps, so no group's values ever meet in one task: first in the counts
    of fixed-width buckets, then inside the one or two buckets that hold the middle ranks.
    """
    slot = F.floor(F.col(value) / bucket)
    buckets = counted.groupBy(*group, slot.alias("_slot")).agg(F.sum(n).alias("_n"))
    order = Window.partitionBy(*group).orderBy("_slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*group)
    placed = buckets.select(
        *group, "_slot", F.sum("_n").over(order).alias("_upto"), F.col("_n"), F.sum("_n").over(whole).alias("_total")
    ).select(
        *group,
        "_slot",
        (F.col("_upto") - F.col("_n")).alias("_before"),
        "_upto",
        F.floor((F.col("_total") - 1) / 2).alias("_low"),
        F.floor(F.col("_total") / 2).alias("_high"),
    )
    middle = placed.where(
        ((F.col("_before") <= F.col("_low")) & (F.col("_low") < F.col("_upto")))
        | ((F.col("_before") <= F.col("_high")) & (F.col("_high") < F.col("_upto")))
    ).drop("_upto")
    inside = counted.select(*group, slot.alias("_slot"), F.col(value).alias("_v"), F.col(n).alias("_n")).join(
        middle, [*group, "_slot"]
    )
    within = Window.partitionBy(*group, "_slot").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside.select(
        *group, "_v", "_low", "_high", "_n", (F.col("_before") + F.sum("_n").over(within)).alias("_upto")
    )
    covers = lambda r: (F.col("_upto") - F.col("_n") <= F.col(r)) & (F.col(r) < F.col("_upto"))
    picked = ranked.groupBy(*group).agg(
        F.max(F.when(covers("_low"), F.col("_v"))).alias("_a"), F.max(F.when(covers("_high"), F.col("_v"))).alias("_b")
    )
    total = F.col("_a") + F.col("_b")
    return picked.select(*group, (F.signum(total.cast("double")) * F.floor(F.abs(total) / 2)).cast("bigint").alias("median"))


def _label(*cols: str) -> Column:
    return F.coalesce(*[F.col(c).cast("string") for c in cols], F.lit("None"))


def perf_by_role(stages: DataFrame) -> DataFrame:
    """(role, n, total_ms, median_ms, input_tokens, output_tokens)."""
    latency = effective_latency(F.col("latency_ms"), F.col("error"))
    counted = (
        stages.select(
            _label("role").alias("role"),
            latency.alias("latency"),
            F.coalesce("input_tokens", F.lit(0)).alias("input_tokens"),
            F.coalesce("output_tokens", F.lit(0)).alias("output_tokens"),
        )
        .groupBy("role", "latency")
        .agg(F.count("*").alias("n"), F.sum("input_tokens").alias("i"), F.sum("output_tokens").alias("o"))
    )
    counted = checkpointed(counted)  # totals and medians both read it; the log itself is scanned once
    totals = counted.groupBy("role").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("latency") * F.col("n")).alias("total_ms"),
        F.sum("i").alias("input_tokens"),
        F.sum("o").alias("output_tokens"),
    )
    medians = grouped_medians(counted, ["role"], "latency", "n").withColumnRenamed("median", "median_ms")
    return totals.join(medians, "role").select("role", "n", "total_ms", "median_ms", "input_tokens", "output_tokens")


def request_sizes(events: DataFrame) -> DataFrame:
    """(label, n, total_bytes, median_bytes, max_bytes) of model request bodies, by role, else stage."""
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    counted = (
        events.where(F.col("stage_event") == "model_request_body")
        .select(F.coalesce(blank("role"), blank("stage"), F.lit("model")).alias("label"), F.coalesce("body_bytes", F.lit(0)).alias("bytes"))
        .groupBy("label", "bytes")
        .agg(F.count("*").alias("n"))
    )
    counted = checkpointed(counted)
    totals = counted.groupBy("label").agg(
        F.sum("n").alias("n"), F.sum(F.col("bytes") * F.col("n")).alias("total_bytes"), F.max("bytes").alias("max_bytes")
    )
    medians = grouped_medians(counted, ["label"], "bytes", "n").withColumnRenamed("median", "median_bytes")
    return totals.join(medians, "label").select("label", "n", "total_bytes", "median_bytes", "max_bytes")


def rejection_waste(stages: DataFrame, k: int | None = 8) -> DataFrame:
    """(role, route_code, subcodes, n, total_ms) of rejected work, most expensive first."""
    latency = effective_latency(F.col("latency_ms"), F.col("error"))
    buckets = (
        stages.where(F.col("verdict") == "reject")
        .groupBy(
            _label("role").alias("role"),
            _label("route_code").alias("route_code"),
            F.coalesce("subcodes", F.array().cast("array<string>")).alias("subcodes"),
        )
        .agg(F.count("*").alias("n"), F.sum(latency).alias("total_ms"))
    )
    if k is None:
        return buckets
    return buckets.orderBy(F.desc("total_ms"), "role", "route_code", F.array_join("subcodes", ",")).limit(k)


def route_counts(stages: DataFrame) -> DataFrame:
    return stages.groupBy("role", "route_code").agg(F.count("*").alias("n"))


def perf_totals(stages: DataFrame, run_col: str = "run_id") -> DataFrame:
    """One row: runs, records, latency, tokens, commits and rejects.

    Runs are pre-aggregated per run, so counting distinct runs shuffles one row per run and task.
    """
    reject = F.count_if(F.col("verdict") == "reject")
    commit = F.count_if((F.col("role") == "curate_committed_sample") & (F.col("verdict") == "accept"))
    latency = effective_latency(F.col("latency_ms"), F.col("error"))
    per_run = stages.groupBy(run_col).agg(
        F.count("*").alias("stage_records"),
        F.sum(latency).alias("total_ms"),
        F.sum(F.coalesce("input_tokens", F.lit(0))).alias("input_tokens"),
        F.sum(F.coalesce("output_tokens", F.lit(0))).alias("output_tokens"),
        commit.alias("commits"),
        reject.alias("rejects"),
    )
    return per_run.agg(
        F.count("*").alias("runs"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in per_run.columns[1:]],
    )


def tokens_by_role(stages: DataFrame) -> DataFrame:
    """(run_id, role, input_tokens, output_tokens); either usage spelling counts."""
    cols = stages.columns
    pick = lambda *names: F.coalesce(*[F.nullif(F.col(n), F.lit(0).cast("bigint")) for n in names if n in cols], F.lit(0))
    return stages.groupBy("run_id", "role").agg(
        F.sum(pick("input_tokens", "prompt_tokens")).alias("input_tokens"),
        F.sum(pick("output_tokens", "completion_tokens")).alias("output_tokens"),
    )


def experiment_metrics(grades: DataFrame) -> DataFrame:
    """(variant, trials, pass_rate, score, false_positive_count): averages over grade documents (JSON)."""
    v = F.try_parse_json("grade")
    passed = F.coalesce(F.try_variant_get(v, "$.passed", "boolean"), F.lit(False)).cast("double")
    return grades.groupBy("variant").agg(
        F.count("*").alias("trials"),
        F.avg(passed).alias("pass_rate"),
        F.avg(F.try_variant_get(v, "$.score", "double")).alias("score"),
        F.avg(F.try_variant_get(v, "$.false_positive_count", "double")).alias("false_positive_count"),
    )


_INDEX = re.compile("0|[1-9][0-9]*")


def pointer(document: Column, path: str) -> Column:
    """The value (variant) a JSON pointer names in a variant document; null where there is none.

    ``/`` parts the steps, ``~1`` and ``~0`` stand for a slash and a tilde in a name. A step of digits is a position of an
    array or a name of an object, whichever is there.
    """
    if path and not path.startswith("/"):
        raise ValueError(f"not a JSON pointer: {path}")
    value = document
    for step in path.split("/")[1:]:
        name = step.replace("~1", "/").replace("~0", "~")
        if "'" in name and '"' in name:
            raise ValueError(f"a name with both kinds of quotes cannot be reached: {path}")
        quoted = f'$["{name}"]' if "'" in name else f"$['{name}']"
        found = F.try_variant_get(value, quoted, "variant")
        if _INDEX.fullmatch(name):
            found = F.coalesce(F.try_variant_get(value, f"$[{name}]", "variant"), found)
        value = found
    return value


def pointer_metrics(grades: DataFrame, definitions: DataFrame) -> DataFrame:
    """(variant, metric, direction, trials, n, value): the mean of every defined metric per variant, in one pass.

    ``grades``: variant, grade (JSON). ``definitions``: metric, pointer, direction (``higher`` or ``lower`` is better), one
    row per metric; the few rows become expressions. Numbers and numbers in strings count as they are, booleans as 1 and
    0; ``n`` trials have the value, others don't count for the mean.
    """
    defined = definitions.select("metric", "pointer", "direction").collect()
    if any(d["direction"] not in ("higher", "lower") for d in defined):
        raise ValueError("a metric is better higher or lower")
    parsed = grades.select("variant", F.try_parse_json("grade").alias("v"))
    number = lambda v: F.coalesce(F.try_variant_get(v, "$", "double"), F.try_variant_get(v, "$", "boolean").cast("double"))
    read = parsed.select("variant", *[number(pointer(F.col("v"), d["pointer"])).alias(f"m{i}") for i, d in enumerate(defined)])
    means = read.groupBy("variant").agg(
        F.count("*").alias("trials"), *[f(f"m{i}").alias(f"{name}{i}") for i in range(len(defined)) for name, f in (("n", F.count), ("value", F.avg))]
    )
    row = lambda i, d: F.struct(
        F.lit(d["metric"]).alias("metric"), F.lit(d["direction"]).alias("direction"), F.col(f"n{i}").alias("n"), F.col(f"value{i}").alias("value")
    )
    rows = F.explode(F.array(*[row(i, d) for i, d in enumerate(defined)])).alias("r")
    return means.select("variant", "trials", rows).select("variant", "r.metric", "r.direction", "trials", "r.n", "r.value")


def compare_variants(metrics: DataFrame, baseline: str) -> DataFrame:
    """(metric, variant, value, baseline_value, change, outcome): every variant against the baseline.

    ``change`` is positive where the variant is better in the metric's direction; ``outcome`` is better, worse, equal or,
    where either side has no value, unknown.
    """
    base = metrics.where(F.col("variant") == baseline).select("metric", F.col("value").alias("baseline_value"))
    sign = F.when(F.col("direction") == "lower", F.lit(-1.0)).otherwise(F.lit(1.0))
    change = sign * (F.col("value") - F.col("baseline_value"))
    outcome = F.when(change > 0, F.lit("better")).when(change < 0, F.lit("worse")).when(change == 0, F.lit("equal")).otherwise(F.lit("unknown"))
    others = metrics.where(F.col("variant") != baseline).join(base, "metric", "left")
    return others.select("metric", "variant", "value", "baseline_value", change.alias("change"), outcome.alias("outcome"))


def merge_coverage(snapshot: DataFrame, commits: DataFrame) -> DataFrame:
    """(cell_key, n): the ledger plus one for every newly committed cell."""
    added = commits.groupBy(cell_key(F.col("cell")).alias("cell_key")).agg(F.count("*").alias("n"))
    return snapshot.select("cell_key", "n").unionByName(added).groupBy("cell_key").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------ ranks and sequences


def ranked_within(df: DataFrame, keys: list[str], ord_col: str, name: str = "position", block: int = RANK_BLOCK) -> DataFrame:
    """1-based position of each row among its key's rows, by a unique whole-number order column.

    Rows are ranked inside fixed blocks of the order column and shifted by the rows in earlier blocks.
    A key that holds a third of the table is thus spread over its blocks instead of sorted in one task.
    """
    blocked = df.withColumn("_block", F.floor(F.col(ord_col) / block))
    sizes = blocked.groupBy(*keys, "_block").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    local = Window.partitionBy(*keys, "_block").orderBy(ord_col)
    placed = blocked.withColumn("_rank", F.row_number().over(local)).join(offsets, [*keys, "_block"])
    return placed.withColumn(name, F.col("_offset") + F.col("_rank")).drop("_block", "_rank", "_offset")


def ranked_by(df: DataFrame, keys: list[str], order: list[Column], name: str = "position") -> DataFrame:
    """1-based position of each row among its key's rows, by any columns, without gathering a key in one task.

    Rows are range-partitioned by key and order and written out once, which fixes the ranges; a key that
    spans several ranges is ranked inside each and shifted by its rows in the ranges before.
    """
    sort = [F.col(k) for k in keys] + order
    ranged = checkpointed(df.repartitionByRange(*sort).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = Window.partitionBy(*keys, "_range").orderBy(*order)
    placed = ranged.withColumn("_rank", F.row_number().over(local)).join(offsets, [*keys, "_range"])
    return placed.withColumn(name, F.col("_offset") + F.col("_rank")).drop("_range", "_rank", "_offset")


def sequence_attempts(df: DataFrame, design: str = "design_id", candidate: str = "id") -> DataFrame:
    """Adds ``position`` and ``is_final``: attempts of a design by (candidate id, attempt number)."""
    placed = ranked_by(df, [design], [F.col(candidate), attempt_number(F.col(candidate), F.lit(0))])
    last = placed.groupBy(design).agg(F.max("position").alias("_last"))
    return placed.join(last, design).withColumn("is_final", F.col("position") == F.col("_last")).drop("_last")


def select_cases(corpus: DataFrame, index: int | None = None, limit: int = 1, ord_col: str = "ord") -> DataFrame:
    """The corpus row at a 0-based index, or the last ``max(1, limit)`` rows, with their ``row_index``.

    Positions come from counts: the last rows are a top-k, and only a requested index needs ranking.
    """
    total = corpus.count()
    if index is not None:
        if index < 0 or index >= total:
            raise IndexError(f"index out of range; corpus has {total} row(s)")
        ranked = ranked_within(corpus.withColumn("_all", F.lit(0)), ["_all"], ord_col, "_position").drop("_all")
        return ranked.where(F.col("_position") == index + 1).withColumn("row_index", F.lit(index)).drop("_position")
    keep = min(total, max(1, limit))
    last = corpus.orderBy(F.desc(ord_col)).limit(keep)
    return last.withColumn("row_index", F.row_number().over(Window.orderBy(ord_col)) - 1 + (total - keep))


def latest_revision(snapshots: DataFrame) -> DataFrame:
    """(design_id, candidate_id, phase, retry_index): the newest snapshot of each design.

    A later retry wins; within a retry a revision supersedes the candidate it revised.
    """
    rank = F.struct(
        F.col("retry_index"), F.col("parent_candidate_id").isNotNull().alias("revised"), F.col("candidate_id")
    )
    newest = snapshots.groupBy("design_id").agg(
        F.max_by(F.struct("candidate_id", "phase", "retry_index"), rank).alias("s")
    )
    return newest.select("design_id", "s.*")


# ------------------------------------------------------------------ top-k and orderings


def slowest(stages: DataFrame, k: int = 8, tie: str = "ord") -> DataFrame:
    """The k stages with the largest effective latency (top-k per task, then merged)."""
    latency = effective_latency(F.col("latency_ms"), F.col("error"))
    return stages.withColumn("effective_ms", latency).orderBy(F.desc("effective_ms"), tie).limit(k)


def recent(df: DataFrame, k: int = 12, ord_col: str = "ord") -> DataFrame:
    """The last k rows, in order."""
    return df.orderBy(F.desc(ord_col)).limit(k).orderBy(ord_col)


def timeline(stages: DataFrame, ord_col: str = "ord") -> DataFrame:
    """Stage rows with their 1-based attempt, in log order."""
    when = F.split_part(F.replace("wallclock_ts", F.lit("T"), F.lit(" ")), F.lit("+"), F.lit(1))
    return stages.select(
        ord_col,
        when.alias("ts"),
        "stage_kind",
        "role",
        "verdict",
        "route_code",
        (F.coalesce("retry_index", F.lit(0)) + 1).alias("attempt"),
        F.array_join(F.coalesce("subcodes", F.array().cast("array<string>")), ",").alias("codes"),
    ).orderBy(ord_col)


def most_common(df: DataFrame, key: str, ord_col: str = "ord", k: int | None = None) -> DataFrame:
    """(key, n, first_ord): most frequent first, ties by first appearance."""
    counts = df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"), F.min(ord_col).alias("first_ord"))
    ordered = counts.orderBy(F.desc("n"), "first_ord")
    return ordered if k is None else ordered.limit(k)


def take_quota(df: DataFrame, n: int, ord_col: str = "ord") -> DataFrame:
    """The first n rows in queue order (top-k per task, then merged)."""
    return df.orderBy(ord_col).limit(n)
