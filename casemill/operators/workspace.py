"""Workspace file tables: structure rules, revisions, evaluation prompts and record search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill import fixed, schemas
from casemill.functions.documents import canonical_json, merge_json, sorted_json
from casemill.functions.scalars import contains_any, excerpt, field
from casemill.operators.checks import RULE, blank

BLANKS = " \t\r\n"


def path_problem(path: Column) -> Column:
    """(subcode, message) struct of a bad file path; null for a relative POSIX path that stays inside."""
    p = F.btrim(path, F.lit(" \t\r\n"))
    note = lambda sub, why: F.struct(F.lit(sub).alias("subcode"), F.lit(why).alias("message"))
    outside = F.startswith(p, F.lit("/")) | F.contains(p, F.lit("\\")) | p.rlike(r"(^|/)\.\.(/|$)")
    return F.when(blank(path), note("invalid_workspace_file", "workspace file path is missing")).when(
        outside,
        note(
            "invalid_workspace_path",
            "workspace file paths must be relative POSIX paths and cannot traverse upward",
        ),
    )


def is_placeholder(content: Column) -> Column:
    text = F.lower(F.btrim(content, F.lit(" \t\r\n")))
    return (text != "") & (text.isin(*fixed.PLACEHOLDER_TEXTS) | contains_any(text, fixed.PLACEHOLDER_FRAGMENTS))


def content_problem(path: Column, content: Column) -> Column:
    note = lambda sub, why: F.struct(F.lit(sub).alias("subcode"), F.lit(why).alias("message"))
    package_marker = F.regexp_extract(path, r"([^/]*)/?$", 1) == "__init__.py"
    return (
        F.when(content.isNull(), note("invalid_workspace_file", "workspace file could not be read"))
        .when(blank(content) & ~package_marker, note("invalid_workspace_file", "workspace file content is missing"))
        .when(is_placeholder(content), note("placeholder_workspace_file", "workspace file content is placeholder text"))
    )


def check_workspace(df: DataFrame, files: DataFrame, id_col: str = "id") -> DataFrame:
    """Structure of each candidate's workspace; the first bad file in file order decides.

    Files are aggregated per (candidate, path) and then per candidate, both with map-side partials, so
    a candidate with very many files never meets in one task row by row.
    """
    judged = files.select(
        "candidate_id",
        "ord",
        F.btrim("path", F.lit(BLANKS)).alias("path"),
        path_problem(F.col("path")).alias("path_problem"),
        content_problem(F.btrim("path", F.lit(BLANKS)), F.col("content")).alias("content_problem"),
    )
    repeats = (
        judged.where(F.col("path_problem").isNull())
        .groupBy("candidate_id", "path")
        .agg(F.min("ord").alias("first_ord"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    joined = judged.join(repeats, ["candidate_id", "path"], "left")
    duplicate = F.struct(
        F.lit("duplicate_workspace_path").alias("subcode"),
        F.concat(F.lit("workspace file path is duplicated: "), F.col("path")).alias("message"),
    )
    problem = F.coalesce(
        "path_problem", F.when(F.col("ord") > F.col("first_ord"), duplicate), F.col("content_problem")
    )
    where = F.concat(F.lit("environment_artifact.payload.files."), F.col("ord").cast("string"), F.lit(".path"))
    flat = joined.select("candidate_id", "ord", problem.alias("problem"), where.alias("path"))
    per_candidate = flat.groupBy("candidate_id").agg(
        F.count("*").alias("n"),
        F.min_by(
            F.when(F.col("problem").isNotNull(), F.struct("problem.subcode", "problem.message", "path")),
            F.when(F.col("problem").isNotNull(), F.col("ord")),
        ).alias("first"),
    )
    kind = F.col("agent_artifact.environment_artifact.kind") if "agent_artifact" in df.columns else F.lit(fixed.WORKSPACE_KIND)
    base = df.select(F.col(id_col).alias("candidate_id"), kind.alias("kind")).join(per_candidate, "candidate_id", "left")
    note = lambda sub, why, path: F.struct(
        F.lit(sub).alias("subcode"), F.lit(why).alias("message"), F.lit(path).alias("path")
    )
    bad = (
        F.when(
            F.col("kind").isNull(),
            note("missing_workspace", "environment_artifact is required for code benchmarks", "environment_artifact"),
        )
        .when(
            F.col("kind") != fixed.WORKSPACE_KIND,
            note(
                "missing_workspace",
                f"code benchmarks require environment_artifact.kind='{fixed.WORKSPACE_KIND}'",
                "environment_artifact.kind",
            ),
        )
        .when(
            F.coalesce("n", F.lit(0)) < 3,
            note(
                "missing_workspace",
                "execution workspace must contain at least 3 files",
                "environment_artifact.payload.files",
            ),
        )
        .otherwise(F.col("first"))
    )
    rows = base.select("candidate_id", bad.alias("bad"))
    noted = F.array(F.struct(F.lit(RULE).alias("source"), F.col("bad.path").alias("path"), F.col("bad.message").alias("value")))
    return rows.select(
        "candidate_id",
        F.lit(0).alias("check_ord"),
        F.lit("environment_artifact").alias("check_id"),
        F.col("bad").isNull().alias("passed"),
        F.when(F.col("bad").isNull(), F.lit("accept")).otherwise(F.lit("reject_schema")).alias("route_code"),
        F.col("bad.subcode").alias("subcode"),
        F.when(F.col("bad").isNull(), F.array().cast(schemas.EVIDENCE)).otherwise(noted).alias("evidence"),
    )


# ------------------------------------------------------------------ search and prompts


def search_records(files: DataFrame, query: str, id_col: str = "candidate_id") -> DataFrame:
    """(id, path, excerpt) of the record files that contain a query, ignoring case."""
    hits = files.where(F.contains(F.lower("content"), F.lit(query.lower())))
    return hits.select(id_col, "path", excerpt(F.col("content"), F.lit(query.lower())).alias("excerpt"))


def _fence_language(path: Column) -> Column:
    suffix = F.lower(F.regexp_extract(path, r"[^/.](\.[^./]*)$", 1))
    language = F.lit("")
    for ending, name in fixed.FENCE_LANGUAGES.items():
        language = F.when(suffix == ending, F.lit(name)).otherwise(language)
    return language


def eval_prompts(corpus: DataFrame, files: DataFrame) -> DataFrame:
    """(candidate_id, prompt): setup, commands, files in path order, then the task.

    Only candidate-visible material is selected. A candidate without an executable workspace gets its
    bare prompt. The prompt is one document, so its files meet in one row by definition.
    """
    case = F.try_parse_json(F.col("agent_artifact.benchmark_case"))
    payload = F.try_parse_json(F.col("agent_artifact.environment_artifact.payload"))
    section = F.concat(
        F.lit("--- "), F.col("path"), F.lit(" ---\n```"), _fence_language(F.col("path")), F.lit("\n"),
        F.regexp_replace("content", r"\s+$", ""), F.lit("\n```"),
    )
    listed = files.groupBy("candidate_id").agg(F.array_sort(F.collect_list(F.struct("path", section.alias("body")))).alias("sections"))
    base = corpus.select(
        F.col("id").alias("candidate_id"),
        F.coalesce(F.try_variant_get(case, "$.prompt", "string"), F.lit("")).alias("task"),
        F.btrim(F.try_variant_get(case, "$.setup", "string"), F.lit(BLANKS)).alias("setup"),
        (F.col("agent_artifact.environment_artifact.kind") == fixed.WORKSPACE_KIND).alias("executable"),
        field(payload, "$.commands").cast("string").alias("commands"),
    ).join(listed, "candidate_id", "left")
    body = F.concat_ws(
        "\n\n",
        F.when(F.coalesce(F.col("setup"), F.lit("")) != "", F.concat(F.lit("SETUP\n"), F.col("setup"))),
        F.when(~F.coalesce("commands", F.lit("{}")).isin("{}", "null"), F.concat(F.lit("COMMANDS\n"), pretty_json(F.col("commands")))),
        F.concat_ws("\n\n", F.lit("REPOSITORY FILES"), F.transform("sections", lambda s: s["body"])),
        F.when(F.col("task") != "", F.concat(F.lit("BENCHMARK PROMPT\n"), F.col("task"))),
    )
    return base.select("candidate_id", F.when(F.coalesce("executable", F.lit(False)), body).otherwise(F.col("task")).alias("prompt"))


def pretty_json(col: Column) -> Column:
    """Two-space indented, key-sorted form of a flat JSON object of strings."""
    entries = F.from_json(col, "map<string,string>")
    keys = F.array_sort(F.map_keys(entries))
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)
    lines = F.transform(keys, lambda k: F.concat(F.lit("  "), quoted(k), F.lit(": "), quoted(F.element_at(entries, k))))
    return F.concat(F.lit("{\n"), F.array_join(lines, ",\n"), F.lit("\n}"))


# ------------------------------------------------------------------ revisions


def _unknown_keys(json_col: str, allowed: list[str]) -> Column:
    keys = F.map_keys(F.try_variant_get(F.try_parse_json(F.col(json_col)), "$", "map<string, variant>"))
    return F.array_sort(F.array_except(F.coalesce(keys, F.array().cast("array<string>")), F.array(*[F.lit(k) for k in allowed])))


def patch_problem() -> Column:
    """Why a revision patch is refused as a whole; null when its shape is fine."""
    ops = F.coalesce(F.size("environment_ops"), F.lit(0))
    extra_case = _unknown_keys("benchmark_case_updates", fixed.BENCHMARK_UPDATE_KEYS)
    extra_meta = _unknown_keys("metadata_updates", fixed.METADATA_UPDATE_KEYS)
    no_keys = lambda c: F.coalesce(F.trim(c), F.lit("{}")).isin("{}", "null", "")
    return (
        F.when(F.size(extra_case) > 0, F.concat(F.lit("unsupported benchmark_case_updates keys: "), F.array_join(extra_case, ", ")))
        .when(F.size(extra_meta) > 0, F.concat(F.lit("unsupported metadata_updates keys: "), F.array_join(extra_meta, ", ")))
        .when(ops > fixed.MAX_REVISION_OPS, F.lit(f"environment_ops holds more than {fixed.MAX_REVISION_OPS} edits"))
        .when(
            (F.greatest(ops, F.lit(0)) == 0) & no_keys(F.col("benchmark_case_updates")) & no_keys(F.col("metadata_updates")),
            F.lit("revision patch made no candidate changes"),
        )
    )


def op_problem(op: Column, at: int) -> Column:
    """Why one edit is refused before looking at its file."""
    old, new = op["old_text"], op["new_text"]
    create = F.coalesce(op["create_if_missing"], F.lit(False))
    where = f"environment_ops.{at}"
    bad_path = path_problem(op["path"])
    bad_content = content_problem(F.btrim(op["path"], F.lit(BLANKS)), new)
    return (
        F.when(~op["op"].eqNullSafe(F.lit("edit_file")), F.lit(f"{where}.op must be 'edit_file'"))
        .when(bad_path.isNotNull(), F.concat(F.lit(f"{where}.path: "), bad_path["message"]))
        .when(new.isNull(), F.lit(f"{where}.new_text must be a string"))
        .when(
            create & (F.coalesce(old, F.lit("")) != ""),
            F.lit(f"{where}.old_text must be omitted when create_if_missing=true"),
        )
        .when(~create & (F.coalesce(old, F.lit("")) == ""), F.lit(f"{where}.old_text must be a non-empty exact string"))
        .when(bad_content.isNotNull(), F.concat(F.lit(f"{where}: "), bad_content["message"]))
    )


def apply_revisions(cands: DataFrame, files: DataFrame, patches: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Apply revision patches: (revised candidates, revised files, error rows).

    Edits apply in order, each seeing the text its predecessors left. Edits touch single files, so a
    patch becomes one row per (candidate, path) holding that path's edits (at most four), and those
    rows meet their file in one full-outer join; the edits are then folded over the file's text. A
    failing edit fails its whole candidate with the error of the earliest failing edit.

    A patch may also state ``runtime_requirements`` (JSON, must be those of its candidate) and ``unknown_keys`` (names
    at its top level that no patch has); both are optional columns. Edits need a candidate with an executable workspace.
    """
    facts = cands.select(
        F.col("id").alias("candidate_id"),
        F.col("agent_artifact.environment_artifact.kind").alias("_kind"),
        F.col("agent_artifact.runtime_requirements").alias("_runtime"),
    )
    optional = lambda name, kind: (F.col(name) if name in patches.columns else F.lit(None)).cast(kind)
    stated = optional("runtime_requirements", "string")
    changes_runtime = stated.isNotNull() & ~canonical_json(stated).eqNullSafe(canonical_json(F.col("_runtime")))
    unknown = F.array_sort(F.coalesce(optional("unknown_keys", "array<string>"), F.array().cast("array<string>")))
    edits_nothing = (F.coalesce(F.size("environment_ops"), F.lit(0)) > 0) & ~F.col("_kind").eqNullSafe(F.lit(fixed.WORKSPACE_KIND))
    refused = F.coalesce(
        F.when(changes_runtime, F.lit("a revision cannot change runtime_requirements")) if "runtime_requirements" in patches.columns else F.lit(None),
        F.when(F.size(unknown) > 0, F.concat(F.lit("unsupported patch keys: "), F.array_join(unknown, ", "))),
        patch_problem(),
        F.when(edits_nothing, F.lit("environment_ops require an executable workspace")),
    )
    sized = patches.join(facts, "candidate_id", "left").withColumn("refused", refused).drop("_kind", "_runtime")
    slots = F.array(
        *[
            F.when(
                F.coalesce(F.size("environment_ops"), F.lit(0)) > i,
                F.struct(
                    F.lit(i).alias("at"),
                    F.get("environment_ops", F.lit(i)).alias("op"),
                    op_problem(F.get("environment_ops", F.lit(i)), i).alias("problem"),
                ),
            )
            for i in range(fixed.MAX_REVISION_OPS)
        ]
    )
    steps = sized.where(F.col("refused").isNull()).select(
        "candidate_id", F.explode(F.array_compact(slots)).alias("step")
    )
    edits = (
        steps.select("candidate_id", F.btrim("step.op.path", F.lit(BLANKS)).alias("path"), "step")
        .groupBy("candidate_id", "path")
        .agg(F.array_sort(F.collect_list("step"), lambda a, b: a["at"] - b["at"]).alias("steps"))
    )
    current = files.select("candidate_id", "ord", F.btrim("path", F.lit(BLANKS)).alias("path"), "content")
    touched = current.join(edits, ["candidate_id", "path"], "right")

    def count_of(text: Column, part: Column) -> Column:
        return ((F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)).cast("int")

    def apply_step(state: Column, s: Column) -> Column:
        op, text = s["op"], state["text"]
        create = F.coalesce(op["create_if_missing"], F.lit(False))
        every = F.coalesce(op["replace_all"], F.lit(False))
        old = F.when(~create & (F.coalesce(op["old_text"], F.lit("")) != ""), op["old_text"])
        hits = F.coalesce(count_of(text, old), F.lit(0))
        where = F.concat(F.lit("environment_ops."), s["at"].cast("string"))
        problem = F.coalesce(
            s["problem"],
            F.when(create & text.isNotNull(), F.concat(F.lit("path already exists: "), op["path"])),
            F.when(~create & text.isNull(), F.concat(where, F.lit(".path does not exist: "), op["path"])),
            F.when(~create & (hits == 0), F.concat(where, F.lit(".old_text did not match file"))),
            F.when(~create & (hits > 1) & ~every, F.concat(where, F.lit(".old_text matched "), hits.cast("string"), F.lit(" times"))),
        )
        at_first = F.instr(text, old)
        once = F.concat(
            F.substr(text, F.lit(1), at_first - 1), op["new_text"], F.substr(text, at_first + F.length(old))
        )
        edited = F.when(create, op["new_text"]).when(every, F.replace(text, old, op["new_text"])).otherwise(once)
        failed = state["error"].isNotNull()
        return F.struct(
            F.when(failed | problem.isNotNull(), text).otherwise(edited).alias("text"),
            F.when(failed, state["error"]).otherwise(problem).alias("error"),
            F.when(failed, state["at"]).when(problem.isNotNull(), s["at"]).alias("at"),
        )

    start = F.struct(
        F.col("content").alias("text"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("int").alias("at")
    )
    folded = touched.select(
        "candidate_id", "path", "ord", F.aggregate("steps", start, apply_step).alias("state")
    )
    edit_errors = (
        folded.where(F.col("state.error").isNotNull())
        .groupBy("candidate_id")
        .agg(F.min_by("state.error", "state.at").alias("error"))
    )
    refused = sized.where(F.col("refused").isNotNull()).select("candidate_id", F.col("refused").alias("error"))
    errors = refused.unionByName(edit_errors)

    good = patches.join(errors, "candidate_id", "left_anti")
    edited = folded.select("candidate_id", "path", F.col("state.text").alias("new_content"), F.col("ord").alias("old_ord"))
    merged = current.join(edited, ["candidate_id", "path"], "full").select(
        "candidate_id", F.coalesce("ord", "old_ord").alias("ord"), "path", F.coalesce("new_content", "content").alias("content")
    )
    revised_files = merged.join(good.select("candidate_id"), "candidate_id", "left_semi")
    revised = (
        cands.join(
            good.select(F.col("candidate_id").alias("id"), "benchmark_case_updates", "metadata_updates"), "id"
        )
        .withColumn(
            "agent_artifact",
            F.col("agent_artifact").withField(
                "benchmark_case", merge_json(F.col("agent_artifact.benchmark_case"), F.col("benchmark_case_updates"))
            ),
        )
        .withColumn(
            "judge_artifact",
            F.from_json(
                merge_json(F.to_json("judge_artifact"), F.col("metadata_updates")), schemas.JUDGE.simpleString()
            ),
        )
        .withColumn(
            "content_hash",
            F.sha2(
                F.concat_ws(
                    "\n", sorted_json(F.col("agent_artifact.benchmark_case")), sorted_json(F.to_json("judge_artifact")), "id"
                ),
                256,
            ),
        )
        .withColumn("provenance", F.map_concat(F.coalesce("provenance", F.create_map().cast("map<string,string>")), F.create_map(F.lit("revision_of"), F.col("id"))))
        .withColumn("id", F.concat("id", F.lit("-rev")))
        .drop("benchmark_case_updates", "metadata_updates")
    )
    return revised, revised_files, errors


def revision_metrics(patches: DataFrame) -> DataFrame:
    """Per patch: edits, files touched, bytes added and removed, rewrites. Row-local, no shuffle."""
    ops = F.coalesce("environment_ops", F.array().cast("array<" + schemas.ENVIRONMENT_OP.simpleString() + ">"))
    flag = lambda name: F.size(F.filter(ops, lambda o: F.coalesce(o[name], F.lit(False)))).cast("bigint")
    size_of = lambda name: F.aggregate(
        ops, F.lit(0).cast("bigint"), lambda acc, o: acc + F.coalesce(F.octet_length(o[name]), F.lit(0)).cast("bigint")
    )
    touched = F.array_sort(
        F.array_distinct(F.transform(F.filter(ops, lambda o: ~blank(o["path"])), lambda o: o["path"]))
    )
    n = F.size(ops).cast("bigint")
    rewrites = flag("create_if_missing")
    return patches.select(
        "candidate_id",
        n.alias("revision_op_count"),
        F.size(F.filter(ops, lambda o: o["op"] == "edit_file")).cast("bigint").alias("revision_edit_file_count"),
        F.size(touched).cast("bigint").alias("revision_files_touched"),
        touched.alias("revision_files_touched_list"),
        size_of("new_text").alias("revision_bytes_added"),
        size_of("old_text").alias("revision_bytes_removed"),
        (size_of("new_text") + size_of("old_text")).alias("revision_bytes_changed"),
        rewrites.alias("revision_full_rewrite_count"),
        rewrites.alias("revision_create_file_count"),
        flag("replace_all").alias("revision_replace_all_count"),
        F.when(n > 0, rewrites / n).otherwise(F.lit(0.0)).alias("revision_full_rewrite_ratio"),
    )
