"""Answer-leak scans over candidate-facing texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill import fixed, schemas
from casemill.functions.documents import json_nodes
from casemill.functions.scalars import WHITESPACE, field
from casemill.operators.checks import RULE
from casemill.session import checkpointed


def candidate_texts(cands: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """(candidate_id, text_key, path, text): every candidate-facing string, ``text_key`` in reading order.

    Case fields come first in their declared order, then workspace files by path (name, then content).
    """
    case = F.try_parse_json(F.col("agent_artifact.benchmark_case"))
    parts = [
        F.concat(F.lit(f'"{k}":'), F.coalesce(field(case, f"$.{k}").cast("string"), F.lit("null")))
        for k in fixed.CANDIDATE_FACING_KEYS
    ]
    # a scalar string casts to bare text, so strings are quoted again
    parts = [
        F.when(
            F.schema_of_variant(field(case, f"$.{k}")) == "STRING",
            F.concat(
                F.lit(f'"{k}":'),
                F.regexp_extract(F.to_json(F.struct(F.try_variant_get(case, f"$.{k}", "string").alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1),
            ),
        ).otherwise(p)
        for k, p in zip(fixed.CANDIDATE_FACING_KEYS, parts)
    ]
    docs = cands.select(F.col("id").alias("candidate_id"), F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("body"))
    nodes = json_nodes(docs, "body", "candidate_id").where(F.col("kind") == "string")
    key = lambda section, ord_, path, part: F.struct(
        F.lit(section).alias("section"), ord_.alias("ord"), path.alias("file"), F.lit(part).alias("part")
    )
    texts = nodes.select(
        "candidate_id",
        key(0, F.col("ord"), F.lit(""), 0).alias("text_key"),
        F.concat(F.lit("benchmark_case."), "path").alias("path"),
        "text",
    )
    if files is None:
        return texts
    runnable = cands.where(F.col("agent_artifact.environment_artifact.kind") == fixed.WORKSPACE_KIND).select(
        F.col("id").alias("candidate_id")
    )
    listed = files.join(runnable, "candidate_id", "left_semi")
    # the file's place in its workspace; a workspace holds a bounded handful of files
    place = F.row_number().over(Window.partitionBy("candidate_id").orderBy(*(["ord"] if "ord" in files.columns else []), "path")) - 1
    listed = listed.withColumn("at", place.cast("string"))
    both = F.array(
        F.struct(key(1, F.lit(0), F.col("path"), 0).alias("text_key"), F.concat(F.lit("environment_artifact.payload.files."), "at", F.lit(".path")).alias("path"), F.col("path").alias("text")),
        F.struct(
            key(1, F.lit(0), F.col("path"), 1).alias("text_key"),
            F.concat(F.lit("environment_artifact.workspace."), "path").alias("path"),
            F.col("content").alias("text"),
        ),
    )
    file_texts = listed.select("candidate_id", F.explode(both).alias("t")).select("candidate_id", "t.*")
    return texts.unionByName(file_texts)


def first_marker(lowered: Column, markers: list[tuple[str, str]]) -> Column:
    """Struct(ord, subcode, pattern) of the first marker in list order that a lower-cased text contains."""
    found = F.lit(None).cast("struct<ord:int,subcode:string,pattern:string>")
    for position, (subcode, pattern) in reversed(list(enumerate(markers))):
        hit = F.struct(F.lit(position).alias("ord"), F.lit(subcode).alias("subcode"), F.lit(pattern).alias("pattern"))
        found = F.when(F.contains(lowered, F.lit(pattern)), hit).otherwise(found)
    return found


def marker_table(markers: DataFrame) -> DataFrame:
    """(ord, subcode, pattern) with patterns lower-cased; blank ones can mark nothing."""
    return markers.select(F.col("ord").cast("int").alias("ord"), "subcode", F.lower("pattern").alias("pattern")).where(
        F.length(F.regexp_replace("pattern", WHITESPACE, "")) > 0
    )


def leak_hits(texts: DataFrame, markers: list[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """(candidate_id, text_key, path, subcode, pattern): the first leaking text of each candidate.

    A list of markers becomes part of the plan. A table (ord, subcode, pattern) of any size is looked up in the
    texts by ``passage_hits``; in both the first text with a marker counts, and there the first marker in order.
    """
    if isinstance(markers, DataFrame):
        listed = marker_table(markers)
        named = texts.select(F.struct("candidate_id", "text_key", "path").alias("id"), "text")
        found = passage_hits(named, listed.select(F.col("ord").alias("passage_id"), F.col("pattern").alias("passage")))
        found = found.join(listed, F.col("passage_id") == F.col("ord")).select("id.*", F.struct("ord", "subcode", "pattern").alias("marker"))
    else:
        lowered = texts.select("candidate_id", "text_key", "path", F.lower("text").alias("_lowered"))
        hit = F.array_compact(F.array(first_marker(F.col("_lowered"), fixed.LEAK_MARKERS if markers is None else markers)))
        # exploding the at most one hit keeps the marker chain from being evaluated again by a filter
        found = lowered.select("candidate_id", "text_key", "path", F.explode(hit).alias("marker"))
    first = found.groupBy("candidate_id").agg(
        F.min(F.struct("text_key", F.col("marker.ord").alias("ord"), "path", "marker.subcode", "marker.pattern")).alias("hit")
    )
    return first.select("candidate_id", "hit.text_key", "hit.path", "hit.subcode", "hit.pattern")


def check_leakage(texts: DataFrame, markers: list[tuple[str, str]] | DataFrame | None = None, ids: DataFrame | None = None) -> DataFrame:
    """One check row per candidate. ``ids`` names candidates that may have no text at all."""
    ids = texts.select("candidate_id").distinct() if ids is None else ids
    joined = ids.join(leak_hits(texts, markers), "candidate_id", "left")
    bad = F.col("pattern").isNotNull()
    note = F.array(
        F.struct(
            F.lit(RULE).alias("source"),
            F.col("path"),
            F.concat(F.lit("candidate-facing text contains answer-leak marker: "), "pattern").alias("value"),
        )
    )
    return joined.select(
        "candidate_id",
        F.lit(0).alias("check_ord"),
        F.lit("answer_leakage").alias("check_id"),
        (~bad).alias("passed"),
        F.when(bad, F.lit("reject_leakage")).otherwise(F.lit("accept")).alias("route_code"),
        F.col("subcode"),
        F.when(bad, note).otherwise(F.array().cast(schemas.EVIDENCE)).alias("evidence"),
    )


def _pairs_of(words: Column) -> Column:
    """Neighbouring words joined by one space."""
    return F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))


def passage_hits(texts: DataFrame, passages: DataFrame) -> DataFrame:
    """(id, passage_id): every pair where the lower-cased text contains the lower-cased passage.

    ``texts`` is (id, text), ``passages`` is (passage_id, passage); both may be large. Exact without
    comparing every pair. Two words strictly inside a passage must be neighbouring whole words of any text
    that holds it, so each passage is looked up under the inside pair that occurs in fewest texts; one with
    a single inside word under that word. A passage of one or two words has none: its longest word lies
    inside some word of the text, so it is looked up among the distinct words of all texts, cut at every
    position to the lengths that such passages have. Looked-up pairs are then verified on the whole text.
    Passages without a visible character are in no result. The joins are plain equality joins, in which a
    frequent key is split by the skew join.
    """
    lowered = passages.select("passage_id", F.lower("passage").alias("passage"))
    lowered = lowered.withColumn("words", F.split("passage", WHITESPACE)).where(F.exists("words", lambda w: w != ""))
    inside = F.slice("words", 2, F.greatest(F.size("words") - 2, F.lit(0)))
    split = lowered.withColumn("inside", F.filter(inside, lambda w: w != ""))
    # neighbours need no empty word between them, which several white-space characters in a row give
    pairs = F.filter(_pairs_of(inside), lambda p: ~F.startswith(p, F.lit(" ")) & ~F.endswith(p, F.lit(" ")))
    keys = F.when(F.size(pairs) > 0, pairs).otherwise(F.col("inside"))
    options = split.select("passage_id", F.explode(F.array_distinct(keys)).alias("token"))
    longest = F.array_max(F.transform("words", lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    short = split.where(F.size("inside") == 0).select("passage_id", longest.alias("piece"))

    words = F.split(F.lower(F.col("text")), WHITESPACE)
    tokens = texts.select("id", F.explode(F.array_distinct(F.concat(words, _pairs_of(words)))).alias("token"))
    # one row per (text, known key), written once: counted for the rarest keys, then joined to them
    known = checkpointed(tokens.join(options.select("token").distinct(), "token", "left_semi"))
    frequency = known.groupBy("token").agg(F.count("*").alias("texts"))
    rarest = (
        options.join(frequency, "token")
        .groupBy("passage_id")
        .agg(F.min(F.struct("texts", "token")).alias("best"))
        .select("passage_id", F.col("best.token").alias("token"))
    )
    sizes = sorted(r["n"] for r in short.select(F.length("piece").alias("n")).distinct().collect())  # lengths of words
    if sizes:
        own = texts.select("id", F.explode(F.array_distinct(words)).alias("token"))
        cut = lambda n: F.when(
            F.length("token") >= n, F.transform(F.sequence(F.lit(1), F.length("token") - n + 1), lambda at: F.substr("token", at, F.lit(n)))
        ).otherwise(F.array().cast("array<string>"))
        pieces = own.select("token").distinct().select("token", F.explode(F.array_distinct(F.flatten(F.array(*[cut(n) for n in sizes])))).alias("piece"))
        by_piece = pieces.join(short, "piece").select("token", "passage_id")
        found = known.join(rarest, "token").select("id", "passage_id").unionByName(own.join(by_piece, "token").select("id", "passage_id"))
    else:
        found = known.join(rarest, "token").select("id", "passage_id")
    verified = (
        found.distinct()
        .join(texts.select("id", F.lower("text").alias("text")), "id")
        .join(lowered.select("passage_id", "passage"), "passage_id")
        .where(F.contains("text", F.col("passage")))
    )
    return verified.select("id", "passage_id")
