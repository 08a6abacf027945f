"""Scalar column functions. All JVM-side expressions; nothing here starts a Python worker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casemill import fixed

WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strings(*values: str) -> Column:
    """A literal array of strings (typed even when empty)."""
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


# ---------------------------------------------------------------- hashing and keys


def stable_hash(**cols: Column) -> Column:
    """sha256 over key-sorted compact JSON; absent values stay visible as null."""
    ordered = F.struct(*[cols[k].alias(k) for k in sorted(cols)])
    return F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256)


def cell_key(cell: Column, missing: str = "None") -> Column:
    """``case_type|difficulty|scenario``; missing parts print as ``None`` like the reports do."""
    return F.concat_ws(
        "|",
        *[F.coalesce(cell[p].cast("string"), F.lit(missing)) for p in ("case_type", "difficulty", "scenario")],
    )


# ---------------------------------------------------------------- tolerant numbers and latency


def safe_int(col: Column) -> Column:
    """Whole numbers as written, anything else 0."""
    text = F.trim(col.cast("string"))
    return F.coalesce(F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint")), F.lit(0).cast("bigint"))


def elapsed_from_error(error: Column) -> Column:
    found = F.regexp_extract(error, r"elapsed_ms=(\d+)", 1)
    return F.coalesce(found.try_cast("bigint"), F.lit(0).cast("bigint"))


def effective_latency(latency: Column, error: Column) -> Column:
    """The recorded latency, or the elapsed time an error message carries, or 0."""
    return F.coalesce(F.nullif(latency.cast("bigint"), F.lit(0).cast("bigint")), elapsed_from_error(error))


def round4(col: Column) -> Column:
    """Round a double to four places, ties to even."""
    return F.bround(col, 4)


# ---------------------------------------------------------------- display


def clip(col: Column, limit: int) -> Column:
    """Collapse whitespace and cut to ``limit - 1`` characters plus an ellipsis."""
    return let(
        F.btrim(F.regexp_replace(col, WHITESPACE, " ")),
        lambda flat: F.when(F.length(flat) <= limit, flat).otherwise(
            F.concat(F.substring(flat, 1, limit - 1), F.lit("..."))
        ),
    )


def short_id(col: Column) -> Column:
    return F.when(F.length(col) <= 48, col).otherwise(
        F.concat(F.substring(col, 1, 22), F.lit("..."), F.right(col, F.lit(22)))
    )


def _one_decimal(value: Column, unit: int) -> Column:
    """``value / unit`` with one decimal, rounded as the binary quotient rounds.

    A tie in decimal is rarely a tie in binary, so the sign of ``quotient * unit - value`` (computed
    without rounding error by splitting the quotient) decides which way a decimal tie goes.
    """
    v = value.cast("bigint")
    u = float(unit)
    q = v.cast("double") / F.lit(u)
    big = q * F.lit(134217729.0)
    high = big - (big - q)
    low = q - high
    product = q * F.lit(u)
    residue = (product - v.cast("double")) + ((high * F.lit(u) - product) + low * F.lit(u))
    tenths = F.floor(v * 10 / F.lit(unit)).cast("bigint")
    twice = (v * 10 - tenths * unit) * 2
    tie_up = (residue > 0) | ((residue == 0) & (tenths % 2 == 1))
    up = (twice > unit) | ((twice == unit) & tie_up)
    tenths = tenths + F.when(up, F.lit(1)).otherwise(F.lit(0))
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def fmt_ms(value: Column) -> Column:
    return (
        F.when(value >= 60_000, F.concat(_one_decimal(value, 60_000), F.lit("m")))
        .when(value >= 1000, F.concat(_one_decimal(value, 1000), F.lit("s")))
        .otherwise(F.concat(value.cast("string"), F.lit("ms")))
    )


def fmt_bytes(value: Column) -> Column:
    return (
        F.when(value >= 1_048_576, F.concat(_one_decimal(value, 1_048_576), F.lit("MiB")))
        .when(value >= 1024, F.concat(_one_decimal(value, 1024), F.lit("KiB")))
        .otherwise(F.concat(value.cast("string"), F.lit("B")))
    )


def attempt_number(candidate_id: Column, fallback: Column) -> Column:
    """The digits after the last dash of a candidate id, else the fallback."""
    tail = F.regexp_extract(candidate_id, r"(?:^|-)([0-9]+)$", 1)
    return F.coalesce(F.nullif(tail, F.lit("")).try_cast("bigint"), fallback.cast("bigint"))


def stage_label(role: Column, stage_kind: Column) -> Column:
    label = F.lit(None).cast("string")
    for name, text in reversed(list(fixed.STAGE_LABELS.items())):
        label = F.when(role == name, F.lit(text)).otherwise(label)
    return F.coalesce(label, stage_kind)


def stage_id(stage_kind: Column, artifact_id: Column) -> Column:
    return F.concat_ws(":", stage_kind, artifact_id)


def safe_event_fields(fields: Column) -> Column:
    """Drop the event fields that would reveal prompts or whole documents."""
    return F.map_filter(fields, lambda k, v: ~k.isin(*fixed.HIDDEN_EVENT_FIELDS))


# ---------------------------------------------------------------- arrays


def ordered_distinct(arr: Column) -> Column:
    return F.array_distinct(arr)


def overlaps(a: Column, b: Column) -> Column:
    return F.coalesce(F.arrays_overlap(a, b), F.lit(False))


def is_subset(a: Column, b: Column) -> Column:
    """Every item of ``a`` is in ``b``."""
    return F.size(F.array_except(F.coalesce(a, strings()), F.coalesce(b, strings()))) == 0


def contains_any(text: Column, markers: list[str]) -> Column:
    """Whether any of a short fixed list of substrings occurs."""
    hit = F.lit(False)
    for m in markers:
        hit = hit | F.contains(text, F.lit(m))
    return hit


def has_marker(text: Column) -> Column:
    """Hypothesis language in lower-cased text."""
    return contains_any(text, fixed.HYPOTHESIS_MARKERS)


def concept_hits(concepts: Column, lowered_text: Column) -> Column:
    return F.size(F.filter(concepts, lambda c: F.contains(lowered_text, F.lower(c))))


def invented_record(records: Column) -> Column:
    """Some cited record starts with none of the known prefixes."""
    known = fixed.KNOWN_RECORD_PREFIXES

    def unknown(r: Column) -> Column:
        ok = F.lit(False)
        for p in known:
            ok = ok | F.startswith(r, F.lit(p))
        return ~ok

    return F.coalesce(F.exists(records, unknown), F.lit(False))


def exposure_matches(actual: Column, expected: Column) -> Column:
    """Revenue and constraint equal, and every expected order and customer reported."""
    revenue = F.coalesce(actual["revenue_at_risk"], F.lit(-1)) == F.coalesce(expected["revenue_at_risk"], F.lit(-2))
    constrained = F.coalesce(actual["constrained_inventory"], F.lit(False)) == F.coalesce(
        expected["constrained_inventory"], F.lit(False)
    )
    return (
        revenue
        & constrained
        & is_subset(expected["affected_orders"], actual["affected_orders"])
        & is_subset(expected["affected_customers"], actual["affected_customers"])
    )


# ---------------------------------------------------------------- vectors


def cosine(a: Column, b: Column) -> Column:
    """Dot product over the shorter length, full norms, 0 when either norm is 0."""
    zero = F.lit(0.0)
    n = F.least(F.size(a), F.size(b))
    dot = F.aggregate(
        F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x * y), zero, lambda acc, x: acc + x
    )
    norm_a = F.sqrt(F.aggregate(a, zero, lambda acc, x: acc + x * x))
    norm_b = F.sqrt(F.aggregate(b, zero, lambda acc, x: acc + x * x))
    return F.when((norm_a == 0) | (norm_b == 0), zero).otherwise(dot / (norm_a * norm_b))


# ---------------------------------------------------------------- JSON text and answers


def strip_fence(col: Column) -> Column:
    """Drop a surrounding Markdown code fence."""
    blanks = " \t\r\n\x0b\x0c"

    def strip(text: Column) -> Column:
        opened = F.regexp_replace(text, r"^```[^\n]*\n?", "")
        closed = F.regexp_replace(opened, r"(?:^|\n)[ \t]*```[ \t]*$", "")
        return F.when(F.startswith(text, F.lit("```")), F.btrim(closed, F.lit(blanks))).otherwise(text)

    return let(F.btrim(col, F.lit(blanks)), strip)


def parse_fenced_json(col: Column) -> Column:
    """Struct of the parsed value (VARIANT) and an error text when the text is not JSON."""
    value = F.try_parse_json(strip_fence(col))
    return F.struct(
        value.alias("parsed"),
        F.when(value.isNull(), F.lit("invalid JSON")).alias("parsing_error"),
    )


def is_json_object(v: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.lit(False))


def is_json_array(v: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("ARRAY")), F.lit(False))


def is_json_string(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def field(v: Column, path: str) -> Column:
    """A field as VARIANT; SQL NULL only when the key is missing."""
    return F.try_variant_get(v, path, "variant")


def truthy(v: Column) -> Column:
    """Truth of a JSON value (VARIANT): present, not null, not false, zero or empty."""
    return F.coalesce(~F.to_json(v).isin("null", "false", "0", "0.0", "-0.0", '""', "[]", "{}"), F.lit(False))


def unwrap_answer(raw: Column) -> Column:
    """The decision object: itself when it holds ``decision``, else the first envelope key that holds one.

    ``raw`` is JSON text; the result is a VARIANT. A string value is parsed again, and skipped when it
    is not JSON.
    """

    def inner(v: Column) -> Column:
        values = F.array(*[field(v, f"$.{key}") for key in fixed.ANSWER_ENVELOPE_KEYS])
        usable = F.transform(
            values,
            lambda x: F.when(is_json_object(x), x).when(is_json_string(x), F.try_parse_json(F.try_variant_get(x, "$", "string"))),
        )
        return F.get(F.filter(usable, lambda x: x.isNotNull()), F.lit(0))

    def unwrap(v: Column) -> Column:
        return (
            F.when(is_json_object(v) & field(v, "$.decision").isNotNull(), v)
            .when(is_json_object(v), F.coalesce(inner(v), v))
            .when(is_json_string(v), F.try_parse_json(F.try_variant_get(v, "$", "string")))
            .otherwise(v)
        )

    return let(F.try_parse_json(raw), unwrap)


def unwrap_response(raw: Column) -> Column:
    """The scan answer: the object inside a JSON-text ``response`` field, else the document itself."""

    def unwrap(v: Column) -> Column:
        text = F.when(is_json_string(field(v, "$.response")), F.try_variant_get(v, "$.response", "string"))
        return let(F.try_parse_json(text), lambda inner: F.when(is_json_object(inner), inner).otherwise(v))

    return let(F.try_parse_json(raw), unwrap)


def error_route(message: Column, structured: Column | None = None) -> Column:
    """Which retry a provider error message calls for."""
    parse = contains_any(message, ["invalid JSON", "structured output", "revision patch", "environment_ops"])
    if structured is not None:
        parse = parse | F.coalesce(structured, F.lit(False))
    return (
        F.when(parse, F.lit("retry_parse"))
        .when(F.contains(F.lower(message), F.lit("empty")), F.lit("retry_provider_empty"))
        .otherwise(F.lit("retry_infra"))
    )


def evidence_aliases(evidence: Column) -> Column:
    """Every name a list of cited evidence may be known by.

    ``evidence`` is ``array<struct<key, source>>``. The cited key itself counts, the key qualified by
    its record file, and the audit form for audit-view citations.
    """

    def names(item: Column) -> Column:
        raw = F.coalesce(item["key"], F.lit("None"))
        source = F.regexp_replace(F.coalesce(item["source"], F.lit("")), r"^records/", "")
        source = F.regexp_replace(F.regexp_replace(source, r"\.json$", ""), r"\.md$", "")
        key = F.regexp_replace(raw, r"^result\.", "")
        audit = F.replace(F.regexp_replace(key, r"^audit\.", "audit_vendor."), F.lit(".result."), F.lit("."))
        return F.array_compact(
            F.array(
                raw,
                F.when(source != "", F.concat(source, F.lit("."), key)),
                F.when(F.startswith(audit, F.lit("audit_vendor.")), audit),
                F.when(
                    F.startswith(source, F.lit("audit_vendor ")) & F.contains(key, F.lit(".")),
                    F.concat(F.lit("audit_vendor."), key),
                ),
            )
        )

    return F.array_distinct(F.flatten(F.transform(evidence, names)))


def excerpt(text: Column, query: Column) -> Column:
    """80 characters before and 160 after the start of the first case-insensitive hit."""
    at = F.instr(F.lower(text), F.lower(query)) - 1
    start = F.greatest(F.lit(0), at - 80)
    return F.replace(F.substr(text, start + 1, at + 160 - start), F.lit("\n"), F.lit(" "))
