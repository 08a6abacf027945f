"""Secrets in texts: base patterns, and weak parts of multipart credentials that count only together.

A weak part - an account name, an unlabelled key, an endpoint - says little alone. Parts are intervals of code points;
an interval join within a document finds which weak parts have their complement near, and only those are reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import stored, text_or_empty

#: The base patterns and the least length of what they must find.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
#: Weak parts: account names, mixed-case keys without a label, endpoints.
IDENTIFIER = r"""(?i:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]{3,}"""
KEY = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{0,200}[0-9])(?=[A-Za-z0-9+/_-]{0,200}[a-z])(?=[A-Za-z0-9+/_-]{0,200}[A-Z])[A-Za-z0-9+/_-]{24,}"
ENDPOINT = r"""(?:https?|jdbc:[a-z]+|postgres|mysql|redis|s3)://[^\x00-\x20"'<>]{4,}|(?i:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]+)?"""
#: Kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "identifier", "key", "endpoint")
#: Code points between parts of one credential.
SCOPE = 200

SPAN = "array<struct<start:int,rank:int,end:int>>"


def _spans(text: Column, kind: str, pattern: str, wanted=None) -> Column:
    """(start, rank of kind, end) of the leftmost non-overlapping matches.

    The text between matches and the matches alternate, so positions are running sums of both lengths.
    """
    rank = F.lit(KINDS.index(kind))
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(matches, F.length)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    keep = F.transform(matches, lambda m: F.lit(True)) if wanted is None else wanted(text)
    pieces = F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), keep.alias("keep"))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def take(state: Column, piece: Column) -> Column:
        start = state["at"] + piece["gap"]
        end = start + F.coalesce(piece["size"], F.lit(0))
        found = F.array(F.struct(start.alias("start"), rank.alias("rank"), end.alias("end")))
        out = F.when(F.coalesce(piece["keep"], F.lit(False)), F.concat(state["out"], found)).otherwise(state["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    return F.aggregate(pieces, begin, take, lambda s: s["out"])


def _if(test: Column, spans: Column) -> Column:
    return F.when(test, spans).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> dict[str, Column]:
    """The base spans of every kind. A cheap test first: most texts hold none."""
    long_enough = lambda t: F.transform(F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)), lambda g: F.length(g) >= ASSIGN_LEAST)
    # a run of these classes is taken whole, so asking for the least length at once finds the same runs
    return {
        "assign": _if(text.rlike(ASSIGN[:-2] + "{%d})" % ASSIGN_LEAST), _spans(text, "assign", ASSIGN, long_enough)),
        "access": _if(F.contains(text, F.lit("AKIA")), _spans(text, "access", ACCESS[:-1] + "{%d,}" % (ACCESS_LEAST - 4))),
        "hex": _if(text.rlike(HEX[:-1] + "{%d}" % HEX_LEAST), _spans(text, "hex", HEX[:-1] + "{%d,}" % HEX_LEAST)),
    }


def weak_spans(text: Column) -> Column:
    """All weak parts; whether they count is for the join to say."""
    marked = F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))
    return F.concat(
        _if(marked & text.rlike(IDENTIFIER), _spans(text, "identifier", IDENTIFIER)),
        _if(text.rlike("[A-Za-z0-9+/_-]{24}"), _spans(text, "key", KEY)),
        _if(marked & text.rlike(ENDPOINT), _spans(text, "endpoint", ENDPOINT)),
    )


def _bins(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(F.floor(start / SCOPE), F.floor(end / SCOPE)))


def linked_parts(found: DataFrame) -> DataFrame:
    """(row, linked): the weak spans of each row whose complementary parts lie within SCOPE code points.

    A name counts near a secret, an unlabelled key near an identifier, an endpoint near both. A part that overlaps a
    base span is left out, that span is reported anyway. The interval join is an equality join on (row, bin of SCOPE
    code points) followed by the exact test; a bin holds no more parts than code points, whatever a document holds.
    """
    rows = found.where(F.size("weak") > 0).dropDuplicates(["row"])
    clear = lambda w: ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"]))
    rows = rows.select("row", "base", F.filter("weak", clear).alias("weak"))
    parts = rows.select("row", F.explode(F.concat("base", "weak")).alias("p")).select("row", "p.*")
    near = parts.select("row", F.col("start").alias("s"), F.col("end").alias("e"), F.col("rank").alias("k"), _bins(F.col("start"), F.col("end")).alias("bin"))
    weak = parts.where(F.col("rank") >= 3).select(
        "row", "start", "rank", "end", _bins(F.greatest(F.lit(0), F.col("start") - SCOPE), F.col("end") + SCOPE).alias("bin")
    )
    name, secret = F.col("k").isin(1, 3), F.col("k").isin(0, 2, 4)
    met = (
        weak.join(near, ["row", "bin"])
        .where((F.col("s") <= F.col("end") + SCOPE) & (F.col("e") >= F.col("start") - SCOPE))
        .groupBy("row", "start", "rank", "end")
        .agg(F.max(name).alias("name"), F.max(secret).alias("secret"))
    )
    counts = F.when(F.col("rank") == 3, F.col("secret")).when(F.col("rank") == 4, F.col("name")).otherwise(F.col("name") & F.col("secret"))
    return met.where(counts).groupBy("row").agg(F.collect_list(F.struct("start", "rank", "end")).alias("linked"))


def spans_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, base and spans (arrays of start, rank, end).

    Positions are code points, ends exclusive; an assignment's span is the whole match. base has the base spans,
    spans those and the linked weak ones, both by start, then kind. Null and empty texts have none. Rows that repeat
    an id with another text are told apart by the text; equal rows get equal results. An empty table gives an empty
    result; other columns are not read.

    Every text is read once, by native expressions; what is written out, joined and grouped are spans. A document's
    own spans are the largest group.
    """
    text = text_or_empty(text_col)
    row = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit(":"), text))
    found = docs.select(F.col(id_col).alias("_id"), row.alias("row"), *[c.alias(k) for k, c in base_spans(text).items()], weak_spans(text).alias("weak"))
    found = stored(found.withColumn("base", F.array_sort(F.concat("assign", "access", "hex"))))
    linked = linked_parts(found.select("row", "base", "weak"))
    return found.join(linked, "row", "left").select(
        F.col("_id").alias(id_col),
        *[F.size(k).cast("bigint").alias("n_" + k) for k in ("assign", "access", "hex")],
        "base",
        F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(SPAN)))).alias("spans"),
    )
