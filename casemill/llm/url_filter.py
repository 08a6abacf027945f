"""URL filters: host rules first, then naive Bayes over the words that Viterbi finds in hosts and paths."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.llm.common import LOWER, UPPER, packed, stored, unpacked

#: (action, host, path prefix)
Rule = tuple[str, str, str]
#: Feature buckets of the classifier and the weight of one seed word's pretended pages.
BUCKETS, SEED_PAGES = 2**16, 50
#: Words that mark hosts to block; they teach the classifier like SEED_PAGES blocked pages each.
SEEDS = ("adult", "bet", "bets", "betting", "casino", "gambling", "poker", "porn", "sex", "spam", "viagra", "warez", "xxx")
LONGEST = 24
_RUNS = T.ArrayType(T.StructType([T.StructField("place", T.StringType()), T.StructField("run", T.StringType())]))
_PART = re.compile("[a-z]+|[0-9]+")
_OPEN = re.compile(r"<(?:(script|style)\b)?")
_WORDS = re.compile("(?<![a-z])[a-z]{2,%d}(?![a-z])" % LONGEST)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return F.translate(F.regexp_extract(_after(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, action) of the longest rule that fits, null if none. A rule fits its host and all its subdomains."""
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for action, name, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(prefix))
        out = F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(action).alias("action"))).otherwise(out)
    return out


# ---------------------------------------------------------------- words


def without_markup(html: str) -> str:
    """Lower-cased ``html`` with a space for every tag and every script or style element, in one pass.

    An element that never closes is a tag like any other, a tag that never closes is text.
    """
    out, at, unclosed = [], 0, set()
    while (tag := _OPEN.search(html, at)) is not None:
        start, name = tag.start(), tag.group(1)
        stop = -1
        if name and name not in unclosed:
            stop = html.find(f"</{name}>", tag.end())
            if stop < 0:
                unclosed.add(name)  # nor will it close for a later one
            else:
                stop += len(name) + 2
        if stop < 0:
            stop = html.find(">", start)
        if stop < 0:
            break
        out += [html[at:start], " "]
        at = stop + 1
    return "".join([*out, html[at:]])


def unigrams(texts: DataFrame, text_col: str) -> DataFrame:
    """(word, n) of every word of two letters or more in a text column without its markup, all texts counted."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = Counter()
            for text in batch["text"]:
                found.update(_WORDS.findall(without_markup((text or "").lower())))
            yield pd.DataFrame({"word": list(found), "n": list(found.values())}).astype({"word": str, "n": "int64"})

    counted = texts.select(F.col(text_col).alias("text")).mapInPandas(count, "word string, n long")
    return stored(counted.groupBy("word").agg(F.sum("n").alias("n")))


def segment(text: str, model: dict[str, float]) -> list[str]:
    """The most probable split of a run of letters into words. Unknown pieces cost more the longer they are."""
    unknown = math.log(1e-9)
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        options = []
        for start in range(max(0, end - LONGEST), end):
            piece = text[start:end]
            cost = model.get(piece)
            options.append((best[start][0] + (unknown - 2.0 * (end - start) if cost is None else cost), start))
        best.append(max(options))
    out, end = [], len(text)
    while end:
        out.append(text[best[end][1] : end])
        end = best[end][1]
    return out[::-1]


@F.pandas_udf(_RUNS)
def _runs(hosts: pd.Series, paths: pd.Series) -> pd.Series:
    """Runs of letters or digits in hosts (place h) and paths (place p)."""
    return pd.Series([[("h", r) for r in _PART.findall(h)] + [("p", r) for r in _PART.findall(p.lower())] for h, p in zip(hosts, paths)])


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(run, piece): what may be a word of a run."""
    for batch in batches:
        for run in batch["run"]:
            found = {run[a : a + n] for n in range(2, LONGEST + 1) for a in range(len(run) - n + 1)}
            yield pd.DataFrame({"run": run, "piece": sorted(found)}, dtype=str)


def tokens(split: DataFrame, words: DataFrame) -> DataFrame:
    """(at, tokens) of rows (at, host, path): words of host and path, marked by where they stand; a number gives its length.

    Every distinct run of letters is split once, by the counts of those of its pieces that are in ``words`` (word, n).
    No vocabulary travels: the counts come by a join. A run that a third of all urls have is one row on that side,
    and the skew join splits the other. Rows without a run are not in the result.
    """
    each = split.select("at", F.posexplode(_runs("host", "path")).alias("position", "part")).select("at", "position", "part.*")
    digits = F.rlike("run", F.lit("^[0-9]"))
    runs = each.where(~digits).select("run").distinct()
    total = float(words.agg(F.sum("n")).first()[0] or 1)
    known = runs.mapInPandas(_pieces, "run string, piece string").join(words, F.col("piece") == F.col("word"))
    counted = known.groupBy("run").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    @F.pandas_udf("array<string>")
    def parts(run: pd.Series, found: pd.Series) -> pd.Series:
        models = [{} if f is None else {x["word"]: math.log(x["n"] / total) for x in f} for f in found]
        return pd.Series([segment(r, m) for r, m in zip(run, models)])

    cut = runs.join(counted, "run", "left").select("run", parts("run", "known").alias("words"))
    number = F.array(F.concat(F.lit("#"), F.length("run").cast("string")))
    marked = each.join(cut, "run", "left").select(
        "at", "position", F.transform(F.when(digits, number).otherwise(F.col("words")), lambda w: F.concat("place", F.lit(":"), w)).alias("marked")
    )
    in_order = F.array_sort(F.collect_list(F.struct("position", "marked")))
    return marked.groupBy("at").agg(F.flatten(F.transform(in_order, lambda x: x["marked"])).alias("tokens"))


# ---------------------------------------------------------------- the classifier


def bayes_weights(taught: DataFrame, seeds: Sequence[str] = SEEDS) -> tuple[float, np.ndarray]:
    """(prior, weight per bucket) of multinomial naive Bayes as log odds of block, from rows (action, buckets).

    Counts come back per bucket and class: 2 * BUCKETS rows at most, whatever the table holds.
    """
    counts, pages = np.ones((2, BUCKETS)), np.ones(2)
    block = (F.col("action") == "block").cast("int")
    for row in taught.groupBy(block.alias("c")).agg(F.count("*").alias("n")).collect():
        pages[row["c"]] += row["n"]
    hits = taught.select(block.alias("c"), F.explode("buckets").alias("b")).groupBy("c", "b").agg(F.count("*").alias("n"))
    for row in hits.collect():
        counts[row["c"], row["b"]] += row["n"]
    spark = taught.sparkSession
    marks = spark.createDataFrame([("h:" + s,) for s in seeds], "w string").select(_bucket(F.col("w")).alias("b")).collect() if seeds else []
    for row in marks:
        counts[1, row["b"]] += SEED_PAGES
    odds = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    return float(np.log(pages[1] / pages[0])), odds


def _bucket(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def judge(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url", text_col: str = "html", seeds: Sequence[str] = SEEDS) -> DataFrame:
    """``pages`` without its text plus host, path, rule, tokens, odds and verdict (allow or block).

    A fitting rule decides; for the others the classifier does, block at odds above zero. It learns from the pages
    that rules decide and from the seed words. Null urls and urls without ``://`` have empty host and path, so no
    rule fits and the prior decides. Repeated rows are judged alike; an empty table gives an empty result; columns
    named like the new ones are replaced.

    The word model counts all texts and the classifier learns from all ruled pages. What travels to the tasks is one weight
    per bucket; counts of words come by a join, whatever their number.
    """
    words = unigrams(pages, text_col)
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    split = packed(pages, host=host, path=path).withColumn("row", F.col("row").dropFields(*[c for c in pages.columns if c.lower() == text_col.lower()]))
    split = stored(split.withColumn("at", F.monotonically_increasing_id()))  # numbers are kept with the rows
    ruled = split.join(tokens(split, words), "at", "left").withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>")))
    fits = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = stored(ruled.withColumn("fits", fits).select("row", "host", "path", "fits.rule", "fits.action", "tokens", F.transform("tokens", _bucket).alias("buckets")))
    prior, weights = bayes_weights(ruled.where("action is not null"), seeds)

    @F.pandas_udf("double")
    def score(buckets: pd.Series) -> pd.Series:
        return buckets.map(lambda b: prior + float(weights[np.asarray(b, dtype=np.int64)].sum()))

    decided = F.coalesce("action", F.when(F.col("odds") > 0, "block").otherwise("allow"))
    judged = ruled.withColumn("odds", score("buckets")).withColumn("verdict", decided)
    return unpacked(judged, ("host", "path", "rule", "tokens", "odds", "verdict"))
