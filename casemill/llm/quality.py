"""Document quality by a Bradley-Terry ranking: pairs of a better and a worse document, logistic loss on differences."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.common import packed, stored, unpacked

_WORD = re.compile("[^\x20\x09-\x0d]+")
_MARKS = re.compile(r"[^\w\s]{2,}")
_UPPER_WORD = re.compile(r"\b[^\W\d_a-zß-öø-ÿ]{2,}\b")
_END = re.compile(r"[.?!](?:\s|$)")
#: Columns of a document's features, in order.
FEATURES = (
    "log_words", "word_length", "upper", "upper_words", "marks", "mark_runs", "digits", "distinct", "top_share", "echo", "echo_run",
    "bars", "ends", "short_words", "line_words", "worst_marks", "worst_echo", "worst_upper", "worst_bars", "bigrams", "empty",
)
PART = 64
ACCEPT = 0.7
PENALTY = 1e-3


def features(text: str | None) -> tuple[float, ...]:
    """Shares and means over the whole text, and the worst of its stretches of PART words; an empty text is all zero but one."""
    text = text or ""
    words = _WORD.findall(text)
    n = len(words)
    if not n:
        return (0.0,) * (len(FEATURES) - 1) + (1.0,)
    chars = sum(map(len, words))
    letters = sum(c.isalpha() for c in text) if not text.isascii() else len(re.findall("[A-Za-z]", text))
    upper = len(re.findall("[A-Z]", text)) if text.isascii() else sum(c.isupper() for c in text)
    digits = len(re.findall("[0-9]", text))
    counts = Counter(words)
    same = np.fromiter((a == b for a, b in zip(words, words[1:])), dtype=bool, count=n - 1)
    breaks = np.flatnonzero(~same)
    longest = int(np.diff(np.concatenate([[-1], breaks, [n - 1]])).max()) if n > 1 else 1
    runs = np.fromiter((bool(_MARKS.search(w)) for w in words), dtype=bool, count=n)
    shout = np.fromiter((len(w) > 1 and w.isupper() for w in words), dtype=bool, count=n)
    bars = np.fromiter((w == "|" for w in words), dtype=bool, count=n)

    def worst(flags: np.ndarray) -> float:
        if not len(flags):
            return 0.0
        starts = np.arange(0, len(flags), PART)
        return float((np.add.reduceat(flags, starts, dtype=np.int64) / np.diff(np.append(starts, len(flags)))).max())

    return (
        math.log1p(n),
        chars / n,
        upper / max(1, letters),
        float(shout.mean()),
        (chars - letters - digits) / chars,
        float(runs.mean()),
        digits / chars,
        len(counts) / n,
        max(counts.values()) / n,
        float(same.mean()) if n > 1 else 0.0,
        math.log(longest),
        float(bars.mean()),
        len(_END.findall(text)) / n,
        sum(len(w) <= 2 for w in words) / n,
        math.log(n / (1 + text.count("\n"))),
        worst(runs),
        worst(same),
        worst(shout),
        worst(bars),
        len(set(zip(words, words[1:]))) / n,
        0.0,
    )


def _key(text_col: str) -> Column:
    """Tells rows that repeat an id apart."""
    return F.md5(F.coalesce(F.col(text_col), F.lit("")))


def with_features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    names = list(FEATURES)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = np.array([features(t) for t in batch["text"]], dtype=np.float64).reshape(len(batch), len(names))
            yield pd.concat([batch[["_id", "_key"]], pd.DataFrame(values, columns=names, index=batch.index)], axis=1)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("_id"), _key(text_col).alias("_key"), F.col(text_col).alias("text")).mapInPandas(
        measure, f"_id {kind}, _key string, " + ", ".join(f"{n} double" for n in names)
    )


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _scaled(moments: dict[str, tuple[float, float]]) -> list[Column]:
    return [((F.col(n) - F.lit(m)) / F.lit(s)).alias(n) for n, (m, s) in moments.items()]


def preference_pairs(train: DataFrame, slot_rows: int = 512) -> DataFrame:
    """Feature differences of pairs (better minus worse), one pair per row of the larger class in every slot.

    Rows are dealt into slots by hash of their id and numbered per slot and label; the n-th better row meets the
    worse row numbered n modulo their count, and the other way round if the worse are more. Never all pairs.
    """
    slots = max(1, train.count() // slot_rows)
    dealt = train.withColumn("_slot", F.pmod(F.xxhash64("_id"), F.lit(slots)))
    own = Window.partitionBy("_slot", "label")
    dealt = dealt.withColumn("_at", F.row_number().over(own.orderBy("_id")) - 1).withColumn("_of", F.count("*").over(own))
    good, bad = dealt.where("label = 1"), dealt.where("label = 0").select(*[F.col(c).alias("b_" + c) for c in dealt.columns])
    turn = F.greatest("_of", "b__of")
    sizes = good.select("_slot", "_of").distinct().join(bad.select(F.col("b__slot").alias("_slot"), "b__of").distinct(), "_slot")
    rows = sizes.select("_slot", F.explode(F.sequence(F.lit(0).cast("bigint"), turn - 1)).alias("_n"), F.col("_of").alias("_g"), F.col("b__of").alias("_b"))
    paired = rows.join(good.withColumnRenamed("_slot", "g__slot"), (F.col("_slot") == F.col("g__slot")) & (F.col("_n") % F.col("_g") == F.col("_at")))
    paired = paired.join(bad, (F.col("_slot") == F.col("b__slot")) & (F.col("_n") % F.col("_b") == F.col("b__at")))
    return paired.select(*[(F.col(n) - F.col("b_" + n)).alias(n) for n in FEATURES])


def fit(pairs: DataFrame, turns: int = 12) -> np.ndarray:
    """Weights by Newton's method on the mean logistic loss of the pairs plus a ridge penalty.

    A turn is one pass over the stored pairs; every task returns one gradient and one Hessian.
    """
    names, d = list(FEATURES), len(FEATURES)
    weights = np.zeros(d)
    for _ in range(turns):
        now = weights.copy()

        def sums(batches: Iterator[pd.DataFrame], now: np.ndarray = now) -> Iterator[pd.DataFrame]:
            total, n = np.zeros((d, d + 1)), 0
            for batch in batches:
                x = batch[names].to_numpy(dtype=np.float64)
                p = 1 / (1 + np.exp(np.clip(x @ now, -40, 40)))
                total += np.column_stack([(x * (p * (1 - p))[:, None]).T @ x, x.T @ p])
                n += len(x)
            yield pd.DataFrame({"n": [n], "sums": [total.ravel().tolist()]})

        parts = pairs.mapInPandas(sums, "n long, sums array<double>").collect()  # one small row per task
        n = sum(p["n"] for p in parts)
        if not n:
            break
        total = sum(np.array(p["sums"]).reshape(d, d + 1) for p in parts) / n
        step = np.linalg.solve(total[:, :d] + PENALTY * np.eye(d), total[:, d] - PENALTY * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def choose_cut(scores: DataFrame, grid: int = 200) -> float:
    """The score quantile that tells the labelled rows apart best: quantiles of all scores, then of the best gap.

    Of equally good cuts the middle one is taken. Two aggregates per round; nothing but counts per bin returns.
    """
    best, low, high = 0.0, -math.inf, math.inf
    for _ in range(2):
        part = scores.where((F.col("raw") >= low) & (F.col("raw") <= high))
        marks = part.agg(F.percentile_approx("raw", [k / grid for k in range(grid + 1)], 100_000)).first()[0]
        if not marks:
            return best
        cuts = sorted(set(marks))
        at = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c <= F.col("raw")))
        bins = np.zeros((len(cuts) + 1, 2))
        for row in part.groupBy(at.alias("bin"), "label").agg(F.count("*").alias("n")).collect():  # bins x 2 rows
            bins[row["bin"], row["label"]] += row["n"]
        # cut k keeps the bins above k
        right = np.cumsum(bins[:-1, 0]) + np.cumsum(bins[::-1, 1])[::-1][1:]
        top = np.flatnonzero(right == right.max())
        first, last = int(top[0]), int(top[-1])
        below = cuts[first - 1] if first else cuts[first]
        best = (below + cuts[last]) / 2 if first == last else (cuts[first] + cuts[last]) / 2
        if first == last:
            best = cuts[first]
        low, high = below, cuts[min(last + 1, len(cuts) - 1)]
    return float(best)


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` that are predicted to be good, by the rules of ``scores``.

    The texts are read once for their features and once to join the narrow scores back.
    """
    good = scores(docs, labels, id_col, text_col, label_col, accept, keyed=True).where("predicted = 1")
    good = good.select(F.col(id_col).alias("good_id"), F.col("_key").alias("good_key")).distinct()
    rows = packed(docs, id=F.col(id_col), key=_key(text_col))
    return unpacked(rows.join(good, F.col("id").eqNullSafe(F.col("good_id")) & (F.col("key") == F.col("good_key")), "left_semi"))


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", accept: float = ACCEPT, keyed: bool = False) -> DataFrame:
    """(id, held_out, score, predicted), one row per input row; ``keyed`` adds the hash of the text.

    Only labelled rows that are not held out teach; an id labelled more than once counts by its lowest label, null
    labels and ids teach nothing. A score is the logistic function of the ranking score, shifted so that ``accept``
    is the quantile of training scores that parts the labels best. Null and empty texts are scored by the feature
    that says so. Without pairs every score is ``accept``. An empty table gives an empty result; other columns are
    not read, and rows that repeat an id are scored one by one.

    The texts are read once for their features, which are written out; all else works on those narrow rows.
    """
    measured = stored(with_features(docs, id_col, text_col))
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_known"))
    known = known.agg(F.min(label_col).cast("int").alias("label"))
    train = measured.where(~held_out("_id")).join(known, F.col("_id") == F.col("_known")).drop("_known")
    moments = train.agg(*[F.avg(n).alias("m_" + n) for n in FEATURES], *[F.stddev_pop(n).alias("s_" + n) for n in FEATURES]).first()
    scale = {n: (moments["m_" + n] or 0.0, max(moments["s_" + n] or 0.0, 1e-6)) for n in FEATURES}
    train = stored(train.select("_id", "label", *_scaled(scale)))
    weights = fit(stored(preference_pairs(train)))
    raw = lambda cols: sum((c * float(w) for c, w in zip(cols, weights)), F.lit(0.0))
    cut = choose_cut(train.select("label", raw([F.col(n) for n in FEATURES]).alias("raw"))) if weights.any() else 0.0
    total = raw([(F.col(n) - m) / s for n, (m, s) in scale.items()]) - cut + math.log(accept / (1 - accept))
    score = F.lit(1.0) / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), total))))
    out = measured.select(F.col("_id").alias(id_col), *["_key"] * keyed, held_out("_id").alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= accept - 1e-12).cast("int"))
