"""How quality filters interact: one table-driven pass over the bytes of every text, then all orders of the filters."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import text_or_empty

#: Classes of bytes, and the fixed values of the symbols that one filter looks for.
OTHER, SPACE, CAPITAL, SYMBOL, INNER = range(5)
SYMBOLS = b"#$%&*|"
#: States of the transducer, and what it emits on a byte.
GAP, WORD = 0, 1
OPENS, CLOSES, CAPITALS, SYMBOLIC, POINT = 1, 2, 4, 8, 16
#: Bytes that one step of the pass takes; a longer text is taken in several steps that share one table of words.
BLOCK = 2**20
#: Multiplier of the words' polynomial hash (odd), and of the hash's last mix.
BASE, MIX = 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD
FILTERS = "ABCDE"


def _classes() -> np.ndarray:
    classes = np.full(256, OTHER, dtype=np.uint8)
    classes[[0x20, *range(0x09, 0x0E)]] = SPACE
    classes[ord("A") : ord("Z") + 1] = CAPITAL
    classes[list(SYMBOLS)] = SYMBOL
    classes[0x80:0xC0] = INNER  # inside a UTF-8 sequence
    return classes


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """(next state, emitted marks) by state and class of byte."""
    follow, emits = np.zeros((2, 5), dtype=np.uint8), np.zeros((2, 5), dtype=np.uint8)
    for state in (GAP, WORD):
        for kind in range(5):
            follow[state, kind] = GAP if kind == SPACE else WORD
            emits[state, kind] = (
                (OPENS if state == GAP and kind != SPACE else 0)
                | (CLOSES if state == WORD and kind == SPACE else 0)
                | (CAPITALS if kind == CAPITAL else 0)
                | (SYMBOLIC if kind == SYMBOL else 0)
                | (POINT if kind != INNER else 0)
            )
    return follow, emits


CLASS = _classes()
FOLLOW, EMITS = _transitions()
#: By class of the byte before and class of the byte: no class leads to different states, so the class before tells the state.
MARKS = EMITS[FOLLOW[GAP]].astype(np.uint8)


class WordTable:
    """An open-addressed table of word spans of one buffer, one entry per (text, word). Equal hashes are verified by bytes."""

    def __init__(self, data: np.ndarray, room: int = 1024):
        self.data = data
        self.start, self.size, self.text, self.hash = (np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.uint64))
        self.slots = np.full(room, -1, dtype=np.int64)

    def _same_bytes(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether spans that start at ``a`` and at ``b`` hold the same ``size`` bytes."""
        same = np.ones(len(a), dtype=bool)
        ends = np.cumsum(size)
        at = 0
        while at < len(a):  # as many pairs at a time as make a block, one at least
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK)))
            n = size[at:to]
            first = np.cumsum(n) - n
            inside = np.arange(int(n.sum())) - np.repeat(first, n)
            unlike = self.data[np.repeat(a[at:to], n) + inside] != self.data[np.repeat(b[at:to], n) + inside]
            same[at:to] = np.add.reduceat(unlike, first) == 0
            at = to
        return same

    def insert(self, start: np.ndarray, size: np.ndarray, text: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Insert spans; True for each that the table did not hold before (the first of equal ones)."""
        base = len(self.start)
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, size])
        self.text, self.hash = np.concatenate([self.text, text]), np.concatenate([self.hash, hashes])
        held = int((self.slots >= 0).sum())
        if 2 * (held + len(start)) > len(self.slots):
            old = self.slots[self.slots >= 0]
            self.slots = np.full(1 << int(2 * (held + len(start))).bit_length(), -1, dtype=np.int64)
            self._place(old, False)
        fresh = np.zeros(len(start), dtype=bool)
        fresh[self._place(np.arange(base, base + len(start)), True) - base] = True
        # spans that were held already are forgotten
        keep = np.concatenate([np.ones(base, dtype=bool), fresh])
        moved = np.cumsum(keep) - 1
        live = self.slots >= 0
        self.slots[live] = moved[self.slots[live]]
        self.start, self.size, self.text, self.hash = (x[keep] for x in (self.start, self.size, self.text, self.hash))
        return fresh

    def _place(self, entries: np.ndarray, verify: bool) -> np.ndarray:
        """Linear probing, all entries at once: every round an entry finds its like, takes a free slot or goes on by one."""
        mask = len(self.slots) - 1
        slot = (self.hash[entries] & np.uint64(mask)).astype(np.int64)
        placed = []
        while len(entries):
            free = self.slots[slot] < 0
            # of the entries that meet at a free slot the first takes it
            self.slots[slot[free][::-1]] = entries[free][::-1]
            holder = self.slots[slot]
            mine = holder == entries
            placed.append(entries[mine])
            done = mine
            if verify:
                alike = ~mine & (self.hash[holder] == self.hash[entries]) & (self.size[holder] == self.size[entries]) & (self.text[holder] == self.text[entries])
                at = np.flatnonzero(alike)
                at = at[self._same_bytes(self.start[holder[at]], self.start[entries[at]], self.size[entries[at]])]
                done = mine.copy()
                done[at] = True
            entries, slot = entries[~done], (slot[~done] + 1) & mask
        return np.concatenate(placed) if placed else np.zeros(0, dtype=np.int64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, for i up to n."""
    inverse = np.uint64(pow(BASE, -1, 2**64))
    out = []
    for base in (np.uint64(BASE), inverse):
        powers = np.full(n + 1, base, dtype=np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers, dtype=np.uint64))
    return out[0], out[1]


class Transducer:
    """One pass over the bytes of texts: words, distinct words, capitals, code points and symbols of each."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.up, self.down = _powers(block)

    def run(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """``data``: the texts' bytes; text i ends at offsets[i + 1]. Returns five counts (rows) per text (columns)."""
        counts = np.zeros((5, len(offsets) - 1), dtype=np.int64)
        at = 0
        while at < len(offsets) - 1:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + self.block, side="right")) - 1)
            table, low, end = WordTable(data), int(offsets[at]), int(offsets[to])
            while low < end:  # a single step but for a text longer than a block
                high = self._cut(data, low, end)
                self._step(data, offsets[at : to + 1], low, high, table, counts[:, at:to])
                low = high
            at = to
        return counts

    def _cut(self, data: np.ndarray, low: int, end: int) -> int:
        """The end of the step from ``low``: after white space if the text goes on; a word longer than a block stays whole."""
        if end - low <= self.block:
            return end
        spaces = np.flatnonzero(CLASS[data[low : low + self.block]] == SPACE)
        if len(spaces):
            return low + int(spaces[-1]) + 1
        high = low + self.block
        while high < end:
            spaces = np.flatnonzero(CLASS[data[high : min(high + self.block, end)]] == SPACE)
            if len(spaces):
                return high + int(spaces[0]) + 1
            high += self.block
        return end

    def _step(self, data: np.ndarray, offsets: np.ndarray, low: int, high: int, table: WordTable, counts: np.ndarray) -> None:
        piece = data[low:high]
        kind = CLASS[piece]
        before = np.empty_like(kind)
        before[1:] = kind[:-1]
        before[0] = SPACE
        first = offsets[(offsets >= low) & (offsets < high)] - low
        before[first] = SPACE  # a text starts in the gap, whatever the one before ends with
        marks = MARKS[before, kind]

        def text_of(places: np.ndarray) -> np.ndarray:
            return np.searchsorted(offsets, places + low, side="right") - 1

        texts = counts.shape[1]
        opens = np.flatnonzero(marks & OPENS)
        text = text_of(opens)
        # a word ends at white space, or where its text does
        ending = np.zeros(len(piece) + 1, dtype=bool)
        ending[:-1] = (marks & CLOSES) != 0
        ends = offsets[(offsets > low) & (offsets <= high)] - low
        ends = ends[kind[ends - 1] != SPACE]
        ending[ends] = True
        closes = np.flatnonzero(ending)
        counts[0] += np.bincount(text, minlength=texts)
        counts[2] += np.bincount(text_of(np.flatnonzero(marks & CAPITALS)), minlength=texts)
        counts[3] += np.bincount(text_of(np.flatnonzero(marks & POINT)), minlength=texts)
        counts[4] += np.bincount(text_of(np.flatnonzero(marks & SYMBOLIC)), minlength=texts)
        if len(opens):
            fresh = table.insert(opens + low, closes - opens, text, self._hashes(piece, opens, closes, text))
            counts[1] += np.bincount(text[fresh], minlength=texts)

    def _hashes(self, piece: np.ndarray, opens: np.ndarray, closes: np.ndarray, text: np.ndarray) -> np.ndarray:
        up, down = (self.up, self.down) if len(piece) <= self.block else _powers(len(piece))
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[: len(piece)], out=sums[1:])
        out = (sums[closes] - sums[opens]) * down[opens]
        out = (out ^ (text.astype(np.uint64) * np.uint64(BASE))) * np.uint64(MIX)
        return out ^ (out >> np.uint64(32))


COUNTS = ("words", "distinct", "capitals", "points", "symbols")


def text_counts(docs: DataFrame, text: Column, *keep: Column, block: int = BLOCK) -> DataFrame:
    """The columns ``keep`` and the long columns of COUNTS, by one pass over the UTF-8 bytes of every text.

    A null text counts as empty: all zero. Texts of any length are taken whole, a block at a time; what is held is one
    block's arrays and the distinct words of one text.
    """

    @F.arrow_udf(", ".join(f"{name} long" for name in COUNTS))
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = Transducer(block)
        for batch in batches:
            texts = batch.cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
            held = texts.buffers()[2]
            data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, dtype=np.uint8)
            yield pa.StructArray.from_arrays([pa.array(row) for row in machine.run(data, offsets)], list(COUNTS))

    whole = F.coalesce(text, F.lit("")).cast("binary")
    return docs.select(*keep, counted(whole).alias("c")).select("*", *[F.col("c")[name].alias(name) for name in COUNTS]).drop("c")


def failures(docs: DataFrame) -> DataFrame:
    """(part, doc_id, digest, failed): per document the filters A to D it fails, as bits of their order."""
    counted = text_counts(
        docs,
        F.col("text"),
        F.coalesce("lang", F.lit("")).alias("part"),
        F.col("doc_id"),
        F.sha2(text_or_empty("text"), 256).alias("digest"),
    )
    fails = (
        F.col("words") < 100,
        100 * F.col("distinct") < 80 * F.col("words"),
        100 * F.col("capitals") > 10 * F.col("points"),
        F.col("symbols") > 0,
    )
    failed = sum((F.when(f, 1 << bit).otherwise(0) for bit, f in enumerate(fails)), F.lit(0))
    return counted.select("part", "doc_id", F.unhex("digest").alias("digest"), failed.alias("failed"))


def profiles(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n, good, toxic): documents per part and set of failed filters, E among them.

    E fails where a smaller doc_id has the same text. Equal texts are those of equal SHA-256 digests. They are counted
    by (text, part, labels, doc_id) and then by text, always in map-side aggregates, so a text that a third of all
    documents share is never gathered. Null ids are neither smaller nor larger than others: such rows pass E.
    """
    marked = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic"),
    )
    rows = failures(docs).join(marked, "doc_id", "left").fillna(False, ["is_good", "is_toxic"])
    alike = ["digest", "part", "failed", "is_good", "is_toxic"]
    by_id = rows.groupBy(*alike, "doc_id").agg(F.count("*").alias("n"))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    kinds = by_id.groupBy(*alike).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"), first.alias("first")
    )
    least = kinds.groupBy("digest").agg(F.min("first.doc_id").alias("least"))
    passing = F.col("no_id") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    both = kinds.join(least, "digest").select(*alike[1:], F.col("n").alias("all"), passing.alias("passing"))
    late = 1 << FILTERS.index("E")
    split = F.explode(
        F.array(
            F.struct(F.col("failed").alias("failed"), F.col("passing").alias("n")),
            F.struct((F.col("failed") + late).alias("failed"), (F.col("all") - F.col("passing")).alias("n")),
        )
    )
    return (
        both.select("part", "is_good", "is_toxic", split.alias("s"))
        .groupBy("part", F.col("s.failed").alias("failed"))
        .agg(
            F.sum("s.n").alias("n"),
            F.sum(F.when(F.col("is_good"), F.col("s.n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("is_toxic"), F.col("s.n")).otherwise(0)).alias("toxic"),
        )
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (language), order of the five filters and step.

    ``docs``: doc_id, text, lang. ``labels``: doc_id, quality, toxic; of several rows of one id any 1 counts. Null texts
    are empty, null languages the part ''. Repeated rows count each; rows of one id and text don't remove each other.
    An empty table has no parts and no rows. Other columns are not read.

    A document is only the set of filters it fails, so a part is 32 numbers, and what any filter does at any step of
    any order is a sum of some of them. Of the 120 orders, those in which one of k failed filters comes first are 120 / k.
    """
    sets = 1 << len(FILTERS)
    numbers = ("n", "good", "toxic")
    per_part = profiles(docs, labels).groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("failed", F.struct(*numbers)))).alias("by_set")
    )
    filled = F.transform(F.sequence(F.lit(0), F.lit(sets - 1)), lambda s: F.try_element_at("by_set", s))
    orders = F.array(*[F.lit("".join(order)) for order in permutations(FILTERS)])
    steps = (
        per_part.select("part", filled.alias("sets"), F.explode(orders).alias("filter_order"))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
        .withColumn("bit", _bits(F.substring("filter_order", F.col("step"), F.lit(1))))
        .withColumn("before", _bits(F.substring("filter_order", F.lit(1), F.col("step") - 1)))
    )

    def total(number: str, chosen, weight=None) -> Column:
        def add(sum_: Column, s: Column) -> Column:
            held = F.coalesce(F.get("sets", s)[number], F.lit(0).cast("bigint"))
            return sum_ + F.when(chosen(s), held if weight is None else held * weight(s)).otherwise(F.lit(0).cast("bigint"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(sets - 1)), F.lit(0).cast("bigint"), add)

    bit, before = F.col("bit"), F.col("before")
    fails, gone = (lambda s: s.bitwiseAND(bit) != 0), (lambda s: s.bitwiseAND(before) != 0)
    removed = lambda s: fails(s) & ~gone(s)
    return steps.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda s: ~fails(s) & ~gone(s)).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda s: fails(s) & gone(s)).alias("redundant"),
        total("n", lambda s: s == bit).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        total("n", fails, lambda s: F.try_divide(F.lit(factorial(len(FILTERS))), F.bit_count(s)).cast("bigint")).alias("shapley"),
    )


def _bits(letters: Column) -> Column:
    return sum((F.when(letters.contains(name), 1 << n).otherwise(0) for n, name in enumerate(FILTERS)), F.lit(0))
