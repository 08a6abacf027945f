"""How far the sources of a language differ in their terms: counts by length-bucketed packing, exact integer divergences."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from casemill.llm.common import stored, text_or_empty

#: Bytes of text and texts that one block packs and sorts at once; a longer text is packed in pieces that are merged.
BLOCK, TEXTS = 2**22, 2**16
#: A term of up to WORD bytes is one word of 64 bits, one of up to twice that is two, a longer one is sorted as bytes.
WORD = 8
#: Cells of the matrix (sources, terms) that one task compares at a time, and sources it takes as rows.
CELLS, ROWS = 2**16, 256
#: Fixed values of the contract: the scale of a probability, the count added to each, documents a kept term is in, ranks reported.
SCALE, PRIOR, LEAST_DOCS, TOP = 10**9, 5, 30, 50


def _fold() -> np.ndarray:
    """Byte to byte: letters and bytes of non-ASCII characters stay, A-Z in lower case; any other byte is 0, a gap."""
    fold = np.zeros(256, dtype=np.uint8)
    small = np.arange(ord("a"), ord("z") + 1)
    fold[small] = fold[small - 32] = small
    fold[0x80:] = np.arange(0x80, 0x100)
    return fold


FOLD = _fold()


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """The order that sorts by ``keys``, the last one first in rank: a stable counting sort per 16-bit digit, lowest first.

    Digits that are the same everywhere, as the unused bytes of short terms are, are skipped.
    """
    order = np.arange(len(keys[0]))
    for key in keys:
        for shift in range(0, 8 * key.itemsize, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


class Runs:
    """Distinct (term, text) of a block with the number of occurrences: packed words of the term, or its bytes."""

    def __init__(self) -> None:
        self.words: dict[int, list[tuple[np.ndarray, ...]]] = {1: [], 2: []}
        self.long: list[tuple[bytes, int, int]] = []

    def add(self, data: np.ndarray, offsets: np.ndarray, first: int = 0) -> None:
        """Count the terms of texts, numbered from ``first``, whose bytes end at offsets[1:]. Terms never cross texts."""
        low, high = int(offsets[0]), int(offsets[-1])
        folded = np.zeros(high - low + WORD * 2, dtype=np.uint8)
        folded[: high - low] = FOLD[data[low:high]]
        live = folded != 0
        edge = np.zeros(len(folded), dtype=bool)
        edge[offsets[(offsets > low) & (offsets < high)] - low] = True
        opens = np.flatnonzero(live & (edge | ~np.concatenate([[False], live[:-1]])))
        after = np.concatenate([live[1:], [False]])
        closes = np.flatnonzero(live & (np.concatenate([edge[1:], [False]]) | ~after)) + 1
        size = closes - opens
        text = (np.searchsorted(offsets, opens + low, side="right") - 1 + first).astype(np.int64)
        for words in (1, 2):
            for half in range((words - 1) * 4, words * 4):  # one bucket per number of digits
                chosen = np.flatnonzero((size + 1) // 2 == half + 1)
                if len(chosen):
                    self.words[words].append(self._counted(*self._packed(folded, opens[chosen], size[chosen], words), text[chosen], None))
        for at in np.flatnonzero(size > 2 * WORD):
            self.long.append((folded[opens[at] : closes[at]].tobytes(), int(text[at]), 1))

    @staticmethod
    def _packed(folded: np.ndarray, opens: np.ndarray, size: np.ndarray, words: int) -> list[np.ndarray]:
        """The terms' bytes as big-endian words, zeros behind. No term holds a zero byte, so equal words are equal terms."""
        packed = []
        for word in range(words):
            value = np.zeros(len(opens), dtype=np.uint64)
            for i in range(word * WORD, (word + 1) * WORD):
                byte = np.where(size > i, folded[opens + i], 0).astype(np.uint64)
                value |= byte << np.uint64(8 * (WORD - 1 - i % WORD))
            packed.append(value)
        return packed

    @staticmethod
    def _counted(*columns: np.ndarray | None) -> tuple[np.ndarray, ...]:
        """Sorted and run-counted: (words ..., text, occurrences), one row per (term, text)."""
        *words, text, times = columns
        order = radix_order([text, *reversed(words)])
        words, text = [w[order] for w in words], text[order]
        fresh = np.concatenate([[True], np.logical_or.reduce([text[1:] != text[:-1], *[w[1:] != w[:-1] for w in words]])])
        starts = np.flatnonzero(fresh)
        ends = np.append(starts[1:], len(text))
        counts = ends - starts if times is None else np.add.reduceat(times[order], starts)
        return *[w[starts] for w in words], text[starts], counts.astype(np.int64)

    def rows(self, group: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
        """(terms, groups, occurrences, texts) per bucket, one row per (term, group); ``group`` has the group of every text."""
        for words, parts in self.words.items():
            if not parts:
                continue
            merged = self._counted(*[np.concatenate(column) for column in zip(*parts)])  # pieces of a text meet here
            *packed, text, times = merged
            found = group[text]
            order = radix_order([found.astype(np.int64), *reversed(packed)])
            packed, found, times = [w[order] for w in packed], found[order], times[order]
            fresh = np.concatenate([[True], np.logical_or.reduce([found[1:] != found[:-1], *[w[1:] != w[:-1] for w in packed]])])
            starts = np.flatnonzero(fresh)
            spelled = np.empty((len(starts), words), dtype=">u8")
            for word, value in enumerate(packed):
                spelled[:, word] = value[starts]
            terms = spelled.view(f"S{WORD * words}")[:, 0].tolist()
            yield terms, found[starts], np.add.reduceat(times, starts), np.diff(np.append(starts, len(found)))
        if self.long:
            self.long.sort()
            per_text = [(term, group[text], sum(n for *_, n in same)) for (term, text), same in groupby(self.long, lambda t: t[:2])]
            per_text.sort()
            terms, found, times, texts = [], [], [], []
            for (term, where), same in groupby(per_text, lambda t: t[:2]):
                counts = [n for *_, n in same]
                terms.append(term)
                found.append(where)
                times.append(sum(counts))
                texts.append(len(counts))
            yield terms, np.array(found), np.array(times, dtype=np.int64), np.array(texts, dtype=np.int64)


def _pieces(data: np.ndarray, low: int, high: int, block: int) -> Iterator[tuple[int, int]]:
    """Parts of one text of about ``block`` bytes that cut no term; a term longer than a block stays whole."""
    while high - low > block:
        at = low + block
        while at < high and FOLD[data[at - 1]]:
            at += 1
        yield low, at
        low = at
    if low < high:
        yield low, high


def block_counts(data: np.ndarray, offsets: np.ndarray, group: np.ndarray, block: int = BLOCK) -> Iterator[tuple]:
    """Rows of ``Runs.rows`` for all texts, block by block; every text is in one block."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = min(at + TEXTS, n, max(at + 1, int(np.searchsorted(offsets, offsets[at] + block, side="right")) - 1))
        runs = Runs()
        if to == at + 1:
            for low, high in _pieces(data, int(offsets[at]), int(offsets[to]), block):
                runs.add(data, np.array([low, high]))
        elif offsets[to] > offsets[at]:
            runs.add(data, offsets[at : to + 1])
        yield from runs.rows(group[at:to])
        at = to


def term_counts(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of every term and the documents that have it, per language and source.

    Null languages, sources and texts are empty strings. Texts of any length are taken whole; a task holds one block.
    Rows are one per (term, group) and block, added up map-side before they are shuffled.
    """
    schema = "lang string, source string, term binary, n long, docs long"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
            held = texts.buffers()[2]
            data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, dtype=np.uint8)
            keys = pd.MultiIndex.from_arrays([batch.column("lang").to_pandas(), batch.column("source").to_pandas()])
            group, names = keys.factorize()
            langs, sources = (pa.array(names.get_level_values(level), pa.string()) for level in (0, 1))
            for terms, found, n, texts_with in block_counts(data, offsets, group, block):
                where = pa.array(found)
                yield pa.RecordBatch.from_arrays(
                    [langs.take(where), sources.take(where), pa.array(terms, pa.binary()), pa.array(n), pa.array(texts_with)],
                    schema=types,
                )

    read = docs.select(*[text_or_empty(name).alias(name) for name in ("lang", "source")], text_or_empty("text").cast("binary").alias("text"))
    found = read.mapInArrow(counted, schema).withColumn("term", F.col("term").cast("string"))
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), exact for any counts."""
    wide = "decimal(38,0)"
    return F.call_function(
        "div", F.lit(SCALE).cast("decimal(10,0)") * (count + PRIOR).cast("decimal(20,0)"), (total + PRIOR * terms).cast(wide)
    ).cast("bigint") + F.lit(1).cast("bigint")


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, block: int = BLOCK, cells: int = CELLS, rows: int = ROWS) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) that occurs in ``docs``, whose other columns are not read.

    A language keeps the terms that at least ``least_docs`` of its documents have. Part ``pair``: for every other
    source of the language, the sum over the kept terms of the absolute difference of both sources' probabilities.
    Part ``term``: the ``top`` kept terms that the source has and has more often than its language, with the excess.
    Ranks go by value, then item. Null languages and sources are empty strings and null texts empty; a source without
    terms, or of a language without kept terms, has its pairs (value 0 in the latter case) and no terms; repeated rows
    count each; an empty table gives an empty result.

    A term that a source lacks has the same probability for all such terms, so only what occurs is stored. The pairs
    are compared in matrices of at most ``cells`` cells: the terms of a language are dealt into chunks by hash, and
    beyond ``rows`` sources the sources into blocks; a chunk returns one partial sum per pair.
    """
    counts = stored(term_counts(docs, block))
    per_term = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = stored(per_term.where(F.col("docs") >= least_docs).select("lang", "term", "lang_n"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    found = stored(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"))
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(*[text_or_empty(name).alias(name) for name in ("lang", "source")]).distinct()
    zero = F.lit(0).cast("bigint")
    sources = (
        groups.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(F.col(c), zero).alias(c) for c in ("total", "terms", "lang_total")])
    )
    base = F.when(F.col("terms") > 0, probability(zero, F.col("total"), F.col("terms"))).otherwise(zero)
    sources = stored(sources.withColumn("base", base))
    valued = found.join(sources, ["lang", "source"]).withColumn("p", probability(F.col("n"), F.col("total"), F.col("terms")))
    excess = F.col("p") - probability(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    ranking = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    terms = valued.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), excess.alias("value"))
    terms = terms.where(F.col("value") > 0).withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= top)
    pairs = pair_sums(valued, sources, cells, rows).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    return pairs.withColumn("rank", F.row_number().over(ranking)).unionByName(terms)


def pair_sums(valued: DataFrame, sources: DataFrame, cells: int = CELLS, rows: int = ROWS) -> DataFrame:
    """(lang, source, other, value): the sum of absolute differences of p over all kept terms, for all pairs of sources.

    ``valued``: (lang, source, term, p) where a term occurs; ``sources``: (lang, source, base, terms), base for where it
    doesn't. Both sources of a pair lack a term: its difference is that of their bases. So a pair's sum is ``terms`` times
    that, plus what each term differs from it that any source of the language has.
    """
    order = Window.partitionBy("lang").orderBy("source")
    numbered = sources.select("lang", "source", "base", "terms", (F.row_number().over(order) - 1).alias("at"))
    numbered = stored(numbered.withColumn("of", F.count("*").over(Window.partitionBy("lang"))))
    chunks = F.greatest(F.lit(1), F.ceil(F.col("terms") * F.col("of") / cells)).cast("int")
    blocks = F.ceil(F.col("of") / rows).cast("int")
    dealt = valued.select("lang", "source", "term", "p").join(numbered, ["lang", "source"])
    dealt = dealt.select(
        "lang",
        F.pmod(F.xxhash64("term"), chunks).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
        "term",
        "at",
        "p",
    )
    bases = numbered.select("lang", "at", "base", chunks.alias("chunks"), blocks.alias("blocks"))
    bases = bases.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    bases = bases.select("lang", "chunk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("string").alias("term"), "at", F.col("base").alias("p"))

    def compared(key: tuple, chunk: pd.DataFrame) -> pd.DataFrame:
        lang, _, block = key
        is_base = chunk["term"].isna().to_numpy()
        base = np.zeros(int(is_base.sum()), dtype=np.int64)
        base[chunk["at"].to_numpy()[is_base]] = chunk["p"].to_numpy()[is_base]
        some = chunk[~is_base]
        column, names = pd.factorize(some["term"])
        matrix = np.repeat(base[:, None], len(names), axis=1)
        matrix[some["at"].to_numpy(), column] = some["p"].to_numpy()
        low, high = block * rows, min(len(base), (block + 1) * rows)
        sums = np.stack([np.abs(matrix - matrix[at]).sum(axis=1) - len(names) * np.abs(base - base[at]) for at in range(low, high)])
        at, other = np.divmod(np.arange(sums.size), len(base))
        return pd.DataFrame({"lang": lang, "at": (at + low).astype("int32"), "other_at": other.astype("int32"), "part": sums.ravel()})

    grouped = dealt.unionByName(bases).groupBy("lang", "chunk", "block")
    parts = grouped.applyInPandas(compared, "lang string, at int, other_at int, part long").where(F.col("at") != F.col("other_at"))
    sums = parts.groupBy("lang", "at", "other_at").agg(F.sum("part").alias("more"))
    one = numbered.select("lang", "at", "source", "base", "terms")
    two = numbered.select("lang", F.col("at").alias("other_at"), F.col("source").alias("other"), F.col("base").alias("other_base"))
    value = F.col("terms") * F.abs(F.col("base") - F.col("other_base")) + F.col("more")
    return sums.join(one, ["lang", "at"]).join(two, ["lang", "other_at"]).select("lang", "source", "other", value.alias("value"))
