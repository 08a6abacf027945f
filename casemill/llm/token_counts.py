"""Token counts of a byte-level BPE vocabulary: adjacent pairs popped from a heap over a linked list, and only counted."""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casemill.llm.common import packed, text_or_empty, unpacked

#: The splitter of byte-level vocabularies, also with its classes of letters, numbers and white space left open.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OPEN_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
#: Bytes that stand for themselves in a byte-level vocabulary; the others, in order, are 256 and up.
PLAIN = (range(0x21, 0x7F), range(0xA1, 0xAD), range(0xAE, 0x100))
#: Words a task remembers, and the longest one it remembers, so that its memory is bounded.
KEPT_WORDS, KEPT_CHARS = 2**18, 64
#: Bits of a symbol in a pair and of a position in a heap entry.
SYMBOL, PLACE = 24, 40


@dataclass(frozen=True)
class Merges:
    """A vocabulary reduced to what counting needs. Its size is that of the vocabulary, whatever the corpus."""

    pattern: str
    odd: str
    first_odd: int
    special: tuple[str, ...]
    bytes: tuple[int, ...]
    pairs: array  # left symbol << SYMBOL | right symbol, in rank order
    made: array  # the symbol each merge makes


def _ranges(points: list[int]) -> str:
    """A character class of sorted code points."""
    spans: list[list[int]] = []
    for p in points:
        if spans and p == spans[-1][1] + 1:
            spans[-1][1] = p
        else:
            spans.append([p, p])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)


def split_patterns(tokenizer: Tokenizer, block: int = 2**14) -> tuple[str, str, int]:
    """OPEN_SPLIT with the classes that the library itself splits by, and the points that SPLIT has in other classes.

    Unicode tables differ between libraries and versions. So the library splits all code points in order: a piece is a
    run of one class, and the class is that of the letter, number or symbol its first point stays together with.
    """
    pieces = tokenizer.pre_tokenizer.pre_tokenize_str
    points: dict[str, list[int]] = {"a": [], "1": [], "!": [], " ": [0x20]}
    for low in range(0, 0x110000, block):
        shown = "".join(chr(p) for p in range(low, low + block) if p != 0x20 and not 0xD800 <= p < 0xE000)
        for _, (start, end) in pieces(shown) if shown else ():
            kin = next((c for c in "a1!" if len(pieces(c + shown[start])) == 1), " ")
            points[kin] += map(ord, shown[start:end])
    odd = set()
    for kin, own in (("a", r"\p{L}"), ("1", r"\p{N}"), ("!", r"[^\s\p{L}\p{N}]"), (" ", r"\s")):
        alike = regex.compile(own).fullmatch
        odd.update(p for p in points[kin] if not alike(chr(p)))
    pattern = OPEN_SPLIT.format(letters=_ranges(points["a"]), numbers=_ranges(points["1"]), spaces=_ranges(sorted(points[" "])))
    return pattern, f"[{_ranges(sorted(odd))}]" if odd else "", min(odd, default=0x110000)


def read_merges(path: str) -> Merges:
    """The merges of a tokenizers file of the byte-level BPE kind. Options that would change counts are refused."""
    with open(path, encoding="utf-8") as lines:
        spec = json.load(lines)
    model, before = spec["model"], spec["pre_tokenizer"]
    kind = (model["type"], before["type"], before.get("add_prefix_space"), before.get("use_regex"))
    if kind != ("BPE", "ByteLevel", False, True) or spec["normalizer"] or any(
        model.get(name) for name in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    ):
        raise ValueError("only plain byte-level BPE is counted here")
    added = spec["added_tokens"]
    if any(token[name] for token in added for name in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens must match as they stand")
    plain = [b for part in PLAIN for b in part]
    names = {b: chr(b) for b in plain}
    names |= {b: chr(256 + n) for n, b in enumerate(sorted(set(range(256)) - set(plain)))}
    vocabulary, pairs, made = model["vocab"], array("q"), array("q")
    for merge in model["merges"]:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        pairs.append(vocabulary[left] << SYMBOL | vocabulary[right])
        made.append(vocabulary[left + right])
    longest_first = tuple(sorted((token["content"] for token in added), key=len, reverse=True))
    return Merges(*split_patterns(Tokenizer.from_file(path)), longest_first, tuple(vocabulary[names[b]] for b in range(256)), pairs, made)


class Counter:
    """Counts tokens of texts. One per task; remembers the counts of a bounded number of words."""

    def __init__(self, merges: Merges, kept_words: int = KEPT_WORDS):
        self.plain_words, self.all_words = regex.compile(SPLIT).findall, re.compile(merges.pattern).findall
        self.odd = re.compile(merges.odd).search if merges.odd else None
        self.high = re.compile(f"[\\U{min(merges.first_odd, 0x10FFFF):08x}-\\U0010ffff]").search
        self.special = re.compile("|".join(map(re.escape, merges.special))) if merges.special else None
        self.bytes, self.made = merges.bytes, merges.made
        self.rank = {pair: rank for rank, pair in reversed(list(enumerate(merges.pairs)))}
        self.kept: dict[str, int] = {}
        self.kept_words = kept_words

    def merged(self, word: bytes) -> int:
        """Tokens of one word: its bytes less the merges made.

        Symbols stand in a linked list. The heap holds (rank, place) of adjacent pairs; the lowest rank, leftmost first,
        is popped and merged, and the two pairs this makes are pushed. ``due`` holds the rank of the pair that starts
        at each place now, so an entry of the heap that has been overtaken is known by its rank.
        """
        symbols = [self.bytes[b] for b in word]
        n = len(symbols)
        rank, made = self.rank.get, self.made
        due = [rank(a << SYMBOL | b, -1) for a, b in zip(symbols, symbols[1:])]
        due.append(-1)
        heap = [r << PLACE | i for i, r in enumerate(due) if r >= 0]
        if not heap:
            return n
        heapq.heapify(heap)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        here, left = (1 << PLACE) - 1, n
        while heap:
            entry = heapq.heappop(heap)
            i, r = entry & here, entry >> PLACE
            if due[i] != r:
                continue
            gone = after[i]
            symbols[i], due[gone], left = made[r], -1, left - 1
            after[i] = right = after[gone]
            if right < n:
                before[right] = i
                due[i] = new = rank(symbols[i] << SYMBOL | symbols[right], -1)
                if new >= 0:
                    heapq.heappush(heap, new << PLACE | i)
            else:
                due[i] = -1
            prior = before[i]
            if prior >= 0:
                due[prior] = new = rank(symbols[prior] << SYMBOL | symbols[i], -1)
                if new >= 0:
                    heapq.heappush(heap, new << PLACE | prior)
        return left

    def word(self, word: str) -> int:
        n = self.merged(word.encode("utf-8", "surrogatepass"))
        if len(word) <= KEPT_CHARS:
            if len(self.kept) >= self.kept_words:
                self.kept.clear()
            self.kept[word] = n
        return n

    def text(self, text: str) -> int:
        kept, total = self.kept.get, 0
        high = self.odd and self.high(text)
        words = self.all_words if high and self.odd(text, high.start()) else self.plain_words
        if self.special is None or not self.special.search(text):
            parts = (text,)
        else:
            parts = self.special.split(text)
            total = len(parts) - 1
        for part in parts:
            for word in words(part):
                total += kept(word) or self.word(word)
        return total


def count_tokens(docs: DataFrame, merges: Merges, limit: int = 1024, text_col: str = "text", kept_words: int = KEPT_WORDS) -> DataFrame:
    """``docs`` plus ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Special strings inside a text are one token each, as the library has them by default; nothing is added or cut.
    Null and empty texts count 0 bytes and 0 tokens; texts of any length are counted whole, one long word in n log n;
    repeated rows count alike; an empty table gives an empty result; extra columns pass through, and columns named
    like the new ones, in any case, are replaced. Only the texts go to Python and only counts come back: no shuffle.
    """

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(merges, kept_words)
        for batch in batches:
            yield pd.Series([counter.text(text) for text in batch], dtype="int64")

    rows = packed(docs, _t=text_or_empty(text_col))
    rows = rows.select("row", F.octet_length("_t").cast("bigint").alias("n_bytes"), counted("_t").alias("n_tokens"))
    return unpacked(rows.withColumn("over_limit", F.col("n_tokens") > limit), ("n_bytes", "n_tokens", "over_limit"))
