"""Byte-level BPE by Spark's higher-order functions: ranked merges folded over the bytes of distinct words."""

import base64
import heapq
from array import array
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm.common import most_frequent, packed, stored, unpacked

#: Bits of a token id and of a position in a folded word. In a state the rank stands above both, in the table of merges the left
#: token's id above that. NONE is the rank of what does not merge, above all others, ALONE is it in a rank's place.
ID, ROOM = 17, 12
RANK, OWNER = ID + ROOM, ID + ROOM + ID
NONE = 2**ID - 1
ALONE = NONE << RANK
#: Words kept in the word map: this many at most, of at most so many bytes each, so its size is bounded.
MAP_WORDS, MAP_WORD_BYTES = 2**18, 32
#: Longer words are merged by a heap, since a fold over arrays copies them once per merge.
FOLD_BYTES = 128


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def java_pattern(pattern: str) -> str:
    """The split pattern with Unicode white space, which ``\\s`` alone does not mean in Java."""
    return pattern.replace(r"\s", r"\p{IsWhite_Space}").replace(r"\S", r"\P{IsWhite_Space}")


# ---------------------------------------------------------------- constant maps


def _slots(keys: Iterable[bytes], bits: int) -> np.ndarray:
    """Two tables of 2**bits slots each, laid end to end: every key's index stands in one of its two slots, -1 is empty."""
    mask = (1 << bits) - 1
    hashes = array("Q", (xxhash.xxh64_intdigest(k, seed=42) for k in keys))
    table = array("i", [-1]) * (2 << bits)
    for at in range(len(hashes)):
        held, side = at, 0
        for _ in range(500):
            slot = (hashes[held] & mask) if side == 0 else (mask + 1 + (hashes[held] >> 24 & mask))
            held, table[slot] = table[slot], held
            if held < 0:
                break
            side = 1 - side if slot <= mask else 0
        else:
            raise RuntimeError("the table is too full")
    return np.frombuffer(table, dtype=np.int32)


def _constant(spark: SparkSession, values: pa.Array) -> Column:
    return F.expr(_variable(spark, values))


def _variable(spark: SparkSession, values: pa.Array) -> str:
    """A session variable that holds ``values`` as one array constant, so that no plan spells it out.

    The variable is named after its content, so a name always means the same values. A plan keeps the values it was
    built with, so the variable can be dropped then.
    """
    one = pa.table({"v": pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)})
    content = xxhash.xxh3_128()
    for part in values.buffers():
        content.update(memoryview(part) if part is not None else b"-")
    name = f"casemill_{len(values)}_{content.hexdigest()}"
    frame = spark.createDataFrame(one)
    frame.createOrReplaceTempView(name)
    spark.sql(f"DECLARE OR REPLACE VARIABLE {name} {frame.schema['v'].dataType.simpleString()}")
    spark.sql(f"SET VAR {name} = (SELECT v FROM {name})")
    spark.catalog.dropTempView(name)
    return name


def _find(key: Column, slots: Column, keys: Column, bits: int) -> tuple[Column, Column, Column, Column]:
    mask = F.lit((1 << bits) - 1).cast("bigint")
    h = F.xxhash64(key)
    a = F.get(slots, h.bitwiseAND(mask))
    b = F.get(slots, F.shiftrightunsigned(h, 24).bitwiseAND(mask) + F.lit(1 << bits))
    return F.get(keys, a) == key, a, F.get(keys, b) == key, b


def _laid(rows: dict[int, np.ndarray], width: int) -> np.ndarray:
    """Where each row of a sparse matrix starts in one array so that no two entries share a place, longest rows first.

    ``rows``: the columns, below ``width``, in order. A row that is not given starts at 0. The search goes on where the
    last one ended and starts anew for every power of two of lengths.
    """
    starts, held, at, size = np.zeros(width, np.int64), np.zeros(8 * width, bool), 0, 0
    for row in sorted(rows, key=lambda r: -len(rows[r])):
        columns = rows[row]
        step = 256 if len(columns) < 64 else 4096
        if len(columns).bit_length() != size:
            at, size = 0, len(columns).bit_length()
        while True:
            if at + step + width > len(held):
                held = np.concatenate([held, np.zeros(len(held) + step, bool)])
            taken = held[at + columns[0] : at + columns[0] + step].copy()
            for column in columns[1:12].tolist():
                taken |= held[at + column : at + column + step]
            fits = np.flatnonzero(~taken) + at
            for column in columns[12:].tolist():
                if not len(fits):
                    break
                fits = fits[~held[fits + column]]
            if len(fits):
                break
            at += step
        at = starts[row] = int(fits[0])
        held[at + columns] = True
    return starts


class RankMap:
    """The vocabulary as constants: pieces by id, ids of single bytes, and the ranked merges.

    A merge of the tokens a and b makes the piece of both, whose rank is its id. The merges are the entries of a sparse
    matrix with a row for every a, laid into one array: (a, rank) stands where the row of a starts, b places further.
    """

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int]):
        pieces = sorted(ranks, key=ranks.__getitem__)
        if [ranks[p] for p in pieces] != list(range(len(pieces))) or len(pieces) >= NONE:
            raise ValueError("ranks must be 0 .. n-1")
        merges: dict[int, dict[int, int]] = {}
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                a, b = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if a is not None and b is not None:
                    merges.setdefault(a, {})[b] = rank
        starts = _laid({a: np.array(sorted(row)) for a, row in merges.items()}, len(pieces))
        table = np.full(int(starts.max()) + len(pieces), NONE << OWNER, np.int64)
        for a, row in merges.items():
            table[starts[a] + np.array(list(row))] = a << OWNER | np.array(list(row.values()), np.int64) << RANK
        self.starts = _constant(spark, pa.array(starts.astype(np.int32)))
        self.merges = _constant(spark, pa.array(table))
        self.bytes = _constant(spark, pa.array([ranks[bytes([b])] for b in range(256)], pa.int64()))
        self.texts = _constant(spark, pa.array(pieces, pa.binary())).cast("array<string>")

    def rank(self, a: Column, b: Column) -> Column:
        """The rank of merging two tokens in its place in a state, ALONE if they don't merge or b is null.

        Without a's own number the entry is the rank; what another number leaves is above all ranks.
        """
        return F.least(F.get(self.merges, F.get(self.starts, a) + b).bitwiseXOR(F.shiftleft(a, OWNER)), _long(ALONE))


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold_word(word: Column, ranks: RankMap) -> Column:
    """Token ids of one word of up to 2**ROOM bytes: its bytes, then the lowest-ranked leftmost pair merged again and again.

    The state is the array of tokens, each one long: the rank of merging it with the next token, its position, its id.
    The least of them is the next merge. A merge makes the token whose id is that rank, takes the next token out and
    looks up only the two pairs it makes.
    """
    data = F.decode(word.cast("binary"), "ISO-8859-1")  # one character per byte
    below, at, own = _long((1 << RANK) - 1), _long(((1 << ROOM) - 1) << ID), _long(NONE)
    singles = F.transform(F.split(data, ""), lambda c: F.get(ranks.bytes, F.ascii(c)))

    def paired(token: Column, i: Column, tokens: Column) -> Column:
        return ranks.rank(token, F.get(tokens, i + 1)).bitwiseOR(F.shiftleft(i.cast("bigint"), ID)).bitwiseOR(token)

    def merged(state: Column, least: Column, i: Column) -> Column:
        """``i`` is the place before the least, -1 at the first."""
        new = F.shiftright(least, RANK)
        token = ranks.rank(new, F.get(state, i + 3).bitwiseAND(own)).bitwiseOR(least.bitwiseAND(at)).bitwiseOR(new)

        def turn(old: Column, j: Column) -> Column:
            before = ranks.rank(old.bitwiseAND(own), new).bitwiseOR(old.bitwiseAND(below))
            return F.when(j < i, old).when(j > i + 2, old).when(j == i, before).when(j == i + 1, token).otherwise(_long(-1))

        return F.filter(F.transform(state, turn), lambda old: old >= 0)

    def step(state: Column, _: Column) -> Column:
        return _let(
            F.array_min(state),
            lambda least: F.when(least < _long(ALONE), _let(F.array_position(state, least).cast("int") - 2, lambda i: merged(state, least, i))).otherwise(state),
        )

    first = _let(singles, lambda tokens: F.transform(tokens, lambda token, i: paired(token, i, tokens)))
    turns = F.sequence(F.lit(1), F.greatest(F.lit(1), F.octet_length(word) - 1))
    return F.aggregate(turns, first, step, lambda state: F.transform(state, lambda token: token.bitwiseAND(own).cast("int")))


def merge_long(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a long word: a heap of pairs over a linked list, n log n."""
    n = len(data)
    end, before, after, live = [i + 1 for i in range(n)], list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    heap = []

    def push(i: int) -> None:
        j = after[i]
        if j < n and (rank := ranks.get(data[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[i], end[j]))

    for i in range(n):
        push(i)
    while heap:
        _, i, mid, to = heapq.heappop(heap)
        j = after[i]
        if not live[i] or end[i] != mid or j >= n or end[j] != to:
            continue
        live[j], end[i], after[i] = False, to, after[j]
        if after[j] < n:
            before[after[j]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    return [ranks[data[i : end[i]]] for i in range(n) if live[i]]


# ---------------------------------------------------------------- documents


def words_of(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text", map_words: int = MAP_WORDS, fold_bytes: int = FOLD_BYTES,
    rank_map: RankMap | None = None,
) -> DataFrame:
    """``docs`` plus ``ids`` (array of int): every match of ``pattern`` in the text encoded by itself, no special tokens.

    Null and empty texts have no ids; extra columns pass through and one named ids, in any case, is replaced; repeated
    rows are encoded like any other; an empty table gives an empty result. ``rank_map`` is that of ``ranks``, for callers
    that decode with it too.

    The words of all documents are counted. The most frequent ones, a bounded number of bounded length, are folded
    once and become a constant word map; a word outside the map is folded where it stands. The map only saves work:
    ids are the same whatever it holds. Nothing but the distinct words is shuffled, never a text or a token.
    """
    spark = docs.sparkSession
    rank_map = rank_map or RankMap(spark, ranks)
    rows = packed(docs, whole=F.col(text_col))
    words = words_of(F.col("whole"), pattern)
    counts = stored(rows.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n")))
    size = F.octet_length("word")
    short = most_frequent(counts.where(size <= MAP_WORD_BYTES), map_words, 16)
    known = short.select("word", "n", fold_word(F.col("word"), rank_map).alias("ids")).toArrow()
    # a key laid later stands in its first slot: the most frequent words are found at the first look
    known = known.sort_by([("n", "ascending"), ("word", "ascending")])
    bits = (known.num_rows * 5 // 4).bit_length() if known.num_rows > 2**16 else max(8, known.num_rows.bit_length() + 1)
    keys, ids = (known[name].combine_chunks() for name in ("word", "ids"))
    table = _slots((k.as_py().encode() for k in keys), bits)
    names = [_variable(spark, values) for values in (pa.array(table, pa.int32()), keys, ids)]
    del known, keys, ids, table
    slots, map_keys, map_ids = (F.expr(name) for name in names)

    def in_place(word: Column) -> Column:
        at, a, bt, b = _find(word, slots, map_keys, bits)
        return F.when(at, F.get(map_ids, a)).when(bt, F.get(map_ids, b)).otherwise(fold_word(word, rank_map))

    def built(out: DataFrame) -> DataFrame:
        """The plan holds the word map now; without its variables the driver is free of it when the plan goes."""
        out = unpacked(out, ("ids",))
        out.schema  # analysed
        for name in names:
            spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS {name}")
        return out

    plain = lambda d: d.select("row", F.flatten(F.transform(words, in_place)).alias("ids"))
    fold_bytes = min(fold_bytes, 2**ROOM)
    if counts.where(size > fold_bytes).isEmpty():
        return built(plain(rows))

    @F.pandas_udf("array<array<int>>")
    def by_heap(batch: pd.Series) -> pd.Series:
        return batch.map(lambda long: [merge_long(w.encode(), ranks) for w in long])

    long = lambda w: F.octet_length(w) > fold_bytes
    has_long = F.exists(words, long)
    rest = rows.where(has_long).select("row", words.alias("words")).withColumn("long", F.filter("words", long))
    rest = rest.withColumn("done", by_heap("long"))
    placed = lambda w: F.when(long(w), F.get("done", F.array_position("long", w) - 1)).otherwise(in_place(w))
    rest = rest.select("row", F.flatten(F.transform("words", placed)).alias("ids"))
    return built(plain(rows.where(~has_long)).unionByName(rest))


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", rank_map: RankMap | None = None) -> DataFrame:
    """``encoded`` plus ``decoded`` (binary): the pieces of the ids, one after the other. No ids give no bytes.

    A column named decoded, in any case, is replaced.
    """
    texts = (rank_map or RankMap(encoded.sparkSession, ranks)).texts
    whole = F.array_join(F.transform(ids_col, lambda i: F.get(texts, i)), "")
    return encoded.withColumn("decoded", whole.cast("binary"))


def ids_text(ids: str = "ids") -> Column:
    return F.array_join(F.col(ids).cast("array<string>"), " ")
