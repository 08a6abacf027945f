"""Removal of long passages seen in an earlier document, by a logarithmic family of sampled suffix arrays.

Documents are dealt into batches and suffixes into shards by the hash of their first bytes. Every batch brings a
shard one sorted suffix array. The shard scans it against its levels and inserts it; two levels of equal size merge,
so a shard has about log2(batches) arrays, as a log-structured merge tree has. Two rounds keep this small:

1. Sampled suffixes. A window of ``length`` bytes is represented by the lowest hash among its grams of ANCHOR bytes,
   which depends on the window's bytes alone: equal windows have equal anchors. The family tells which anchors
   another batch, or another document of the batch, has as well.
2. Whole windows, only those whose anchor is shared. They go to the shard of their anchor as the bytes they cover,
   equal stretches once per batch; the shard sorts the windows by 128 bits of hash and tells which of them the
   smallest document having them is not the one that sent them. An anchor that more than CROWD batches have is too
   much for one shard: edges of a common passage differ with every document. Its windows are hashed in the batch,
   reduced there to the smallest document, and go to the shards of their own hashes instead.

Neither a text nor a window leaves its batch otherwise. All three passes over the texts read one shuffle of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import text_or_empty

LENGTH = 50
ANCHOR = 16
#: Bytes of text for each batch and for each shard, and how many of both there are at least.
BATCH_BYTES, SHARD_BYTES, LEAST = 6_000_000, 8_000_000, 64
#: An anchor of more batches than this has its windows dealt one by one, at 32 bytes each; what fewer send fits one task.
CROWD = 128
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASES = (0x100000001B3, 0xD6E8FEB86659FD93)


# ---------------------------------------------------------------- hashes of every position


def rolling(data: np.ndarray, length: int, base: int) -> np.ndarray:
    """A 64-bit hash of the ``length`` bytes at every position, built by doubling."""
    if len(data) < length:
        return np.zeros(0, dtype=np.uint64)
    level, span, power = data.astype(np.uint64) + np.uint64(1), 1, base
    out, done, rest = None, 0, length
    while rest:
        if rest & 1 and out is None:
            out, done = level, span
        elif rest & 1:  # the part so far, then this level's part
            n = len(level) - done
            out, done = out[:n] * np.uint64(power) + level[done : done + n], done + span
        rest >>= 1
        if rest:
            level = level[:-span] * np.uint64(power) + level[span:]
            span, power = span * 2, power * power % 2**64
    out = out[: len(data) - length + 1]
    out = (out ^ (out >> np.uint64(31))) * _ODD
    return out ^ (out >> np.uint64(29))


def _slide(values: np.ndarray, window: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of every full window, by doubling."""
    span = 1
    while span * 2 <= window:
        values, span = pick(values[:-span], values[span:]), span * 2
    more = window - span
    return pick(values[: len(values) - more], values[more:]) if more else values


def lowest(data: np.ndarray, length: int, gram: int) -> np.ndarray:
    """The anchor hash of every window of ``length`` bytes, mixed once more since minima crowd the low values."""
    if len(data) < length:
        return np.zeros(0, dtype=np.uint64)
    low = _slide(rolling(data, gram, _BASES[0]), length - gram + 1, np.minimum) * _ODD
    return low ^ (low >> np.uint64(32))


def _stretches(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, dtype=np.int64)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(40)) * np.uint64(shards) >> np.uint64(24)).astype(np.int64)


# ---------------------------------------------------------------- the family of one shard


class Family:
    """Sorted arrays of distinct keys whose sizes grow geometrically, with a mark for keys that came twice."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def insert(self, keys: np.ndarray) -> None:
        """Scan a new batch's sorted distinct keys against every level, then add them as the smallest level."""
        seen = np.zeros(len(keys), dtype=bool)
        for held, shared in self.levels:
            at, hit = _lookup(held, keys)
            shared[at[hit]] = True
            seen |= hit
        self.levels.append((keys, seen))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            both, marks = np.concatenate([a, b]), np.concatenate([x, y])
            order = np.argsort(both, kind="stable")
            both, marks = both[order], marks[order]
            first = _stretches(both)
            self.levels.append((both[first], np.logical_or.reduceat(marks, first) if len(first) else marks))

    def shared(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), dtype=bool)
        for held, marks in self.levels:
            at, hit = _lookup(held, keys)
            out[hit] |= marks[at[hit]]
        return out


def _lookup(held: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(held, keys)
    at[at == len(held)] = 0
    return at, (held[at] == keys if len(held) else np.zeros(len(keys), dtype=bool))


def _array(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(blob, dtype=kind)


def hashed_windows(blob: bytes, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, offset, one, two) of every window of the stretches laid end to end in ``blob``; one, two: its hash."""
    data = np.frombuffer(blob, dtype=np.uint8)
    windows = sizes - length + 1
    stretch = np.repeat(np.arange(len(sizes)), windows)
    offset = np.arange(len(stretch)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = np.repeat(np.cumsum(sizes) - sizes, windows) + offset
    one, two = (rolling(data, length, base)[at] for base in _BASES)
    return stretch, offset, one, two


def seen_earlier(one: np.ndarray, two: np.ndarray, who: np.ndarray) -> np.ndarray:
    """Of every hash, whether the same hash also has a smaller id."""
    order = np.argsort(one, kind="stable")
    same = one[order]
    clash = (same[1:] == same[:-1]) & (two[order][1:] != two[order][:-1])
    if clash.any():
        order = np.lexsort((two, one))
    keys, more = one[order], two[order]
    first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (more[1:] != more[:-1])]))
    who = who[order]
    least = np.repeat(np.minimum.reduceat(who, first), np.diff(np.append(first, len(order))))
    repeated = np.empty(len(order), dtype=bool)
    repeated[order] = least < who
    return repeated


def repeated_windows(blob: bytes, sizes: np.ndarray, ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, offset, repeated) of every window of the stretches laid end to end in ``blob``.

    repeated: a stretch of a smaller id holds the same window.
    """
    stretch, offset, one, two = hashed_windows(blob, sizes, length)
    return stretch, offset, seen_earlier(one, two, ids[stretch])


# ---------------------------------------------------------------- the job


def _texts(batch: pa.Table) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(ids, texts, order) of a batch: rows sorted by id, then text, so every pass numbers them alike."""
    ids = batch["_id"].to_numpy(zero_copy_only=False)
    texts = batch["_text"].to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
    return ids[order], [texts[i] for i in order], np.array(order, dtype=np.int64)


def _anchors_of(texts: list[bytes], length: int, gram: int) -> list[np.ndarray]:
    return [lowest(np.frombuffer(t, dtype=np.uint8), length, gram) for t in texts]


def asked_windows(
    ids: np.ndarray, texts: list[bytes], lows: list[np.ndarray], keys: np.ndarray, crowded: np.ndarray, shards: int, number: int, length: int
) -> list[tuple]:
    """What batch ``number`` sends to the shards: (shard, batch, blob, sizes, ranks, starts, ids).

    ``keys``: its shared anchors in order. Stretches of an anchor go to the anchor's shard, their bytes compressed in blob; windows of
    ``crowded`` anchors go one by one to the shards of their hashes, no sizes and both halves of the hashes in blob.
    What the batch settles itself has no blob.
    """
    sent: dict[int, list] = {}
    known: dict[bytes, int] = {}
    local = []
    crowd = []
    for rank, (text, low) in enumerate(zip(texts, lows)):
        starts = _stretches(low)
        if not len(starts):
            continue
        stops = np.append(starts[1:], len(low))
        at, hit = _lookup(keys, low[starts])
        own = np.flatnonzero(hit)
        for shard, many, a, b in zip(_shard(low[starts[own]], shards).tolist(), crowded[at[own]].tolist(), starts[own].tolist(), stops[own].tolist()):
            stretch = text[a : b + length - 1]
            before = known.setdefault(stretch, rank)
            if ids[before] < ids[rank]:
                local.append((rank, a, b - a))
            elif many:
                crowd.append((rank, a, stretch))
            else:
                sent.setdefault(shard, []).append((rank, a, stretch))
    out = []
    for shard, entries in sent.items():
        ranks = np.array([e[0] for e in entries], dtype=np.int32)
        out.append(
            (shard, number, pa.compress(b"".join(e[2] for e in entries), "zstd", asbytes=True), np.array([len(e[2]) for e in entries], dtype=np.int32), ranks, np.array([e[1] for e in entries], dtype=np.int32), ids[ranks])
        )
    if crowd:
        sizes = np.array([len(e[2]) for e in crowd], dtype=np.int64)
        stretch, offset, one, two = hashed_windows(b"".join(e[2] for e in crowd), sizes, length)
        ranks = np.array([e[0] for e in crowd], dtype=np.int32)[stretch]
        starts = (np.array([e[1] for e in crowd], dtype=np.int64)[stretch] + offset).astype(np.int32)
        gone = seen_earlier(one, two, ids[ranks])
        local += [(rank, start, 1) for rank, start in zip(ranks[gone].tolist(), starts[gone].tolist())]
        one, two, ranks, starts = one[~gone], two[~gone], ranks[~gone], starts[~gone]
        to = _shard(one, shards)
        order = np.argsort(to, kind="stable")
        first = _stretches(to[order])
        for part in np.split(order, first[1:]):
            out.append((int(to[part[0]]), number, one[part].tobytes() + two[part].tobytes(), b"", ranks[part], starts[part], ids[ranks[part]]))
    if local:  # settled inside the batch; it passes through a shard to reach the last pass
        ranks, starts, counts = (np.array(x, dtype=np.int32) for x in zip(*local))
        out.append((number % shards, number, None, counts, ranks, starts, np.zeros(0, dtype=np.int64)))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = ANCHOR) -> DataFrame:
    """One row per input row: id, n_bytes, spans (array of start, end in bytes) and kept (binary, the bytes left).

    A byte goes if some ``length``-byte string that covers it also starts in a document with a smaller id; strings
    are judged on the input and never cross documents. Texts are taken as UTF-8, null as empty; shorter texts lose
    nothing. Null ids come before all others. Rows that repeat an id don't remove from each other. An empty table
    gives an empty result; other columns are not read.
    """
    total = docs.agg(F.sum(F.octet_length(text_or_empty(text_col)))).first()[0] or 0
    batches, shards = max(LEAST, total // BATCH_BYTES), max(LEAST, total // SHARD_BYTES)
    null_text = F.when(F.col(id_col).isNull(), text_or_empty(text_col))  # null ids are dealt by their texts, not into one batch
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(id_col), null_text), F.lit(batches)).cast("int").alias("batch"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)).cast("long")).alias("_id"),
        F.col(id_col).isNull().alias("_null"),
        text_or_empty(text_col).cast("binary").alias("_text"),
    )

    def suffixes(key: tuple, batch: pa.Table) -> pa.Table:
        _, texts, _ = _texts(batch)
        keys, often = _distinct(_anchors_of(texts, length, gram))
        cuts = np.searchsorted(_shard(keys, shards), np.arange(shards + 1))
        out = [(s, keys[a:b].tobytes(), np.packbits(often[a:b]).tobytes()) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        return pa.table(
            {
                "shard": pa.array([x[0] for x in out], pa.int32()),
                "batch": pa.array([key[0].as_py()] * len(out), pa.int32()),
                "keys": pa.array([x[1] for x in out], pa.binary()),
                "often": pa.array([x[2] for x in out], pa.binary()),
            }
        )

    def scan(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("batch")
        arrays = [_array(k, "u8") for k in shard["keys"]]
        family = Family()
        for keys in arrays:
            family.insert(keys)
        every, times = np.unique(np.concatenate(arrays), return_counts=True)
        crowded = every[times > CROWD]
        crowds = [np.packbits(_lookup(crowded, keys)[1]).tobytes() for keys in arrays]
        flags = [
            np.packbits(family.shared(keys) | np.unpackbits(_array(often, "u1"), count=len(keys)).astype(bool)).tobytes()
            for keys, often in zip(arrays, shard["often"])
        ]
        return pd.DataFrame({"batch": shard["batch"], "shard": shard["shard"], "flags": flags, "crowds": crowds})

    def windows(batch: pa.Table, answers: pa.Table) -> pa.Table:
        if not batch.num_rows or not answers.num_rows:
            return _windows_table([])
        number = batch["batch"][0].as_py()
        ids, texts, _ = _texts(batch)
        lows = _anchors_of(texts, length, gram)
        keys, _ = _distinct(lows)
        answers = answers.sort_by("shard")
        cuts = np.searchsorted(_shard(keys, shards), np.arange(shards + 1))
        shared, crowded = (
            np.concatenate(
                [np.unpackbits(_array(f, "u1"), count=int(cuts[s + 1] - cuts[s])) for s, f in zip(answers["shard"].to_pylist(), answers[c].to_pylist())]
            ).astype(bool)
            for c in ("flags", "crowds")
        )
        keys, crowded = keys[shared], crowded[shared]
        return _windows_table(asked_windows(ids, texts, lows, keys, crowded, shards, number, length))

    def settle(shard: pd.DataFrame) -> pd.DataFrame:
        done = shard["blob"].isna()
        passed = shard[done]
        out = [pd.DataFrame({"batch": passed["batch"], "ranks": passed["ranks"], "starts": passed["starts"], "counts": passed["sizes"]})]
        single = ~done & (shard["sizes"].map(lambda x: x is not None and len(x) == 0))
        asked = shard[single]
        if len(asked):
            halves = [_array(x, "u8").reshape(2, -1) for x in asked["blob"]]
            one, two = np.concatenate(halves, axis=1)
            repeated = seen_earlier(one, two, np.concatenate([_array(x, "i8") for x in asked["ids"]]))
            ends = np.cumsum([h.shape[1] for h in halves])
            for a, b, batch, ranks, starts in zip([0, *ends], ends, asked["batch"], asked["ranks"], asked["starts"]):
                gone = repeated[a:b]
                if gone.any():
                    found = (batch, _array(ranks, "i4")[gone].tobytes(), _array(starts, "i4")[gone].tobytes(), np.ones(gone.sum(), dtype=np.int32).tobytes())
                    out.append(pd.DataFrame([found], columns=["batch", "ranks", "starts", "counts"]))
        asked = shard[~done & ~single]
        if len(asked):
            sizes = np.concatenate([_array(x, "i4") for x in asked["sizes"]]).astype(np.int64)
            ids = np.concatenate([_array(x, "i8") for x in asked["ids"]])
            ranks = np.concatenate([_array(x, "i4") for x in asked["ranks"]])
            starts = np.concatenate([_array(x, "i4") for x in asked["starts"]])
            blob = b"".join(
                pa.decompress(x, int(_array(n, "i4").sum(dtype=np.int64)), "zstd", asbytes=True) for x, n in zip(asked["blob"], asked["sizes"])
            )
            owner = np.repeat(asked["batch"].to_numpy(), [len(x) // 4 for x in asked["sizes"]])
            stretch, offset, repeated = repeated_windows(blob, sizes, ids, length)
            stretch, offset = stretch[repeated], offset[repeated]
            if len(stretch):
                first = np.flatnonzero(np.concatenate([[True], (stretch[1:] != stretch[:-1]) | (offset[1:] != offset[:-1] + 1)]))
                counts = np.diff(np.append(first, len(stretch))).astype(np.int32)
                stretch, begin = stretch[first], (starts[stretch[first]] + offset[first]).astype(np.int32)
                order = np.argsort(owner[stretch], kind="stable")
                stretch, begin, counts = stretch[order], begin[order], counts[order]
                groups = _stretches(owner[stretch])
                for a, b in zip(groups, np.append(groups[1:], len(stretch))):
                    part = stretch[a:b]
                    out.append(pd.DataFrame([(owner[part[0]], ranks[part].tobytes(), begin[a:b].tobytes(), counts[a:b].tobytes())], columns=["batch", "ranks", "starts", "counts"]))
        return pd.concat(out)

    def cut(batch: pa.Table, removed: pa.Table) -> pa.Table:
        ids, texts, order = _texts(batch)
        ranks, starts, counts = (
            np.concatenate([np.zeros(0, dtype=np.int32), *(_array(x, "i4") for x in removed[c].to_pylist())]) for c in ("ranks", "starts", "counts")
        )
        by = np.argsort(ranks, kind="stable")
        ranks, starts, counts = ranks[by], starts[by].astype(np.int64), counts[by].astype(np.int64)
        edges = np.searchsorted(ranks, np.arange(len(texts) + 1))
        spans, kept = [], []
        for rank, text in enumerate(texts):
            a, b = edges[rank], edges[rank + 1]
            if a == b:
                spans.append([])
                kept.append(text)
                continue
            depth = np.zeros(len(text) + 1, dtype=np.int32)
            np.add.at(depth, starts[a:b], 1)
            np.add.at(depth, starts[a:b] + counts[a:b] + length - 1, -1)
            gone = np.cumsum(depth)[:-1] > 0
            turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            spans.append([{"start": x, "end": y} for x, y in turn.reshape(-1, 2).tolist()])
            kept.append(np.frombuffer(text, dtype=np.uint8)[~gone].tobytes())
        nulls = batch["_null"].to_numpy(zero_copy_only=False)[order] if len(texts) else np.zeros(0, dtype=bool)
        return pa.table(
            {
                "id": pa.array(ids, pa.int64(), mask=nulls),
                "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    grouped = rows.groupBy("batch")
    arrays = grouped.applyInArrow(suffixes, "shard int, batch int, keys binary, often binary")
    flags = arrays.groupBy("shard").applyInPandas(scan, "batch int, shard int, flags binary, crowds binary")
    sent = grouped.cogroup(flags.groupBy("batch")).applyInArrow(
        windows, "shard int, batch int, blob binary, sizes binary, ranks binary, starts binary, ids binary"
    )
    removed = sent.groupBy("shard").applyInPandas(settle, "batch int, ranks binary, starts binary, counts binary")
    out = grouped.cogroup(removed.groupBy("batch")).applyInArrow(
        cut, "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    )
    return out.withColumnRenamed("id", id_col)


def _distinct(lows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct anchors of a batch in order, and whether two of its documents have them."""
    own = [np.unique(low[_stretches(low)]) for low in lows if len(low)]
    if not own:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
    every = np.sort(np.concatenate(own))
    first = _stretches(every)
    return every[first], np.diff(np.append(first, len(every))) > 1


def _windows_table(out: list[tuple]) -> pa.Table:
    columns = list(zip(*out)) if out else [()] * 7
    blobs = [pa.array([x if x is None or isinstance(x, bytes) else x.tobytes() for x in c], pa.binary()) for c in columns[2:]]
    return pa.Table.from_arrays(
        [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), *blobs], names=["shard", "batch", "blob", "sizes", "ranks", "starts", "ids"]
    )
