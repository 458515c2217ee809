"""Lines that many documents share, found through sharded minimal perfect hashes."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelabel.llm.common import python_columns, releasing, stored

#: Line hashes in one shard of the index, about; a shard is built in one task.
SHARD_KEYS = 200_000
#: Bytes of the index that are broadcast at a time. A larger index is probed in several rounds.
ROUND_BYTES = 64 << 20
GAMMA = 2.0
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """A new hash of 64-bit hashes for each level."""
    x = (keys ^ np.uint64((level * 0xD6E8FEB86659FD93 + 1) & (2**64 - 1))) * _ODD
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bit sets.

    A key sits at the first level where no other remaining key has its bit; its number is the
    count of bits before it. What is left after the last level is kept sorted.
    """

    LEVELS = 24

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        base = 0
        for level in range(self.LEVELS):
            if not len(keys):
                break
            size = -(-int(len(keys) * GAMMA + 64) // 64) * 64
            at = _mixed(keys, level) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            words = np.packbits(alone, bitorder="little").view(np.uint64)
            ranks = np.cumsum(alone.reshape(-1, 64).sum(1), dtype=np.uint32)
            ranks = np.concatenate([[0], ranks[:-1]]).astype(np.uint32) + np.uint32(base)
            self.levels.append((size, words, ranks))
            base += int(alone.sum())
            keys = keys[~alone[at.astype(np.int64)]]
        self.rest, self.base = np.sort(keys), base
        self.size = base + len(keys)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers; any number or -1 for keys that were not given."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (size, words, ranks) in enumerate(self.levels):
            if not len(open_):
                return out
            at = _mixed(keys[open_], level) % np.uint64(size)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[open_[hit]] = ranks[word[hit]].astype(np.int64) + np.bitwise_count(below)
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            out[open_] = np.where(self.rest[at] == keys[open_], self.base + at, -1)
        return out


class Shard:
    """Counts of lines by their 128-bit hash: half of it finds the slot, half is the fingerprint."""

    def __init__(self, low: np.ndarray, high: np.ndarray, counts: np.ndarray):
        self.hash = PerfectHash(low)
        at = self.hash.numbers(low)
        self.prints, self.counts = np.zeros(len(low), np.uint64), np.zeros(len(low), np.uint32)
        self.prints[at], self.counts[at] = high, np.minimum(counts, 2**32 - 1)

    def count(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if not self.hash.size:
            return np.zeros(len(low), np.uint32)
        at = self.hash.numbers(low)
        return np.where((at >= 0) & (self.prints[at] == high), self.counts[at], np.uint32(0))


def _hashes(keys: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def line_counts(docs: DataFrame, text_col: str, min_chars: int) -> DataFrame:
    """(low, high, n): the number of documents that have a line, by its key's hash.

    Each task sends a line once, with its count so far.
    """
    def count(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for part in parts:
            for text in part.column(0).to_pylist():
                for key in {line.strip().lower() for line in (text or b"").split(b"\n")}:
                    if len(key) >= min_chars and (min_chars < 2 or len(key.decode("utf-8", "replace")) >= min_chars):
                        digest = xxhash.xxh3_128_digest(key)
                        seen[digest] = seen.get(digest, 0) + 1
            if len(seen) > 500_000:
                yield packed(seen)
                seen = {}
        if seen:
            yield packed(seen)

    def packed(seen: dict[bytes, int]) -> pa.RecordBatch:
        both = np.frombuffer(b"".join(seen), "<i8").reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(list(seen.values()), pa.int64())],
            names=["low", "high", "n"])

    counted = docs.select(F.col(text_col).cast("binary")).mapInArrow(releasing(count), "low long, high long, n long")
    return counted.groupBy("low", "high").agg(F.sum("n").alias("n"))


def build_index(counts: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """(shard, size, body) from stored (low, high, n): one row per shard of the index."""
    shards = max(1, -(-counts.count() // shard_keys))

    def build(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(parts)
        if not rows:
            return
        table = pa.Table.from_batches(rows)
        shard, low, high, n = (table.column(i).to_numpy() for i in range(4))
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order])) + 1
        for at in np.split(order, cuts):
            keys = low[at].view(np.uint64)
            # Two lines may agree in one half of the hash; the second goes to a list of its own.
            _, first = np.unique(keys, return_index=True)
            twice = np.setdiff1d(np.arange(len(at)), first)
            body = pickle.dumps((
                Shard(keys[first], high[at][first].view(np.uint64), n[at][first]),
                {(int(keys[i]), int(high[at][i].view(np.uint64))): int(n[at][i]) for i in twice}))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(shard[at[0]])], pa.int64()), pa.array([len(body)], pa.int64()), pa.array([body])],
                names=["shard", "size", "body"])

    dealt = counts.select(F.pmod("high", F.lit(shards)).alias("shard"), "low", "high", "n") \
        .repartition(shards, "shard")
    return dealt.mapInArrow(releasing(build), "shard long, size long, body binary")


def _rounds(index: DataFrame, most: int) -> list[list[int]]:
    """Shard numbers, packed into rounds of bounded size: one short row per shard."""
    rounds, room = [], 0
    for row in index.select("shard", "size").orderBy("shard").toLocalIterator():
        if row["size"] > room:
            rounds.append([])
            room = most
        rounds[-1].append(row["shard"])
        room -= row["size"]
    return rounds


def line_dedup(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text",
    extra: tuple[str, ...] = (), shard_keys: int = SHARD_KEYS, round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """One row per row of `docs`: the id and `extra` columns, text (what stays), n_lines, n_dropped.

    A line's key is the line without white space at its ends and with A-Z lower-cased; keys of at
    least `min_chars` code points that at least `min_docs` documents have lose all their lines.
    Null and empty texts are one empty line, which stays. Rows that repeat an id count as documents
    of their own. Other lines stay as they are, in order. An empty table gives no rows.

    Counts cover every line. Lines below `min_docs` never lose a line and need no slot, so the index
    holds the distinct hashes at or above it. Documents probe it in memory: no line is shuffled but
    once per task to be counted. Hashes have 128 bits, so a wrong match is not to be expected.
    The index is broadcast in rounds of at most `round_bytes`; between rounds the rows are stored.
    """
    spark = docs.sparkSession
    shared = stored(line_counts(docs, text_col, min_chars).where(F.col("n") >= min_docs))
    index = stored(build_index(shared, shard_keys))
    shards = max(1, -(-shared.count() // shard_keys))
    keep = [id_col, *extra]
    rows = docs.select(*keep, F.col(text_col).cast("binary").alias("_text"), F.lit(b"").alias("_gone"))
    rounds = _rounds(index, round_bytes) or [[]]
    for i, wanted in enumerate(rounds):
        bodies = {r["shard"]: bytes(r["body"]) for r in index.where(F.col("shard").isin(wanted)).collect()} if wanted else {}
        held = spark.sparkContext.broadcast(bodies)
        final = i == len(rounds) - 1
        rows = python_columns(
            rows, _prober(held, shards, min_docs, final),
            "text string, n_lines long, n_dropped long" if final else "_text binary, _gone binary",
            {"text": F.col("_text"), "gone": F.col("_gone")}, keep)
        if not final:
            rows = stored(rows)
    return rows


def _prober(held, shards: int, min_docs: int, final: bool) -> Callable:
    """Marks the lines that the round's shards know as shared (bits in `gone`); the last one drops them."""
    def make():
        loaded = {shard: pickle.loads(body) for shard, body in held.value.items()}

        def found(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            shard = np.mod(high.view(np.int64), shards)
            hit = np.zeros(len(low), bool)
            for number, (index, more) in loaded.items():
                at = np.flatnonzero(shard == number)
                hit[at] = index.count(low[at], high[at]) >= min_docs
                for j in at if more else ():
                    hit[j] |= more.get((int(low[j]), int(high[j])), 0) >= min_docs
            return hit

        def probe(batch: dict[str, pa.Array]) -> dict[str, pa.Array]:
            texts = [t or b"" for t in batch["text"].to_pylist()]
            lines = [t.split(b"\n") for t in texts]
            hit = found(*_hashes(line.strip().lower() for own in lines for line in own))
            ends = np.cumsum([len(own) for own in lines])
            gone = []
            for flags, before in zip(np.split(hit, ends[:-1]), batch["gone"].to_pylist()):
                old = np.unpackbits(np.frombuffer(before, np.uint8), count=len(flags)).astype(bool) if before else False
                gone.append(flags | old)
            if not final:
                return {"_text": pa.array(texts, pa.binary()), "_gone": pa.array([np.packbits(g).tobytes() for g in gone], pa.binary())}
            left = [t if not g.any() else b"\n".join(x for x, off in zip(own, g) if not off) for t, own, g in zip(texts, lines, gone)]
            return {
                "text": pa.array(left, pa.binary()).cast(pa.string()),
                "n_lines": pa.array([len(own) for own in lines], pa.int64()),
                "n_dropped": pa.array([int(g.sum()) for g in gone], pa.int64())}

        return probe

    return make
