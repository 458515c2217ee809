"""Benchmark passages in documents, by a prefix-filtered containment join."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelabel.llm.common import once_a_text, python_columns, releasing, stored, text_key, with_parts

WINDOW = 13
SHINGLE = 5
#: Bytes of benchmark text whose windows are broadcast at a time. More text takes more rounds.
BLOCK_BYTES = 4 << 20
#: Bytes of text whose words are looked up at a time.
CHUNK_BYTES = 1 << 20

# A word is a run of ASCII digits and letters and of everything beyond ASCII; A-Z are lower-cased.
_FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
_POWERS = np.array([pow(0x9E3779B97F4A7C15, j + 1, 2**64) for j in range(SHINGLE)], np.uint64)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def _shingles(ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for j in range(k):
        out += ids[at + j] * _POWERS[j]
    return out


class Windows:
    """The distinct windows of a block of items and the shingles in them.

    A window that a document contains has all its shingles there, so for containment the necessary
    prefix is one token: its rarest shingle, once `order_by_rarity` has been told the frequencies.
    """

    def __init__(self, items: list[tuple[str | None, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            n = min(WINDOW, len(ids))
            for i in range(len(ids) - n + 1 if n else 0):
                own = found.setdefault(tuple(ids[i:i + n]), set())
                if name is not None:
                    own.add(name)
        by_length: dict[int, list[tuple[int, ...]]] = {}
        for window in found:
            by_length.setdefault(len(window), []).append(window)
        self.windows = {n: np.array(own, np.uint64) for n, own in by_length.items()}
        self.items = {n: [sorted(found[w]) for w in own] for n, own in by_length.items()}
        self.tokens: dict[int, np.ndarray] = {}
        for n, own in self.windows.items():
            k = min(n, SHINGLE)
            grams = self._grams(own, k).ravel()
            self.tokens[k] = np.unique(np.concatenate([self.tokens.get(k, grams[:0]), grams]))
        self.prefix: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    @staticmethod
    def _grams(own: np.ndarray, k: int) -> np.ndarray:
        at = np.arange(own.shape[1] - k + 1)
        return np.stack([_shingles(row, at, k) for row in own])

    def order_by_rarity(self, counts: dict[tuple[int, int], int]) -> None:
        """Keep of each window the rarest shingle (ties: the smaller hash) and its position."""
        self.prefix = []
        for n, own in self.windows.items():
            k = min(n, SHINGLE)
            grams = self._grams(own, k)
            often = np.array([counts.get((k, int(g)), 0) for g in self.tokens[k]], np.int64)
            rank = np.empty(len(often), np.int64)
            rank[np.lexsort((self.tokens[k], often))] = np.arange(len(often))
            offset = rank[np.searchsorted(self.tokens[k], grams)].argmin(1)
            token = grams[np.arange(len(grams)), offset]
            order = np.argsort(token, kind="stable")
            keys, first, size = np.unique(token[order], return_index=True, return_counts=True)
            self.prefix.append((n, k, keys, np.stack([first, size], 1), order, offset))

    def ids_of(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts, 0 for other words and once after each text; where texts begin."""
        ends = np.cumsum([len(t) + 1 for t in texts])
        ids = np.zeros(int(ends[-1]), np.uint64)
        for words, end in zip(texts, ends):
            ids[end - 1 - len(words):end - 1] = np.fromiter(
                map(self.vocabulary.get, words, repeat(0)), np.uint64, len(words))
        return ids, np.concatenate([[0], ends])

    @staticmethod
    def places(ids: np.ndarray, k: int) -> np.ndarray:
        """Where k known words stand in a row."""
        other = np.concatenate([[0], np.cumsum(ids == 0)])
        return np.flatnonzero(other[k:] == other[:-k])

    def occurrences(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, starts, window numbers) of all windows in the text."""
        for n, k, keys, span, order, offset in self.prefix:
            at = self.places(ids, k)
            grams = _shingles(ids, at, k)
            token = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
            same = keys[token] == grams
            at, token = at[same], token[same]
            first, size = span[token, 0], span[token, 1]
            window = order[np.repeat(first - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]
            start = np.repeat(at, size) - offset[window]
            fits = (start >= 0) & (start + n <= len(ids))
            start, window = start[fits], window[fits]
            for cut in range(0, len(start), 100_000):
                s, w = start[cut:cut + 100_000], window[cut:cut + 100_000]
                real = (ids[s[:, None] + np.arange(n)] == self.windows[n][w]).all(1)
                yield n, s[real], w[real]


def _chunks(texts: list[bytes | None]) -> Iterator[slice]:
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text or b"")
        if size >= CHUNK_BYTES:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def _frequencies(docs: DataFrame, held, text_col: str) -> DataFrame:
    """(k, token, n) over all documents, for the tokens of a block."""
    def count(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = held.value
        totals = {k: np.zeros(len(keys), np.int64) for k, keys in block.tokens.items()}
        for part in parts:
            bodies = part.column(0).to_pylist()
            for piece in _chunks(bodies):
                ids, _ = block.ids_of([words_of(t) for t in bodies[piece]])
                for k, keys in block.tokens.items():
                    grams = _shingles(ids, block.places(ids, k), k)
                    at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
                    totals[k] += np.bincount(at[keys[at] == grams], minlength=len(keys))
        for k, n in totals.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k, np.int64)), pa.array(block.tokens[k][at].view(np.int64)), pa.array(n[at])],
                names=["k", "token", "n"])

    counted = docs.select(F.col(text_col).cast("binary")).mapInArrow(releasing(count), "k long, token long, n long")
    return counted.groupBy("k", "token").agg(F.sum("n").alias("n"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", extra: tuple[str, ...] = (),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of `docs`: the id and `extra` columns, n_words, n_hit, n_items, items, contaminated.

    A document word is hit if it lies in an occurrence of a window: 13 consecutive words of an item,
    or all of an item with fewer. `items` are the ids, as sorted strings, of items with occurring
    windows. Contaminated: 5% or more of the words are hit, and at least one. Null and empty texts
    and items have no words. Items without id hit words but are not listed; an id on several rows is
    one item. Rows that repeat a document id are judged one by one. Empty tables: no rows, or no hits.

    Frequencies of the benchmark's shingles are counted over all documents. Each window is then
    looked up by its rarest shingle; the shingle's place in the window gives the only place where
    the document can hold it, and the words there are compared. The benchmark is taken in blocks of
    bounded size; each is broadcast and passes over the documents once to count and once to search. With
    several blocks, a round writes only what it finds, by a hash of the text; texts are not written.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(item_text_col), F.lit("")).cast("binary").alias("body"))
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    items = stored(items.withColumn("block", F.pmod(F.xxhash64("item", "body"), F.lit(blocks))))
    rows = docs.select(id_col, *extra, F.col(text_col).cast("binary").alias("_text"))
    rounds = []
    for i in range(blocks):
        block = Windows([(r["item"], bytes(r["body"])) for r in items.where(F.col("block") == i).collect()])
        held = spark.sparkContext.broadcast(block)
        counts = {(r["k"], r["token"] & (2**64 - 1)): r["n"] for r in _frequencies(docs, held, text_col).collect()} \
            if block.windows else {}
        block.order_by_rarity(counts)
        held = spark.sparkContext.broadcast(block)
        if blocks == 1:
            return python_columns(rows, _judge(held), _FIELDS, {"text": F.col("_text")}, [id_col, *extra])
        keyed = rows.select(text_key(F.col("_text")).alias("_key"), "_text")
        found = python_columns(keyed, _searcher(held), f"_part {_PART}", {"text": F.col("_text")}, ["_key"])
        rounds.append(once_a_text(found.where("size(_part.first) > 0")))
    parted = with_parts(rows.withColumn("_key", text_key(F.col("_text"))), rounds)
    return python_columns(
        parted, _judge(), _FIELDS, {"text": F.col("_text"), "parts": F.col("_parts")}, [id_col, *extra])


#: What a round finds in a text: the runs of hit words, from first to before last, and the items.
_PART = "struct<first: array<int>, last: array<int>, items: array<string>>"
_ARROW_PART = pa.struct([
    ("first", pa.list_(pa.int32())), ("last", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])
_FIELDS = "n_words long, n_hit long, n_items long, items array<string>, contaminated boolean"


def _found(block: Windows, bodies: list[bytes | None]) -> tuple[np.ndarray, list[dict]]:
    """Number of words of each text, and what the block's windows hit there."""
    sizes, parts = np.zeros(len(bodies), np.int64), []
    for piece in _chunks(bodies):
        texts = [words_of(t) for t in bodies[piece]]
        sizes[piece] = [len(t) for t in texts]
        ids, begins = block.ids_of(texts)
        edge = np.zeros(len(ids) + 1, np.int64)
        names: list[set[str]] = [set() for _ in texts]
        for n, start, window in block.occurrences(ids):
            np.add.at(edge, start, 1)
            np.add.at(edge, start + n, -1)
            own = np.searchsorted(begins, start, "right") - 1
            for d, w in set(zip(own.tolist(), window.tolist())):
                names[d].update(block.items[n][w])
        # Word 0 after each text is never hit, so no run goes on from one text to the next.
        turn = np.diff(np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]]).astype(np.int8))
        first, last = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        cut = np.searchsorted(first, begins)
        for d, own_names in enumerate(names):
            at = slice(cut[d], cut[d + 1])
            parts.append({
                "first": (first[at] - begins[d]).tolist(), "last": (last[at] - begins[d]).tolist(),
                "items": sorted(own_names)})
    return sizes, parts


def _searcher(held) -> Callable:
    def make():
        def search(batch: dict[str, pa.Array]) -> dict[str, pa.Array]:
            return {"_part": pa.array(_found(held.value, batch["text"].to_pylist())[1], _ARROW_PART)}

        return search

    return make


def _judge(held=None) -> Callable:
    """The columns of a document from what all rounds found in it, or what the only one finds now."""
    def make():
        def judge(batch: dict[str, pa.Array]) -> dict[str, pa.Array]:
            bodies = batch["text"].to_pylist()
            if held is not None:
                sizes, found = _found(held.value, bodies)
                given = [[part] for part in found]
            else:
                sizes = np.array([len(words_of(t)) for t in bodies], np.int64)
                given = [parts or () for parts in batch["parts"].to_pylist()]
            hits = np.array([_covered(parts) for parts in given], np.int64)
            names = [sorted({x for part in parts for x in part["items"]}, key=str.encode) for parts in given]
            return {
                "n_words": pa.array(sizes), "n_hit": pa.array(hits), "n_items": pa.array([len(n) for n in names], pa.int64()),
                "items": pa.array(names, pa.list_(pa.string())),
                "contaminated": pa.array((hits > 0) & (20 * hits >= sizes))}

        return judge

    return make


def _covered(parts: Iterable[dict]) -> int:
    """Number of words in at least one of the runs."""
    runs = sorted((a, b) for part in parts for a, b in zip(part["first"], part["last"]))
    total = end = 0
    for a, b in runs:
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total
