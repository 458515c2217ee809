"""Packing of tokenised documents into sequences of equal length and similar attention cost."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelabel.llm.common import SLICE_BYTES, releasing, stored

#: Characters encoded at a time.
SLICE_CHARS = 1 << 20

# The pattern by which byte-level BPE cuts a text into words, and its white space.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The pattern never joins a character of a word with white space behind it, so a text may be cut there.
_CUT = re.compile(f"(?<=[^{_SPACE}])(?=[{_SPACE}])")


@dataclass(frozen=True)
class PackParams:
    """`tokenizer` is the path of a byte-level BPE file that all executors can read.

    A piece of n tokens costs n + quadratic * n * n. The default is what attention adds to the
    other layers' work at a width of 1024: 1 / (12 * width).

    Whole sequences need no placing. The rest is placed in groups of about `group_tokens`, each by
    one task; a group leaves at most one sequence partly empty.
    """

    tokenizer: str
    capacity: int = 2048
    end_id: int = 1
    quadratic: float = 1 / (12 * 1024)
    group_tokens: int = 1 << 21

    def cost(self, tokens: int) -> float:
        return tokens + self.quadratic * tokens * tokens


class Encoder:
    """Texts to ids, as little-endian unsigned 32-bit numbers.

    The file's ids number its merges, so it can be read as ranks: the same ids at a quarter of the
    time. A file of another kind is encoded by the library that it is made for.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Names of special tokens in a text are ordinary text.
        self.tokenizer.encode_special_tokens = True
        self.ranked = _as_ranks(json.loads(self.tokenizer.to_str()))

    def encode(self, text: str) -> bytes:
        return b"".join(self._ids(part).astype("<u4").tobytes() for part in _slices(text))

    def _ids(self, text: str) -> np.ndarray:
        if self.ranked is None:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.ranked.encode_ordinary(text), "<u4")


def _slices(text: str) -> Iterator[str]:
    """Parts that are encoded as in the whole text."""
    begin = 0
    while len(text) - begin > SLICE_CHARS and (cut := _CUT.search(text, begin + SLICE_CHARS)):
        yield text[begin:cut.start()]
        begin = cut.start()
    yield text[begin:] if begin else text


def _as_ranks(described: dict):
    """A byte-level BPE file whose ids are the order of its merges, as an encoding by ranks; else None."""
    import tiktoken

    model, split = described["model"], described["pre_tokenizer"] or {}
    words = model.get("vocab", {})
    special = {t["content"] for t in described["added_tokens"]}
    # Each byte is written as one character: printable ones as themselves, others from 256 on.
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model.get("merges", [])]
    if (described["normalizer"] or split.get("type") != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]
            or any(words.get(m) != 256 + i for i, m in enumerate(merged))
            or any(c not in byte_of for w in words if w not in special for c in w)):
        return None
    ranks = {bytes(byte_of[c] for c in w): i for w, i in words.items() if w not in special}
    return tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(docs: DataFrame, params: PackParams, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens): every document cut at multiples of the capacity."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), *T.StructType.fromDDL(
            "start long, length long, ids binary, doc_tokens long")])
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    width = 4 * params.capacity
    end = np.array([params.end_id], "<u4").tobytes()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(params.tokenizer)
        for batch in batches:
            of, starts, sizes, ids, totals, held = [], [], [], [], [], 0

            def rows() -> pa.RecordBatch:
                columns = [
                    batch.column(0).take(pa.array(of, pa.int64())), pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(totals, pa.int64())]
                return pa.RecordBatch.from_arrays(columns, names=schema.names)

            for i, text in enumerate(batch.column(1)):
                whole = encoder.encode(text.as_py()) + end
                for at in range(0, len(whole), width):
                    piece = whole[at:at + width]
                    of.append(i)
                    starts.append(at // 4)
                    sizes.append(len(piece) // 4)
                    ids.append(piece)
                    totals.append(len(whole) // 4)
                    held += len(piece)
                    if held >= SLICE_BYTES:
                        yield rows()
                        of, starts, sizes, ids, totals, held = [], [], [], [], [], 0
            if of:
                yield rows()

    return source.mapInArrow(releasing(cut), schema)


class Sequences:
    """Sequences by free capacity and cost: finds the cheapest one with enough room.

    Sequences with the same room lie in one heap; a tree over all rooms holds the cheapest of each.
    """

    NONE = (float("inf"), -1)

    def __init__(self, count: int, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.heaps = {capacity: [(0.0, i) for i in range(count)]}
        self.tree = [self.NONE] * (2 * self.size)
        self._renew(capacity)

    def _renew(self, room: int) -> None:
        heap = self.heaps.get(room)
        at = room + self.size
        self.tree[at] = heap[0] if heap else self.NONE
        while at > 1:
            at //= 2
            best = min(self.tree[2 * at], self.tree[2 * at + 1])
            if self.tree[at] == best:
                break
            self.tree[at] = best

    def _leaf(self, at: int, wanted: tuple) -> int:
        while at < self.size:
            at = 2 * at if self.tree[2 * at] == wanted else 2 * at + 1
        return at - self.size

    def take(self, tokens: int) -> tuple[int, int, float]:
        """(room, sequence, cost) of the cheapest sequence with room for `tokens`, else of the roomiest."""
        tree, best, where = self.tree, self.NONE, 0
        low, high = tokens + self.size, 2 * self.size
        while low < high:
            if low & 1:
                if tree[low] < best:
                    best, where = tree[low], low
                low += 1
            if high & 1:
                high -= 1
                if tree[high] < best:
                    best, where = tree[high], high
            low, high = low // 2, high // 2
        if where:
            room = self._leaf(where, best)
        else:
            at = 1
            while at < self.size:
                at = 2 * at + 1 if tree[2 * at + 1] != self.NONE else 2 * at
            room = at - self.size
        cost, sequence = heapq.heappop(self.heaps[room])
        self._renew(room)
        return room, sequence, cost

    def give(self, room: int, sequence: int, cost: float) -> None:
        heapq.heappush(self.heaps.setdefault(room, []), (cost, sequence))
        self._renew(room)


def place(lengths: list[int], params: PackParams) -> list[tuple[int, int, int, int, int]]:
    """(piece, skip, length, sequence, offset) for pieces shorter than a sequence.

    There are as many sequences as the tokens fill. The longest piece left goes to the sequence of
    lowest cost that has room for all of it. If none has, the roomiest takes its beginning and the
    rest waits for its turn by length.
    """
    total = sum(lengths)
    sequences = Sequences(-(-total // params.capacity), params.capacity)
    waiting = [(-n, i, 0) for i, n in enumerate(lengths)]
    heapq.heapify(waiting)
    placed = []
    while waiting:
        size, piece, skip = heapq.heappop(waiting)
        room, sequence, cost = sequences.take(-size)
        taken = min(-size, room)
        placed.append((piece, skip, taken, sequence, params.capacity - room))
        if room > taken:
            sequences.give(room - taken, sequence, cost + params.cost(taken))
        if taken < -size:
            heapq.heappush(waiting, (size + taken, piece, skip + taken))
    return placed


def _packer(params: PackParams, schema: pa.Schema):
    def pack_group(group: pa.Table) -> pa.Table:
        group = group.sort_by("piece").combine_chunks()
        placed = place(group.column("length").to_pylist(), params)
        of, skips, sizes, sequences, offsets = (np.array(c, np.int64) for c in zip(*placed))
        ids = group.column("ids")
        number = group.column("group")[0].as_py()
        cut = [ids[i].as_py()[4 * s:4 * (s + n)] for i, s, n in zip(of.tolist(), skips.tolist(), sizes.tolist())]
        taken = group.take(pa.array(of))
        return pa.Table.from_arrays([
            taken.column("doc_id"), pa.array(taken.column("start").to_numpy() + skips), pa.array(sizes),
            pa.array(cut, pa.binary()), taken.column("doc_tokens"), pa.array(((number << 32) + sequences) * 2),
            pa.array(offsets)], names=schema.names)

    return pack_group


def pack(docs: DataFrame, params: PackParams, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset, cost.

    A document is the ids of its text and the end id. It is cut at multiples of the capacity; only
    what is left over at its end is placed among others, and cut again only where no sequence has
    room for all of it. `ids` are little-endian unsigned 32-bit numbers, `sequence_id` is even for
    sequences put together and odd for those that one piece fills, `cost` is that of the piece.

    Null and empty texts are the end id alone. Rows that repeat an id are documents of their own;
    a null id is kept. Equal lengths go in the order of their rows. A very long text is one row in
    memory, about twice its size, and leaves it in batches of pieces. Other columns are ignored,
    whatever their names. An empty table gives no rows.

    Left-over pieces are dealt by a hash of their number in the stored table of pieces, not of their
    id, so no key can make a group large: a group differs from `group_tokens` only as much as a
    random deal does.
    """
    cut = stored(pieces(docs, params, id_col, text_col).withColumn("piece", F.monotonically_increasing_id()))
    whole = F.col("length") == params.capacity
    rest = cut.where(~whole)
    tokens = rest.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-tokens // params.group_tokens))
    schema = T.StructType([*cut.drop("piece").schema, *T.StructType.fromDDL("sequence_id long, offset long")])
    arrow = pa.schema([(n, pa.null()) for n in schema.names])
    packed = rest.withColumn("group", F.pmod(F.xxhash64("piece"), F.lit(groups))) \
        .groupBy("group").applyInArrow(_packer(params, arrow), schema)
    alone = cut.where(whole).select(
        *cut.drop("piece").columns, (F.col("piece") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    size = F.col("length")
    return alone.unionByName(packed).withColumn("cost", size + F.lit(params.quadratic) * size * size)
