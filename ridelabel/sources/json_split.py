"""The values inside large JSON documents, cut out by many tasks.

Spark reads a file whose records end in a line break in splits. A JSON document has no such
record, but every value in it ends in a bracket. So the text is read in pieces that end in that
bracket, and two passes find which pieces end a value: the first sums up each split (quotes, depth
gained inside and outside strings), the sums give the state in which every split begins, and the
second cuts out the values. A value that lies across splits is put together from its parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridelabel.storage import written

_ESCAPE = re.compile(rb"\\.", re.DOTALL)
_QUOTE = ord('"')
#: What each byte adds to the depth, and the bytes that matter: brackets and quotes. UTF-8 has them nowhere else.
_STEP = np.zeros(256, np.int8)
_STEP[list(b"{[")], _STEP[list(b"}]")] = 1, -1
_MATTERS = _STEP != 0
_MATTERS[_QUOTE] = True

#: Rows handed on at a time.
_ROWS = 2000

# Parts of a value: all of it, its end, its beginning, a split's whole text within it, or the end of
# text that turned out to be no value.
WHOLE, HEAD, TAIL, MIDDLE, NONE = "whole", "head", "tail", "middle", "none"


def _marks(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place and kind of each bracket and quote, and how many quotes come up to it.

    The text begins and ends outside any escape.
    """
    plain = _ESCAPE.sub(b"  ", text) if b"\\" in text else text
    kinds = np.frombuffer(plain, np.uint8)
    at = np.flatnonzero(_MATTERS[kinds])
    kinds = kinds[at]
    return at, kinds, np.cumsum(kinds == _QUOTE)


class SplitSum:
    """What a split adds: whether it turns string into no string, and the depth gained in either case."""

    def __init__(self) -> None:
        self.flips = False
        self.gained = [0, 0]  # beginning outside, or inside, a string

    def add(self, text: bytes) -> None:
        _, kinds, quotes = _marks(text)
        steps = _STEP[kinds]
        odd = int(steps[quotes % 2 == 1].sum(dtype=np.int64))
        even = int(steps.sum(dtype=np.int64)) - odd
        out, inside = (odd, even) if self.flips else (even, odd)
        self.gained[0] += out
        self.gained[1] += inside
        self.flips ^= bool(len(quotes) and quotes[-1] % 2)


class ValueCutter:
    """Cuts values at one depth out of consecutive texts; begins in any state."""

    def __init__(self, depth: int, inside: bool, target: int, close: str):
        self.depth, self.inside, self.target, self.close = depth, inside, target, ord(close)
        self.active = depth >= target
        self.held: list[bytes] = []
        # The first value began in an earlier split, unless the document begins here.
        self.kind = HEAD

    def cut(self, text: bytes) -> Iterator[tuple[str, bytes]]:
        at, kinds, quotes = _marks(text)
        quotes += self.inside
        if len(quotes):
            self.inside = bool(quotes[-1] % 2)
        brackets = (kinds != _QUOTE) & (quotes % 2 == 0)
        at, kinds = at[brackets], kinds[brackets]
        steps = _STEP[kinds]
        depths = self.depth + np.cumsum(steps, dtype=np.int64)
        if len(depths):
            self.depth = int(depths[-1])
        on, below = depths == self.target, (steps < 0) & (depths < self.target)
        # Only brackets that begin or end a value, or that leave the depth of values, are looked at one by one.
        seen = below | on & ((steps > 0) | (kinds == self.close))
        begin = 0
        for place, opens, leaves in zip((at[seen] + 1).tolist(), (steps[seen] > 0).tolist(), below[seen].tolist()):
            if opens:
                begin, self.held, self.active, self.kind = place, [], True, WHOLE
            elif leaves:
                if self.active and self.kind == HEAD:
                    yield NONE, b""
                self.active, self.held, self.kind = False, [], WHOLE
            elif self.active:
                self.held.append(text[begin:place])
                yield self.kind, b"".join(self.held)
                begin, self.held, self.kind = place, [], WHOLE
        if self.active:
            self.held.append(text[begin:])

    def rest(self) -> Iterator[tuple[str, bytes]]:
        if self.active:
            yield (MIDDLE if self.kind == HEAD else TAIL), b"".join(self.held)


def _runs(batches: Iterable[pa.RecordBatch], close: str) -> Iterator[tuple[bool, dict, bytes]]:
    """(a split begins here, its columns, text) for texts in the order of the files.

    A text is all of a batch's pieces that lie in one split, each with the bracket it ends in.
    """
    split = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = [n for n in batch.schema.names if n != "value"]
        pieces = batch.column("value").cast(pa.binary()).to_pylist()
        changes = np.zeros(batch.num_rows - 1, bool)
        for column in map(batch.column, names):
            changes |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
        for begin, end in zip(edges, edges[1:]):
            key = {n: batch.column(n)[begin].as_py() for n in names}
            new, split = key != split, key
            # The last piece ends in its bracket, too.
            yield new, key, close.encode().join([*pieces[begin:end], b""])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_SUM = pa.schema([("doc", pa.string()), ("block", pa.int64()), ("flips", pa.bool_()), ("out", pa.int64()), ("ins", pa.int64())])
_VALUE = pa.schema([("doc", pa.string()), ("block", pa.int64()), ("nth", pa.int64()), ("kind", pa.string()), ("value", pa.string())])


def _summer(close: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, key = None, None
        for new, split, text in _runs(batches, close):
            if new:
                if total:
                    yield _rows([(key["doc"], key["block"], total.flips, *total.gained)], _SUM)
                total, key = SplitSum(), split
            total.add(text)
        if total:
            yield _rows([(key["doc"], key["block"], total.flips, *total.gained)], _SUM)

    return run


def _cutter(target: int, close: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        cutter, key, nth = None, None, 0
        for new, split, text in _runs(batches, close):
            if new:
                if cutter:
                    rows += [(key["doc"], key["block"], nth, *part) for part in cutter.rest()]
                cutter, key, nth = ValueCutter(split["depth"], split["inside"], target, close), split, 0
            for part in cutter.cut(text):
                rows.append((key["doc"], key["block"], nth, *part))
                nth += 1
            if len(rows) >= _ROWS:
                yield _rows(rows, _VALUE)
                rows = []
        if cutter:
            rows += [(key["doc"], key["block"], nth, *part) for part in cutter.rest()]
        if rows:
            yield _rows(rows, _VALUE)

    return run


def json_values(spark: SparkSession, path: str, close: str, depth: int) -> DataFrame:
    """(doc, pos, value): texts of the values that end in ``close`` and lie at a depth, in each file's order.

    Depth counts the brackets around a value: 1 for the entries of a document's map or list, 2 for
    the objects in a list below a key. An entry of a map is its key, colon and value. All files of
    ``path`` are read, each holding one document or several after each other; other values at
    that depth must end in the other bracket or in none.

    A document is read in splits like any text file, twice; ``pos`` orders the values of a file.
    The values are written to the shared folder at the call (see ``written``). A broadcast holds
    one row per split (of ``spark.sql.files.maxPartitionBytes``).
    """
    meta = F.col("_metadata")
    pieces = spark.read.text(path, lineSep=close).select(
        meta["file_path"].alias("doc"), meta["file_block_start"].alias("block"), "value")
    sums = pieces.mapInArrow(_summer(close), "doc string, block long, flips boolean, out long, ins long")
    before = Window.partitionBy("doc").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    flips = F.coalesce(F.sum(F.col("flips").cast("int")).over(before), F.lit(0)) % 2 == 1
    states = sums.withColumn("inside", flips)
    gained = F.when(F.col("inside"), F.col("ins")).otherwise(F.col("out"))
    states = states.withColumn("gained", gained).select(
        "doc", "block", "inside", F.coalesce(F.sum("gained").over(before), F.lit(0)).alias("depth"))
    begun = pieces.join(F.broadcast(states), ["doc", "block"])
    # Whole values and parts are read apart; the text is not cut twice for that.
    parts = written(begun.select("doc", "block", "inside", "depth", "value").mapInArrow(
        _cutter(depth, close), "doc string, block long, nth long, kind string, value string"))

    # Two parts at most from each split lie across its edges.
    whole = parts.where(F.col("kind") == WHOLE).select("doc", (F.col("block") + F.col("nth")).alias("pos"), "value")
    order = Window.partitionBy("doc").orderBy("block", "nth")
    cut = parts.where(F.col("kind") != WHOLE).withColumn(
        "n", F.sum((F.col("kind") == TAIL).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = cut.groupBy("doc", "n").agg(
        F.array_sort(F.collect_list(F.struct("block", "nth", "value"))).alias("parts"),
        F.bool_or(F.col("kind") == NONE).alias("none")).where("not none")
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "")
    first = F.col("parts")[0]
    joined = joined.select("doc", (first["block"] + first["nth"]).alias("pos"), text.alias("value"))
    blank = F.regexp_replace("value", r"^[\s,]+", "")
    return whole.unionByName(joined).withColumn("value", blank).where(F.col("value") != "")
