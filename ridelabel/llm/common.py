"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelabel.storage import written

# The white space of the contracts, and the ASCII letters.
WHITESPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Bytes of Arrow data that Python code handles at a time.
SLICE_BYTES = 4 << 20

#: Rows of narrow keys (under 64 bytes each) that may be broadcast. More are shuffled.
BROADCAST_ROWS = 500_000

#: Bytes that may be broadcast where rows are not narrow.
BROADCAST_BYTES = 64 << 20

#: Copies of what is known of a text, for the rows of one text to spread over.
SALTS = 8


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame) -> DataFrame:
    """The frame, written to the shared folder and read back: lineage ends here and
    lost executors lose nothing."""
    return written(frame)


def small_enough(keys: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a stored table of narrow rows may be broadcast; reads no more than the limit."""
    return keys.limit(limit + 1).count() <= limit


def semi(big: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of `big` that have a key; wide rows are shuffled only if the stored keys are too many."""
    return big.join(F.broadcast(keys) if small_enough(keys) else keys, on, "left_semi")


def text_key(text: Column) -> Column:
    """32 bytes that tell texts apart; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("binary"), F.lit(b"")), 256))


def once_a_text(round_: DataFrame) -> DataFrame:
    """What a round over the documents gave, (_key, _part), written without repeating a text."""
    return stored(round_.select("_key", "_part").dropDuplicates(["_key"]))


def with_parts(rows: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """`rows`, which have a _key, with `_parts`: what the stored rounds gave for their text, in the order of
    the rounds, null if nothing. Rounds need not write texts anew: the parts find their rows by the key.

    The parts are broadcast if few and small; else the rows of one text spread over copies of its parts.
    """
    every = rounds[0].select("_key", F.lit(0).alias("_round"), "_part")
    for i, given in enumerate(rounds[1:], 1):
        every = every.unionAll(given.select("_key", F.lit(i).alias("_round"), "_part"))
    gathered = every.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("_round", "_part"))).alias("_own"))
    parts = stored(gathered.select("_key", F.col("_own._part").alias("_parts")))
    if small_enough(parts):
        size = parts.agg(F.sum(F.octet_length(F.to_json(F.struct("_parts"))))).first()[0] or 0
        if size <= BROADCAST_BYTES:
            return rows.join(F.broadcast(parts), "_key", "left")
    spread = F.pmod(F.xxhash64(*(F.col(c) for c in rows.columns if c != "_key")), F.lit(SALTS)).cast("int")
    copies = parts.withColumn("_salt", F.explode(F.array(*(F.lit(i) for i in range(SALTS)))))
    return rows.withColumn("_salt", spread).join(copies, ["_key", "_salt"], "left").drop("_salt")


def drop_white(text: Column) -> Column:
    for c in WHITESPACE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def words_in(text: Column) -> Column:
    """Number of runs of other characters than white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def releasing(batches: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """The same function for `mapInArrow`; at the end of a task its memory goes back to the system.

    Python workers serve task after task. Without this they keep the most that any of them needed.
    """
    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from batches(parts)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):
                pass  # another C library than glibc

    return run


def python_columns(
    frame: DataFrame, make: Callable[[], Callable[[dict[str, pa.Array]], dict[str, pa.Array]]], fields: str,
    inputs: dict[str, Column], keep: list[str],
) -> DataFrame:
    """`keep` columns of the frame and columns computed batch by batch in Python.

    `make` is called once per task; what it returns maps some rows' `inputs` to `fields`. It gets
    about SLICE_BYTES at a time, so that what it makes of them stays small.
    """
    added = T.StructType.fromDDL(fields)
    names = {name: f"_in{i}" for i, name in enumerate(inputs)}
    source = frame.select(*keep, *(inputs[n].alias(a) for n, a in names.items()))
    schema = T.StructType([f for f in source.schema if f.name in keep] + list(added))

    def batches(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for part in parts:
            step = max(1, SLICE_BYTES * part.num_rows // max(part.nbytes, 1))
            for begin in range(0, part.num_rows, step):
                piece = part.slice(begin, step)
                out = compute({n: piece.column(piece.schema.get_field_index(a)) for n, a in names.items()})
                kept = [piece.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *(out[f.name] for f in added)], names=[f.name for f in schema])

    return source.mapInArrow(releasing(batches), schema)
