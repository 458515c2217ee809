"""Exact duplicates by content hash, with the bytes compared inside the groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelabel.llm.common import drop_white, semi, small_enough, stored


def content_hash(text: Column) -> Column:
    """128 bits as 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are once white space is deleted; the row with the most code
    points, then the smallest id, stays. Null texts count as empty and form one group with
    empty ones. A null id comes after all others. Rows that repeat an id are rows of their own
    in `group_size`; those equal to the row that stays are all kept, as nothing tells them
    apart. An empty table gives no rows; other columns are ignored.

    Groups are counted on (id, hash, length) alone. Texts move only for groups of two or more,
    as their smallest and largest member, aggregated before the shuffle: the two are the same
    bytes exactly if the whole group is. Only groups where they differ are split by text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    norm = drop_white(text)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.length(text).alias("n_chars"), norm.alias("norm"))
    rows = rows.withColumn("h", hashed(F.col("norm")))
    keys = stored(rows.select("doc_id", "n_chars", "h", F.unhex(F.sha2(F.col("norm"), 256)).alias("sha")))
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("none"), "doc_id"))
    groups = keys.groupBy("h").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))

    repeated = stored(groups.where("group_size > 1"))
    members = semi(rows, repeated.select("h"), "h")
    mixed = stored(
        members.groupBy("h").agg(F.min("norm").alias("least"), F.max("norm").alias("most"))
        .where("least != most").select("h"))
    if not mixed.isEmpty():
        return _split_by_text(rows, mixed, best)
    return _result(keys, repeated, ["h"])


def _split_by_text(rows: DataFrame, mixed: DataFrame, best: Column) -> DataFrame:
    """Different texts share a hash: in those groups the text itself becomes part of the key."""
    clash = F.broadcast(mixed) if mixed.count() <= 1000 else mixed
    keyed = rows.join(clash.withColumn("clash", F.lit(True)), "h", "left")
    keys = stored(keyed.select(
        "doc_id", "n_chars", "h", F.when(F.col("clash"), F.col("norm")).alias("exact"),
        F.unhex(F.sha2(F.col("norm"), 256)).alias("sha")))
    keys = keys.withColumn("exact", F.coalesce("exact", F.lit("")))
    groups = keys.groupBy("h", "exact").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
    return _result(keys, stored(groups.where("group_size > 1")), ["h", "exact"])


def _result(keys: DataFrame, repeated: DataFrame, on: list[str]) -> DataFrame:
    """Rows without a group of two or more stay by themselves."""
    joined = keys.join(F.broadcast(repeated) if small_enough(repeated) else repeated, on, "left")
    same = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("n_chars") == -F.col("best.n"))
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), (alone | same).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
