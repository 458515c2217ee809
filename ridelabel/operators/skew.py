"""Keeping hot keys and growing lookup tables from ending up in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelabel.storage import written

#: Column that numbers a hot key's stretches of time; rows without it are cut nowhere.
CHUNK = "_chunk"
#: A hot key is cut into at most this many chunks.
MOST_CHUNKS = 1000


def split_hot(df: DataFrame, key: str, time: str, max_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys, and rows of keys with more than ``max_rows`` rows (or None).

    One narrow pass with map-side counts says whether there are hot keys, a second one writes them. There are at most
    ``rows / max_rows`` of them, which bounds the broadcast. Hot rows are cut into
    chunks (see ``with_chunks``).
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    hot = counts.where(F.col("_rows") > max_rows).select(F.col(key).alias("_hot"))
    if hot.isEmpty():
        return df, None
    hot = written(hot)
    same = df[key].eqNullSafe(hot["_hot"])
    keys = F.broadcast(hot)
    return df.join(keys, same, "left_anti"), with_chunks(df.join(keys, same, "left_semi"), key, time, max_rows)


def with_chunks(df: DataFrame, key: str, time: str, max_rows: int) -> DataFrame:
    """Add the chunk of each row: quantiles of the key's times, about ``max_rows`` rows apart.

    Chunks are ordered like the times. Equal times share a chunk; rows without
    time come first and share the lowest one. Meant for the rows of hot keys only:
    the bounds are broadcast, and there is about one for every ``max_rows`` rows.
    """
    steps = [i / MOST_CHUNKS for i in range(1, MOST_CHUNKS)]
    at = F.unix_micros(time)
    found = df.groupBy(F.col(key).alias("_key")).agg(
        F.percentile_approx(at, steps, 10 * MOST_CHUNKS).alias("_q"), F.count(F.lit(1)).alias("_rows")
    )
    every = F.greatest(F.lit(1), F.floor(F.lit(MOST_CHUNKS * max(1, max_rows)) / F.col("_rows")))
    bounds = written(found.select(
        "_key", F.array_distinct(F.filter("_q", lambda _, i: (i + 1) % every == 0)).alias("_bounds")
    ))
    joined = df.join(F.broadcast(bounds), df[key].eqNullSafe(bounds["_key"]))
    chunk = F.size(F.filter("_bounds", lambda bound: bound < at))
    return joined.withColumn(CHUNK, F.greatest(F.coalesce(chunk, F.lit(0)), F.lit(0))).drop("_key", "_bounds")


def shuffled(table: DataFrame) -> DataFrame:
    """The table, to be joined by a shuffle of both sides.

    For tables that grow with the input. Spark takes an exploded table for as large as the rows it
    was exploded from, and a stored one for as large as its compressed file; left to itself it may
    send many millions of rows through the driver as a broadcast.
    """
    return table.hint("merge")


def _splits_popular_keys(spark: SparkSession) -> bool:
    """Whether Spark deals a popular key's rows to several tasks by itself once they are shuffled."""
    names = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(spark.conf.get(n).lower() == "true" for n in names)


def lookup(big: DataFrame, small: DataFrame, keys: list[str], broadcast: bool, salts: int,
           spread: list[Column]) -> DataFrame:
    """Left join to a table with few rows per key.

    ``broadcast`` must come from a check of the table's size. Without it both sides are shuffled,
    each row once: what a popular key brings together is split by Spark when the join runs. A
    session that does not do so (a stream's) spreads every key over ``salts`` parts instead, chosen
    by a hash of ``spread``, with a copy of the table for each. Rows with a null key match nothing:
    their salts are all hashes there are.
    """
    if broadcast:
        return big.join(F.broadcast(small), keys, "left")
    missing = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    salt = F.hash(*spread)
    if _splits_popular_keys(big.sparkSession):
        # Always 0, but no literal: that would be taken out of the join's keys, and null keys with it.
        own, copies = F.lit(0), F.pmod(F.hash(*keys), F.lit(1))
    else:
        own, copies = F.pmod(salt, F.lit(salts)), F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    salted_big = big.withColumn("_salt", F.when(missing, salt).otherwise(own))
    salted_small = small.withColumn("_salt", copies)
    return salted_big.join(shuffled(salted_small), [*keys, "_salt"], "left").drop("_salt")
