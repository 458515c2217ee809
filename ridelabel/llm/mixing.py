"""Mixing of sources by a curriculum: weights that change over the training run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelabel.llm.common import stored, words_in

#: Buckets of the hashed order inside a source; running sums are taken over bucket totals first.
BUCKETS = 4096


@dataclass(frozen=True)
class Curriculum:
    """`weights` repeat over the sources in order; `budget` is the share of all words to take and
    `most` how often a source's words may be taken at most.

    `knots` are (time, intensity) pairs from time 0 to 1 for each of `weights`, linear in between:
    how a source's words are spread over the run. Their integral is brought to the source's target.
    """

    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    budget: float = 1.5
    most: float = 2.0
    knots: tuple[tuple[tuple[float, float], ...], ...] = (
        ((0.0, 1.0), (1.0, 1.0)),
        ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
        ((0.0, 1.6), (0.7, 0.9), (1.0, 0.3)),
    )


def source_targets(sizes: DataFrame, plan: Curriculum) -> DataFrame:
    """(source, rank, source_size, target) from (source, source_size): one row per source.

    Weights are dealt by code point order, null last. Capped targets fill up in the order of
    cap to weight: the first k are capped where the level the others then share first stays
    below the next cap. That is what resharing the excess again and again ends in.
    """
    named = Window.orderBy(F.col("source").isNull(), "source")
    weights = F.array(*(F.lit(float(w)) for w in plan.weights))
    rank = (F.row_number().over(named) - 1).cast("int")
    ranked = sizes.select("source", "source_size", rank.alias("rank")).withColumns({
        "weight": F.element_at(weights, F.col("rank") % len(plan.weights) + 1),
        "cap": F.col("source_size") * float(plan.most),
    }).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("ratio", "rank").rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(every) * float(plan.budget)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = ranked.withColumn("level", F.when(level <= F.col("ratio"), level))
    reached = levels.withColumn("final", F.first("level", ignorenulls=True).over(every))
    target = F.least(F.col("cap"), F.coalesce(F.col("final") * F.col("weight"), F.col("cap")))
    return reached.select("source", "rank", "source_size", target.alias("target"))


def _time_of(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time at which `share` of the integral of the knots is used up."""
    areas = [0.0]
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        areas.append(areas[-1] + (w0 + w1) / 2 * (t1 - t0))
    demand, time = share * areas[-1], F.lit(1.0)
    for i in reversed(range(len(knots) - 1)):
        (t0, w0), (t1, w1) = knots[i], knots[i + 1]
        rest, slope = demand - areas[i], (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + rest * (2 * slope), F.lit(0.0)))
        time = F.when(demand <= areas[i + 1], F.lit(t0) + F.when(rest > 0, rest * 2 / (root + w0)).otherwise(0.0)).otherwise(time)
    return time


def mix(
    docs: DataFrame, plan: Curriculum = Curriculum(), id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document, sorted by training position: doc_id, size, source_size, target, taken,
    position, last_position.

    A source's documents form one stream, ordered by a hash of the id, which the run goes through
    as often as the target needs; the last pass stops within a document. `position` is the time
    (0 to 1) at which the stream's demand, the integral of the source's schedule, first reaches the
    document, `last_position` that of its last pass; both are null if nothing of it is taken.

    Null and empty texts have size 0 and are never taken. A null source is a source of its own, the
    last one. A null id counts as an empty one; rows that repeat an id follow each other by size.
    An empty table gives no rows; other columns are ignored.

    Running sums are taken over the totals of hashed buckets and then inside each bucket, so no
    task holds a whole source.
    """
    key = F.unhex(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")))
    sized = stored(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words_in(F.col(text_col)).alias("size"),
        key.alias("key")))
    sized = sized.withColumn("bucket", F.conv(F.hex(F.substring("key", 1, 2)), 16, 10).cast("int") % BUCKETS)
    # A bucket is a set of hashes, not a range; the order is bucket, then hash.
    totals = stored(sized.groupBy("source", "bucket").agg(F.sum("size").alias("total")))
    targets = source_targets(totals.groupBy("source").agg(F.sum("total").alias("source_size")), plan)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("start", F.coalesce(F.sum("total").over(before), F.lit(0)))
    starts = stored(
        starts.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
        .select("b.source", "bucket", "start", "rank", "source_size", "target"))

    inside = Window.partitionBy("source", "bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = sized.withColumn("inner", F.sum("size").over(inside) - F.col("size"))
    on = F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.bucket") == F.col("s.bucket"))
    known = F.broadcast(starts) if starts.count() <= 64 * BUCKETS else starts
    rows = placed.alias("d").join(known.alias("s"), on).select(
        "doc_id", "size", "source_size", "target", "rank", (F.col("start") + F.col("inner")).alias("offset"))

    goal = F.floor("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumns({"goal": goal, "passes": passes})
    rest = F.col("goal") - F.col("passes") * F.col("source_size") - F.col("offset")
    extra = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest))
    rows = rows.withColumns({"extra": extra, "taken": F.col("passes") * F.col("size") + extra})
    last = F.col("passes") - F.when(F.col("extra") > 0, 0).otherwise(1)
    timed = {"position": F.col("offset"), "last_position": F.col("offset") + last * F.col("source_size")}
    for name, reached in timed.items():
        share, time = reached / F.col("goal"), F.lit(None).cast("double")
        for i, knots in enumerate(plan.knots):
            time = F.when(F.col("rank") % len(plan.knots) == i, _time_of(share, knots)).otherwise(time)
        timed[name] = F.round(F.when(F.col("taken") > 0, time), 9)
    return rows.select("doc_id", "size", "source_size", "target", "taken", *(c.alias(n) for n, c in timed.items())) \
        .orderBy(F.col("position").asc_nulls_last(), "doc_id")
