"""Quality by perplexity under an interpolated modified Kneser-Ney model of characters."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelabel.llm.common import once_a_text, python_columns, releasing, semi, stored, text_key, with_parts

ORDER = 4
BEGIN = 2
#: Rows of the probability table that are broadcast at a time (about 24 bytes each).
ROUND_ROWS = 3_000_000
#: Characters that are counted or scored at a time.
CHUNK_CHARS = 500_000
#: Perplexities are compared in steps of this size, so that quantiles need one row per step.
STEP = 0.001


@dataclass(frozen=True)
class QualityParams:
    """A document is rejected above `factor` times the `quantile` of its language's trusted texts.
    Languages with fewer than `enough` trusted texts use what holds for all. A text counts as if
    `prior` more characters had its language's usual perplexity: short texts vary most."""

    quantile: float = 0.995
    factor: float = 1.02
    enough: int = 20
    prior: float = 200.0
    #: One in so many trusted texts (by a hash of the id) is not learned from but gives the quantiles.
    held_out: int = 2


def characters(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """16-bit character numbers with ORDER - 1 begin marks before each text, its first place, its length.

    Characters beyond the basic plane fall into the 6400 classes of the private area.
    """
    pad = chr(BEGIN) * (ORDER - 1)
    own = [(t or b"").decode("utf-8", "replace") for t in texts]
    codes = np.frombuffer("".join(pad + t for t in own).encode("utf-32-le", "replace"), np.uint32)
    codes = np.where(codes < 65536, codes, 0xE000 + codes % 6400).astype(np.uint64)
    sizes = np.array([len(t) for t in own], np.int64)
    ends = np.cumsum(sizes + ORDER - 1)
    return codes, ends - sizes, sizes


def _keys(codes: np.ndarray) -> np.ndarray:
    """At each place, the character and the three before it, as one number."""
    out = codes.copy()
    for j in range(1, ORDER):
        out[j:] |= codes[:-j] << np.uint64(16 * j)
    return out


def _pieces(texts: list[bytes | None]) -> Iterator[slice]:
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text or b"")
        if size >= CHUNK_CHARS:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, n) over all texts, each task's counts added up before they are sent."""
    def count(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for part in parts:
            bodies = part.column(0).to_pylist()
            for piece in _pieces(bodies):
                codes, first, sizes = characters(bodies[piece])
                inside = np.ones(len(codes), bool)
                inside[(first[:, None] - np.arange(1, ORDER)).ravel()] = False
                new, n = np.unique(_keys(codes)[inside], return_counts=True)
                both = np.concatenate([keys, new])
                keys, at = np.unique(both, return_inverse=True)
                counts = np.bincount(at, np.concatenate([counts, n]), len(keys)).astype(np.int64)
            if len(keys) > 2_000_000:
                yield packed(keys, counts)
                keys, counts = keys[:0], counts[:0]
        if len(keys):
            yield packed(keys, counts)

    def packed(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["gram", "n"])

    return texts.mapInArrow(releasing(count), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _low(gram: Column, order: int) -> Column:
    """The last `order` characters of a gram."""
    return gram.bitwiseAND(F.lit((1 << 16 * order) - 1)) if order < 4 else gram


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of grams seen once to four times."""
    seen = {r["n"]: r["c"] for r in counts.where("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    n1, n2, n3, n4 = (seen.get(i, 0) for i in range(1, 5))
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    ratio = lambda a, b: a / b if b else 0.0
    raw = (1 - 2 * y * ratio(n2, n1), 2 - 3 * y * ratio(n3, n2), 3 - 4 * y * ratio(n4, n3))
    # Too few rare grams leave an estimate outside its range.
    return tuple(min(max(d, 0.1 * (i + 1)), i + 1.0) for i, d in enumerate(raw))


def language_model(texts: DataFrame) -> DataFrame:
    """(part, order, gram, value): log probabilities of grams, and log weights of contexts (order + 10).

    The highest order uses counts, the lower ones the number of characters seen before a gram.
    An order's grams are joined with their contexts' totals and with the next lower order's
    probabilities; both joins are spread over the grams' hashes. `part` is the last character of
    the context: all that one place of a text needs lies in one part (-1: in every part).
    """
    counts = {ORDER: stored(gram_counts(texts))}
    for order in range(ORDER - 1, 0, -1):
        grams = counts[order + 1].select(_low(F.col("gram"), order).alias("gram"))
        counts[order] = stored(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    tables, lower = [], None
    for order in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(counts[order])
        n = F.col("n")
        less = F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)
        own = counts[order].withColumn("context", F.shiftrightunsigned("gram", 16) if order > 1 else F.lit(0).cast("long"))
        totals = own.groupBy("context").agg(F.sum("n").alias("total"), F.sum(less).alias("cut"))
        weights = totals.select("context", "total", (F.col("cut") / F.col("total")).alias("weight"))
        if lower is None:
            # One context: its total and weight are two numbers, not a table to join.
            one = weights.first()
            total, weight = (one["total"], one["weight"]) if one else (None, None)
            joined = own.withColumns({"total": F.lit(total).cast("long"), "weight": F.lit(weight).cast("double")})
            # The lowest order shares its weight evenly among the characters seen and one more.
            even = 1.0 / (counts[1].count() + 1)
            joined = joined.withColumn("below", F.lit(even))
            tables.append(weights.select(
                F.lit(-1).alias("part"), F.lit(11).alias("order"), F.col("context").alias("gram"),
                (F.log("weight") + F.log(F.lit(even))).alias("value")))
        else:
            joined = own.join(weights, "context").withColumn("low", _low(F.col("gram"), order - 1)) \
                .join(lower.select(F.col("gram").alias("low"), F.col("p").alias("below")), "low")
            tables.append(weights.select(
                _low(F.col("context"), 1).cast("int").alias("part"), F.lit(order + 10).alias("order"),
                F.col("context").alias("gram"), F.log("weight").alias("value")))
        p = F.greatest(n - less, F.lit(0.0)) / F.col("total") + F.col("weight") * F.col("below")
        lower = stored(joined.select("gram", "context", p.alias("p")))
        part = _low(F.col("context"), 1).cast("int") if order > 1 else F.lit(-1)
        tables.append(lower.select(part.alias("part"), F.lit(order).alias("order"), "gram", F.log("p").alias("value")))
    model = tables[0]
    for table in tables[1:]:
        model = model.unionAll(table)
    return stored(model)


class Scorer:
    """Log probabilities of the characters whose context ends in one of some parts of the model.

    `skipped` are the parts that other rounds score; characters of no part are scored by the last.
    """

    def __init__(self, orders: np.ndarray, grams: np.ndarray, values: np.ndarray, skipped: np.ndarray):
        self.tables = {}
        for order in (*range(1, ORDER + 1), *range(11, ORDER + 11)):
            at = np.flatnonzero(orders == order)
            keys = grams[at].view(np.uint64)
            sort = np.argsort(keys)
            self.tables[order] = keys[sort], values[at][sort]
        self.parts = None
        if len(skipped):
            self.parts = np.ones(65536, bool)
            self.parts[skipped] = False

    def _find(self, order: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known, values = self.tables[order]
        if not len(known):
            return np.zeros(len(keys), bool), np.zeros(len(keys))
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return known[at] == keys, values[at]

    def sums(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the log probabilities and number of characters of each text."""
        totals, sizes = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for piece in _pieces(texts):
            codes, first, own = characters(texts[piece])
            sizes[piece] = own
            inside = np.ones(len(codes), bool)
            inside[(first[:, None] - np.arange(1, ORDER)).ravel()] = False
            if self.parts is not None:
                inside[1:] &= self.parts[codes[:-1].astype(np.int64)]
            keys, owner = _keys(codes)[inside], np.repeat(np.arange(len(own)), own + ORDER - 1)[inside]
            logs, open_ = np.zeros(len(keys)), np.arange(len(keys))
            for order in range(ORDER, 0, -1):
                mask = np.uint64((1 << 16 * order) - 1)
                hit, value = self._find(order, keys[open_] & mask)
                logs[open_[hit]] += value[hit]
                open_ = open_[~hit]
                if not len(open_):
                    break
                context = (keys[open_] & mask) >> np.uint64(16) if order > 1 else np.zeros(len(open_), np.uint64)
                seen, weight = self._find(order + 10, context)
                logs[open_[seen]] += weight[seen]
            totals[piece] = np.bincount(owner, logs, len(own))
        return totals, sizes


def _rounds(model: DataFrame, most: int) -> list[list[int]]:
    """Parts of the model, packed into rounds of bounded size: one row per last character, 65536 at most."""
    sizes = model.where("part >= 0").groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    rounds, room = [], 0
    for row in sizes:
        if row["n"] > room:
            rounds.append([])
            room = most
        rounds[-1].append(row["part"])
        room -= row["n"]
    return rounds or [[]]


def perplexities(
    docs: DataFrame, model: DataFrame, keep: list[str], text_col: str = "text", round_rows: int = ROUND_ROWS,
) -> DataFrame:
    """`keep` columns, n (characters) and log_sum (of their probabilities) of each row.

    With several rounds, each but the last writes one number a text, by a hash of it; texts are not written.
    """
    spark = docs.sparkSession
    rows = docs.select(*keep, F.col(text_col).cast("binary").alias("_text"))
    rounds = _rounds(model, round_rows)
    several = len(rounds) > 1
    if several:
        rows = rows.withColumn("_key", text_key(F.col("_text")))
    before = []
    for i, parts in enumerate(rounds):
        table = model.where(F.col("part").isin([-1, *parts])) if several else model
        table = table.select("order", "gram", "value").toArrow()
        final = i == len(rounds) - 1
        others = np.array([p for own in rounds if own is not parts for p in own], np.int64)
        skipped = others if final else np.setdiff1d(np.arange(65536), parts)
        held = spark.sparkContext.broadcast((
            table.column("order").to_numpy(), table.column("gram").to_numpy(), table.column("value").to_numpy(), skipped))
        kept = ["_key"] if not final else [*keep, "_key"] if several else keep
        scored = python_columns(rows, _scored(held), "n long, log_sum double", {"text": F.col("_text")}, kept)
        if not final:
            before.append(once_a_text(scored.withColumn("_part", F.col("log_sum"))))
    if not several:
        return scored
    earlier = F.aggregate("_parts", F.lit(0.0), lambda total, part: total + part)
    return with_parts(scored, before).withColumn("log_sum", earlier + F.col("log_sum")).select(*keep, "n", "log_sum")


def _scored(held) -> Callable:
    def make():
        scorer = Scorer(*held.value)

        def score(batch: dict[str, pa.Array]) -> dict[str, pa.Array]:
            totals, sizes = scorer.sums(batch["text"].to_pylist())
            return {"n": pa.array(sizes), "log_sum": pa.array(totals)}

        return score

    return make


def _by_language(rows: DataFrame, params: QualityParams, *aggregates: Column) -> DataFrame:
    """(lang, ...): one row per language with enough rows, and one with lang null for all."""
    own = rows.where("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("_rows"), *aggregates)
    every = rows.groupBy(F.lit(None).cast("string").alias("lang")).agg(F.count(F.lit(1)).alias("_rows"), *aggregates)
    return stored(own.where(F.col("_rows") >= params.enough).unionAll(every).drop("_rows"))


def _with_language(rows: DataFrame, table: DataFrame, value: str) -> DataFrame:
    """`value` of the row's language, or that for all. The table has a row per language: it is broadcast."""
    own = table.where("lang is not null").select(F.col("lang").alias("_lang"), F.col(value).alias("_own"))
    every = table.where("lang is null").select(value).first()
    joined = rows.join(F.broadcast(own), F.col("lang") == F.col("_lang"), "left")
    return joined.withColumn(value, F.coalesce("_own", F.lit(every[0] if every else None).cast("double"))).drop("_lang", "_own")


def thresholds(scored: DataFrame, params: QualityParams) -> DataFrame:
    """(lang, threshold) from trusted (lang, smoothed), exact to STEP; lang null holds for all."""
    steps = scored.select("lang", F.ceil(F.col("smoothed") / STEP).cast("long").alias("step"))
    counts = stored(steps.groupBy("lang", "step").agg(F.count(F.lit(1)).alias("n")))
    counts = counts.where("lang is not null").unionAll(
        counts.groupBy("step").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "step", "n"))
    own = Window.partitionBy("lang")
    ranked = counts.withColumns({
        "total": F.sum("n").over(own),
        "upto": F.sum("n").over(own.orderBy("step").rowsBetween(Window.unboundedPreceding, 0))})
    reached = ranked.where(F.col("upto") >= F.ceil(F.col("total") * params.quantile))
    found = reached.groupBy("lang").agg(F.min("step").alias("step"), F.max("total").alias("total"))
    return stored(found.where(F.col("lang").isNull() | (F.col("total") >= params.enough)).select(
        "lang", (F.col("step") * STEP * params.factor).alias("threshold")))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled as good and never as bad."""
    own = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("good"))
    return own.where("good = 1").select("doc_id")


def quality(
    docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(), extra: tuple[str, ...] = (),
    round_rows: int = ROUND_ROWS,
) -> DataFrame:
    """One row per row of `docs`: doc_id, lang, `extra` columns, perplexity, smoothed, threshold, kept.

    The documents that `labels` (doc_id, quality) call good are trusted. The model is trained on the
    whole texts of half of them; the others, which it has not seen, give the quantiles. A document's perplexity is per character, over its whole text; it is
    kept unless that, smoothed towards its language's usual one, is above the language's threshold. Null and empty texts have no perplexity and
    are not kept. A null or rare language uses the threshold of all trusted texts. Without trusted
    texts there are no thresholds, and everything with text is kept. Rows that repeat an id are
    scored one by one. An empty table gives no rows.

    Counting and all joins of the model are Spark's, spread by gram. The resulting table of
    characters is bounded by the alphabet rather than by the corpus; it is broadcast in rounds of at
    most `round_rows` rows, and what the rounds give for a document is added up.
    """
    trusted = stored(trusted_ids(labels))
    apart = F.crc32(F.col("doc_id").cast("string").cast("binary")) % params.held_out == 0
    model = language_model(semi(docs, trusted.where(~apart), "doc_id").select(F.col("text").cast("binary")))
    unseen = semi(docs, trusted.where(apart), "doc_id")
    good = stored(perplexities(unseen, model, ["lang"], round_rows=round_rows).where("n > 0"))
    usual = _by_language(good, params, (-F.sum("log_sum") / F.sum("n")).alias("usual"))

    def smoothed(rows: DataFrame) -> DataFrame:
        value = F.exp((-F.col("log_sum") + params.prior * F.col("usual")) / (F.col("n") + params.prior))
        return _with_language(rows, usual, "usual").withColumn("smoothed", F.when(F.col("n") > 0, value))

    keep = list(dict.fromkeys(["doc_id", "lang", *extra]))
    scored = perplexities(docs, model, keep, round_rows=round_rows)
    rows = _with_language(smoothed(scored), thresholds(smoothed(good), params), "threshold")
    kept = (F.col("n") > 0) & F.coalesce(F.col("smoothed") <= F.col("threshold"), F.lit(True))
    perplexity = F.when(F.col("n") > 0, F.exp(-F.col("log_sum") / F.col("n")))
    return rows.select(*keep, perplexity.alias("perplexity"), "smoothed", "threshold", kept.alias("kept"))
