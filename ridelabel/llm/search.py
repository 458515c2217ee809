"""Ranked lexical search by the Best Position Algorithm over lists sorted by impact."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelabel.llm.common import releasing, stored

#: Bytes of item texts that are searched together; their terms are broadcast.
BLOCK_BYTES = 8 << 20
#: Postings of the documents that one run of the algorithm goes over.
SHARD_POSTINGS = 1_000_000
#: Positions read from every list in the first round; each round reads twice as many.
FIRST_READ = 8
#: Parts in which the best of all tasks are compared before the last comparison.
MERGE_PARTS = 64

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


@dataclass(frozen=True)
class RankParams:
    """Impact of tf occurrences among a document's n terms: scale * tf div (1000 * tf + 8 * m), where
    m = 100 - slope + (slope * n * N div L), N documents with L terms in all."""

    k: int = 10
    slope: int = 90
    scale: int = 1_000_000_000


def terms_of(body: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII; only A-Z is lower-cased."""
    return _TERM.findall(body.lower())


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Lists:
    """Impact lists of some documents: per term, documents by falling impact.

    A list is a range of positions; `docs` and `impacts` are read in that order. `find` is the
    direct access: where a document stands in a list.
    """

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, count: int):
        order = np.lexsort((docs, -impacts, terms))
        terms, self.docs, self.impacts, self.count = terms[order], docs[order], impacts[order], count
        self.terms, self.begins = np.unique(terms, return_index=True)
        self.ends = np.append(self.begins[1:], len(terms))
        keys = terms.astype(np.int64) * count + self.docs
        self.by_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.by_key]

    def find(self, terms: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(held, position) for every term (rows) and document (columns)."""
        wanted = terms[:, None].astype(np.int64) * self.count + docs[None, :]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return self.keys[at] == wanted, self.by_key[at]


def best_positions(
    lists: Lists, terms: np.ndarray, weights: np.ndarray, k: int, floor: int, tie: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the `k` best with a positive score of `floor` or more, by score, then `tie`.

    Every round reads the next positions of all lists, finds each new document's place in every
    list directly and adds up its score. All places found so, by reading or directly, count as
    seen; a list's best position is the last one before the first unseen. An unseen document can at
    most have the impacts of the first unseen positions. Once their sum lies strictly below the
    k-th score nothing unseen can come in, not even by a tie.
    """
    if not len(lists.terms):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(lists.terms, terms)
    held = (at < len(lists.terms)) & (lists.terms[np.minimum(at, len(lists.terms) - 1)] == terms) & (weights > 0)
    terms, weights, at = terms[held], weights[held], at[held]
    begins, ends = lists.begins[at], lists.ends[at]
    base = np.cumsum(ends - begins) - (ends - begins)
    seen = np.zeros(int((ends - begins).sum()), bool)
    read, best = begins.copy(), begins.copy()
    met = np.zeros(lists.count, bool)
    top_docs, top_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    step = FIRST_READ
    while len(terms):
        until = np.minimum(read + step, ends)
        new = np.concatenate([lists.docs[a:b] for a, b in zip(read, until)])
        for a, b, shift in zip(read, until, base - begins):
            seen[a + shift:b + shift] = True
        read, step = until, 2 * step
        new = np.unique(new[~met[new]])
        if len(new):
            met[new] = True
            found, places = lists.find(terms, new)
            scores = (np.where(found, lists.impacts[places], 0) * weights[:, None]).sum(0)
            seen[(places + (base - begins)[:, None])[found]] = True
            good = scores >= max(floor, 1)
            top_docs, top_scores = np.append(top_docs, new[good]), np.append(top_scores, scores[good])
            order = np.lexsort((tie[top_docs], -top_scores))[:k]
            top_docs, top_scores = top_docs[order], top_scores[order]
            if len(top_docs) == k:
                floor = max(floor, int(top_scores[-1]))
        bound = 0
        for i in range(len(terms)):
            tail = seen[best[i] - begins[i] + base[i]:ends[i] - begins[i] + base[i]]
            gap = int(tail.argmin()) if len(tail) else 0
            best[i] += gap if len(tail) and not tail[gap] else len(tail)
            if best[i] < ends[i]:
                bound += int(weights[i]) * int(lists.impacts[best[i]])
        if bound == 0 or bound < floor:
            break
    return top_docs, top_scores


def _postings(docs: DataFrame, vocabulary: Broadcast, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, counts): documents with at least one term; terms and counts of the vocabulary only."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), *T.StructType.fromDDL("n long, terms binary, counts binary")])
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).where("text is not null")

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value.get
        for batch in batches:
            sizes, terms, counts, kept = [], [], [], []
            for i, text in enumerate(batch.column(1)):
                words = terms_of(text.as_buffer().to_pybytes())
                if not words:
                    continue
                found = np.array([t for t in map(known, words) if t is not None], np.int32)
                ids, times = np.unique(found, return_counts=True)
                kept.append(i)
                sizes.append(len(words))
                terms.append(ids.astype("<i4").tobytes())
                counts.append(times.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64()),
                pa.array(terms, pa.binary()), pa.array(counts, pa.binary())], names=schema.names)

    return source.mapInArrow(releasing(index), schema)


def _frequencies(postings: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary occurs."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for terms in batch.column(0):
                total[np.frombuffer(terms.as_buffer(), "<i4")] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])

    found = np.zeros(size, np.int64)
    summed = postings.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for row in summed.toLocalIterator():
        found[row["term"]] = row["df"]
    return found


def _best_of_tasks(postings: DataFrame, queries: Broadcast, params: RankParams, shard: int) -> DataFrame:
    """(item, doc_id, score): the best documents of each task's rows, at most `k` an item."""
    id_type = postings.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("doc_id", id_type), T.StructField("score", T.LongType())])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, documents, length = queries.value
        tops: list[list[tuple]] = [[] for _ in items]
        held: list[pa.RecordBatch] = []
        size, of_ids = 0, None

        def run() -> None:
            ids = pa.concat_arrays([b.column(0) for b in held])
            n = np.concatenate([b.column(1).to_numpy() for b in held])
            terms, counts = (
                [np.frombuffer(x.as_buffer(), "<i4") for b in held for x in b.column(c)] for c in (2, 3))
            docs = np.repeat(np.arange(len(n)), [len(t) for t in terms])
            tf = np.concatenate(counts).astype(np.int64)
            m = 100 - params.slope + params.slope * n * documents // length
            lists = Lists(np.concatenate(terms), docs, params.scale * tf // (1000 * tf + 8 * m[docs]), len(n))
            # Ids in order, null last.
            tie = np.empty(len(n), np.int64)
            tie[pc.sort_indices(ids).to_numpy()] = np.arange(len(n))
            for i, (own, weights) in enumerate(items):
                floor = -tops[i][-1][0] if len(tops[i]) == params.k else 1
                found, scores = best_positions(lists, own, weights, params.k, floor, tie)
                if len(found):
                    names = ids.take(pa.array(found)).to_pylist()
                    tops[i] = sorted(
                        tops[i] + [(-s, d is None, d) for s, d in zip(scores.tolist(), names)],
                        key=lambda t: t[:2] if t[1] else t)[:params.k]

        for batch in batches:
            of_ids = batch.column(0).type
            weight_of = max(1, batch.nbytes // 8)
            step = max(1, batch.num_rows * shard // weight_of)
            for begin in range(0, batch.num_rows, step):
                piece = batch.slice(begin, step)
                held.append(piece)
                size += weight_of * piece.num_rows // batch.num_rows
                if size >= shard:
                    run()
                    held, size = [], 0
        if held:
            run()
        rows = [(i, d, -s) for i, top in enumerate(tops) for s, _, d in top]
        if rows:
            item, doc, score = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array(doc, of_ids), pa.array(score, pa.int64())], names=schema.names)

    return postings.mapInArrow(releasing(search), schema)


def _first(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(items: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """The stored items with a block number, and how many blocks there are."""
    rows = stored(items)
    total = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    while True:
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
        sums = dealt.groupBy("block").agg(F.sum(F.octet_length("body")).alias("size"), F.count_distinct("item_id").alias("ids"))
        # A block of one item cannot be made smaller.
        if blocks == 1 or sums.where((F.col("size") > 2 * block_bytes) & (F.col("ids") > 1)).isEmpty():
            return dealt, blocks
        blocks *= 2


def ranked_search(
    docs: DataFrame, items: DataFrame, params: RankParams = RankParams(), id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES, shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's best documents, equal scores by ascending doc_id, null last.

    Texts without a term, null and empty ones among them, are no documents and no queries. Rows that
    repeat an item id are one item with the terms of all of them, null ids too; rows that repeat a
    document id are ranked one by one. Terms of a very long text are counted in one go. Other
    columns are ignored, whatever their names. Empty tables give no rows.

    The items are taken in blocks of bounded size. For each block the documents are read once, and
    only the postings of its terms are stored. Every task then runs the Best Position Algorithm over
    shards of its documents, with the k-th score of its earlier shards as the first bound; at most k
    documents per item and task are compared in the end, in two steps.
    """
    spark = docs.sparkSession
    # The id stays as it is; its number within the block stands for it in tasks.
    dealt, blocks = _blocks(items.select(
        F.col(item_col).alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).cast("binary").alias("body")), block_bytes)
    id_type = items.schema[item_col].dataType
    schema = T.StructType([
        T.StructField("item_id", id_type), T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.LongType())])
    results = []
    for block in range(blocks):
        terms: dict = {}
        for row in dealt.where(F.col("block") == block).toLocalIterator():
            terms.setdefault(row["item_id"], set()).update(terms_of(bytes(row["body"])))
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*terms.values())))}
        if not vocabulary:
            continue
        held = spark.sparkContext.broadcast(vocabulary)
        postings = stored(_postings(docs, held, id_col, text_col))
        documents, length = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not documents:
            continue
        df = _frequencies(postings, len(vocabulary))
        weights = np.array([weight(documents, int(n)) for n in df], np.int64)
        names = list(terms)
        owned = [np.array(sorted(vocabulary[t] for t in terms[name]), np.int32) for name in names]
        queries = spark.sparkContext.broadcast(([(own, weights[own]) for own in owned], documents, length))
        found = _best_of_tasks(postings, queries, params, shard_postings)
        part = F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_PARTS))
        best = _first(_first(found.withColumn("part", part), ["item", "part"], params.k), ["item"], params.k)
        known = spark.createDataFrame([(i, n) for i, n in enumerate(names)], T.StructType([
            T.StructField("item", T.IntegerType()), T.StructField("item_id", id_type)]))
        results.append(best.join(F.broadcast(known), "item").select(*schema.names))
    if not results:
        return spark.createDataFrame([], schema)
    out = results[0]
    for more in results[1:]:
        out = out.unionAll(more)
    return out
