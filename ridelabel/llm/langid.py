"""Language identification with bit-sliced Bloom filters of character trigrams."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelabel.llm.common import once_a_text, python_columns, releasing, stored, text_key, with_parts

UNKNOWN = "und"
#: Languages in one word of a filter row.
WORD = 63
#: Characters that are looked at together.
CHUNK_CHARS = 500_000
#: Trigrams of all languages that a task adds up before it sends them on.
TASK_KEYS = 2_000_000


@dataclass(frozen=True)
class LangIdParams:
    """`share`: a trigram is in a language's filter if it is at least this share as frequent there
    as in the language where it is most frequent. A filter has `slots_per_gram` slots for each trigram.
    Beyond `most_slots` slots (over all words of a row) trigrams are dealt to several filters by hash, one
    round over the texts each. `hashes` are the probes per trigram."""

    share: float = 0.2
    slots_per_gram: int = 16
    most_slots: int = 1 << 22
    hashes: int = 3


@lru_cache
def _letters() -> np.ndarray:
    """The code point itself for letters, 0 for everything else."""
    return np.array([c if unicodedata.category(chr(c))[0] == "L" else 0 for c in range(0x110000)], np.uint64)


def _pieces(texts: list[str | None]) -> Iterator[slice]:
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= CHUNK_CHARS:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of lower-cased letters, words padded by one blank; the text that each belongs to."""
    own = [(t or "").lower() + "\n" for t in texts]
    codes = np.frombuffer("".join(["\n", *own]).encode("utf-32-le", "replace"), np.uint32)
    codes = _letters()[codes]
    owner = np.concatenate([[0], np.repeat(np.arange(len(own)), [len(t) for t in own])])
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0)
    codes, owner = codes[keep], owner[keep]
    if len(codes) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    middle = codes[1:-1] > 0
    grams = (codes[:-2] << np.uint64(42)) | (codes[1:-1] << np.uint64(21)) | codes[2:]
    return grams[middle], owner[1:-1][middle]


def _slots(grams: np.ndarray, probe: int, slots: int) -> np.ndarray:
    x = grams * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03 * (probe + 1) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(29))) & np.uint64(slots - 1)).astype(np.int64)


def gram_counts(texts: DataFrame, languages: list[str]) -> DataFrame:
    """(gram, lang number, n) over (lang, text): each task's counts added up before they are sent."""
    number = {lang: i for i, lang in enumerate(languages)}

    def count(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {i: (np.zeros(0, np.uint64), np.zeros(0, np.int64)) for i in number.values()}
        for part in parts:
            langs = np.array([number[x] for x in part.column(0).to_pylist()])
            texts = part.column(1).to_pylist()
            for piece in _pieces(texts):
                grams, owner = trigrams(texts[piece])
                lang = langs[piece][owner]
                for i in np.unique(lang):
                    new, n = np.unique(grams[lang == i], return_counts=True)
                    keys, at = np.unique(np.concatenate([sums[i][0], new]), return_inverse=True)
                    sums[i] = keys, np.bincount(at, np.concatenate([sums[i][1], n]), len(keys)).astype(np.int64)
                if sum(len(keys) for keys, _ in sums.values()) > TASK_KEYS:
                    for i, (keys, n) in sums.items():
                        yield packed(i, keys, n)
                        sums[i] = keys[:0], n[:0]
        for i, (keys, n) in sums.items():
            if len(keys):
                yield packed(i, keys, n)

    def packed(lang: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), lang, np.int32)), pa.array(n)],
            names=["gram", "lang", "n"])

    return texts.mapInArrow(releasing(count), "gram long, lang int, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n"))


class Filters:
    """Bloom filters of all languages, sliced so that one row holds a slot's bit of each language.

    `shard` of `shards`: the filters hold the trigrams that fall there by hash, and judge only those.
    """

    def __init__(self, n_languages: int, rows: np.ndarray, hashes: int, shard: int = 0, shards: int = 1):
        self.n_languages, self.rows, self.hashes, self.shard, self.shards = n_languages, rows, hashes, shard, shards
        fill = [((rows[:, i // WORD] >> (i % WORD)) & 1).mean() for i in range(n_languages)]
        self.false = np.array(fill) ** hashes

    def matches(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, languages) trigrams found in each language's filter, and all judged trigrams of each text."""
        found, total = np.zeros((len(texts), self.n_languages)), np.zeros(len(texts))
        for piece in _pieces(texts):
            grams, owner = trigrams(texts[piece])
            if self.shards > 1:
                mine = _shard(grams, self.shards, self.hashes) == self.shard
                grams, owner = grams[mine], owner[mine]
            size = piece.stop - piece.start
            total[piece] = np.bincount(owner, minlength=size)
            for word in range(self.rows.shape[1]):
                column = self.rows[:, word]
                mask = column[_slots(grams, 0, len(column))]
                for probe in range(1, self.hashes):
                    mask &= column[_slots(grams, probe, len(column))]
                for i in range(word * WORD, min(self.n_languages, (word + 1) * WORD)):
                    bit = ((mask >> np.array(i % WORD, mask.dtype)) & 1).astype(bool)
                    found[piece, i] = np.bincount(owner[bit], minlength=size)
        return found, total

    def evidence(self, texts: list[str | None]) -> np.ndarray:
        """A row per text: its judged trigrams; those found in each language less the false positives to
        expect if it has none of them; and the most that this can come to. Rows of all shards add up."""
        found, total = self.matches(texts)
        false = total[:, None] * self.false
        return np.concatenate([total[:, None], found - false, total[:, None] - false], 1)


def _shard(grams: np.ndarray, shards: int, hashes: int) -> np.ndarray:
    """A further hash than those of the slots; `shards` is a power of two."""
    return _slots(grams, hashes, shards)


@dataclass(frozen=True)
class LanguageModel:
    """`table` (shard, slot, word, bits) holds the filters of all shards, `usual` is the language learned from most."""

    languages: list[str]
    usual: str
    table: DataFrame | None
    slots: int
    shards: int
    hashes: int

    def filters(self, shard: int) -> Filters:
        """The filters of a shard: at most `most_slots` numbers come to the driver."""
        rows = np.zeros((self.slots, max(1, -(-len(self.languages) // WORD))), np.int64)
        if self.table is not None:
            table = self.table.where(F.col("shard") == shard).select("slot", "word", "bits").toArrow()
            rows[table.column("slot").to_numpy(), table.column("word").to_numpy()] = table.column("bits").to_numpy()
        if len(self.languages) <= 8:
            rows = rows.astype(np.uint8)
        return Filters(len(self.languages), rows, self.hashes, shard, self.shards)

    def decide(self, evidence: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The best language and its share, given a row of summed evidence for each text."""
        n = len(self.languages)
        total, net, room = evidence[:, 0], evidence[:, 1:n + 1], evidence[:, n + 1:]
        share = np.clip(net / np.maximum(room, 1e-9), 0, 1)
        best = share.argmax(1) if n else np.zeros(len(total), np.int64)
        names, scores = [], np.zeros(len(total))
        for d, i in enumerate(best):
            if not total[d] or not n:
                names.append(UNKNOWN)
                continue
            scores[d] = share[d, i]
            names.append(self.languages[i] if scores[d] > 0 else self.usual)
        return names, scores


def fit(texts: DataFrame, params: LangIdParams = LangIdParams()) -> LanguageModel:
    """Filters from all rows of (lang, text); null languages are left out.

    Frequencies are Spark aggregates over whole texts. Each slot of a filter is made by or-ing the
    languages of the trigrams that fall there; the filters of all shards are written as one table.
    """
    known = texts.where("lang is not null")
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").collect()
    languages = sorted((r["lang"] for r in sizes), key=str.encode)
    if not languages:
        return LanguageModel([], UNKNOWN, None, 1, 1, params.hashes)
    counts = stored(gram_counts(known.select("lang", "text"), languages))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rates = counts.join(F.broadcast(totals), "lang").withColumn("rate", F.col("n") / F.col("total"))
    most = rates.groupBy("gram").agg(F.max("rate").alias("most"))
    member = stored(rates.join(most, "gram").where(F.col("rate") >= F.col("most") * params.share).select("gram", "lang"))
    grams = member.select("gram").distinct().count()
    room = params.most_slots // -(-len(languages) // WORD)
    slots = shards = 1
    while slots * shards < grams * params.slots_per_gram:
        if 2 * slots <= room:
            slots *= 2
        else:
            shards *= 2

    def place(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keys, lang = part.column(0).to_numpy().view(np.uint64), part.column(1).to_numpy()
            bit = np.left_shift(np.int64(1), (lang % WORD).astype(np.int64))
            shard = _shard(keys, shards, params.hashes)
            for probe in range(params.hashes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), pa.array(_slots(keys, probe, slots)), pa.array((lang // WORD).astype(np.int32)), pa.array(bit)],
                    names=["shard", "slot", "word", "bits"])

    placed = member.mapInArrow(releasing(place), "shard long, slot long, word int, bits long")
    merged = placed.groupBy("shard", "slot", "word").agg(F.bit_or("bits").alias("bits"))
    table = stored(merged.sortWithinPartitions("shard", "slot"))
    return LanguageModel(languages, sizes[0]["lang"], table, slots, shards, params.hashes)


def held_out(id_col: str = "doc_id"):
    """Documents that nothing is learned from; a row without id is none of them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, model: LanguageModel, keep: list[str], text_col: str = "text") -> DataFrame:
    """`keep` columns, lang_pred and score. `und`, with score 0, if the text is null or has no letter
    (or nothing was learned). A text with letters of which none of the filters knows a trigram gets
    the language learned from most often, with score 0. Equal shares go to the first language by name.

    One shard is one scan. With several, each shard's filter passes over the texts and writes its
    evidence, some numbers a text, which is then added up."""
    fields = "lang_pred string, score double"
    spark, text = docs.sparkSession, {"text": F.col("_text")}
    # What the tasks decide with; the table stays with the driver.
    names = replace(model, table=None)
    rows = docs.select(*keep, F.col(text_col).alias("_text"))
    if model.shards == 1:
        held = spark.sparkContext.broadcast(model.filters(0))
        return python_columns(rows, _decider(names, held), fields, text, keep)
    rows = rows.withColumn("_key", text_key(F.col("_text")))
    rounds = []
    for shard in range(model.shards):
        held = spark.sparkContext.broadcast(model.filters(shard))
        rounds.append(once_a_text(python_columns(rows, _witness(held), "_part array<double>", text, ["_key"])))
    parted = with_parts(rows.drop("_text"), rounds)
    return python_columns(parted, _decider(names), fields, {"parts": F.col("_parts")}, keep)


def _witness(held) -> Callable:
    def make():
        def witness(batch: dict[str, pa.Array]) -> dict[str, pa.Array]:
            evidence = held.value.evidence(batch["text"].to_pylist())
            return {"_part": pa.array(list(evidence), pa.list_(pa.float64()))}

        return witness

    return make


def _decider(names: LanguageModel, held=None) -> Callable:
    """Decides by the evidence of all rounds, or by what the only filter finds now."""
    def make():
        def decide(batch: dict[str, pa.Array]) -> dict[str, pa.Array]:
            if held is not None:
                evidence = held.value.evidence(batch["text"].to_pylist())
            else:
                evidence = np.array([np.sum(parts, 0) for parts in batch["parts"].to_pylist()])
            langs, scores = names.decide(evidence)
            return {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores)}

        return decide

    return make


def identify(docs: DataFrame, params: LangIdParams = LangIdParams()) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, lang_pred, score.

    Learns from text and non-null lang of the rows with an id that are not held out; other columns
    are ignored. Rows that repeat an id are judged one by one. An empty table gives no rows.
    """
    marked = docs.select("doc_id", held_out().alias("held_out"), "lang", "text")
    model = fit(marked.where("not held_out and doc_id is not null").select("lang", "text"), params)
    return predict(marked, model, ["doc_id", "held_out"])
