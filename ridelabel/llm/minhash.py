"""Near duplicates: banded MinHash candidates, sequential Bayesian pruning, exact confirmation."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelabel.llm.common import releasing, semi, small_enough, stored
from ridelabel.llm.components import components

#: Members of a bucket that are compared in one task; larger buckets are cut into pairs of parts.
BUCKET_ROWS = 4096
#: Bytes of text that are compared in one task; larger families are cut into parts.
PART_BYTES = 4 << 20
#: Documents of a large family that every one of its parts gets.
ANCHORS = 32


@dataclass(frozen=True)
class MinHashParams:
    """A pair at the threshold shares no band with probability (1 - threshold^rows)^bands, 3e-7 by
    default. `miss` is the posterior probability of a link below which a pair is dropped."""

    shingle: int = 2
    percent: int = 80
    bands: int = 50
    rows: int = 6
    batch: int = 25
    miss: float = 1e-6
    seed: int = 7

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


class _WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _finished(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Sketcher:
    """Shingle hashes of a text, and the MinHash values of a set of them."""

    def __init__(self, params: MinHashParams):
        draw = np.random.default_rng(params.seed)
        self.params, self.words = params, _WordHashes()
        self.powers = draw.integers(1, 2**63, max(params.shingle, 2), np.uint64) * np.uint64(2) + np.uint64(1)
        self.factors = draw.integers(1, 2**31, params.hashes, np.uint32) * np.uint32(2) + np.uint32(1)
        self.terms = draw.integers(0, 2**32, params.hashes, np.uint32)
        self.mixers = draw.integers(1, 2**63, (params.bands, params.rows), np.uint64) * np.uint64(2) + np.uint64(1)

    def shingles(self, text: bytes | None) -> np.ndarray:
        """Distinct hashes, sorted: one per run of `shingle` words; fewer words are one run."""
        words = (text or b"").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        k, n = self.params.shingle, len(words)
        ids = np.fromiter(map(self.words.__getitem__, words), np.uint64, n)
        if n < k:
            return _finished(np.sum(ids * self.powers[:n], keepdims=True, dtype=np.uint64) + np.uint64(n))
        out = ids[:n - k + 1] * self.powers[0]
        for j in range(1, k):
            out += ids[j:n - k + 1 + j] * self.powers[j]
        return np.unique(_finished(out))

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        x, least = (shingles >> np.uint64(32)).astype(np.uint32), np.full(len(self.factors), 2**32 - 1, np.uint32)
        for i in range(0, len(x), 512):
            values = x[i:i + 512, None] * self.factors
            values += self.terms
            np.minimum(least, values.min(0), out=least)
        return least

    def bands(self, minima: np.ndarray) -> np.ndarray:
        values = (minima.reshape(self.mixers.shape).astype(np.uint64) + np.uint64(1)) * self.mixers
        return _finished(values.sum(1, dtype=np.uint64)).view(np.int64)

    @staticmethod
    def bytes_of(minima: np.ndarray) -> np.ndarray:
        """One byte of each value: two different values agree with probability 1/256."""
        return ((minima * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


@lru_cache
def needed_matches(params: MinHashParams) -> tuple[tuple[int, int], ...]:
    """(compared, least matches) after each batch: with fewer, the posterior probability that the
    similarity reaches the threshold is below `miss`. The prior is uniform."""
    s = (np.arange(20_000) + 0.5) / 20_000
    agree = s + (1 - s) / 256
    above = s * 100 >= params.percent
    out = []
    for n in range(params.batch, params.hashes + 1, params.batch):
        low = 0
        for m in range(n + 1):
            log = m * np.log(agree) + (n - m) * np.log1p(-agree)
            mass = np.exp(log - log.max())
            if mass[above].sum() >= params.miss * mass.sum():
                low = m
                break
        out.append((n, low))
    return tuple(out)


def likely(params: MinHashParams, one: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which of the other signatures may belong to sets similar enough, batch by batch."""
    alive = np.flatnonzero((100 * np.minimum(sizes, size) >= params.percent * np.maximum(sizes, size)))
    matches, done = np.zeros(len(alive), np.int64), 0
    for n, low in needed_matches(params):
        matches += (others[alive, done:n] == one[done:n]).sum(1)
        done = n
        keep = matches >= low
        alive, matches = alive[keep], matches[keep]
        if not len(alive):
            break
    out = np.zeros(len(sizes), bool)
    out[alive] = True
    return out


def forest(size: int, near: Callable[[int, np.ndarray], np.ndarray], groups: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Edges that connect what `near` connects, no more than one per member. Each member is only
    compared with those that are not reached yet. Members of one group count as connected."""
    left = np.arange(size)
    while len(left):
        queue, left = [left[0]], left[1:]
        if groups is not None:
            same = groups[left] == groups[queue[0]]
            queue, left = queue + list(left[same]), left[~same]
        while queue and len(left):
            at = queue.pop()
            hit = near(at, left)
            for x in left[hit]:
                yield int(at), int(x)
            found, left = list(left[hit]), left[~hit]
            if groups is not None and found:
                same = np.isin(groups[left], groups[found])
                found, left = found + list(left[same]), left[~same]
            queue += found


def grouped(frame: DataFrame, keys: list[str], work: Callable[[], Callable[[pa.Table], list[tuple]]], schema: str) -> DataFrame:
    """Groups of bounded size, one after another: sorted partitions are read as a stream."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        do, held, last = work(), [], None

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                rows = do(pa.Table.from_batches(held))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

        for part in parts:
            if not part.num_rows:
                continue
            own = np.stack([part.column(k).to_numpy() for k in keys])
            cuts = [0, *(np.flatnonzero((own[:, 1:] != own[:, :-1]).any(0)) + 1), part.num_rows]
            for begin, end in zip(cuts, cuts[1:]):
                if last is not None and tuple(own[:, begin]) != last:
                    yield from flush()
                    held = []
                last = tuple(own[:, begin])
                held.append(part.slice(begin, end - begin))
        yield from flush()

    return frame.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(releasing(run), schema)


def features(docs: DataFrame, params: MinHashParams, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, set_hash, sketch, bands) of every row; empty sets have no bands."""
    def compute(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(params)
        for part in parts:
            sizes, digests, sketches, bands = [], [], [], []
            for text in part.column(1):
                shingles = sketcher.shingles(text.as_py())
                sizes.append(len(shingles))
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                if len(shingles):
                    minima = sketcher.minima(shingles)
                    sketches.append(sketcher.bytes_of(minima).tobytes())
                    bands.append(sketcher.bands(minima))
                else:
                    sketches.append(b"")
                    bands.append(np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_hash", "sketch", "bands"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return source.mapInArrow(releasing(compute), "doc_id long, n_shingles long, set_hash binary, sketch binary, bands array<long>")


def _bucket_members(unique: DataFrame, params: MinHashParams) -> DataFrame:
    """(band, part, doc_id, n_shingles, sketch) of buckets with two or more members.

    A bucket above BUCKET_ROWS is cut by a hash of the id; each pair of parts meets in one task.
    """
    banded = unique.select("doc_id", F.explode("bands").alias("band"))
    sizes = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = stored(sizes.select("band", F.ceil(F.col("n") / BUCKET_ROWS).cast("long").alias("parts")))
    narrow = banded.join(F.broadcast(buckets) if small_enough(buckets) else buckets, "band")
    members = narrow.join(unique.select("doc_id", "n_shingles", "sketch"), "doc_id")
    return members.withColumn("part", F.explode(_pairs_of_parts(F.pmod(F.xxhash64("doc_id"), "parts"), F.col("parts")))) \
        .select("band", "part", "doc_id", "n_shingles", "sketch")


def _pairs_of_parts(own: Column, parts: Column) -> Column:
    """Numbers of the pairs of parts that a member of part `own` belongs to."""
    others = F.sequence(F.lit(0).cast("long"), parts - 1)
    pairs = F.transform(others, lambda x: F.least(own, x) * parts + F.greatest(own, x))
    return F.when(parts == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.array_distinct(F.filter(pairs, lambda p: (F.floor(p / parts) != p % parts))))


def candidate_links(unique: DataFrame, params: MinHashParams) -> DataFrame:
    """(a, b): a forest over each bucket's pairs that survive the Bayesian comparison."""
    def work():
        def search(table: pa.Table) -> list[tuple]:
            ids, sizes = table.column("doc_id").to_numpy(), table.column("n_shingles").to_numpy()
            sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(ids), -1)
            near = lambda at, left: likely(params, sketches[at], sizes[at], sketches[left], sizes[left])
            return [(int(ids[i]), int(ids[j])) for i, j in forest(len(ids), near)]

        return search

    return grouped(_bucket_members(unique, params), ["band", "part"], work, "a long, b long")


def _confirmer(params: MinHashParams, with_groups: bool) -> Callable:
    """Links inside a part of a family: sets of the words themselves are intersected."""
    def work():
        sketcher = Sketcher(params)

        def confirm(table: pa.Table) -> list[tuple]:
            ids, texts = table.column("doc_id").to_numpy(), table.column("text").to_pylist()
            numbers: dict[tuple[bytes, ...], int] = {}
            sets, sketches = [], []
            for text in texts:
                words = (text or b"").lower().split()
                k = min(params.shingle, len(words))
                runs = zip(*(words[j:] for j in range(k)))
                sets.append(np.unique(np.array([numbers.setdefault(r, len(numbers)) for r in runs], np.int64)))
                sketches.append(sketcher.bytes_of(sketcher.minima(sketcher.shingles(text))))
            sizes, sketches = np.array([len(s) for s in sets]), np.stack(sketches)

            def near(at: int, left: np.ndarray) -> np.ndarray:
                hit = likely(params, sketches[at], sizes[at], sketches[left], sizes[left])
                for j in np.flatnonzero(hit):
                    both = len(np.intersect1d(sets[at], sets[left[j]], assume_unique=True))
                    hit[j] = 100 * both >= params.percent * (sizes[at] + sizes[left[j]] - both)
                return hit

            groups = table.column("component").to_numpy() if with_groups else None
            return [(int(ids[i]), int(ids[j])) for i, j in forest(len(ids), near, groups) if ids[i] != ids[j]]

        return confirm

    return work


def confirmed_links(docs: DataFrame, families: DataFrame, params: MinHashParams) -> DataFrame:
    """(a, b): links that connect all that is linked inside each family of (node, component).

    A family within PART_BYTES is one task. A larger one is cut into parts, each with the same
    anchors, and linked part by part. Members that are then outside the family's largest component
    are few where copies are close; they meet all parts in a second round.
    """
    members = stored(families.select(F.col("node").alias("doc_id"), F.col("component").alias("family")))
    texts = semi(docs, members.select("doc_id"), "doc_id") \
        .select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    owned = stored(texts.join(members, "doc_id"))
    weights = owned.groupBy("family").agg(
        F.ceil(F.sum(F.octet_length("text")) / PART_BYTES).cast("long").alias("parts"), F.count(F.lit(1)).alias("n"))
    weights = stored(weights.select("family", F.greatest(F.lit(1).cast("long"), "parts").alias("parts"), "n"))
    dealt = owned.join(F.broadcast(weights) if small_enough(weights) else weights, "family").withColumns({
        "own": F.pmod(F.xxhash64("doc_id"), "parts"),
        # About ANCHORS members, by a hash of the id.
        "anchor": (F.col("parts") > 1) & (F.pmod(F.xxhash64("doc_id", F.lit(1)), "n") < ANCHORS)})
    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    first = dealt.withColumn("part", F.explode(F.when(F.col("anchor"), every).otherwise(F.array("own"))))
    links = stored(grouped(
        first.select("family", "part", "doc_id", "text"), ["family", "part"], _confirmer(params, False), "a long, b long"))

    large = dealt.where("parts > 1")
    if large.isEmpty():
        return links
    known = components(links)
    labelled = large.join(known.withColumnRenamed("node", "doc_id"), "doc_id", "left") \
        .withColumn("component", F.coalesce("component", "doc_id"))
    labelled = stored(labelled.select("family", "parts", "own", "doc_id", "text", "component"))
    sizes = labelled.groupBy("family", "component").agg(F.count(F.lit(1)).alias("m"))
    main = sizes.groupBy("family").agg(F.max_by("component", F.struct("m", "component")).alias("main"))
    flagged = labelled.join(stored(main), "family").withColumn("rest", F.col("component") != F.col("main"))
    loose = flagged.where("rest").groupBy("family").agg(
        F.ceil(F.sum(F.octet_length("text")) / PART_BYTES).cast("long").alias("loose"))
    paired = flagged.join(stored(loose), "family").withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(2)), "loose"))
    # Every part of the family meets every part of the loose members.
    meets = paired.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("loose") - 1)).alias("with")) \
        .select("family", (F.col("own") * F.col("loose") + F.col("with")).alias("part"), "doc_id", "text", "component")
    joins = paired.where("rest").select("*", F.explode(every).alias("to")).where("to != own") \
        .select("family", (F.col("to") * F.col("loose") + F.col("half")).alias("part"), "doc_id", "text", "component")
    more = grouped(
        meets.unionAll(joins), ["family", "part"], _confirmer(params, True), "a long, b long")
    return links.unionAll(stored(more))


def near_duplicates(
    docs: DataFrame, params: MinHashParams = MinHashParams(), id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    A document's set holds its distinct runs of `shingle` words (A-Z lower-cased, cut at white
    space); fewer words are one run. Documents are linked if 100 * intersection >= percent * union;
    a component is named by its smallest id, whose row is kept. Null and empty texts have an empty
    set and are linked with nothing. Rows that repeat an id are one document: they are in one
    component, and all kept if that is theirs. Rows without id are linked with nothing and kept,
    their component is null. An empty table gives no rows; other columns are ignored.

    1. Documents with the same set (by a 128-bit hash) are represented by one of them.
    2. Buckets of equal bands give candidates. Signatures are compared batch by batch until the
       posterior probability of a link falls below `miss`. A bucket yields a forest, never all pairs.
    3. Candidates connected in this way form families. Inside a family the sets themselves are
       compared, as far as their documents are not connected yet, and the links kept.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = stored(features(rows, params))
    filled = known.where("n_shingles > 0 and doc_id is not null")
    classes = stored(filled.groupBy("set_hash").agg(F.min("doc_id").alias("rep")))
    reps = classes.select("set_hash", F.col("rep").alias("doc_id"))
    unique = semi(filled, reps, ["set_hash", "doc_id"])
    families = components(stored(candidate_links(unique, params)))
    links = confirmed_links(rows, families, params)

    # An id on rows of several classes ties these together.
    owned = filled.select("doc_id", "set_hash").join(classes, "set_hash").select("doc_id", "rep")
    tied = owned.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"), F.count(F.lit(1)).alias("n")).where("a != b")
    every = owned.join(tied.select("doc_id", "a"), "doc_id").select("a", F.col("rep").alias("b"))
    labels = components(links.unionAll(every))
    named = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("set_hash", F.coalesce("component", "rep").alias("component"))
    found = known.select("doc_id", "n_shingles", "set_hash").join(named, "set_hash", "left")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return found.select(
        "doc_id", "n_shingles",
        F.when(linked, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
