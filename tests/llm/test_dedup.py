"""Exact, line and near duplicates."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from ridelabel.llm.components import components
from ridelabel.llm.exact_dedup import exact_dedup
from ridelabel.llm.line_dedup import PerfectHash, line_dedup
from ridelabel.llm import common, minhash
from ridelabel.llm import components as components_module
from ridelabel.llm import exact_dedup as exact_module
from ridelabel.llm.minhash import MinHashParams, near_duplicates
from tests.llm.plain import near


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_exact_groups_ties_nulls_and_long_texts(frame):
    long = "word " * 50_000
    rows = [(5, "a b"), (3, "ab"), (4, "a\tb"), (9, None), (8, ""), (7, " \n"), (1, long), (2, long.replace(" ", "\n")), (None, "ab"), (6, "é")]
    got = {r.doc_id: r for r in exact_dedup(frame(rows)).collect()}
    assert len(got) == len(rows)
    assert {i: (got[i].keep_id, got[i].group_size, got[i].kept) for i in got} == {
        5: (4, 4, False), 3: (4, 4, False), 4: (4, 4, True), None: (4, 4, False), 9: (7, 3, False), 8: (7, 3, False),
        7: (7, 3, True), 1: (1, 2, True), 2: (1, 2, False), 6: (6, 1, True)}
    assert got[5].text_sha256 == _sha("ab") and got[9].text_sha256 == _sha("")


def test_exact_repeated_rows_and_empty_table(frame):
    rows = exact_dedup(frame([(1, "x"), (1, "x"), (2, "x y")])).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in rows) == [(1, 1, 2, True), (1, 1, 2, True), (2, 2, 1, True)]
    assert exact_dedup(frame([])).count() == 0


def test_exact_compares_bytes_when_hashes_collide(frame):
    rows = [(i, f"{'ab'[i % 2]} {i % 3}") for i in range(12)] + [(20, "alone")]
    weak = exact_dedup(frame(rows), hashed=lambda text: F.substring(text, 1, 1).cast("binary"))
    strong = exact_dedup(frame(rows))
    assert sorted(map(tuple, weak.collect())) == sorted(map(tuple, strong.collect()))


def test_perfect_hash_is_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 50_000, np.uint64))
    index = PerfectHash(keys)
    assert sorted(index.numbers(keys)) == list(range(len(keys)))
    assert len(PerfectHash(keys[:0]).numbers(keys[:3])) == 3


def _lines(rows, least):
    keys = {}
    for n, (_, text) in enumerate(rows):
        for key in {x.strip(" \t\n\x0b\x0c\r") for x in (text or "").split("\n")}:
            key = "".join(c.lower() if "A" <= c <= "Z" else c for c in key)
            keys.setdefault(key, set()).add(n)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        fold = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
        left = [x for x in lines if not fold(x) or len(keys[fold(x)]) < least]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=repr)


def test_lines_equal_plain_version_in_one_and_in_many_rounds(frame):
    draw = random.Random(3)
    rows = [(i, "\n".join(draw.choice(["", " Same", "same\t", "É x", "é x", "own %d" % i, "B%d" % draw.randrange(4)]) for _ in range(draw.randrange(6))))
            for i in range(40)] + [(100, None), (101, ""), (7, "Same\nSame"), (102, "same\n" * 20_000 + "end")]
    want = _lines(rows, 5)
    one = line_dedup(frame(rows), min_docs=5)
    many = line_dedup(frame(rows), min_docs=5, shard_keys=2, round_bytes=1)
    for got in (one, many):
        assert sorted((tuple(r) for r in got.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr) == want


def test_lines_of_an_empty_table(frame):
    assert line_dedup(frame([])).count() == 0


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _families(seed):
    """Copies with a growing number of changed words, so that many pairs are near the threshold."""
    draw, rows = random.Random(seed), []
    for f in range(12):
        base = [f"w{draw.randrange(400)}" for _ in range(draw.choice([1, 2, 3, 8, 40, 120]))]
        for _ in range(draw.randrange(1, 9)):
            copy = [w if draw.random() > 0.06 else "x%d" % draw.randrange(9) for w in base]
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    return rows + [(1000, None), (1001, ""), (1002, " \t"), (1003, "One"), (1004, "one"), (1005, "long " * 30_000)]


def test_near_duplicates_equal_plain_version(frame):
    rows = _families(5)
    for params in (MinHashParams(), MinHashParams(shingle=5)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame(rows), params).collect()}
        assert got == near(rows, params.shingle)


def test_near_duplicates_cut_large_buckets_and_families(frame, monkeypatch):
    monkeypatch.setattr(minhash, "BUCKET_ROWS", 5)
    monkeypatch.setattr(minhash, "PART_BYTES", 600)
    monkeypatch.setattr(minhash, "ANCHORS", 2)
    draw = random.Random(2)
    base = [f"w{draw.randrange(400)}" for _ in range(60)]
    rows = [(i, " ".join(w if draw.random() > 0.05 else "x%d" % draw.randrange(50) for w in base)) for i in range(45)] + _families(6)[:20]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame(rows)).collect()}
    assert got == near(rows)


def test_near_duplicates_nulls_repeats_and_empty_table(frame):
    rows = [(5, "a b c d e f"), (5, "g h i j k l"), (3, "g h i j k l"), (None, "a b c d e f"), (7, "a b c d e f")]
    got = sorted(map(tuple, near_duplicates(frame(rows)).collect()), key=repr)
    assert got == sorted([(5, 5, 3, False), (5, 5, 3, False), (3, 5, 3, True), (None, 5, None, True), (7, 5, 3, False)], key=repr)
    assert near_duplicates(frame([])).count() == 0


def test_shuffled_joins_give_the_same_result_as_broadcasts(frame, monkeypatch):
    rows = _families(7)
    near_want = near(rows)
    exact_want = sorted(map(tuple, exact_dedup(frame(rows)).collect()), key=repr)
    for module in (common, components_module, exact_module, minhash):
        monkeypatch.setattr(module, "small_enough", lambda *_: False)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame(rows)).collect()} == near_want
    assert sorted(map(tuple, exact_dedup(frame(rows)).collect()), key=repr) == exact_want
