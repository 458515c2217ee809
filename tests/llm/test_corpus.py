"""Mixing, URL verdicts, the registered queries and the pipeline."""

import hashlib
import random
import re
from collections import Counter
from math import asin, pi, sqrt

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ridelabel.llm import oracles, queries
from ridelabel.llm.mixing import Curriculum, mix
from ridelabel.llm.urls import ReputationParams, chance_above, judge_urls, registered_domain, reputations, site_of
from tests.compare import compare, connect
from tests.llm import plain
from tests.llm.test_dedup import _lines
from tests.llm.test_text import _contamination


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, queries.queries()[name], oracles.oracle_sql()[name]) is None


def test_rows_that_repeat_an_id_count_as_documents_in_lines_and_sql(spark, tmp_path):
    rows = [(7, "shared\nown")] * 10 + [(i, f"other {i}\nShared ") for i in range(3)] + [(20, None), (20, "\n")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    query = queries.queries()["op5_line_dedup"]
    assert compare(spark, con, str(tmp_path), query, oracles.oracle_sql()["op5_line_dedup"]) is None
    assert sorted((r.doc_id, r.n_dropped) for r in query(spark, str(tmp_path)).collect()) == [
        (0, 1), (1, 1), (2, 1), *[(7, 2)] * 10, (20, 0), (20, 0)]


def test_every_operator_is_registered():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] and set(oracles.oracle_sql()) < set(names)


def _plain_mix(rows, plan):
    """doc_id -> (size, source_size, target, taken) by filling up sources again and again."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _, _ in rows}
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(size[i] for i, _, _, x in rows if x == s) for s in sources}
    weight = {s: plan.weights[n % len(plan.weights)] for n, s in enumerate(sources)}
    target, left = {s: 0.0 for s in sources}, plan.budget * sum(total.values())
    while left > 1e-9:
        open_ = [s for s in sources if target[s] < plan.most * total[s] - 1e-9]
        if not open_:
            break
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in open_:
            target[s] += share * weight[s]
            left += max(0.0, target[s] - plan.most * total[s])
            target[s] = min(target[s], plan.most * total[s])
    return {i: (size[i], total[s], target[s]) for i, _, _, s in rows}


def test_mix_targets_taken_and_positions(frame):
    rows = [(i, "w " * (i % 17), "en", "abcdef"[i % 6] if i % 11 else None) for i in range(200)] + [(900, None, "en", "a"), (901, "", None, "z"), (902, "w " * 40_000, None, "b")]
    for plan in (Curriculum(), Curriculum(weights=(9.0, 1.0), budget=1.9), Curriculum(budget=2.0)):
        got = {r.doc_id: r for r in mix(frame(rows), plan).collect()}
        want = _plain_mix(rows, plan)
        source = {i: s for i, _, _, s in rows}
        taken = {}
        for i, r in got.items():
            assert (r["size"], r.source_size) == want[i][:2] and r.target == pytest.approx(want[i][2])
            assert 0 <= r.taken <= 2 * r["size"] and (r.position is None) == (r.taken == 0)
            assert r.position is None or 0 <= r.position <= r.last_position <= 1
            taken[source[i]] = taken.get(source[i], 0) + r.taken
        assert all(abs(taken[source[i]] - r.target) < 1 for i, r in got.items())
    order = [r.position for r in mix(frame(rows)).collect() if r.position is not None]
    assert order == sorted(order)


def test_mix_reruns_repeats_and_empty_table(frame):
    rows = [(1, "a b c", None, "x"), (1, "a b c", None, "x"), (1, "a", None, "x"), (None, "a b", None, "y"), (None, "a b c d", None, None)]
    once, again = (sorted(map(tuple, mix(frame(rows, parts)).collect()), key=repr) for parts in (1, 4))
    assert once == again and len(once) == 5
    assert mix(frame([])).count() == 0


def test_url_parts_and_rules(spark):
    urls = [
        "http://A.example.NET/en/1?x#y", "https://net/x", "http://net?x", "x://b.net#/", "http://sub.example.com/de/", "http://example.com/den",
        "http://wiki.org/fr/a", "http://notorg/fr/", None, "no scheme", "://h/p", "http://u:p@Ä.Com:80/a b?c", "a://b://c/d", ""]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, urls[0], "h")], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([(0, 1), (None, 1), (3, None)], "page_id long, bad int")
    got = [(r.page_id, r.host, r.path, r["rule"], r.verdict) for r in judge_urls(pages, outcomes).collect()]
    want = [
        ("a.example.net", "/en/1", "example.net/en/", "allow"), ("net", "/x", "net/", "block"), ("net", "", None, "allow"), ("b.net", "", None, "allow"),
        ("sub.example.com", "/de/", "example.com/de/", "block"), ("example.com", "/den", None, "allow"), ("wiki.org", "/fr/a", "org/fr/", "allow"),
        ("notorg", "/fr/", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("h", "/p", None, "allow"), ("u:p@Ä.com:80", "/a b", None, "allow"),
        ("b:", "//c/d", None, "allow"), ("", "", None, "allow")]
    assert sorted(got, key=repr) == sorted([(i, *w) for i, w in enumerate(want)] + [(None, *want[0])], key=repr)
    assert judge_urls(pages.where("false"), outcomes.where("false")).count() == 0


def test_reputation_shrinks_through_domain_and_suffix(spark):
    rows = [(f"h{i}.good.com", 0) for i in range(30) for _ in range(10)] + [(f"h{i}.bad.com", 1) for i in range(30) for _ in range(10)]
    rows += [("new.bad.com", 1), ("new.good.com", 1), ("www.shop.co.uk", 0), ("localhost", 0), ("h1.good.com", None)]
    got = {r.host: r for r in reputations(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert got["h3.bad.com"].above > 0.95 and got["h3.good.com"].above is None
    assert got["new.bad.com"].bad_rate > 0.8 and got["new.good.com"].bad_rate < 0.5
    assert all(r.above is None or 0 <= r.above <= 1 for r in got.values()) and got["h1.good.com"].n == 10
    pages = spark.createDataFrame([(i, f"http://{h}/x") for i, (h, _) in enumerate(rows)], "page_id long, url string")
    outcomes = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(rows)], "page_id long, bad int")
    verdicts = {(r.host, r.verdict) for r in judge_urls(pages, outcomes, rules=(), params=ReputationParams()).collect()}
    assert ("h3.bad.com", "block") in verdicts and ("h3.good.com", "allow") in verdicts


def test_domains_and_suffixes_of_sites(spark):
    want = {
        "a.b.co.il": ("b.co.il", "co.il"), "x.example.com": ("example.com", "com"), "co.uk": ("co.uk", "uk"), "uk": ("uk", "uk"),
        "shop.gov.br": ("shop.gov.br", "gov.br"), "a.b.de": ("b.de", "de"), "10.1.2.3": ("10.1.2.3", "10.1.2.3"), "[::1]": ("[::1]", "[::1]"),
        "me.pages.host.io": ("me.pages.host.io", "pages.host.io"), "x.me.host.io": ("me.host.io", "host.io"), "": ("", ""), "1.2.3": ("2.3", "3")}
    rows = spark.createDataFrame([(h,) for h in want], "host string")
    domain, suffix = registered_domain(F.col("host"), ("host.io", "pages.host.io"))
    assert {r.host: (r.d, r.s) for r in rows.select("host", domain.alias("d"), suffix.alias("s")).collect()} == want
    sites = {"u:p@a.com:80": "a.com", "a.com.": "a.com", "a.com.:8": "a.com", "[::1]:80": "[::1]", "[::1]": "[::1]", "a": "a", ":80": ""}
    rows = spark.createDataFrame([(h,) for h in sites], "host string").select("host", site_of(F.col("host")).alias("s"))
    assert {r.host: r.s for r in rows.collect()} == sites


def test_posterior_probability_equals_fine_integration(spark):
    pairs = [(0.7, 0.4), (1.0, 1.0), (3.0, 2.0), (8.5, 0.5), (60.0, 41.0), (5_000.0, 4_900.0), (0.5, 30.0), (600_000.0, 599_000.0)]
    rows = spark.createDataFrame(pairs, "a double, b double").select("a", "b", chance_above(0.5, F.col("a"), F.col("b")).alias("p")).collect()
    for r in rows:
        mean, reach = asin(sqrt(r.a / (r.a + r.b))), 8 / sqrt(r.a + r.b + 1)
        x = np.linspace(max(mean - reach, 0), min(mean + reach, pi / 2), 2_000_001)
        x = (x[1:] + x[:-1]) / 2
        log = (2 * r.a - 1) * np.log(np.sin(x)) + (2 * r.b - 1) * np.log(np.cos(x))
        density = np.exp(log - log.max())
        assert r.p == pytest.approx(density[x > pi / 4].sum() / density.sum(), abs=0.004)


def test_planted_hosts_domains_and_suffixes_are_blocked_in_query_and_sql(spark, tmp_path):
    """One bad host of a good domain, a bad domain with a page seen once, a bad suffix with a new domain."""
    good, bad = "<p>" + "plain words here " * 9, "<p>" + "man*** gled%%% words!! " * 9
    urls = [(f"http://h{i % 5}.fine{i % 7}.{'com' if i % 2 else 'co.uk'}/{i}", good) for i in range(600)]
    urls += [(f"https://u@spoilt.fine1.com:8{i}/x", bad) for i in range(40)] + [(f"http://w{i}.worse.com/", bad) for i in range(40)]
    urls += [(f"http://w.d{i}.rotten/{j}", bad) for i in range(30) for j in range(4)]
    urls += [("http://seen.worse.com/once", bad), ("http://w.new.rotten/once", bad), ("http://h0.fine0.com/odd", bad),
             ("http://10.0.0.1/", "few words"), ("http://never.seen/", None), (None, good)]
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(urls)], "page_id long, url string, html string")
    pages.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    query, sql = queries.queries()["op1_url_filter"], oracles.oracle_sql()["op1_url_filter"]
    assert compare(spark, con, str(tmp_path), query, sql) is None
    blocked = {r.host.split("@")[-1].split(":")[0] for r in query(spark, str(tmp_path)).where("verdict = 'block'").collect()}
    assert {"spoilt.fine1.com", "w3.worse.com", "seen.worse.com", "w.d3.rotten", "w.new.rotten"} <= blocked
    assert not any(h.startswith("h") or h in ("10.0.0.1", "never.seen", "") for h in blocked)


def test_pipeline_stages_equal_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(corpus_pipeline.stored(stage(spark, frames[-1], sf_dir)))
    rows = [[(r.doc_id, r.text) for r in f.collect()] for f in frames[:-1]]
    assert all(f.columns == corpus_pipeline.DOCUMENT_COLUMNS for f in frames[:-1])

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {i for i, _ in rows[1]}
    good = [i for i, _ in rows[0] if labels.get(i) == 1]
    assert len(kept & set(good)) >= 0.97 * len(good) and kept < {i for i, _ in rows[0]}
    whole = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    assert kept == {i for i, stays in plain.quality(whole, labels.items()).items() if stays}

    assert sorted(rows[2]) == sorted((i, t) for i, t, *_ in _lines(rows[1], 10))
    near = plain.near(rows[2], k=5)
    assert {i for i, _ in rows[3]} == {i for i, (_, c) in near.items() if c == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    dirty = {r[0] for r in _contamination(rows[3], items) if r[-1]}
    assert {i for i, _ in rows[4]} == {i for i, _ in rows[3]} - dirty and dirty
    mixed = {r.doc_id: r for r in frames[5].collect()}
    want = _plain_mix([(r.doc_id, r.text, None, r.source) for r in frames[4].collect()], Curriculum())
    assert {i: (r["size"], r.source_size) for i, r in mixed.items()} == {i: w[:2] for i, w in want.items()}


WORDS = "the of and that house with water from there stone river green light under bridge seven".split()


def test_pipeline_stages_on_odd_rows(spark, frame, tmp_path):
    """Nulls, empty and very long texts, repeated rows and clashing column names; each stage's docstring says what becomes of them."""
    draw = random.Random(5)
    text = lambda n: " ".join(draw.choice(WORDS) for _ in range(n))
    plain_rows = [(i, text(60), "en", "s") for i in range(60)]
    shared = "\n".join(["shared line of text"])
    odd = [(100, None, "en", "s"), (101, "", None, None), (None, text(50), None, None), (102, text(30_000), "en", "s"),
           (103, plain_rows[0][1], "en", "s"), (103, plain_rows[0][1], "en", "s"), (104, "one word", "xx", None)]
    lines = [(200 + i, f"{shared}\n{text(40)}", "en", "t") for i in range(12)]
    item = text(40)
    dirty = [(300, item, "en", "t"), (301, f"{text(20)} {item}", None, "t")]
    labels = [(i, 1, 0) for i in range(60)] + [(None, 1, 0), (5, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item), (None, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = frame(plain_rows + odd + lines + dirty)
    after = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)))
        after.append(docs.collect())
        assert len(after) == 5 or docs.columns == corpus_pipeline.DOCUMENT_COLUMNS
    ids = [Counter(r.doc_id for r in rows) for rows in after]
    # Quality: texts without a character go, repeated rows and null ids are judged like others.
    assert not {100, 101} & set(ids[0]) and ids[0][103] == 2 and ids[0][None] == 1 and ids[0][102] == 1
    # Lines: the shared line goes, everything stays a row, the length is that of the new text.
    assert ids[1] == ids[0] and all(r.text.count("shared line") == 0 and r.n_chars == len(r.text) for r in after[1])
    # Near duplicates: of equal texts the smallest id stays, rows that repeat that id all do.
    assert 103 not in ids[2] and ids[2][0] == 1 and ids[2][102] == 1
    # Benchmark: texts that hold the item go.
    assert not {300, 301} & set(ids[3]) and ids[3][102] == 1
    # Mixing: a row for every row, sizes in words.
    assert ids[4] == ids[3] and all(r["size"] <= 30_000 and r.taken <= 2 * r["size"] for r in after[4])


def test_pipeline_takes_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_pipeline_digest_is_stable(spark, sf_dir):
    one, two = (sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()), key=repr) for _ in range(2))
    assert hashlib.sha256(repr(one).encode()).digest() == hashlib.sha256(repr(two).encode()).digest()
