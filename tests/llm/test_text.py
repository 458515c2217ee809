"""Quality, language, decontamination, main text and personal data."""

import hashlib
import html
import math
import random
import re
import time
from collections import Counter
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from ridelabel.llm.decontaminate import decontaminate
from ridelabel.llm.html_text import LearnParams, Page, best_run, learned_weights, main_text, weights_from
from ridelabel.llm.langid import LangIdParams, fit, identify
from ridelabel.llm.minhash import MinHashParams, likely, needed_matches
from ridelabel.llm.pii import (
    ALL_KINDS, MORE, SIZES, PiiParams, boosted, calibrated, candidates, find_pii, listed, redacted, running_sums, score,
    selected_codes)
from ridelabel.llm.quality import QualityParams, language_model, perplexities, quality
from tests.llm.plain import base_spans, kneser_ney, perplexity


def _sentences(seed, n, words):
    draw = random.Random(seed)
    return [" ".join(draw.choice(words) for _ in range(draw.randrange(3, 30))).capitalize() + "." for _ in range(n)]


ENGLISH, GERMAN = "the of and that house with water from there".split(), "der die und nicht Straße über schön zwischen".split()


def test_model_equals_textbook_formulas(spark, frame):
    texts = _sentences(1, 40, ENGLISH) + ["é😀x", ""]
    docs = frame(list(enumerate(texts)))
    model = language_model(docs.select(F.col("text").cast("binary")))
    plain = kneser_ney([t.replace("😀", "\ue000".replace("\ue000", chr(0xE000 + 0x1F600 % 6400))) for t in texts])
    rows = [(0, "the water from"), (1, "zzz Ω the"), (2, texts[3]), (3, None), (4, "")]
    for limit in (10**6, 30):
        got = {r.doc_id: (r.n, r.log_sum) for r in perplexities(frame(rows), model, ["doc_id"], round_rows=limit).collect()}
        for i, text in rows:
            assert got[i][0] == len(text or "")
            assert got[i][1] == pytest.approx(plain(text) if text else 0.0, rel=1e-9)
    assert perplexity(plain, texts[3]) < perplexity(plain, "ZZ!! QQ!!")


def test_quality_rejects_noise_and_keeps_clean(spark, frame):
    good = [(i, t, "en" if i % 2 else None) for i, t in enumerate(_sentences(2, 300, ENGLISH))]
    bad = [(1000 + i, "!!".join("QXZ%d" % (i * j) for j in range(20)), "en") for i in range(20)]
    more = [(2000, None, "en"), (2001, "", None), (2002, " ".join(_sentences(9, 4000, ENGLISH)), "xx"), (None, "The house of water.", "en")]
    labels = spark.createDataFrame(
        [(i, 1, 0) for i, *_ in good[:200]] + [(1000, 0, 1), (5, 1, None), (None, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality(frame(good + bad + more), labels, QualityParams(factor=1.2)).collect()}
    assert not any(got[i].kept for i, *_ in bad)
    assert sum(got[i].kept for i, *_ in good) >= 294
    assert not got[2000].kept and got[2000].perplexity is None and not got[2001].kept and got[2002].kept
    assert got[None].perplexity > 1
    assert quality(frame([]), labels).count() == 0
    nothing = labels.where("false")
    assert quality(frame(good[:3] + more[:1]), nothing).where("kept").count() == 3


def test_language_by_held_out_accuracy_and_odd_texts(frame):
    rows = [(i, t, "en") for i, t in enumerate(_sentences(3, 150, ENGLISH))]
    rows += [(1000 + i, t, "de") for i, t in enumerate(_sentences(4, 150, GERMAN))]
    rows += [(2000, None, "en"), (2001, "123 !!", "de"), (2002, "", None), (2003, "ж", None), (None, "und nicht", "de"), (2004, "und nicht " * 30_000, None)]
    got = {r.doc_id: r for r in identify(frame(rows)).collect()}
    assert len(got) == len(rows)
    held = [r for r in rows[:300] if got[r[0]].held_out]
    assert held and all(got[i].lang_pred == lang for i, _, lang in held)
    assert [got[i].lang_pred for i in (2000, 2001, 2002)] == ["und"] * 3 and got[2003].lang_pred in ("de", "en")
    assert got[2004].lang_pred == "de" and not got[None].held_out and all(0 <= r.score <= 1 for r in got.values())
    assert identify(frame([])).count() == 0
    assert identify(frame([(1, "abc")])).first().lang_pred == "und"


def test_language_with_more_languages_than_bits(frame):
    words = [[f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j)}" for j in range(6)] for i in range(70)]
    rows = [(i * 20 + j, t, f"l{i:02d}") for i in range(70) for j, t in enumerate(_sentences(i, 12, words[i]))]
    got = {r.doc_id: r.lang_pred for r in identify(frame(rows), LangIdParams(slots_per_gram=64)).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) >= 0.99 * len(rows)


def _grams(text):
    """Trigrams of lower-cased letters, everything else is one blank."""
    flat = " " + re.sub(r"[\W\d_]+", " ", (text or "").lower()) + " "
    return [flat[i - 1:i + 2] for i in range(1, len(flat) - 1) if flat[i] != " "]


@pytest.mark.parametrize("shuffled", [False, True])
def test_language_by_many_small_filters_equals_plain_sets(frame, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr("ridelabel.llm.common.small_enough", lambda *_: False)
    rows = [(i, t, "en") for i, t in enumerate(_sentences(5, 90, ENGLISH))]
    rows += [(200 + i, t, "de") for i, t in enumerate(_sentences(6, 90, GERMAN))]
    rows += [(400 + i, "und the Straße", None) for i in range(60)] + [(500, None, "en"), (501, "", "de"), (500, "12", None), (None, "und", "de")]
    rows += [(600 + i, "zwischen house " * 3, None) for i in range(5)]
    params = LangIdParams(slots_per_gram=256, most_slots=4096)
    marked = identify(frame(rows), params).collect()
    counts = {"en": Counter(), "de": Counter()}
    unseen = {r.doc_id for r in marked if r.held_out}
    for i, text, lang in rows:
        if lang and i is not None and i not in unseen:
            counts[lang].update(_grams(text))
    rate = {x: {g: n / sum(own.values()) for g, n in own.items()} for x, own in counts.items()}
    most = {g: max(own.get(g, 0) for own in rate.values()) for own in rate.values() for g in own}
    member = {x: {g for g, r in own.items() if r >= 0.2 * most[g]} for x, own in rate.items()}
    model = fit(frame(rows).where("doc_id % 2 = 0").select("lang", "text"), params)
    assert model.shards >= 4
    want = Counter()
    for i, text, _ in rows:
        own = _grams(text)
        share = {x: sum(g in member[x] for g in own) / max(len(own), 1) for x in ("de", "en")}
        best = max(share, key=share.get)
        want[i, best if own else "und", round(share[best], 2) if own else 0.0] += 1
    assert Counter((r.doc_id, r.lang_pred, round(r.score, 2)) for r in marked) == want


def test_filters_stay_sparse_at_any_number_of_trigrams(spark, frame):
    draw = random.Random(11)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 400)]
    rows = [(i, "".join(draw.choice(letters) for _ in range(2000)), "zh" if i % 2 else "ja") for i in range(40)]
    model = fit(frame(rows).select("lang", "text"), LangIdParams(most_slots=1 << 16))
    assert model.shards == 32 and model.slots == 1 << 16
    assert all((model.filters(shard).false < 0.01).all() for shard in (0, 13, 31))


@pytest.mark.parametrize("shuffled", [False, True])
def test_rounds_write_results_by_text_and_never_texts(spark, frame, monkeypatch, shuffled):
    from ridelabel.llm import common

    kept = []
    monkeypatch.setattr(common, "stored", lambda made, real=common.stored: kept.append(made.dtypes) or real(made))
    if shuffled:
        monkeypatch.setattr(common, "small_enough", lambda *_: False)
    docs = [(i, "the water from there " * (1 + i % 3), "en") for i in range(30)] + [(40, None, "en"), (41, "", None), (None, "water", None)]
    docs += [(7, "the water", "en")] * 2
    model = language_model(frame(docs).select(F.col("text").cast("binary")))
    once, often = (
        sorted(map(tuple, perplexities(frame(docs), model, ["doc_id", "lang"], round_rows=limit).collect()), key=repr) for limit in (10**6, 20))
    assert len(once) == len(docs) and [r[:3] for r in once] == [r[:3] for r in often]
    assert [r[3] for r in often] == pytest.approx([r[3] for r in once], rel=1e-12)
    bench = spark.createDataFrame([(1, "water from there"), (2, "the water"), (None, "there the water")], "item_id long, text string")
    once, often = (
        sorted(map(repr, decontaminate(frame(docs), bench, extra=("lang", "text"), block_bytes=size).collect())) for size in (10**6, 10))
    assert len(once) == len(docs) and once == often
    assert kept and all({name for name, _ in own} <= {"_key", "_part", "_parts"} for own in kept)


def _contamination(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    out = []
    for i, text in docs:
        own, hit, names = words(text), set(), set()
        for item, body in items:
            w = words(body)
            n = min(13, len(w))
            for a in range(len(w) - n + 1 if n else 0):
                for b in range(len(own) - n + 1):
                    if own[b:b + n] == w[a:a + n]:
                        hit |= set(range(b, b + n))
                        names |= {str(item)} if item is not None else set()
        out.append((i, len(own), len(hit), len(names), sorted(names), bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=repr)


def test_contamination_equals_plain_version_in_one_and_many_blocks(spark, frame):
    draw = random.Random(8)
    vocabulary = [f"w{i}" for i in range(12)] + ["Éa", "b", "C9"]
    text = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([1, 2, 4, 5, 12, 13, 14, 30, 30])] + [(20, None), (21, "--"), (None, text(15)), (3, text(16)), (22, "same " * 20)]
    docs = [(i, text(draw.randrange(60))) for i in range(25)]
    docs += [(100 + i, text(20) + ", " + (b or "").upper() + "! " + text(draw.randrange(300))) for i, (_, b) in enumerate(items)]
    docs += [(200, None), (201, ""), (202, "same, " * 3000), (100, items[7][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = _contamination(docs, items)
    for size in (1 << 20, 60):
        got = decontaminate(frame(docs), bench, block_bytes=size)
        rows = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in got.collect()]
        assert sorted(rows, key=repr) == want
    assert decontaminate(frame([]), bench).count() == 0
    assert not decontaminate(frame(docs[:2]), bench.where("false")).where("contaminated or n_hit > 0").count()


def test_main_text_of_generated_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in main_text(pages).collect()}
    for page in pages.collect():
        inner = re.sub(r"</?b>|<br>", "", re.search(r"<article>(.*)</article>", page.html, re.S)[1])
        blocks = (" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:h1|p)>", inner))
        want = "\n".join(b for b in blocks if b)
        assert got[page.page_id].text == want and got[page.page_id].n_chars == len(want)


def _unmarked(source):
    """The page without any mark of areas: plain elements, no class, id or role."""
    source = re.sub(r"<(/?)(?:article|main|nav|header|footer|aside|form)\b[^>]*>", r"<\1div>", source)
    return re.sub(r"\s(?:class|id|role)=(?:\"[^\"]*\"|'[^']*'|[^\s>]+)", "", source)


def test_pages_without_marks_are_read_by_the_learned_weights(spark, sf_dir):
    """What lies outside is cut off by the scan alone: 0.9 of the words found are right, and of the right ones found."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    weights = learned_weights(pages)
    assert weights["word"] > 0 > max(v for n, v in weights.items() if n in ("div", "p", "h1", "li", "a"))
    sure = {r.page_id: r.text.split() for r in main_text(pages).collect()}
    plain = pages.withColumn("html", F.udf(_unmarked)("html"))
    assert plain.where("html rlike '<(article|nav|footer)'").isEmpty()
    same = found = wanted = 0
    for r in main_text(plain, weights).collect():
        got, want = Counter(r.text.split()), Counter(sure[r.page_id])
        same, found, wanted = same + sum((got & want).values()), found + sum(got.values()), wanted + sum(want.values())
    assert same >= 0.9 * found and same >= 0.9 * wanted
    other = learned_weights(pages, params=LearnParams(pages=20, rounds=3))
    assert other != weights and learned_weights(pages.where("false")) == weights_from([])


def test_the_scan_finds_the_best_run():
    draw = random.Random(3)
    for _ in range(300):
        scores = [float(draw.randrange(-3, 4)) for _ in range(draw.randrange(12))]
        runs = [(sum(scores[a:b + 1]), -b, a) for b in range(len(scores)) for a in range(b + 1)]
        best = max(runs, default=(0, 0, 0))
        assert best_run(scores) == ((best[2], -best[1]) if best[0] > 0 else (0, -1))


WEIGHTS = weights_from([])
BODY = "A sentence with quite a few words to read, " * 4
TEXT = " ".join(BODY.split())


def test_main_text_leaves_out_what_is_not_the_article():
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body><header><h1>Site</h1></header>
      <div class="top-menu"><a href=x>Home</a></div><div id="cookie-notice">We use cookies</div>
      <div class="post"><h2>On &eacute; &amp; &#233;</h2><p>{BODY}<p>Second   one<br>with a
      <a href='>'>link</a>.<script>if (a<b) "</p>"</script><div class="advert">Buy</div><p hidden>no<p>Third {BODY}</div>
      <section class="comments"><p>{BODY}</p></section><aside>{BODY}</aside><form>Name</form><footer>c</footer>"""
    assert Page(page).text(WEIGHTS) == f"On é & é\n{TEXT}\nSecond one with a link.\nThird {TEXT}"


@pytest.mark.parametrize("wrapper", ['div class="layout has-sidebar"', 'div class="share-price-news"', 'div id="header-form"', "form", 'div class="ad"'])
def test_wrappers_do_not_drop_the_article(wrapper):
    name = wrapper.split()[0]
    for inner in (f"<article><p>{BODY}</p></article>", f"<p>{BODY}</p>"):
        page = f"<body><nav><a href=x>Home</a></nav><{wrapper}>{inner}</{name}><footer>end of it</footer>"
        assert Page(page).text(WEIGHTS) == TEXT


def test_teasers_and_comments_are_no_article():
    page = f"""<main><h1>Title</h1><p>{BODY}</p><section class="comments"><article class="comment"><p>{BODY}{BODY}{BODY}</p></article>
      </section></main><aside><article><p>{BODY}</p></article></aside>"""
    assert Page(page).text(WEIGHTS) == f"Title\n{TEXT}"


def test_odd_pages_have_defined_texts(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<p>"), (3, "w", "plain words"), (4, "w", "<p>" + "long word " * 40_000 + "<"),
            (5, "x", "<b" * 2000), (6, "y", "a < b <3 c"), (7, "z", "one<!-- two"), (8, "z", "one <a href='x>two"), (9, "z", "</p></x>one</p>"),
            (9, "z", "one<script>two</scriptx>"), (10, "z", "A<br/>B<hr>C<?php x?>D<!doctype y>E")]
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))).collect()
    assert sorted(((r.page_id or 0, r.url, r.text if r.page_id != 4 else "") for r in got), key=repr) == sorted([
        (0, "v", ""), (1, "u", ""), (2, None, ""), (3, "w", "plain words"), (4, "w", ""), (5, "x", ""), (6, "y", "a < b <3 c"),
        (7, "z", "one"), (8, "z", "one two"), (9, "z", "one"), (9, "z", "one"), (10, "z", "A B\nCDE")], key=repr)
    assert all(r.n_chars == len(r.text) for r in got) and [r.n_chars for r in got if r.page_id == 4] == [400_001]
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("unit", ["<b", "<div>", "<a \">\"", "<i class='x", "<p><b>", "</p>", "<!--", "<script>", "<li><div><b>", "id id  ", "<div class=ad>"])
def test_a_page_of_a_megabyte_is_read_in_linear_time(unit):
    begin = time.time()
    Page(unit * (1_000_000 // len(unit))).text(WEIGHTS)
    assert time.time() - begin < 12


HARD = [
    "a.b@c.d@e.f", "x@y a@b.c_x@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.04", "+1 (900) 555-2077 or (900) 555-2077", None, "",
    "é😀 a@b.co 😀 4111 1111-1111 1111 4111111111111112", "9" * 20_000 + " " + "a" * 20_000 + "@", "+1+22222222222+3 4444444444.",
    "1.2.3." * 300, "4111111111111111 " * 40, "a@b.c," * 50, "0000000000000",
]


def test_base_spans_equal_plain_version(spark, frame, sf_dir):
    texts = [(10_000 + i, t) for i, t in enumerate(HARD)]
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = texts + documents + documents[:2] + [(None, HARD[0])]
    got = find_pii(frame(rows)).select("doc_id", listed(F.filter("spans", lambda s: s["base"])).alias("b")).collect()
    assert sorted((r.doc_id or -1, r.b) for r in got) == sorted((i or -1, base_spans(t)) for i, t in rows)
    assert find_pii(frame([])).count() == 0


def test_further_candidates_are_learned_and_kept_apart(frame):
    draw = random.Random(4)
    number = lambda: f"({draw.randrange(100, 999)}) {draw.randrange(100, 999)}-{draw.randrange(1000, 9999)}"
    rows = [(i, f"Words and then call +1 {number()} or write x{i}@mail.example.com now.") for i in range(120)]
    rows += [(500 + i, f"Words and then call {number()} now.") for i in range(3)] + [(600, "see 12.5 and 300.400.1.2")]
    docs = frame(rows)
    found = find_pii(docs, PiiParams(least=5))
    got = {r.doc_id: r.spans for r in found.collect()}
    assert all(len(got[500 + i]) == 1 and not got[500 + i][0].base for i in range(3)) and not got[600]
    assert all(s.base for i in range(120) for s in got[i])
    text = docs.select("doc_id", "text").join(found, "doc_id").where("doc_id = 500").select(redacted(F.col("text"), F.col("spans"))).first()[0]
    assert text == "Words and then call [phone] now."


def test_running_sums_of_any_length(spark):
    draw = random.Random(2)
    lists = [[draw.randrange(9) for _ in range(n)] for n in (0, 1, 2, 15, 16, 17, 255, 256, 257, 1000)]
    rows = spark.createDataFrame([(x,) for x in lists], "x array<int>").select("x", running_sums(F.col("x")).alias("s")).collect()
    assert all(r.s == list(accumulate(r.x)) for r in rows)


FURTHER = [
    "ann (at) mail (dot) example (dot) com, b.c[at]x.org; call (030) 1234-5678 or 0049 301 4567, 030/123 4567",
    "4111.1111.1111.1111 and 4111/1111/1111/11 2001:0db8:85a3:0000:0000:8a2e:0370:7334", "é😀 (030) 123-4567 😀 (031) 123-4568",
    "key = 0123456789abcdef0123 " + "Z9" * 70 + " password: 'aaaabbbbccccdddd1'", "x(at)y.z " * 40, "9a" * 10 + " " + "abc" * 10,
]


def test_places_of_further_candidates_equal_plain_search(frame, spark, sf_dir):
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = [(10_000 + i, t) for i, t in enumerate(FURTHER + HARD)] + documents
    want = set()
    for i, text in rows:
        for kind, (pattern, trigger) in MORE.items():
            if re.search(trigger, text or ""):
                want |= {(i, kind, m.start(), m.end()) for m in re.finditer(pattern, text or "")}
    each = candidates(frame(rows)).select("doc_id", F.explode("spans").alias("s")).where("not s.sure")
    got = {(r.doc_id, ALL_KINDS[r.kind], r.start, r.end) for r in each.select("doc_id", "s.kind", "s.start", "s.end").collect()}
    assert want <= got and len(want) > 60
    # What is more are matches of the checked patterns that failed.
    assert {kind for _, kind, _, _ in got - want} <= {"ip", "card", "phone"}


def _luhn(draw, digits, good):
    """An even number of digits that pass, or do not pass, the check."""
    while True:
        number = "".join(str(draw.randrange(10)) for _ in range(digits))
        total = sum(x if i % 2 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, number)))
        if (total % 10 == 0) == good:
            return number


def test_planted_spans_are_found_beyond_the_checked_ones(frame):
    """Mistyped cards in the form of checked ones are found; numbers no checked one looks like stay."""
    draw = random.Random(6)
    rows, planted = [], set()
    for i in range(1200):
        kind = i % 12
        if kind < 6:
            rows.append((i, f"paid by card {_luhn(draw, 16, kind < 1)} in May"))
            if kind:
                planted.add(i)
        elif kind < 8:
            rows.append((i, f"parcel no. {_luhn(draw, 12, False)}x left"))
        elif kind < 9:
            rows.append((i, f"write to x{i}@mail.example.com or x{i} (at) mail (dot) example (dot) com"))
        else:
            rows.append((i, f"token = {draw.getrandbits(128):032x} set" if kind < 11 else f"see {draw.getrandbits(128):032x} there"))
    found = {r.doc_id: r.spans for r in find_pii(frame(rows)).collect()}
    more = {i for i, spans in found.items() if any(not s.base and s.kind == 2 for s in spans)}
    assert len(more & planted) >= 0.95 * len(planted) and len(more & planted) >= 0.9 * len(more)
    assert sum(len(found[i]) == 2 for i, t in rows if "(at)" in t) >= 95
    # Keys are found with and without the word in front, but for rare formats.
    keys = [any(ALL_KINDS[s.kind] == "secret" for s in found[i]) for i, _ in rows if i % 12 >= 9]
    assert sum(keys) >= 0.9 * len(keys)
    # Without labelled spans of a kind nothing is learned for it.
    few = [(i, f"paid by card {_luhn(draw, 16, False)}") for i in range(60)]
    assert not any(r.spans for r in find_pii(frame(few)).collect())


def _trees_plainly(rows, params):
    """The same boosting over single rows, every split tried."""
    single = [(x, y) for x, n, k in rows for y in [1] * k + [0] * (n - k)]
    k, n = sum(y for _, y in single), len(single)
    scores = [math.log((k + 1) / (n - k + 1))] * n

    def split(own):
        best = (1e-9, 0, -1)
        total = [sum(g[i] for i in own), sum(h[i] for i in own)]
        for f in range(len(SIZES)):
            for most in sorted({single[i][0][f] for i in own})[:-1]:
                left = [i for i in own if single[i][0][f] <= most]
                a, b = sum(g[i] for i in left), sum(h[i] for i in left)
                gain = a * a / (b + 1) + (total[0] - a) ** 2 / (total[1] - b + 1) - total[0] ** 2 / (total[1] + 1)
                if gain > best[0] + 1e-9:
                    best = (gain, f, most)
        return best[1:]

    for _ in range(params.rounds):
        p = [1 / (1 + math.exp(-s)) for s in scores]
        g, h = [y - q for (_, y), q in zip(single, p)], [q * (1 - q) for q in p]
        f, most = split(range(n))
        for side in ([i for i in range(n) if single[i][0][f] <= most], [i for i in range(n) if single[i][0][f] > most]):
            f2, most2 = split(side)
            for leaf in ([i for i in side if single[i][0][f2] <= most2], [i for i in side if single[i][0][f2] > most2]):
                step = params.rate * sum(g[i] for i in leaf) / (sum(h[i] for i in leaf) + 1)
                for i in leaf:
                    scores[i] += step
    return {tuple(x): 1 / (1 + math.exp(-s)) for (x, _), s in zip(single, scores)}


def test_trees_and_calibration_equal_plain_versions():
    draw = random.Random(12)
    rows = [([d, draw.randrange(4), 0, draw.randrange(3), c, 3], n, draw.randrange(n + 1))
            for d in range(6) for c in (0, 1) for n in [draw.randrange(1, 9)]]
    params = PiiParams(rounds=5)
    trees = boosted(rows, params)
    for x, p in _trees_plainly(rows, params).items():
        assert score(trees, list(x)) == pytest.approx(p, abs=1e-9)
    for _ in range(50):
        seen = [(draw.randrange(8) / 8, n, draw.randrange(n + 1)) for n in [draw.randrange(1, 6) for _ in range(10)]]
        merged = {}
        for p, n, k in seen:
            a, b = merged.get(p, (0, 0))
            merged[p] = (a + n, b + k)
        levels = sorted(merged)
        mean = lambda i, j: sum(merged[p][1] for p in levels[i:j + 1]) / sum(merged[p][0] for p in levels[i:j + 1])
        steps = calibrated(seen)
        for i, p in enumerate(levels):
            want = max(min(mean(a, b) for b in range(i, len(levels))) for a in range(i + 1))
            assert [share for low, share in steps if low <= p][-1] == pytest.approx(want)


def test_boosting_separates():
    rows = [([d, 1, 0, 0, c, 3], 50, 48 if d > 4 and c else 2) for d in range(10) for c in (0, 1)]
    trees = boosted(rows, PiiParams())
    assert score(trees, [8, 1, 0, 0, 1, 3]) > 0.8 > 0.2 > score(trees, [8, 1, 0, 0, 0, 3])
    assert selected_codes([], PiiParams()) == {}


def test_a_text_of_many_numbers_is_searched_in_linear_time(frame):
    draw = random.Random(1)
    texts = [" ".join(str(draw.randrange(10**6)) for _ in range(100_000)), "; ".join(str(draw.randrange(10**6)) for _ in range(100_000)),
             "; ".join(_luhn(draw, 16, True) for _ in range(3000)) * 4, "a@b.co " * 30_000]
    begin = time.time()
    found = {r.doc_id: len(r.spans) for r in candidates(frame(list(enumerate(texts)))).collect()}
    assert found[1] == 0 and found[2] == 12_000 - 3 and found[3] == 30_000
    assert time.time() - begin < 40


def test_pruning_bounds_keep_the_threshold():
    params = MinHashParams()
    bounds = needed_matches(params)
    assert [n for n, _ in bounds] == list(range(25, 301, 25)) and all(0 < m < 0.8 * n for n, m in bounds)
    import numpy as np
    draw = np.random.default_rng(3)
    one = draw.integers(0, 256, 300).astype(np.uint8)
    same = draw.random((2000, 300)) < 0.8
    near = np.where(same, one, draw.integers(0, 256, (2000, 300)).astype(np.uint8))
    assert likely(params, one, 100, near, np.full(2000, 100)).mean() > 0.999
    far = np.where(draw.random((2000, 300)) < 0.5, one, draw.integers(0, 256, (2000, 300)).astype(np.uint8))
    assert likely(params, one, 100, far, np.full(2000, 100)).mean() < 0.01


def test_hash_of_the_listing(frame):
    text = "a@b.co 1.2.3.4"
    row = find_pii(frame([(1, text)])).select(F.sha2(listed(F.col("spans")).cast("binary"), 256)).first()
    assert row[0] == hashlib.sha256(b"email:0:6,ip:7:14").hexdigest()
