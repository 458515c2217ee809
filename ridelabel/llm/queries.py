"""The registered queries of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelabel.llm.common import read
from ridelabel.llm.decontaminate import decontaminate
from ridelabel.llm.exact_dedup import exact_dedup
from ridelabel.llm.html_text import main_text
from ridelabel.llm.infill import fill_in_middle, restore
from ridelabel.llm.langid import identify
from ridelabel.llm.line_dedup import line_dedup
from ridelabel.llm.minhash import near_duplicates
from ridelabel.llm.mixing import mix
from ridelabel.llm.packing import PackParams, pack
from ridelabel.llm.pii import KINDS, find_pii, listed
from ridelabel.llm.quality import quality
from ridelabel.llm.search import ranked_search
from ridelabel.llm.urls import judge_urls


#: Marks that a page's text has been mangled, and what counts as its words.
MANGLED, PAGE_WORD = r"(\*\*\*|###|\$\$\$|%%%|&amp;&amp;&amp;|!!)([\x20\x0A<]|$)", r"[^\x20\x09-\x0D<>]+"


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is read off its own text: bad if a fifth of its words end in runs of symbols.

    Pages of fewer than 20 words say too little and have no outcome.
    """
    pages = read(spark, sf_dir, "pages")
    words, mangled = (F.regexp_count("html", F.lit(p)) for p in (PAGE_WORD, MANGLED))
    outcomes = pages.select("page_id", words.alias("words"), mangled.alias("mangled")).where("words >= 20").select(
        "page_id", (5 * F.col("mangled") >= F.col("words")).cast("int").alias("bad"))
    return judge_urls(pages, outcomes)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup(read(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    listed = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return done.select("doc_id", "n_words", "n_hit", "n_items", listed.alias("items_sha256"), "contaminated")


def _is(kind: int) -> Callable:
    return lambda s: s["kind"] == kind


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_pii(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    counts = [
        F.size(F.filter(base, _is(i))).cast("long").alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    rows = pack(read(spark, sf_dir, "documents"), PackParams(path("byte_bpe_50k.json")))
    return rows.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "cost")


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(read(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256")
    kept = ("doc_id", "n", "form", "prefix_chars", "middle_chars")
    back = restore(rows.select(*kept, "output", digest), keep=(*kept, "output_sha256"))
    return back.select(*kept, "output_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("restored_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_quality": op3_quality,
        "op4_language": op4_language,
        "op5_line_dedup": op5_line_dedup,
        "op6_main_text": op6_main_text,
        "op7_mixing": op7_mixing,
        "op8_decontamination": op8_decontamination,
        "op9_pii": op9_pii,
        "op10_near_duplicates": op10_near_duplicates,
        "op11_packing": op11_packing,
        "op12_search": op12_search,
        "op13_fill_in_middle": op13_fill_in_middle,
    }
