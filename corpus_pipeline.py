"""A training corpus from the documents table: five stages, each on all that the one before kept.

All stages take any rows of the documents' columns. Other columns, whatever their names, are
dropped. Ids may be null and may repeat: every row is judged by itself unless a stage says
otherwise. Very long texts are read whole, in slices inside a task. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelabel.llm.common import DOCUMENT_COLUMNS, read, small_enough, stored
from ridelabel.llm.decontaminate import decontaminate
from ridelabel.llm.line_dedup import line_dedup
from ridelabel.llm.minhash import MinHashParams, near_duplicates
from ridelabel.llm.mixing import mix
from ridelabel.llm.quality import quality

#: Near duplicates share 80% of their runs of five words.
NEAR = MinHashParams(shingle=5)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within their language's perplexity threshold.

    Null and empty texts have no perplexity and go. A null or rare language takes the threshold of
    all; a perplexity equal to the threshold stays. Repeated rows share their fate.
    """
    rows = quality(docs, read(spark, sf_dir, "labels"), extra=tuple(DOCUMENT_COLUMNS))
    return rows.where("kept").select(*DOCUMENT_COLUMNS)


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that ten or more of them share; n_chars is that of what stays.

    No document goes, even if no line of it stays. Null and empty texts are one empty line and
    come out empty. Repeated rows count as often as they stand there.
    """
    rows = line_dedup(docs, extra=("lang", "source"))
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Texts without words, null ones too, resemble nothing and stay. Rows that repeat the id that
    stays all stay: they are one document as far as ids tell. Rows without id stay.
    """
    gone = stored(near_duplicates(docs, NEAR).where("not kept").select("doc_id").distinct())
    return docs.join(F.broadcast(gone) if small_enough(gone) else gone, "doc_id", "left_anti").select(*DOCUMENT_COLUMNS)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a trace of benchmark items.

    Null and empty texts hold nothing and stay; items without words are in no text. Exactly one word
    in twenty is too much.
    """
    rows = decontaminate(docs, read(spark, sf_dir, "benchmark"), extra=tuple(DOCUMENT_COLUMNS[1:]))
    return rows.where("not contaminated").select(*DOCUMENT_COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What a training run takes of each document, and when.

    One row for every row. Null and empty texts have size 0 and are never taken; a null source is a
    source of its own, the last. Rows that repeat an id follow each other by size.
    """
    return mix(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", own_lines),
    ("near duplicates", one_of_each),
    ("decontamination", clean_of_benchmarks),
    ("mixing", mixed),
]

#: The language model and the chained texts are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table, each written before the next one reads it.

    What is written stays in the shared folder for as long as the result may be read.
    """
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
