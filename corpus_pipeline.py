"""A corpus pipeline: from raw documents to the token ids of a mixture of clean, distinct ones.

Each stage works on all that the one before has kept, written as Parquet in
between. All stages but the last return the columns of ``documents``.

All stages take whole texts of any length, null ids and repeated rows, and further columns of any name, which they pass on
(but for the last). An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topup_analytics.llm.bpe import encode
from topup_analytics.llm.common import read_table, stored
from topup_analytics.llm.jaccard import one_of_each
from topup_analytics.llm.language import UNDETERMINED, learn, with_languages
from topup_analytics.llm.mixing import mixed_documents
from topup_analytics.llm.quality import judged

#: Near duplicates share 80 % of their distinct shingles of five words.
SHINGLE_WORDS = 5
PERCENT = 80
#: A text without a main language, or whose main language has a smaller share, is rejected.
LEAST_MAIN_SHARE = 0.4


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules.

    A null or blank text has too few words and goes. Rows are judged one by one against references of all: repeated
    rows share one verdict, and ties do not arise.
    """
    return judged(docs).where("kept").select("row.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language; a missing label is filled with it.

    A text that is null or without letters has none and goes, as does every text where no row has a label. Equal
    shares go to the language first in order. Repeated rows share one prediction.
    """
    names, model = learn(docs)
    main = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_MAIN_SHARE)
    found = with_languages(docs, names, model).where(main)
    return found.select(F.col("row").withField("lang", F.coalesce("row.lang", "lang_pred")).alias("row")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates.

    The smallest id stays, null ids last; of different texts with that id the one with the smallest hash, of equal rows one.
    Rows without words, null texts among them, are no one's duplicates and all stay.
    """
    return one_of_each(docs, SHINGLE_WORDS, PERCENT)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mixture reads, once for each time; a source's run may start or end inside one.

    Null sources are one source, last in order. A null or blank text has no words and is not read. Repeated rows are
    documents like any other; those that tie in the seeded order are equal.
    """
    mix = mixed_documents(docs)
    return mix.withColumn("n_chars", F.char_length("text").cast("bigint")).select(docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each text, and whether they decode to its bytes.

    A null text counts as empty and has no ids. Every row gives one; equal texts have equal ids.
    """
    columns = docs.select("doc_id", "lang", "source", "text")
    encoded = encode(columns, data="data")
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        (F.col("data") == F.encode(F.coalesce("text", F.lit("")), "utf-8")).alias("exact"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("source_mixture", source_mixture),
    ("byte_bpe", byte_bpe),
]

#: SQL cannot express the language model, so the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
