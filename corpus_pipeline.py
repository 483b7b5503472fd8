"""From raw documents to packed sequences: five stages, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deq.llm import jaccard, lines, packing, personal, quality
from deq.llm.common import settled
from deq.llm.queries import tokenizer_path
from deq.session import materialize


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text where the table has that column."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule; nulls and empty texts fail."""
    settled(spark)
    return quality.quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that an earlier line repeats; those left without a word go."""
    settled(spark)
    return _counted(lines.without_repeated_lines(docs, drop_emptied=True))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id; others stay.

    Of rows that share the smallest id one stays. Texts without words are linked with nothing.
    """
    settled(spark)
    return jaccard.one_of_each(docs, 5, 80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the name of its kind."""
    settled(spark)
    return _counted(personal.redact(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and the sequence each is put into."""
    settled(spark)
    return packing.best_fit_pack(packing.token_pieces(docs, tokenizer_path("word_bpe_49k.json"), 2048), 2048)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenization and rolling digests are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
