"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each to the shared
folder and reads it again as the next one's ``docs``. All but the last return the columns of
``documents``. Nulls, empty texts, repeated rows and empty tables are handled as the operators'
docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontaminate, language, line_dedup, near_dedup, packing
from tickloom.llm.queries import table, tokenizer
from tickloom.session import shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document is rejected if no language holds so much of its letters.
LEAST_SHARE = 0.3
#: SQL can express neither the learned language model nor the packing; tests compare the stages
#: with brute force.
ORACLE_SQL = None


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters in a language that the labels teach. Rejected: no letter or text,
    and texts in which no language holds LEAST_SHARE of the letters."""
    out = language.detect(docs, language.learn(docs))
    return out.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SHARE)) \
        .select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents hold stay in the first of them. A document may become empty;
    its row stays."""
    return _sized(line_dedup.drop_repeated_lines(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return near_dedup.keep_one(docs).select(*COLUMNS)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts; the rest of the document stays."""
    return _sized(decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), cut=True))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document's pieces in training sequences of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer())


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


STAGES = [("language", keep_languages), ("line_dedup", drop_lines),
          ("near_dedup", drop_near_copies), ("decontaminate", cut_benchmark),
          ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark)
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs
