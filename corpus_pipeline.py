"""A training-data pipeline over documents: each stage is one operator, written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import line_dedup, mixing, ngram_join, sentencepiece_codec, toxicity
from wattlake.llm._common import read, written
from wattlake.plans.shipping import ship


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores under 0.5."""
    ship(spark)
    return toxicity.scored(docs, read(spark, sf_dir, "labels")).where("__score < 0.5").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each near-equal line left only where it comes first."""
    return line_dedup.dedup_lines(docs).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix in training order, as often as it takes them, with their position in it."""
    return mixing.mixed(docs).select(*docs.columns, "position")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids."""
    ship(spark)
    return sentencepiece_codec.encoded(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]
#: SQL can express neither the toxicity model nor the MinHash bands.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir).select("doc_id", "source", "position", "n_tokens", "ids_crc32", F.xxhash64("text").alias("text_hash"))
