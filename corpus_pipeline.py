"""The corpus pipeline: documents to token ids in five stages, each written and read again between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import language, leaks, lines, pieces, simhash
from touchline.llm.queries import vocabulary
from touchline.llm.shared import read, stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with some margin; dictionaries come from all documents with a language."""
    return language.keep_known(docs, language.learn(docs, F.lit(True)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that came before."""
    out = lines.drop_lines(docs).drop("n_lost")
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return leaks.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    return pieces.encode(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [("language ID", language_id), ("line dedup", line_dedup), ("SimHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("SentencePiece encoding", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of `sf_dir`; no stage can be expressed in SQL."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Compression, SimHash, singular values and merges are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None
QUERIES, ORACLES = {"pipeline": run}, {}
