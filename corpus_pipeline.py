"""Raw documents to packed training sequences, stage by stage.

Each stage gets the documents that its predecessor kept, written as Parquet and read
again. All but the last return the columns of ``documents``.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.storage import as_table
from claimloom.llm import decontaminate, language, lines, minhash, packing
from claimloom.llm.queries import query, table, vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    return language.accepted(docs, language.training_samples(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; ``n_chars`` counts what stays."""
    found = lines.without_repeats(docs)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; rows that share an id stay or go together."""
    found = minhash.near_duplicates(docs, words=5, percent=80)
    gone = found.groupBy("doc_id").agg(F.max("kept").alias("stays")).filter("NOT stays").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    return packing.packed(docs, vocabulary(), added_tokens=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack),
]

# Language models, signatures and tokens have no SQL; the tests hold it against a brute-force version.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = as_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
