"""The corpus pipeline: toxicity, line dedup, near-dedup, secrets and packing over documents.

Each stage takes (spark, docs, sf_dir), works on all rows of docs and returns
a DataFrame that is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents. The stages handle nulls,
empty and very long texts, repeated rows, empty tables and further columns as
the operators that they call do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import linededup, packing, secrets, simhash, toxicity
from lodestrata.llm.common import table
from lodestrata.session import scope, written


def _counted(docs: DataFrame) -> DataFrame:
    """docs with n_chars as its texts now are; null for null texts."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go from the texts; documents stay, those that lose all lines with an empty text."""
    return _counted(linededup.deduplicated(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, a similarity of 0.8 or more) the document of the smallest doc_id stays."""
    return simhash.near_representatives(docs, similarity=0.8, width=5)


def secret(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets, also those in nested encodings, give way to their kind in brackets."""
    return _counted(secrets.redacted(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts, each with its sequence and place."""
    import public_tokenizers

    parts = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.packed(parts).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", toxic), ("line_dedup", lines), ("simhash_near_dedup", near), ("secret_scan", secret), ("best_fit_packing", packed)]

#: A learned score and a tokenizer are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scope(spark):  # what a stage wrote on its way goes with it
            docs = written(stage(spark, docs, sf_dir), name, keep=True)
    return docs
