"""Where queries register themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.batches import small_batches
from lodestrata.functions.text import split_lines

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its name, with its SQL if it has any."""

    def put(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return run

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def exploded(docs: DataFrame) -> DataFrame:
    """doc_id, line_no (from 1) and text of each line; split by the newline alone, as the SQL does."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).select("doc_id", (F.col("pos") + 1).alias("line_no"), F.col("line").alias("text"))


def python_lines(docs: DataFrame) -> DataFrame:
    """The same by all line ends, without a last empty line."""
    return docs.select("doc_id", F.posexplode(split_lines(F.col("text"))).alias("pos", "line")).select("doc_id", (F.col("pos") + 1).alias("line_no"), F.col("line").alias("text"))


#: SQL for lines: doc_id, line_no from 1, text.
LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)"
#: SQL for lines without a last empty one.
PYTHON_LINES = "lines AS (SELECT doc_id, text, line_no FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS line_no, len(string_split(text, chr(10))) AS n FROM documents) WHERE NOT (line_no = n AND text = ''))"
#: SQL for a second capture: some documents gone, some with a line more, some under another name.
SECOND = "second AS (SELECT CASE WHEN doc_id % 13 = 0 THEN doc_id + 1000000 ELSE doc_id END AS doc_id, source, lang, CASE WHEN doc_id % 11 = 0 THEN text || chr(10) || 'appended line' ELSE text END AS text FROM documents WHERE doc_id % 17 <> 0)"


def second(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id % 17 <> 0").select(F.when(F.col("doc_id") % 13 == 0, F.col("doc_id") + 1000000).otherwise(F.col("doc_id")).alias("doc_id"), "source", "lang", F.when(F.col("doc_id") % 11 == 0, F.concat("text", F.lit("\nappended line"))).otherwise(F.col("text")).alias("text"))
