"""Exact deduplication by content sort.

Texts are equal when they are identical without white space. Rows are dealt
by sampled splitters over (the first HEAD normalised bytes, hash, doc_id), so
that equal texts come to lie in one run of neighbouring partitions and also
a group with a third of all rows is spread over many; an external sort of
each partition puts equals side by side, and neighbours are compared in full.
A run at the edge of a partition carries its text once, by which the parts of
a group that several partitions hold are put together.

Cases: null texts count as empty, and all empty texts are equal; rows that
repeat a doc_id are rows of their own, of which one stays; a null doc_id sorts
last; an empty table gives no rows; further columns are ignored by the digest
and carried along by `deduplicated`.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.common import SPACE, arrow_schema, fresh, in_batches, table, text_column
from lodestrata.session import written

#: Bytes of the normalised text that splitters hold; bounds what sampling sends to the driver.
HEAD = 64

SORTED, SORTED_ARROW = arrow_schema(doc_id="long", n="long", sha="string", run="string", member="long", edge="string")


def _runs(part: int) -> Callable[[pa.RecordBatch], list[pa.RecordBatch]]:
    """Number the runs of equal neighbours in a sorted partition; a key's runs count as edge runs if the key is the partition's first or last."""
    state = {"key": None, "text": None, "run": -1, "first": None, "row": 0, "last": []}

    def step(batch: pa.RecordBatch | None) -> list[pa.RecordBatch]:
        out: list[tuple] = []
        if batch is None:  # the end of the partition
            if state["key"] != state["first"]:
                out += [(None, None, None, r, None, t) for r, t in state["last"]]
        else:
            for doc, n, sha, head, h, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = (head, h)
                if state["first"] is None:
                    state["first"] = key
                if key != state["key"]:
                    state["last"] = []
                if key != state["key"] or text != state["text"]:
                    state["run"] += 1
                    name = f"{part}:{state['run']}"
                    state["last"].append((name, text))
                    if key == state["first"]:
                        out.append((None, None, None, name, None, text))
                state["key"], state["text"] = key, text
                out.append((doc, n, sha, f"{part}:{state['run']}", (part << 40) + state["row"], None))
                state["row"] += 1
        return [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), SORTED_ARROW.types, strict=True)], schema=SORTED_ARROW)] if out else []

    return step


def classes(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: doc_id, n (code points), sha (of the normalised text), group_size, keep_id, kept."""
    text = text_column()
    norm = F.regexp_replace(text, f"{SPACE}+", "")
    rows = docs.select("doc_id", F.length(text).cast("long").alias("n"), norm.alias("norm"))
    keyed = rows.select("doc_id", "n", F.sha2("norm", 256).alias("sha"), F.substring(F.encode("norm", "utf-8"), 1, HEAD).alias("head"), F.xxhash64("norm").alias("h"), "norm")
    ranged = keyed.repartitionByRange("head", "h", "doc_id").sortWithinPartitions("head", "h", "norm", F.desc("n"), F.asc_nulls_last("doc_id"))

    def make():
        from pyspark import TaskContext

        return _runs(TaskContext.get().partitionId())

    t = written(in_batches(ranged, make, SORTED, ends=True), "sorted")
    members = t.where("member is not null")
    # Parts of one text in several partitions: at most two keys' runs for a partition.
    edges = t.where("edge is not null").select("run", "edge").distinct()
    joined = edges.join(edges.groupBy("edge").agg(F.min("run").alias("whole"), F.count("*").alias("parts")).where("parts > 1"), "edge").select("run", "whole")
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("none"), "doc_id", "member")).alias("best")
    runs = members.groupBy("run").agg(F.count("*").alias("size"), best).join(joined, "run", "left").withColumn("whole", F.coalesce("whole", "run"))
    groups = runs.groupBy("whole").agg(F.sum("size").alias("group_size"), F.min("best").alias("keep"))
    stay = runs.select("run", "whole").join(groups, "whole").select("run", "group_size", "keep")
    return members.join(stay, "run").select("doc_id", "n", "sha", "group_size", F.col("keep.doc_id").alias("keep_id"), (F.col("member") == F.col("keep.member")).alias("kept"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns: of equal texts the longest, then the smallest doc_id."""
    norm = F.regexp_replace(text_column(), f"{SPACE}+", "")
    ident, sha, n = fresh(docs, "__id", "__sha", "__n")
    keep = classes(docs).where("kept").select("doc_id", "sha", "n").toDF(ident, sha, n)
    same = F.col("doc_id").eqNullSafe(F.col(ident)) & (F.sha2(norm, 256) == F.col(sha)) & (F.length(text_column()) == F.col(n))
    return docs.join(keep, same, "left_semi")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = classes(table(spark, sf_dir, "documents"))
    return c.select("doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


OP9_SQL = """
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS k FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY k) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, k AS text_sha256
FROM t WINDOW w AS (PARTITION BY k ORDER BY n DESC, doc_id)
"""
