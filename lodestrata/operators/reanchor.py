"""A proposal carried over to a new capture: citations that moved, and what follows from those that were lost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.quotes import remapped
from lodestrata.session import written


def proposal(records: DataFrame, kept: DataFrame, events: DataFrame, relations: DataFrame, findings: DataFrame | None = None) -> dict[str, DataFrame]:
    """records, dropped, events, relations and questions after re-anchoring.

    records: record_id, citations (array of citation ids). kept: citation_id of
    citations that found a place. events: record_id, event_id, refs (array of
    positions in citations that an event needs: its own, its anchor's and its
    alternatives'). relations: src, type, dst. findings, if any: record_id,
    finding, citations (array).

    A record goes if it has no citation left, or had findings and none has one.
    An event goes if any citation that it needs is lost; the refs of others
    move. A relation goes if its target goes, once and not in turn. What a
    record lost becomes a question: (record_id, code, subject).
    """
    left = remapped(records, kept)
    if findings is not None:
        each = findings.select("record_id", "finding", F.explode_outer("citations").alias("citation_id")).join(kept.select("citation_id").distinct().withColumn("here", F.lit(True)), "citation_id", "left")
        held = each.groupBy("record_id", "finding").agg(F.coalesce(F.bool_or("here"), F.lit(False)).alias("held"), F.count_if(F.col("citation_id").isNotNull() & F.col("here").isNull()).alias("gone"))
        per = held.groupBy("record_id").agg(F.bool_or("held").alias("any"), F.sum("gone").alias("f_gone"))
        left = left.join(per, "record_id", "left").where("any is null or any").withColumn("lost", F.col("lost") + F.coalesce("f_gone", F.lit(0))).drop("any", "f_gone")
    left = written(left, "remapped")  # all that follows reads it
    if findings is not None:
        findings = held.where("held").select("record_id", "finding").join(left.select("record_id"), "record_id", "left_semi")
    dropped = records.select("record_id").join(left, "record_id", "left_anti")
    stay = left.select("record_id", "old_to_new")
    e = events.join(stay, "record_id").withColumn("ok", F.forall("refs", lambda i: F.map_contains_key("old_to_new", i)))
    moved = e.where("ok").select("record_id", "event_id", F.transform("refs", lambda i: F.col("old_to_new")[i].cast("int")).alias("refs"))
    r = relations.join(stay.select(F.col("record_id").alias("src")), "src", "left_semi")
    there = stay.select(F.col("record_id").alias("dst"))
    gone = r.join(there, "dst", "left_anti")
    q = lambda df, key, code, subject: df.select(F.col(key).alias("record_id"), F.lit(code).alias("code"), subject.cast("string").alias("subject"))
    questions = q(left.where("lost > 0"), "record_id", "lost_citations", F.col("lost")).unionByName(q(e.where("not ok"), "record_id", "lost_event", F.col("event_id"))).unionByName(q(gone, "src", "lost_relation", F.concat_ws(":", "type", "dst")))
    out = {"records": left, "dropped": dropped, "events": moved, "relations": r.join(there, "dst", "left_semi"), "questions": questions}
    return out if findings is None else out | {"findings": findings}


def coverage(new_files: DataFrame, old_files: DataFrame, old_coverage: DataFrame, cited: DataFrame, approved: bool) -> DataFrame:
    """evidence_id, disposition, method and `why` for each new file.

    new_files and old_files: logical_id, evidence_id, text_sha256,
    representation_sha256. old_coverage: evidence_id (old), disposition,
    method. cited: evidence_id (new) that kept citations are in. Cited files
    are used. Of an approved release, what was read without a record or was
    triaged out is carried over for files whose text and representation are the
    same; everything else is to be read again.
    """
    old = old_files.join(old_coverage, "evidence_id").select("logical_id", F.col("text_sha256").alias("o_text"), F.col("representation_sha256").alias("o_rep"), F.col("disposition").alias("o_disposition"), F.col("method").alias("o_method"))
    rows = new_files.join(old, "logical_id", "left").join(cited.select("evidence_id").distinct().withColumn("cited", F.lit(True)), "evidence_id", "left")
    same = F.col("text_sha256").eqNullSafe(F.col("o_text")) & F.col("representation_sha256").eqNullSafe(F.col("o_rep")) & F.col("o_disposition").isin("reviewed_no_record", "triaged_out")
    carried = F.lit(approved) & same
    not_approved = F.lit(not approved) & F.col("o_disposition").isNotNull() & (F.col("o_disposition") != "used")
    why = F.when(F.col("cited"), "cited").when(carried, "carried_over").when(not_approved, "not_approved").otherwise("new_or_changed")
    return rows.select("evidence_id", F.when(F.col("cited"), "used").when(carried, F.col("o_disposition")).otherwise("deferred").alias("disposition"), F.when(F.col("cited").isNull() & carried, F.col("o_method")).alias("method"), why.alias("why"))


def carries_over(review: DataFrame, run_id: str, records_sha: str, manifest_sha: str) -> bool:
    """Whether a review approved exactly these records of this run."""
    return review.where((F.col("decision") == "approve") & (F.col("run_id") == run_id) & (F.col("records_sha256") == records_sha) & (F.col("manifest_sha256") == manifest_sha)).limit(1).count() > 0
