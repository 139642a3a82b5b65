"""The review report as rows: what may block an approval, and what to verify of each record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.views import record_changes

# What a reviewer is asked, by kind of record.
QUESTIONS = {
    "decision": "Does the cited context establish a final decision and its authority, rather than a proposal?",
    "uncertainty": "Are both sides of the uncertainty and the unresolved status preserved?",
    "investigation": "Do the scoped citations support each finding without implying runtime verification?",
}
OTHER = "Does each citation support the stated requirement, scope, status, and conditions?"
CHANGED = " What justifies the change from the previous approved record?"
REMOVED = "Is removing this previously approved record justified by current evidence and scope?"


def question(kind: Column, change: Column) -> Column:
    asked = F.lit(OTHER)
    for k, text in QUESTIONS.items():
        asked = F.when(kind == k, text).otherwise(asked)
    return F.when(change == "removed", REMOVED).when(change == "changed", F.concat(asked, F.lit(CHANGED))).otherwise(asked)


def severity(kind: Column, change: Column) -> Column:
    return F.when((kind == "uncertainty") | change.isin("changed", "removed"), "high").otherwise("review")


def blockers(records: DataFrame, old: DataFrame, issues: DataFrame, coverage: DataFrame, segment_coverage: DataFrame) -> DataFrame:
    """(severity, code, subject) of what may stand against an approval; none of it decides."""
    row = lambda df, level, code, subject: df.select(F.lit(level).alias("severity"), F.lit(code).alias("code"), F.col(subject).cast("string").alias("subject"))
    return reduce(
        DataFrame.unionByName,
        [
            row(old.join(records, "record_id", "left_anti"), "high", "removed", "record_id"),
            row(records.where("kind = 'uncertainty' or epistemic_status = 'unresolved'"), "high", "unresolved", "record_id"),
            row(issues, "potential_high", "unavailable_material", "evidence_id"),
            row(triaged(coverage, "evidence_id"), "review", "triaged_file", "evidence_id"),
            row(triaged(segment_coverage, "segment_id"), "review", "triaged_segment", "segment_id"),
        ],
    )


def triaged(declared: DataFrame, key: str, more: DataFrame | None = None) -> DataFrame:
    """The keys that are triaged out, each once; `more` are further declarations, as those of intervals."""
    both = declared.select(key, "disposition") if more is None else declared.select(key, "disposition").unionByName(more.select(key, "disposition"))
    return both.where("disposition = 'triaged_out'").select(key).distinct()


def reviews(old: DataFrame, new: DataFrame, fields: list[str]) -> DataFrame:
    """record_id, change (added, removed, changed or unchanged), severity, question, before and after for each record of either side."""
    change = record_changes(old, new, fields).withColumn("change", F.when(F.col("change") == "retained", "unchanged").otherwise(F.col("change")))
    said = lambda: F.concat(F.col("kind"), F.lit(" / "), F.col("epistemic_status"), F.lit(": "), F.col("statement"))
    a = old.select("record_id", F.col("kind").alias("o_kind"), said().alias("before"))
    b = new.select("record_id", F.col("kind").alias("n_kind"), said().alias("after"))
    rows = change.join(a, "record_id", "left").join(b, "record_id", "left").withColumn("kind", F.coalesce("n_kind", "o_kind"))
    return rows.select("record_id", "change", severity(F.col("kind"), F.col("change")).alias("severity"), question(F.col("kind"), F.col("change")).alias("question"), "before", "after")


def events_text(events: DataFrame) -> DataFrame:
    """record_id and one line for each event of it: its statement, the numbers of its citations and its date label."""
    numbers = F.array_join(F.transform("refs", lambda i: (i + 1).cast("string")), ", ")
    return events.select("record_id", F.concat(F.lit("Event "), F.col("event_id"), F.lit(": "), F.col("statement"), F.lit(" (citations "), numbers, F.lit("; "), F.col("label"), F.lit(")")).alias("line"))
