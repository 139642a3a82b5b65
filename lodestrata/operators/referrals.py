"""Referrals between projects: manual references, the intake ledger, captures and links; their rules join `rules.RULES`.

Tables beyond those of `rules` and `routing`:

manual_mentions  mention_id, evidence_id, segment_id, representation_sha256, start, end, quote, target
segment_hashes   segment_id, representation_sha256
report_digests   name, expected, found: digests of the registry and the mention scan as stated and as recomputed
proposal         project_id, run_id, schema_version, records_schema_version, registry_version (one row), with run_project_id and run_run_id of the run
intake           item_id, expected_id, origin_project, target_project, family, supersedes, source_status, first_seen, origin_review_sha256
observations     item_id, ordinal, status
decisions        item_id, ordinal, decision, reviewer, reason, reviewed_at, origin_review_sha256, capture_mode (null: none)
tasks            item_id, status
requests         request_id, evidence_id, start, end: what a targeted run asks for
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.operators.graph import reachable_cycles
from lodestrata.operators.quotes import checked
from lodestrata.operators.rules import _of, _twice, rule

#: Scanned and manual references of a run at most.
MOST = 10_000


@rule("V31_registry_and_scan", "proposal", "report_digests")
def _(t):
    p = _of(t["proposal"].where("registry_version <> '1.1'"), "run_id", "registry_version")
    return p.unionByName(_of(t["report_digests"].where("not (expected <=> found)"), "name", "does not recompute"))


@rule("V32_referrals_belong_to_the_run", "proposal")
def _(t):
    p = t["proposal"]
    other = p.where("project_id <> run_project_id or run_id <> run_run_id")
    old = p.where("records_schema_version = '0.6' and schema_version <> '1.1'")
    return _of(other, "run_id", "another project or run").unionByName(_of(old, "run_id", "schema_version"))


@rule("V33_references_in_number", "mentions", "manual_mentions")
def _(t):
    n = t["mentions"].select("mention_id").unionAll(t["manual_mentions"].select("mention_id")).agg(F.count("*").alias("n"))
    return _of(n.where(F.col("n") > MOST), F.lit("run"), "n")


@rule("V34_manual_references", "manual_mentions", "mentions", "files", "segments", "segment_hashes", "projects", "home")
def _(t):
    m = t["manual_mentions"]
    s = t["segments"].join(t["segment_hashes"], "segment_id").select("segment_id", F.col("evidence_id").alias("s_evidence"), F.col("representation_sha256").alias("s_rep"), F.col("start").alias("s_start"), F.col("end").alias("s_end"))
    bound = m.join(s, "segment_id", "left").where("s_evidence is null or s_evidence <> evidence_id or s_rep <> representation_sha256 or not (s_start <= start and start <= end and end <= s_end)")
    quoted = checked(m, t["files"]).where("verdict <> 'ok'")
    home = t["projects"].join(t["home"], F.col("id") == F.col("project_id")).select(F.col("id").alias("home_id"), F.col("domain").alias("home_domain"))
    fit = t["projects"].join(home, (F.col("domain") == F.col("home_domain")) & (F.col("id") != F.col("home_id"))).select(F.col("id").alias("target"))
    again = m.join(t["mentions"].select("mention_id"), "mention_id", "left_semi")
    return _of(bound, "mention_id", "no exact segment range").unionByName(_of(quoted, "mention_id", "verdict")).unionByName(_of(m.join(fit, "target", "left_anti"), "mention_id", "target")).unionByName(_of(again, "mention_id", "also scanned")).unionByName(_twice(m, "mention_id"))


@rule("V34_manual_references_selected", "manual_mentions", "selected")
def _(t):
    s = t["selected"].select(F.col("evidence_id").alias("p_evidence"), F.col("start").alias("p_start"), F.col("end").alias("p_end"))
    return _of(t["manual_mentions"].join(s, (F.col("evidence_id") == F.col("p_evidence")) & (F.col("p_start") <= F.col("start")) & (F.col("end") <= F.col("p_end")), "left_anti"), "mention_id", "outside the selected passages")


def task_of(items: DataFrame, decisions: DataFrame) -> DataFrame:
    """item_id and the status of its capture task: what its last decision, if it accepts, leads to; items without one have none."""
    last = decisions.groupBy("item_id").agg(F.max_by(F.struct("decision", "capture_mode"), "ordinal").alias("d"))
    status = F.when(F.col("source_status") != "current", F.concat(F.lit("blocked_source_"), F.col("source_status"))).when(F.col("d.capture_mode").isNotNull(), "proposed_capture_reconciliation").otherwise("blocked_capture_authorization")
    return items.join(last, "item_id").where("d.decision = 'accept'").select("item_id", status.alias("status"))


def human(reviewer: Column, reason: Column, at: Column, floor: Column, now: Column, skew: int = 600) -> Column:
    """Whether a review names a person and a reason, and is neither before what it reviews nor in the future."""
    return (F.trim(reviewer) != "") & (F.trim(reason) != "") & (at >= floor) & (at <= now + F.make_dt_interval(secs=F.lit(skew)))


@rule("V53_intake_identities", "intake", "home")
def _(t):
    i = t["intake"].join(t["home"].select(F.col("project_id").alias("home_id")), F.lit(True))  # one row
    return _of(i.where("target_project <> home_id or origin_project = home_id or item_id <> expected_id"), "item_id", "identity").unionByName(_twice(t["intake"], "item_id"))


@rule("V53_intake_status_is_the_last_observed", "intake", "observations")
def _(t):
    last = t["observations"].groupBy("item_id").agg(F.max_by("status", "ordinal").alias("last"))
    return _of(t["intake"].join(last, "item_id", "left").where("last is null or last <> source_status"), "item_id", "last")


@rule("V53_intake_decisions", "intake", "decisions")
def _(t):
    d = t["decisions"].join(t["intake"].select("item_id", "first_seen", F.col("origin_review_sha256").alias("i_sha")), "item_id", "left")
    bad = d.where(F.col("i_sha").isNull() | (F.col("i_sha") != F.col("origin_review_sha256")) | ~human(F.col("reviewer"), F.col("reason"), F.col("reviewed_at"), F.col("first_seen"), F.current_timestamp()) | ((F.col("decision") != "accept") & F.col("capture_mode").isNotNull()))
    name = F.concat_ws(":", "item_id", F.col("ordinal").cast("string"))
    before = F.max("reviewed_at").over(Window.partitionBy("item_id").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1))
    late = t["decisions"].withColumn("before", before).where("reviewed_at < before")
    same = t["decisions"].drop("ordinal")
    return _of(bad, name, "decision").unionByName(_of(late, name, "older than the decision before")).unionByName(_of(same.groupBy(*same.columns).count().where("count > 1"), "item_id", "decided twice alike"))


@rule("V53_intake_tasks", "intake", "decisions", "tasks")
def _(t):
    want = task_of(t["intake"], t["decisions"]).withColumnRenamed("status", "want")
    return _of(want.join(t["tasks"], "item_id", "full_outer").where("not (want <=> status)"), "item_id", "status")


@rule("V53_intake_lineage", "intake")
def _(t):
    i = t["intake"]
    p = i.select(F.col("item_id").alias("p_id"), F.col("family").alias("p_family"))
    bad = i.where("supersedes is not null").join(p, F.col("supersedes") == F.col("p_id"), "left").where("p_family is null or p_family <> family")
    ring = reachable_cycles(i.where("supersedes is not null"), "item_id", "supersedes").withColumnRenamed("src", "item_id")
    return _of(bad, "item_id", "supersedes").unionByName(_of(ring, "item_id", "cyclic lineage"))


@rule("V56_requests", "requests", "files")
def _(t):
    f = t["files"].select("evidence_id", F.size("lines").alias("n"))
    bad = t["requests"].join(f, "evidence_id", "left").where("n is null or start < 1 or end < start or end > n")
    return _of(bad, "request_id", "evidence_id").unionByName(_twice(t["requests"], "request_id"))


@rule("V61_target_is_registered", "proposal", "projects", "home")
def _(t):
    gone = t["home"].join(t["projects"], F.col("project_id") == F.col("id"), "left_anti")
    return _of(t["proposal"].where("registry_version <> '1.1'"), "run_id", "registry_version").unionByName(_of(gone, "project_id", "not registered"))


def source_files(referrals: DataFrame, files: DataFrame, segments: DataFrame) -> DataFrame:
    """referral_id and the file that it comes from: source_id, relative_path, sha256, original_locator."""
    f = files.select("evidence_id", F.col("source_id").alias("f_source"), F.col("relative_path").alias("f_path"), "sha256")
    return referrals.select("referral_id", "evidence_id", "segment_id").join(f, "evidence_id").join(segments.select("segment_id", "original_locator"), "segment_id").select("referral_id", F.col("f_source").alias("source_id"), F.col("f_path").alias("relative_path"), "sha256", "original_locator")


def has_quote(text: Column, quote: Column) -> Column:
    """Whether whole lines of a text are the quote."""
    return F.contains(F.concat(F.lit("\n"), text, F.lit("\n")), F.concat(F.lit("\n"), quote, F.lit("\n")))


def captures(authorisations: DataFrame) -> DataFrame:
    """authorisations (item_id, mode, decision, reason, stated_sha256, actual_sha256, origin_sha256, text, quote; text is null where the bytes are no UTF-8) with `verdict`: ok, or why the capture may not go ahead."""
    full = F.when(F.col("actual_sha256") != F.col("origin_sha256"), "not_the_original")
    part = F.when(F.col("actual_sha256") == F.col("origin_sha256"), "whole_file_as_export").when(F.col("text").isNull() | F.contains("text", F.lit("\x00")), "not_text").when(~has_quote(F.col("text"), F.col("quote")), "quote_not_kept")
    verdict = F.when((F.col("decision") != "accept") | (F.trim("reason") == ""), "not_accepted").when(F.col("stated_sha256") != F.col("actual_sha256"), "bytes_changed").when(F.col("mode") == "full_file", full).otherwise(part)
    return authorisations.withColumn("verdict", F.coalesce(verdict, F.lit("ok")))


def compared(links: DataFrame, citations: DataFrame) -> DataFrame:
    """Each linked record's own citations of the authorised bytes: item_id, record_id, evidence_id, comparison.

    links: item_id, record_id, mode, capture_sha256, quote,
    representation_sha256, original_locator. citations: record_id,
    evidence_id, file_sha256, quote, representation_sha256, original_locator. A
    record with no such citation has one row with null evidence and comparison
    `unsupported`.
    """
    c = citations.select(*[F.col(x).alias(f"c_{x}") for x in citations.columns])
    met = links.join(c, (F.col("record_id") == F.col("c_record_id")) & (F.col("capture_sha256") == F.col("c_file_sha256")) & has_quote(F.col("c_quote"), F.col("quote")), "left")
    same = F.col("representation_sha256").eqNullSafe(F.col("c_representation_sha256")) & F.col("original_locator").eqNullSafe(F.col("c_original_locator"))
    kind = F.when(F.col("c_evidence_id").isNull(), "unsupported").when(F.col("mode") == "scoped_export", "scoped_export").when(same, "same_representation_and_locator").otherwise("different_representation_or_locator")
    return met.select("item_id", "record_id", F.col("c_evidence_id").alias("evidence_id"), kind.alias("comparison"))
