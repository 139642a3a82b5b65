"""Integrity rules: each is a query of violations, and any violation stops a run.

A rule takes the tables by name and returns (rule, subject, detail). Tables:

files       evidence_id, source_id, source_type, relative_path, sha256, lines (array of string)
records     record_id, kind, epistemic_status, statement, open_questions (array), run_id, project_id
citations   record_id, ordinal, evidence_id, start, end, quote, segment_id
relations   src, type, dst
coverage    evidence_id, disposition, method
segments    segment_id, evidence_id, ordinal, start, end
segment_coverage  segment_id, disposition, method
interval_coverage segment_id, ordinal, start, end, disposition, method
events      event_id, record_id, status, value, end_value, precision, evidence_refs (array of int)
assertions  owner, type, target, status
attributions record_id, citation_ordinal, class, linked
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.dates import partial
from lodestrata.functions.globs import identifier, safe_path
from lodestrata.operators.intervals import not_covering, overlapping, rollup
from lodestrata.operators.quotes import checked

Tables = dict[str, DataFrame]
RULES: dict[str, tuple[tuple[str, ...], Callable[[Tables], DataFrame]]] = {}

# Fixed values.
PREFIXES = {"requirement": "REQ", "decision": "DEC", "uncertainty": "UNC", "investigation": "INV"}
DISPOSITIONS = ("used", "deferred", "triaged_out", "reviewed_no_record")


def rule(name: str, *needs: str):
    def put(f):
        RULES[name] = (needs, lambda t: f(t).select(F.lit(name).alias("rule"), F.col("subject").cast("string").alias("subject"), F.col("detail").cast("string").alias("detail")))
        return f

    return put


def _of(df: DataFrame, subject: Column | str, detail: Column | str = "") -> DataFrame:
    c = lambda x: F.col(x) if isinstance(x, str) and x in df.columns else F.lit(x) if isinstance(x, str) else x
    return df.select(c(subject).cast("string").alias("subject"), c(detail).cast("string").alias("detail"))


def _twice(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).count().where("count > 1").select(F.concat_ws(":", *[F.col(k).cast("string") for k in keys]).alias("subject"), F.concat(F.lit("occurs "), F.col("count").cast("string"), F.lit(" times")).alias("detail"))


@rule("V3_unique_evidence", "files")
def _(t):
    return _twice(t["files"], "evidence_id").unionByName(_twice(t["files"], "source_id", "relative_path"))


@rule("V5_line_content", "files")
def _(t):
    return _of(t["files"].where(F.exists("lines", lambda x: F.contains(x, F.lit("\x00")))), "evidence_id", "holds NUL")


@rule("V6_not_empty", "files")
def _(t):
    return t["files"].agg(F.count("*").alias("n")).where("n = 0").select(F.lit("run").alias("subject"), F.lit("no files").alias("detail"))


@rule("PF7_safe_paths", "files")
def _(t):
    return _of(t["files"].where(~safe_path(F.col("relative_path"))), "evidence_id", "relative_path")


@rule("PF8_identifiers", "files")
def _(t):
    return _of(t["files"].where(~identifier(F.col("source_id"))), "evidence_id", "source_id")


@rule("V10_unique_records", "records")
def _(t):
    return _twice(t["records"], "record_id")


@rule("V11_file_coverage", "files", "coverage")
def _(t):
    f, c = t["files"], t["coverage"]
    return _of(f.join(c, "evidence_id", "left_anti"), "evidence_id", "not declared").unionByName(_of(c.join(f, "evidence_id", "left_anti"), "evidence_id", "unknown file")).unionByName(_twice(c, "evidence_id"))


@rule("V12_triage_names_its_method", "coverage")
def _(t):
    return _of(t["coverage"].where((F.col("disposition") == "triaged_out") != F.col("method").isNotNull()), "evidence_id", "disposition")


@rule("V12_known_disposition", "coverage")
def _(t):
    return _of(t["coverage"].where(~F.col("disposition").isin(*DISPOSITIONS)), "evidence_id", "disposition")


@rule("V13_exact_citations", "citations", "files")
def _(t):
    bad = checked(t["citations"], t["files"]).where("verdict <> 'ok'")
    return _of(bad, F.concat_ws(":", "record_id", F.col("ordinal").cast("string")), "verdict")


@rule("V14_within_segment", "citations", "segments")
def _(t):
    s = t["segments"].select(F.col("segment_id").alias("s_id"), F.col("evidence_id").alias("s_evidence"), F.col("start").alias("s_start"), F.col("end").alias("s_end"))
    c = t["citations"].where("segment_id is not null").join(s, F.col("segment_id") == F.col("s_id"), "left")
    bad = c.where("s_id is null or s_evidence <> evidence_id or start < s_start or end > s_end")
    return _of(bad, F.concat_ws(":", "record_id", F.col("ordinal").cast("string")), "segment_id")


@rule("V15_prefix_is_kind", "records")
def _(t):
    prefix = F.create_map(*[x for k, v in PREFIXES.items() for x in (F.lit(k), F.lit(v))])[F.col("kind")]
    return _of(t["records"].where(~F.col("record_id").rlike(r"^[A-Z]{3}-\d+$") | ~F.coalesce(F.split_part("record_id", F.lit("-"), F.lit(1)) == prefix, F.lit(False))), "record_id", "kind")


@rule("V16_decisions_need_more_than_code", "records", "citations", "files")
def _(t):
    c = t["citations"].join(t["files"].select("evidence_id", "source_type"), "evidence_id")
    only = c.groupBy("record_id").agg(F.bool_and(F.col("source_type") == "repository").alias("only")).where("only")
    return _of(t["records"].where("kind = 'decision'").join(only, "record_id"), "record_id", "cites only repositories")


@rule("V17_relations", "relations", "records")
def _(t):
    from lodestrata.operators.coverage import edge_faults

    bad = edge_faults(t["relations"], t["records"], node="record_id")
    return _of(bad, F.concat_ws(":", "src", "type", "dst"), "fault")


@rule("V18_uncertainty_is_open", "records")
def _(t):
    return _of(t["records"].where("kind = 'uncertainty' and (epistemic_status <> 'unresolved' or size(open_questions) = 0)"), "record_id", "epistemic_status")


@rule("V20_used_means_cited", "coverage", "citations")
def _(t):
    used = t["coverage"].where("disposition = 'used'").select("evidence_id").distinct()
    cited = t["citations"].select("evidence_id").distinct()
    return _of(used.join(cited, "evidence_id", "left_anti"), "evidence_id", "used but not cited").unionByName(_of(cited.join(used, "evidence_id", "left_anti"), "evidence_id", "cited but not used"))


@rule("V21_segment_coverage", "segments", "segment_coverage")
def _(t):
    s, c = t["segments"], t["segment_coverage"]
    return _of(s.join(c, "segment_id", "left_anti"), "segment_id", "not declared").unionByName(_of(c.join(s, "segment_id", "left_anti"), "segment_id", "unknown segment")).unionByName(_twice(c, "segment_id"))


@rule("W5_segments_ascend", "segments", "files")
def _(t):
    from lodestrata.operators.intervals import not_ascending

    beyond = t["segments"].join(t["files"].select("evidence_id", F.size("lines").alias("n")), "evidence_id").where("end > n or start < 1")
    return _of(not_ascending(t["segments"], ["evidence_id"], "ordinal"), "segment_id", "out of order").unionByName(_of(beyond, "segment_id", "out of its file"))


@rule("V22_intervals_partition", "segments", "interval_coverage")
def _(t):
    s = t["segments"].select("segment_id", F.col("start").alias("seg_start"), F.col("end").alias("seg_end"))
    i = t["interval_coverage"].join(s, "segment_id")
    return _of(not_covering(i, ["segment_id"], "ordinal"), "segment_id", "faults").unionByName(_of(s.join(t["interval_coverage"], "segment_id", "left_anti"), "segment_id", "no intervals"))


@rule("V22_used_intervals_are_cited", "interval_coverage", "citations")
def _(t):
    c = t["citations"].where("segment_id is not null").select("segment_id", "start", "end")
    hit = overlapping(t["interval_coverage"].select("segment_id", "ordinal", "start", "end"), c, ["segment_id"]).select("segment_id", "ordinal").distinct().withColumn("cited", F.lit(True))
    both = t["interval_coverage"].join(hit, ["segment_id", "ordinal"], "left").where((F.col("disposition") == "used") != F.coalesce("cited", F.lit(False)))
    return _of(both, F.concat_ws(":", "segment_id", F.col("ordinal").cast("string")), "disposition")


@rule("V22_rollup", "interval_coverage", "segment_coverage")
def _(t):
    up = t["interval_coverage"].groupBy("segment_id").agg(rollup(F.col("disposition")).alias("rolled"))
    return _of(t["segment_coverage"].join(up, "segment_id").where("disposition <> rolled"), "segment_id", "rolled")


@rule("V23_attributions", "attributions", "citations", "records")
def _(t):
    a = t["attributions"]
    n = t["citations"].groupBy("record_id").agg(F.count("*").alias("n"))
    missing = t["citations"].join(a, [t["citations"]["record_id"] == a["record_id"], t["citations"]["ordinal"] == a["citation_ordinal"]], "left_anti").select(F.concat_ws(":", "record_id", F.col("ordinal").cast("string")).alias("subject"), F.lit("not attributed").alias("detail"))
    bad = a.join(t["records"].select("record_id", "epistemic_status"), "record_id").join(n, "record_id", "left").where("class = 'R2' or (class in ('unknown', 'R3') and epistemic_status = 'observed') or (class in ('R1', 'R4') and not linked) or citation_ordinal >= n")
    return missing.unionByName(_of(bad, F.concat_ws(":", "record_id", F.col("citation_ordinal").cast("string")), "class")).unionByName(_twice(a, "record_id", "citation_ordinal"))


@rule("V24_assertions", "assertions", "records")
def _(t):
    a = t["assertions"]
    own = _of(a.where("owner = target"), F.concat_ws(":", "owner", "type", "target"), "self")
    gone = _of(a.join(t["records"].select(F.col("record_id").alias("target")), "target", "left_anti"), F.concat_ws(":", "owner", "type", "target"), "no such target")
    return own.unionByName(gone).unionByName(_twice(a, "owner", "type", "target"))


@rule("V25_nothing_deferred", "records", "coverage")
def _(t):
    none = t["records"].agg(F.count("*").alias("n")).where("n = 0").select(F.lit("run").alias("subject"), F.lit("no records").alias("detail"))
    return none.unionByName(_of(t["coverage"].where("disposition = 'deferred'"), "evidence_id", "deferred"))


@rule("V26_events", "events", "citations")
def _(t):
    e = t["events"]
    n = t["citations"].groupBy("record_id").agg(F.count("*").alias("n"))
    refs = e.join(n, "record_id", "left").where(F.exists("evidence_refs", lambda i: (i < 0) | (i >= F.coalesce(F.col("n"), F.lit(0)))))
    dated = e.where("status in ('known', 'approximate')").withColumn("v", partial(F.col("value"))).withColumn("w", partial(F.col("end_value")))
    wrong = dated.where("v is null or v.precision <> precision or (end_value is not null and (w is null or w.sort_ts < v.sort_ts))")
    return _twice(e, "event_id").unionByName(_of(refs, "event_id", "reference out of range")).unionByName(_of(wrong, "event_id", "value"))


def violations(tables: Tables, only: list[str] | None = None, absent: str = "report") -> DataFrame:
    """All violations as one query, of all rules or of those named in `only`.

    A rule whose tables are not there can't be checked, which is a violation
    too; absent="skip" leaves such rules out, for a caller who knows that a run
    has no such tables.
    """
    from lodestrata.operators import gates, referrals, routing  # noqa: F401  register their rules

    if unknown := set(only or ()) - set(RULES):
        raise ValueError(f"no such rules: {sorted(unknown)}")
    spark = next(iter(tables.values())).sparkSession
    wanted = {name: r for name, r in RULES.items() if only is None or name in only}
    skipped = [(name, "run", f"not checked: no table {', '.join(n for n in needs if n not in tables)}") for name, (needs, _) in wanted.items() if any(n not in tables for n in needs)]
    found = [f(tables) for needs, f in wanted.values() if all(n in tables for n in needs)]
    if skipped and absent != "skip":
        found.append(spark.createDataFrame(skipped, "rule string, subject string, detail string"))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "rule string, subject string, detail string")


def require(tables: Tables, only: list[str] | None = None, absent: str = "report") -> None:
    """Raise with the first twenty violations by rule and subject, if there are any."""
    bad = violations(tables, only, absent).orderBy("rule", "subject", "detail").limit(20).collect()
    if bad:
        raise ValueError("; ".join(f"{r.rule} {r.subject}: {r.detail}" for r in bad))


def hints(tables: Tables) -> DataFrame:
    """What a reviewer should look at, but no rule forbids: (code, record_id, detail)."""
    from lodestrata.functions.text import pending_words

    c, r = tables["citations"], tables["records"]
    single = c.groupBy("record_id").agg(F.bool_and(F.col("start") == F.col("end")).alias("one")).where("one").select(F.lit("single_line_citations").alias("code"), "record_id", F.lit("every citation is one line").alias("detail"))
    words = c.join(r.where("kind = 'decision'").select("record_id"), "record_id").select("record_id", F.explode(pending_words(F.col("quote"))).alias("w")).groupBy("record_id").agg(F.array_join(F.array_sort(F.collect_set("w")), ", ").alias("detail"))
    triaged = tables["coverage"].groupBy().agg(F.count_if(F.col("disposition") == "triaged_out").alias("n"), F.count("*").alias("all"), F.array_join(F.array_sort(F.collect_set("method")), ", ").alias("m")).where("n > 0")
    return single.unionByName(words.select(F.lit("decision_quote_pending_language").alias("code"), "record_id", "detail")).unionByName(triaged.select(F.lit("triaged_coverage").alias("code"), F.lit(None).cast("string").alias("record_id"), F.concat(F.col("n").cast("string"), F.lit(" of "), F.col("all").cast("string"), F.lit(": "), F.col("m")).alias("detail")))
