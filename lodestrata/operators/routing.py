"""Rules on registries, cross-project routing, indexes, reviews and investigations; they join the others in `rules.RULES`.

Tables beyond those of `rules`:

projects     id, domain, names (array of string: the name and the aliases)
disclosures  from_project, to_project, source_id, path_pattern
home         project_id (one row)
mentions     mention_id, evidence_id, line, end_line, target, segment_ids (array)
assessments  mention_id, class, disposition, referral_id, homes (array)
referrals    referral_id, target, class, homes (array), evidence_id, segment_id, start, end, quote, source_id, relative_path, include_pattern
links        record_id, target: what records declare
selected     evidence_id, start, end: selected passages, if a run is targeted
releases     project_id, run_id, visibility
entries      key, project_id, run_id, record_id, visibility
publications ordinal, run_id, sequence, created_at, rollback_reason, and project_id if there are several projects
reviews      run_id, decision, reviewer, reviewed_at, created_at, approved (array), checks (map of boolean)
investigations record_id, scope (array), present (bool)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.globs import regex_of
from lodestrata.functions.text import tokens
from lodestrata.operators.quotes import checked
from lodestrata.operators.rules import Tables, _of, _twice, rule

UNREAD = ("triaged_out", "deferred")


def _hits(t: Tables) -> DataFrame:
    """Mentions with their assessments."""
    return t["mentions"].withColumn("last", F.coalesce("end_line", "line")).join(t["assessments"], "mention_id")


def _granted(rows: DataFrame, t: Tables) -> DataFrame:
    """Rows (with target, source_id, relative_path) that a disclosure grant of the home project covers.

    Patterns are few; they are compiled on the driver.
    """
    g = t["disclosures"].join(t["home"], F.col("from_project") == F.col("project_id")).select("to_project", F.col("source_id").alias("g_source"), "path_pattern").distinct().collect()
    test = F.lit(False)
    for r in g:
        test = test | ((F.col("target") == r.to_project) & (F.col("source_id") == r.g_source) & F.col("relative_path").rlike(regex_of(r.path_pattern)))
    return rows.where(test)


@rule("V19_investigations", "records", "investigations", "citations", "files")
def _(t):
    inv = t["investigations"].where("present")
    kind = t["records"].join(inv.select("record_id").withColumn("has", F.lit(True)), "record_id", "left").where((F.col("kind") == "investigation") != F.coalesce("has", F.lit(False)))
    scope = inv.select("record_id", F.explode("scope").alias("evidence_id"))
    unknown = scope.join(t["files"], "evidence_id", "left_anti")
    beyond = t["citations"].join(inv.select("record_id"), "record_id", "left_semi").join(scope, ["record_id", "evidence_id"], "left_anti")
    return _of(kind, "record_id", "kind").unionByName(_of(unknown, "record_id", "evidence_id")).unionByName(_of(beyond, "record_id", "evidence_id"))


@rule("V27_registry", "projects", "disclosures")
def _(t):
    names = t["projects"].select("id", "domain", F.explode("names").alias("name")).withColumn("words", F.transform(tokens("name"), lambda x: x["token"]))
    blank = names.where((F.size("words") == 0) | (F.trim("name") != F.col("name")))
    shared = names.groupBy("domain", "words").agg(F.count_distinct("id").alias("n"), F.array_join(F.array_sort(F.collect_set("id")), ",").alias("ids")).where("n > 1")
    p = t["projects"].select("id", "domain")
    g = t["disclosures"].join(p.select(F.col("id").alias("from_project"), F.col("domain").alias("a")), "from_project", "left").join(p.select(F.col("id").alias("to_project"), F.col("domain").alias("b")), "to_project", "left")
    bad = g.where("a is null or b is null or from_project = to_project or a <> b")
    return _twice(t["projects"], "id").unionByName(_of(blank, "id", "name")).unionByName(_of(shared, "ids", "alias shared in a domain")).unionByName(_of(bad, F.concat_ws(">", "from_project", "to_project"), "path_pattern"))


@rule("V28_review", "reviews", "records")
def _(t):
    r = t["reviews"]
    open_ = r.where("decision <> 'approve' or trim(reviewer) = '' or reviewed_at is null or reviewed_at < created_at or exists(map_values(checks), x -> not x)")
    ids = t["records"].select("record_id")
    approved = r.select(F.explode("approved").alias("record_id"))
    return _of(open_, "run_id", "not approved in full").unionByName(_of(ids.join(approved, "record_id", "left_anti"), "record_id", "not approved")).unionByName(_of(approved.join(ids, "record_id", "left_anti"), "record_id", "approved but unknown"))


@rule("V29_publication_order", "publications")
def _(t):
    p = t["publications"]
    p = p if "project_id" in p.columns else p.withColumn("project_id", F.lit(None).cast("string"))
    before = F.max(F.struct("sequence", "created_at")).over(Window.partitionBy("project_id").orderBy("ordinal").rowsBetween(-1, -1))
    late = p.withColumn("was", before).where(F.struct("sequence", "created_at") < F.col("was")).where("rollback_reason is null or trim(rollback_reason) = ''")
    return _of(late, "run_id", "older than the current release without a reason").unionByName(_twice(t["publications"], "run_id"))


@rule("V30_index", "entries", "releases")
def _(t):
    e, r = t["entries"], t["releases"].withColumnRenamed("visibility", "v")
    bad = e.join(r, ["project_id", "run_id"], "left").where(F.col("v").isNull() | (F.col("v") != F.col("visibility")) | (F.col("key") != F.concat_ws(":", "project_id", "run_id", "record_id")))
    return _twice(e, "key").unionByName(_twice(t["releases"], "project_id", "run_id")).unionByName(_of(bad, "key", "visibility"))


@rule("V35_one_assessment_each", "mentions", "assessments")
def _(t):
    m, a = t["mentions"].select("mention_id"), t["assessments"].select("mention_id")
    return _twice(a, "mention_id").unionByName(_of(m.join(a, "mention_id", "left_anti"), "mention_id", "not assessed")).unionByName(_of(a.join(m, "mention_id", "left_anti"), "mention_id", "no such mention"))


@rule("V36_unique_referrals", "referrals")
def _(t):
    return _twice(t["referrals"], "referral_id")


@rule("V37_mentions_have_segments", "mentions")
def _(t):
    return _of(t["mentions"].where("size(segment_ids) = 0"), "mention_id", "no segment")


@rule("V38_homes_exist", "assessments", "records")
def _(t):
    h = t["assessments"].select("mention_id", F.explode("homes").alias("record_id"))
    return _of(h.join(t["records"].select("record_id"), "record_id", "left_anti"), "mention_id", "record_id")


@rule("V39_to_V42_classes", "assessments")
def _(t):
    a = t["assessments"].withColumn("n", F.size("homes"))
    reason = F.when(F.expr("class = 'R2' and n > 0"), "target-only mention with a home record").when(F.expr("class = 'R3' and (n > 0 or disposition not in ('dismissed', 'unresolved'))"), "context mention with a home or route").when(F.expr("class = 'R1' and n = 0"), "home constraint without a home record").when(F.expr("disposition = 'linked_home' and (class not in ('R1', 'R4') or n = 0)"), "linked without a home record").when(F.expr("disposition = 'dismissed' and class <> 'R3'"), "only context mentions may be dismissed")
    return _of(a.withColumn("reason", reason).where("reason is not null"), "mention_id", "reason")


@rule("V43_home_links_are_granted", "mentions", "assessments", "files", "disclosures", "home")
def _(t):
    rows = _hits(t).where("size(homes) > 0").join(t["files"].select("evidence_id", "source_id", "relative_path"), "evidence_id")
    return _of(rows.join(_granted(rows, t).select("mention_id"), "mention_id", "left_anti"), "mention_id", "no grant")


def _referred(t: Tables) -> DataFrame:
    r = t["referrals"].select(*[F.col(c).alias(f"r_{c}") for c in t["referrals"].columns])
    return _hits(t).where("disposition = 'referred'").join(r, F.col("referral_id") == F.col("r_referral_id"), "left")


@rule("V44_referrals_agree", "mentions", "assessments", "referrals")
def _(t):
    r = _referred(t)
    bad = r.where("r_referral_id is null or class = 'R3' or r_target <> target or r_class <> class or not (r_homes <=> homes)")
    return _of(bad, "mention_id", "referral_id").unionByName(_twice(t["assessments"].where("disposition = 'referred' and referral_id is not null"), "referral_id"))


@rule("V45_referral_covers_its_mention", "mentions", "assessments", "referrals", "segments")
def _(t):
    s = t["segments"].select(F.col("segment_id").alias("s_id"), F.col("evidence_id").alias("s_evidence"), F.col("start").alias("s_start"), F.col("end").alias("s_end"))
    r = _referred(t).where("r_referral_id is not null").join(s, F.col("r_segment_id") == F.col("s_id"), "left")
    return _of(r.where("s_id is null or r_evidence_id <> evidence_id or s_evidence <> evidence_id or not (s_start <= r_start and r_start <= line and last <= r_end and r_end <= s_end)"), "r_referral_id", "outside the mention's segment")


@rule("V46_referral_quotes", "referrals", "files")
def _(t):
    return _of(checked(t["referrals"], t["files"]).where("verdict <> 'ok'"), "referral_id", "verdict")


@rule("V47_referral_in_selection", "referrals", "selected")
def _(t):
    s = t["selected"].select(F.col("evidence_id").alias("p_evidence"), F.col("start").alias("p_start"), F.col("end").alias("p_end"))
    return _of(t["referrals"].join(s, (F.col("evidence_id") == F.col("p_evidence")) & (F.col("p_start") <= F.col("start")) & (F.col("end") <= F.col("p_end")), "left_anti"), "referral_id", "outside the selected passages")


@rule("V47_referral_was_read", "referrals", "coverage", "segment_coverage", "interval_coverage")
def _(t):
    r = t["referrals"].select("referral_id", "evidence_id", "segment_id", "start", "end")
    unread = F.col("disposition").isin(*UNREAD)
    i = t["interval_coverage"].where(unread).select(F.col("segment_id").alias("i_segment"), F.col("start").alias("i_start"), F.col("end").alias("i_end"))
    by = [r.join(t["coverage"].where(unread).select("evidence_id"), "evidence_id", "left_semi"), r.join(t["segment_coverage"].where(unread).select("segment_id"), "segment_id", "left_semi"), r.join(i, (F.col("segment_id") == F.col("i_segment")) & (F.col("i_start") <= F.col("end")) & (F.col("start") <= F.col("i_end")), "left_semi")]
    return _of(by[0], "referral_id", "file not read").unionByName(_of(by[1], "referral_id", "segment not read")).unionByName(_of(by[2], "referral_id", "interval not read"))


@rule("V48_referral_target", "referrals", "files", "projects", "disclosures", "home")
def _(t):
    f = t["files"].select("evidence_id", F.col("source_id").alias("f_source"), F.col("relative_path").alias("f_path"))
    r = t["referrals"].join(f, "evidence_id", "left")
    hint = r.where("f_source is null or source_id <> f_source or relative_path <> f_path or include_pattern <> f_path")
    domain = t["projects"].join(t["home"], F.col("id") == F.col("project_id")).select(F.col("domain").alias("h"))
    p = t["projects"].select(F.col("id").alias("target"), "domain").join(domain, F.col("domain") == F.col("h"), "left_semi")
    return _of(hint, "referral_id", "capture hint is not the exact path").unionByName(_of(r.join(p, "target", "left_anti"), "referral_id", "target")).unionByName(_of(r.join(_granted(r, t).select("referral_id"), "referral_id", "left_anti"), "referral_id", "no grant"))


@rule("V49_only_referred_have_referrals", "assessments")
def _(t):
    return _of(t["assessments"].where("disposition <> 'referred' and referral_id is not null"), "mention_id", "referral_id")


@rule("V50_target_only_is_not_cited", "mentions", "assessments", "citations")
def _(t):
    c = t["citations"].select(F.col("evidence_id").alias("c_evidence"), F.col("start").alias("c_start"), F.col("end").alias("c_end"))
    return _of(_hits(t).where("class = 'R2'").join(c, (F.col("evidence_id") == F.col("c_evidence")) & (F.col("c_start") <= F.col("last")) & (F.col("line") <= F.col("c_end")), "left_semi"), "mention_id", "cited as home knowledge")


@rule("V51_homes_hold_the_mention", "mentions", "assessments", "citations")
def _(t):
    h = _hits(t).withColumn("home", F.explode("homes"))
    c = t["citations"].select("record_id", F.col("evidence_id").alias("c_evidence"), F.col("start").alias("c_start"), F.col("end").alias("c_end"))
    return _of(h.join(c, (F.col("home") == F.col("record_id")) & (F.col("evidence_id") == F.col("c_evidence")) & (F.col("c_start") <= F.col("line")) & (F.col("last") <= F.col("c_end")), "left_anti"), "mention_id", "home")


@rule("V51_every_referral_is_used", "referrals", "assessments")
def _(t):
    used = t["assessments"].where("disposition = 'referred'").select("referral_id")
    return _of(t["referrals"].join(used, "referral_id", "left_anti"), "referral_id", "no mention maps to it")


@rule("V52_links_agree", "mentions", "assessments", "links")
def _(t):
    have = _hits(t).select(F.explode("homes").alias("record_id"), "target").distinct()
    said = t["links"].select("record_id", "target").distinct()
    name = F.concat_ws(">", "record_id", "target")
    return _of(have.join(said, ["record_id", "target"], "left_anti"), name, "assessed but not declared").unionByName(_of(said.join(have, ["record_id", "target"], "left_anti"), name, "declared but not assessed"))


def publishable(requests: DataFrame) -> DataFrame:
    """Runs that may be published at all: those for analysis only never are."""
    return requests.where("purpose is null or purpose <> 'analysis_only'")
