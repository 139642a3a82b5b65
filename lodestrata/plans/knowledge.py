"""Queries on the index, re-anchored proposals, review reports, referrals and scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.functions import dates, identity, text
from lodestrata.operators import context, coverage, delta, index, intervals, quotes, ranking, reanchor, referrals, report, rules, selection
from lodestrata.plans.registry import SECOND, documents, query, second, table
from lodestrata.session import written

# ---- the index: parts are records of 25 projects and three runs

RECS = "recs AS (SELECT 'n' || p_partkey % 25 AS project_id, 'run' || p_partkey % 3 AS run_id, 'R-' || p_partkey AS record_id, ['requirement','decision','uncertainty','investigation'][p_partkey % 4 + 1] AS kind, ['observed','interpretation','proposal'][p_size % 3 + 1] AS epistemic_status FROM part), projects AS (SELECT 'n' || n_nationkey AS project_id, 'run' || n_nationkey % 3 AS current_run_id FROM nation), rel AS (SELECT project_id, 'run' || i AS run_id, CASE WHEN 'run' || i = current_run_id THEN 'current' ELSE 'historical' END AS visibility FROM projects, (SELECT unnest([0, 1, 2]) AS i))"


def _index(spark, sf_dir, include_history=True):
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("project_id"), F.concat(F.lit("run"), (F.col("n_nationkey") % 3).cast("string")).alias("current_run_id"))
    releases = n.select("project_id", F.explode(F.array(*[F.lit(f"run{i}") for i in range(3)])).alias("run_id"))
    k = F.col("p_partkey")
    pick = lambda at, *x: F.element_at(F.array(*map(F.lit, x)), (at + 1).cast("int"))
    records = table(spark, sf_dir, "part").select(F.concat(F.lit("n"), (k % 25).cast("string")).alias("project_id"), F.concat(F.lit("run"), (k % 3).cast("string")).alias("run_id"), F.concat(F.lit("R-"), k.cast("string")).alias("record_id"), pick(k % 4, *index.KINDS).alias("kind"), pick(F.col("p_size") % 3, *index.STATUSES[:3]).alias("epistemic_status"))
    return index.build(n, releases, records, include_history, most_entries=10**9)


@query(f"WITH {RECS} SELECT r.project_id || ':' || r.run_id || ':' || record_id AS key, kind, epistemic_status, visibility FROM recs r JOIN rel USING (project_id, run_id)")
def q_index_entries(spark, sf_dir):
    return _index(spark, sf_dir)["entries"].select("key", "kind", "epistemic_status", "visibility")


@query(f"WITH {RECS} SELECT record_id FROM recs JOIN rel USING (project_id, run_id) WHERE visibility = 'historical' AND kind = 'decision' AND epistemic_status = 'proposal'")
def q_index_eligible(spark, sf_dir):
    return index.eligible(_index(spark, sf_dir)["entries"], "historical", kind="decision", status="proposal").select("record_id")


@query(f"WITH {RECS}, e AS (SELECT project_id, count(*) AS entries, count(*) FILTER (visibility = 'current') AS current_entries FROM recs JOIN rel USING (project_id, run_id) GROUP BY project_id), c AS (SELECT project_id, count(*) AS releases FROM rel GROUP BY project_id) SELECT project_id, releases, coalesce(entries, 0) AS entries, coalesce(current_entries, 0) AS current_entries FROM projects JOIN c USING (project_id) LEFT JOIN e USING (project_id)")
def q_index_summary(spark, sf_dir):
    return index.summary(_index(spark, sf_dir))


@query("SELECT l_orderkey AS record_id, l_linenumber AS citation_index, l_partkey AS evidence_id, p_brand AS source_id, p_name AS relative_path, CASE WHEN s_suppkey IS NOT NULL THEN s_name END AS original_locator FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_size < 40 LEFT JOIN supplier ON s_suppkey = l_suppkey AND l_linenumber <> 2")
def q_evidence_links(spark, sf_dir):
    run = [F.lit("p").alias("project_id"), F.lit("r").alias("run_id")]
    c = table(spark, sf_dir, "lineitem").select(*run, F.col("l_orderkey").alias("record_id"), F.col("l_linenumber").alias("citation_index"), F.col("l_partkey").alias("evidence_id"), F.when(F.col("l_linenumber") != 2, F.col("l_suppkey")).alias("segment_id"))
    files = table(spark, sf_dir, "part").where("p_size < 40").select(*run, F.col("p_partkey").alias("evidence_id"), F.col("p_brand").alias("source_id"), F.col("p_name").alias("relative_path"))
    segments = table(spark, sf_dir, "supplier").select(*run, F.col("s_suppkey").alias("segment_id"), F.col("s_name").alias("original_locator"))
    return index.evidence_links(c, files, segments).select("record_id", "citation_index", "evidence_id", "source_id", "relative_path", "original_locator")


# ---- re-anchoring: orders are records, their lines citations, of which those of small quantity keep a place

CITED = "c AS (SELECT o_orderkey AS k, l_linenumber AS n, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS i, l_quantity < 35 AS here FROM orders JOIN lineitem ON l_orderkey = o_orderkey), r AS (SELECT k, count(*) FILTER (NOT here) AS lost FROM c GROUP BY k HAVING bool_or(here)), e AS (SELECT r.k, 'E' || r.k AS event_id, CASE WHEN r.k % 2 = 1 THEN [0, 1] ELSE [0] END AS refs, (SELECT bool_and(coalesce((SELECT here FROM c WHERE c.k = r.k AND c.i = x), false)) FROM (SELECT unnest([0, r.k % 2]) AS x)) AS ok FROM r)"


def _reanchored(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("x"))
    o = table(spark, sf_dir, "orders").select("o_orderkey").join(li, F.col("o_orderkey") == F.col("l_orderkey"))
    ordered = o.groupBy(F.col("o_orderkey").alias("record_id")).agg(F.array_sort(F.collect_list("x")).alias("xs"))  # of one order
    ids = ordered.select("record_id", F.transform("xs", lambda x, i: F.struct((F.shiftleft("record_id", 20) + i).alias("id"), (x["l_quantity"] < 35).alias("here"))).alias("cs"))
    ids = written(ids, "cited")  # read as records and as citations
    records = ids.select("record_id", F.col("cs.id").alias("citations"))
    kept = ids.select(F.explode("cs").alias("c")).where("c.here").select(F.col("c.id").alias("citation_id"))
    events = records.select("record_id", F.concat(F.lit("E"), F.col("record_id").cast("string")).alias("event_id"), F.array_distinct(F.array(F.lit(0), (F.col("record_id") % 2).cast("int"))).alias("refs"))
    relations = records.select(F.col("record_id").alias("src"), F.lit("refines").alias("type"), (F.col("record_id") + 1).alias("dst"))
    return reanchor.proposal(records, kept, events, relations)


@query(f"WITH {CITED} SELECT k AS record_id, lost FROM r")
def q_reanchored_records(spark, sf_dir):
    return _reanchored(spark, sf_dir)["records"].select("record_id", "lost")


@query(f"WITH {CITED}, n AS (SELECT k, i, (sum(here::INT) OVER (PARTITION BY k ORDER BY i) - 1)::INT AS j FROM c) SELECT e.k AS record_id, event_id, string_agg(n.j::VARCHAR, ',' ORDER BY list_position(refs, n.i)) AS refs FROM e JOIN n ON n.k = e.k AND list_contains(refs, n.i) WHERE ok GROUP BY ALL")
def q_reanchored_events(spark, sf_dir):
    return _reanchored(spark, sf_dir)["events"].select("record_id", "event_id", F.array_join(F.transform("refs", lambda i: i.cast("string")), ",").alias("refs"))


@query(f"WITH {CITED} SELECT k AS record_id, 'lost_citations' AS code, lost::VARCHAR AS subject FROM r WHERE lost > 0 UNION ALL SELECT k, 'lost_event', event_id FROM e WHERE NOT ok UNION ALL SELECT k, 'lost_relation', 'refines:' || (k + 1) FROM r WHERE k + 1 NOT IN (SELECT k FROM r)")
def q_reanchored_questions(spark, sf_dir):
    return _reanchored(spark, sf_dir)["questions"]


@query(f"""WITH {SECOND}, o AS (SELECT doc_id, sha256(text) AS h, CASE WHEN doc_id % 4 = 0 THEN 'triaged_out' WHEN doc_id % 4 = 1 THEN 'used' ELSE 'reviewed_no_record' END AS d FROM documents)
SELECT s.doc_id::VARCHAR AS evidence_id, CASE WHEN s.doc_id % 9 = 0 THEN 'used' WHEN o.h = sha256(s.text) AND d <> 'used' THEN d ELSE 'deferred' END AS disposition, CASE WHEN s.doc_id % 9 = 0 THEN 'cited' WHEN o.h = sha256(s.text) AND d <> 'used' THEN 'carried_over' ELSE 'new_or_changed' END AS why FROM second s LEFT JOIN o ON o.doc_id = s.doc_id""")
def q_carried_coverage(spark, sf_dir):
    d = documents(spark, sf_dir)
    files = lambda x, e: x.select(F.col("doc_id").cast("string").alias("logical_id"), e.alias("evidence_id"), F.sha2("text", 256).alias("text_sha256"), F.lit(None).cast("string").alias("representation_sha256"))
    i = F.col("doc_id")
    old_e = F.concat(F.lit("old"), i.cast("string"))
    declared = d.select(old_e.alias("evidence_id"), F.when(i % 4 == 0, "triaged_out").when(i % 4 == 1, "used").otherwise("reviewed_no_record").alias("disposition"), F.lit("m").alias("method"))
    s = second(d)
    cited = s.where("doc_id % 9 = 0").select(i.cast("string").alias("evidence_id"))
    return reanchor.coverage(files(s, i.cast("string")), files(d, old_e), declared, cited, approved=True).select("evidence_id", "disposition", "why")


# ---- the review report

OLD_NEW = "o AS (SELECT p_partkey AS k, ['requirement','decision','uncertainty','investigation'][p_partkey % 4 + 1] AS kind, CASE WHEN p_size % 5 = 0 THEN 'unresolved' ELSE 'observed' END AS s, p_name AS t FROM part WHERE p_partkey % 7 <> 0), n AS (SELECT p_partkey AS k, ['requirement','decision','uncertainty','investigation'][p_partkey % 4 + 1] AS kind, CASE WHEN p_size % 5 = 0 THEN 'unresolved' ELSE 'observed' END AS s, CASE WHEN p_partkey % 3 = 0 THEN p_name || '!' ELSE p_name END AS t FROM part WHERE p_partkey % 8 <> 0)"


def _old_new(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    row = lambda x, t: x.select(k.alias("record_id"), F.element_at(F.array(*map(F.lit, index.KINDS)), (k % 4 + 1).cast("int")).alias("kind"), F.when(F.col("p_size") % 5 == 0, "unresolved").otherwise("observed").alias("epistemic_status"), t.alias("statement"))
    return row(p.where("p_partkey % 7 <> 0"), F.col("p_name")), row(p.where("p_partkey % 8 <> 0"), F.when(k % 3 == 0, F.concat("p_name", F.lit("!"))).otherwise(F.col("p_name")))


@query(f"""WITH {OLD_NEW}, x AS (SELECT coalesce(n.k, o.k) AS record_id, CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' WHEN o.t <> n.t THEN 'changed' ELSE 'unchanged' END AS change, coalesce(n.kind, o.kind) AS kind, o.kind || ' / ' || o.s || ': ' || o.t AS before, n.kind || ' / ' || n.s || ': ' || n.t AS after FROM o FULL JOIN n ON o.k = n.k)
SELECT record_id, change, CASE WHEN kind = 'uncertainty' OR change IN ('changed', 'removed') THEN 'high' ELSE 'review' END AS severity, before, after, CASE WHEN change = 'removed' THEN '{report.REMOVED}' ELSE CASE kind WHEN 'decision' THEN '{report.QUESTIONS["decision"]}' WHEN 'uncertainty' THEN '{report.QUESTIONS["uncertainty"]}' WHEN 'investigation' THEN '{report.QUESTIONS["investigation"]}' ELSE '{report.OTHER}' END || CASE WHEN change = 'changed' THEN '{report.CHANGED}' ELSE '' END END AS question FROM x""")
def q_review_rows(spark, sf_dir):
    return report.reviews(*_old_new(spark, sf_dir), ["kind", "epistemic_status", "statement"])


@query(f"""WITH {OLD_NEW} SELECT 'high' AS severity, 'removed' AS code, k::VARCHAR AS subject FROM o WHERE k NOT IN (SELECT k FROM n) UNION ALL SELECT 'high', 'unresolved', k::VARCHAR FROM n WHERE kind = 'uncertainty' OR s = 'unresolved'
UNION ALL SELECT 'potential_high', 'unavailable_material', doc_id::VARCHAR FROM documents WHERE n_chars < 100 UNION ALL SELECT 'review', 'triaged_file', doc_id::VARCHAR FROM labels WHERE quality = 0 GROUP BY doc_id UNION ALL SELECT 'review', 'triaged_segment', doc_id::VARCHAR FROM labels WHERE toxic = 1 GROUP BY doc_id""")
def q_review_blockers(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    l_ = table(spark, sf_dir, "labels")
    declared = lambda key, test: l_.select(F.col("doc_id").alias(key), F.when(F.expr(test), "triaged_out").otherwise("used").alias("disposition"))
    issues = documents(spark, sf_dir).where("n_chars < 100").select(F.col("doc_id").alias("evidence_id"))
    return report.blockers(new, old, issues, declared("evidence_id", "quality = 0"), declared("segment_id", "toxic = 1"))


@query("SELECT DISTINCT doc_id FROM labels WHERE quality = 0 OR toxic = 1")
def q_triaged_ids(spark, sf_dir):
    l_ = table(spark, sf_dir, "labels")
    declared = lambda test: l_.select("doc_id", F.when(F.expr(test), "triaged_out").otherwise("used").alias("disposition"))
    return report.triaged(declared("quality = 0"), "doc_id", declared("toxic = 1"))


# ---- referrals: events are decisions on items (users)

INTAKE = "i AS (SELECT user_id AS item_id, CASE user_id % 4 WHEN 0 THEN 'stale' WHEN 1 THEN 'withdrawn' ELSE 'current' END AS source_status FROM events GROUP BY user_id), d AS (SELECT user_id AS item_id, arg_max(event_type, (ts, event_id)) AS t, arg_max(event_id % 3, (ts, event_id)) AS m FROM events GROUP BY user_id)"


@query(f"WITH {INTAKE} SELECT item_id, CASE WHEN source_status <> 'current' THEN 'blocked_source_' || source_status WHEN m > 0 THEN 'proposed_capture_reconciliation' ELSE 'blocked_capture_authorization' END AS status FROM i JOIN d USING (item_id) WHERE t <> 'error'")
def q_intake_tasks(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    items = e.select(F.col("user_id").alias("item_id")).distinct().withColumn("source_status", F.when(F.col("item_id") % 4 == 0, "stale").when(F.col("item_id") % 4 == 1, "withdrawn").otherwise("current"))
    decisions = e.select(F.col("user_id").alias("item_id"), F.struct("ts", "event_id").alias("ordinal"), F.when(F.col("event_type") == "error", "decline").otherwise("accept").alias("decision"), F.when(F.col("event_id") % 3 > 0, "full_file").alias("capture_mode"))
    return referrals.task_of(items, decisions)


@query("""WITH a AS (SELECT doc_id, doc_id % 2 = 0 AS wh, doc_id % 7 <> 0 AS yes, sha256(text) AS stated, sha256(CASE WHEN doc_id % 11 = 0 THEN text || 'x' ELSE text END) AS actual, sha256(CASE WHEN doc_id % 5 < 2 THEN text ELSE 'origin' END) AS origin, text, string_split(text, chr(10))[1] AS quote FROM documents)
SELECT doc_id AS item_id, CASE WHEN NOT yes THEN 'not_accepted' WHEN stated <> actual THEN 'bytes_changed' WHEN wh THEN CASE WHEN actual <> origin THEN 'not_the_original' ELSE 'ok' END WHEN actual = origin THEN 'whole_file_as_export' WHEN doc_id % 13 = 0 AND quote || '?' <> text THEN 'quote_not_kept' ELSE 'ok' END AS verdict FROM a""")
def q_referral_captures(spark, sf_dir):
    i = F.col("doc_id")
    first = F.split_part("text", F.lit("\n"), F.lit(1))
    a = documents(spark, sf_dir).select(i.alias("item_id"), F.when(i % 2 == 0, "full_file").otherwise("scoped_export").alias("mode"), F.when(i % 7 != 0, "accept").otherwise("defer").alias("decision"), F.lit("why").alias("reason"), F.sha2("text", 256).alias("stated_sha256"), F.sha2(F.when(i % 11 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")), 256).alias("actual_sha256"), F.sha2(F.when(i % 5 < 2, F.col("text")).otherwise("origin"), 256).alias("origin_sha256"), "text", F.when(i % 13 == 0, F.concat(first, F.lit("?"))).otherwise(first).alias("quote"))
    return referrals.captures(a).select("item_id", "verdict")


@query("""WITH l AS (SELECT p_partkey AS item_id, p_size AS record_id, CASE WHEN p_partkey % 3 = 0 THEN 'scoped_export' ELSE 'full_file' END AS mode, 'h' || p_partkey % 10 AS h, 'r' || p_partkey % 2 AS rep FROM part), c AS (SELECT DISTINCT l_suppkey % 50 + 1 AS record_id, 'E' || l_suppkey % 20 AS evidence_id, 'h' || l_suppkey % 10 AS h, 'r' || l_suppkey % 2 AS rep FROM lineitem)
SELECT item_id, l.record_id, c.evidence_id, CASE WHEN c.evidence_id IS NULL THEN 'unsupported' WHEN mode = 'scoped_export' THEN 'scoped_export' WHEN l.rep = c.rep THEN 'same_representation_and_locator' ELSE 'different_representation_or_locator' END AS comparison FROM l LEFT JOIN c ON c.record_id = l.record_id AND c.h = l.h""")
def q_link_comparison(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("l_suppkey")
    t = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    links = table(spark, sf_dir, "part").select(k.alias("item_id"), F.col("p_size").cast("long").alias("record_id"), F.when(k % 3 == 0, "scoped_export").otherwise("full_file").alias("mode"), t("h", k % 10).alias("capture_sha256"), F.lit("said").alias("quote"), t("r", k % 2).alias("representation_sha256"), F.lit("p1").alias("original_locator"))
    cites = table(spark, sf_dir, "lineitem").select((s % 50 + 1).cast("long").alias("record_id"), t("E", s % 20).alias("evidence_id"), t("h", s % 10).alias("file_sha256"), F.lit("he\nsaid").alias("quote"), t("r", s % 2).alias("representation_sha256"), F.lit("p1").alias("original_locator")).distinct()
    return referrals.compared(links, cites)


@query("SELECT l_orderkey * 10 + l_linenumber AS referral_id, min(p_brand) AS source_id, min(p_name) AS relative_path, min(s_name) AS original_locator FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey")
def q_source_files(spark, sf_dir):
    r = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("referral_id"), F.col("l_partkey").alias("evidence_id"), F.col("l_suppkey").alias("segment_id")).distinct()
    files = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("evidence_id"), F.col("p_brand").alias("source_id"), F.col("p_name").alias("relative_path"), F.lit("h").alias("sha256"))
    segments = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("segment_id"), F.col("s_name").alias("original_locator"))
    return referrals.source_files(r, files, segments).drop("sha256")


@query("""WITH i AS (SELECT p_partkey AS item_id, p_partkey % 9 AS family, CASE WHEN p_partkey % 6 = 0 AND p_partkey > 9 THEN p_partkey - 9 WHEN p_partkey % 50 = 7 THEN p_partkey + 1 END AS sup FROM part)
SELECT 'V53_intake_lineage' AS rule, a.item_id::VARCHAR AS subject FROM i a LEFT JOIN i b ON a.sup = b.item_id WHERE a.sup IS NOT NULL AND (b.item_id IS NULL OR a.family <> b.family) UNION ALL SELECT 'V53_intake_identities', item_id::VARCHAR FROM i WHERE item_id % 17 = 0""")
def q_violations_intake(spark, sf_dir):
    k = F.col("p_partkey")
    intake = table(spark, sf_dir, "part").select(k.alias("item_id"), F.when(k % 17 == 0, k + 1).otherwise(k).alias("expected_id"), F.lit("o").alias("origin_project"), F.lit("home").alias("target_project"), (k % 9).alias("family"), F.when((k % 6 == 0) & (k > 9), k - 9).when(k % 50 == 7, k + 1).alias("supersedes"))
    home = spark.createDataFrame([("home",)], "project_id string")
    return rules.violations({"intake": intake, "home": home}, ["V53_intake_lineage", "V53_intake_identities"]).select("rule", "subject")


@query(f"""WITH {SECOND} SELECT 'V8_live_bytes' AS rule, d.doc_id::VARCHAR AS subject, CASE WHEN s.doc_id IS NULL THEN 'gone' ELSE 'changed' END AS detail FROM documents d LEFT JOIN second s ON s.doc_id = d.doc_id WHERE s.doc_id IS NULL OR sha256(s.text) <> sha256(d.text)
UNION ALL SELECT 'V54_release_gate', 'p:' || o_orderkey || ':records', 'not what was approved' FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT 'V54_release_gate', 'p:' || o_orderkey, 'not in the publication history' FROM orders WHERE o_orderkey % 50 = 7
UNION ALL SELECT 'V1_digests', p_name || p_partkey, 'differs' FROM part WHERE p_size % 10 = 3""")
def q_violations_gates(spark, sf_dir):
    d, o, p = documents(spark, sf_dir), table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    sha = lambda x: x.select(F.col("doc_id").cast("string").alias("evidence_id"), F.sha2("text", 256).alias("sha256"))
    run = F.col("o_orderkey").cast("string").alias("run_id")
    tables = {
        "files": sha(d),
        "live": sha(second(d)),
        "bindings": o.select(F.lit("p").alias("project_id"), run, F.lit("records").alias("artefact"), F.lit("a").alias("reviewed"), F.when(F.col("o_orderstatus") == "P", "b").otherwise("a").alias("released")),
        "releases": o.select(F.lit("p").alias("project_id"), run, F.lit("current").alias("visibility")),
        "publications": o.where("o_orderkey % 50 <> 7").select(run),
        "digests": p.select(F.concat("p_name", F.col("p_partkey").cast("string")).alias("name"), F.lit("x").alias("expected"), F.when(F.col("p_size") % 10 == 3, "y").otherwise("x").alias("found")),
    }
    return rules.violations(tables, ["V8_live_bytes", "V54_release_gate", "V1_digests"])


SEGMENTED = "d AS (SELECT doc_id AS i, len(string_split(text, chr(10))) AS n FROM documents)"


@query(f"""WITH {SEGMENTED}, t AS (SELECT 'R' || i AS r FROM d), v AS (SELECT 'V3_unique_evidence' AS rule, i::VARCHAR AS subject FROM d WHERE i % 61 = 0 UNION ALL SELECT 'V3_unique_evidence', 's:' || i FROM d WHERE i % 61 = 0
UNION ALL SELECT 'V14_within_segment', 'R' || i || ':0' FROM d WHERE i % 29 = 0
UNION ALL SELECT 'V21_segment_coverage', 'S' || i FROM d WHERE i % 37 = 0 OR i % 41 = 0 UNION ALL SELECT 'V21_segment_coverage', 'T' || i FROM d WHERE i % 67 = 0
UNION ALL SELECT 'V22_rollup', 'S' || i FROM d WHERE i % 47 = 0 AND i % 37 <> 0 UNION ALL SELECT 'V22_rollup', 'S' || i FROM d WHERE i % 47 = 0 AND i % 37 <> 0 AND i % 41 = 0
UNION ALL SELECT 'V22_intervals_partition', 'S' || i FROM d WHERE i % 43 = 0
UNION ALL SELECT 'V22_used_intervals_are_cited', 'S' || i || ':0' FROM d WHERE i % 47 <> 0 AND i % 71 = 0 UNION ALL SELECT 'V22_used_intervals_are_cited', 'S' || i || ':0' FROM d WHERE i % 47 = 0 AND i % 71 <> 0
UNION ALL SELECT 'V24_assertions', 'R' || i || ':refines:R' || CASE WHEN i % 53 = 0 THEN i ELSE i + 1 END FROM d WHERE i % 53 = 0 OR 'R' || (i + 1) NOT IN (SELECT r FROM t)
UNION ALL SELECT 'V26_events', 'V' || i FROM d WHERE i % 73 = 0 UNION ALL SELECT 'V26_events', 'V' || i FROM d WHERE i % 79 = 0 UNION ALL SELECT 'V26_events', 'V' || i FROM d WHERE i % 83 = 0
UNION ALL SELECT 'W5_segments_ascend', 'S' || i FROM d WHERE i % 31 = 0) SELECT DISTINCT rule, subject FROM v""")
def q_violations_segments(spark, sf_dir):
    """Each violation once, of rules on files, segments, intervals, assertions and events."""
    i, n = F.col("doc_id"), F.size(F.split("text", "\n", -1))
    d = documents(spark, sf_dir).withColumn("n", n)
    name = lambda p, c=i: F.concat(F.lit(p), c.cast("string"))
    twice = lambda df, test: df.unionByName(df.where(test))
    end = F.col("n") + F.when(i % 31 == 0, 1).otherwise(0)
    files = twice(d, "doc_id % 61 = 0").select(i.cast("string").alias("evidence_id"), F.lit("s").alias("source_id"), i.cast("string").alias("relative_path"), F.split("text", "\n", -1).alias("lines"))
    segments = d.select(name("S").alias("segment_id"), i.cast("string").alias("evidence_id"), F.lit(0).alias("ordinal"), F.lit(1).alias("start"), end.alias("end"))
    cited = d.where("doc_id % 71 <> 0")
    cites = cited.select(name("R").alias("record_id"), F.lit(0).alias("ordinal"), i.cast("string").alias("evidence_id"), F.lit(1).alias("start"), F.when(i % 29 == 0, F.col("n") + 99).otherwise(1).alias("end"), name("S").alias("segment_id"))
    bare = d.where("doc_id % 71 = 0").select(name("R").alias("record_id"), F.lit(0).alias("ordinal"), i.cast("string").alias("evidence_id"), F.lit(1).alias("start"), F.lit(1).alias("end"), F.when(i % 29 == 0, name("none")).alias("segment_id"))
    cov = twice(d, "doc_id % 41 = 0").where("doc_id % 37 <> 0").select(name("S").alias("segment_id"), F.lit("used").alias("disposition")).unionByName(twice(d, "doc_id % 41 = 0").where("doc_id % 37 = 0 and doc_id % 41 = 0 and false").select(name("S").alias("segment_id"), F.lit("used").alias("disposition"))).unionByName(d.where("doc_id % 67 = 0").select(name("T").alias("segment_id"), F.lit("used").alias("disposition")))
    intervals_ = d.select(name("S").alias("segment_id"), F.lit(0).alias("ordinal"), F.when(i % 43 == 0, 0).otherwise(1).alias("start"), end.alias("end"), F.when(i % 47 == 0, "deferred").otherwise("used").alias("disposition"))
    records = d.select(name("R").alias("record_id"))
    assertions = d.select(name("R").alias("owner"), F.lit("refines").alias("type"), name("R", F.when(i % 53 == 0, i).otherwise(i + 1)).alias("target"))
    events = twice(d, "doc_id % 73 = 0").select(name("V").alias("event_id"), name("R").alias("record_id"), F.lit("known").alias("status"), F.lit("2024-05").alias("value"), F.when(i % 83 == 0, "2023").alias("end_value"), F.lit("month").alias("precision"), F.array(F.when(i % 79 == 0, 5).otherwise(0)).alias("evidence_refs"))
    tables = {"files": files, "segments": segments, "citations": cites.unionByName(bare), "segment_coverage": cov, "interval_coverage": intervals_, "records": records, "assertions": assertions, "events": events}
    names = ["V3_unique_evidence", "V14_within_segment", "V21_segment_coverage", "V22_rollup", "V22_intervals_partition", "V22_used_intervals_are_cited", "V24_assertions", "V26_events", "W5_segments_ascend"]
    return rules.violations(tables, names).select("rule", "subject").distinct()


# ---- scalars

STAMPS = "s AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M-05:00') WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 3 THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S+02:00') END AS t, ts FROM events)"


def _stamps(spark, sf_dir):
    i = F.col("event_id") % 5
    d = lambda f: F.date_format("ts", f)
    t = F.when(i == 0, F.concat(d("yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).when(i == 1, F.concat(d("yyyy-MM-dd'T'HH:mm"), F.lit("-05:00"))).when(i == 2, d("yyyy-MM-dd'T'HH:mm:ss")).when(i == 3, d("yyyy-MM-dd")).otherwise(F.concat(d("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
    return table(spark, sf_dir, "events").select("event_id", t.alias("t"), "ts")


@query(f"WITH {STAMPS} SELECT event_id, CASE event_id % 5 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('minute', ts) + INTERVAL 5 hour WHEN 4 THEN date_trunc('second', ts) - INTERVAL 2 hour END::TIMESTAMP AS at, CASE event_id % 5 WHEN 0 THEN 'second' WHEN 1 THEN 'minute' WHEN 2 THEN 'second' WHEN 3 THEN 'day' ELSE 'second' END AS precision FROM s")
def q_instants(spark, sf_dir):
    return _stamps(spark, sf_dir).select("event_id", dates.instant(F.col("t")).cast("timestamp_ntz").alias("at"), dates.anchor_precision(F.col("t")).alias("precision"))


@query("SELECT event_id, ts > TIMESTAMP '2024-01-15 00:00:00' + INTERVAL 10 minute AS ahead FROM events")
def q_clock_skew(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", dates.ahead_of_clock(F.col("ts").cast("timestamp"), F.lit("2024-01-15 00:00:00").cast("timestamp")).alias("ahead"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'unknown' || ' ' || chr(8212) || ' ' || 'asked' WHEN 1 THEN 'known: ' || strftime(o_orderdate, '%Y-%m-%d') || ' (day; explicit) ' || chr(8212) || ' asked' ELSE 'conflicting: ' || strftime(o_orderdate, '%Y-%m') || ' (month; citations 1, 3); ' || strftime(o_orderdate, '%Y') || ' (year; citations 2) ' || chr(8212) || ' asked' END AS label FROM orders""")
def q_date_labels(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    d = lambda f: F.date_format("o_orderdate", f)
    alt = lambda v, p, *r: F.struct(v.alias("value"), F.lit(p).alias("precision"), F.array(*map(F.lit, r)).alias("evidence_refs"))
    status = F.when(k == 0, "unknown").when(k == 1, "known").otherwise("conflicting")
    x = F.struct(status.alias("status"), F.lit("explicit").alias("basis"), d("yyyy-MM-dd").alias("value"), F.lit(None).cast("string").alias("end"), F.lit("day").alias("precision"), F.lit(None).cast("int").alias("anchor_ref"), F.lit(None).cast("string").alias("anchor_value"), F.lit("asked").alias("note"), F.array(alt(d("yyyy-MM"), "month", 0, 2), alt(d("yyyy"), "year", 1)).alias("alternatives"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.label(x).alias("label"))


@query("WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN chr((65 + p_partkey % 26)::INT) ELSE chr((65 + p_size % 26)::INT) || chr((65 + p_partkey % 26)::INT) END AS l FROM part) SELECT p_partkey, (CASE WHEN length(l) = 1 THEN ascii(l) - 64 ELSE (ascii(l) - 64) * 26 + ascii(substr(l, 2)) - 64 END)::INT AS number FROM x")
def q_column_numbers(spark, sf_dir):
    c = lambda x: F.char((65 + x % 26).cast("int"))
    letters = F.when(F.col("p_partkey") % 3 == 0, c(F.col("p_partkey"))).otherwise(F.concat(c(F.col("p_size")), c(F.col("p_partkey"))))
    return table(spark, sf_dir, "part").select("p_partkey", text.column_number(letters).alias("number"))


@query("""WITH p AS (SELECT page_id, url || CASE page_id % 4 WHEN 0 THEN '/Notes by Gemini.MD' WHEN 1 THEN '/ai-generated/report.docx' WHEN 2 THEN '/x.tar.GZ' ELSE '/README' END AS path FROM pages)
SELECT page_id, lower(regexp_extract(path, '(\\.[^./]+)$', 1)) AS ext, string_split(path, '/')[len(string_split(path, '/'))] AS name, page_id % 4 = 0 AS machine FROM p""")
def q_file_names(spark, sf_dir):
    k = F.col("page_id") % 4
    path = F.concat("url", F.when(k == 0, "/Notes by Gemini.MD").when(k == 1, "/ai-generated/report.docx").when(k == 2, "/x.tar.GZ").otherwise("/README"))
    return table(spark, sf_dir, "pages").select("page_id", text.extension(path).alias("ext"), text.basename(path).alias("name"), text.machine_written(path).alias("machine"))


@query("SELECT p_partkey, array_to_string(list_sort(list_filter(['propuesto','propuesta','pendiente','a validar','a definir','por confirmar','tbd','proposed','pending','to be confirmed'], lambda w: contains(lower(p_name || CASE p_partkey % 3 WHEN 0 THEN ' Pending, TBD' WHEN 1 THEN ' a Definir' ELSE '' END), w))), ',') AS words FROM part")
def q_pending_words(spark, sf_dir):
    k = F.col("p_partkey") % 3
    said = F.concat("p_name", F.when(k == 0, " Pending, TBD").when(k == 1, " a Definir").otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.pending_words(said), ",").alias("words"))


@query("SELECT doc_id, sha256('[' || list_aggregate(list_transform(string_split(text, chr(10)), lambda x: '\"' || sha256(x) || '\"'), 'string_agg', ',') || ']') AS digest FROM documents")
def q_ordered_digest(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", identity.ordered_digest(F.transform(F.split("text", "\n", -1), lambda x: F.sha2(x, 256))).alias("digest"))


@query("SELECT user_id AS project_id, (coalesce(max(event_id), 0) + 1)::BIGINT AS next, max(ts) AS latest FROM events GROUP BY user_id")
def q_next_sequence(spark, sf_dir):
    runs = table(spark, sf_dir, "events").select(F.col("user_id").alias("project_id"), F.col("event_id").alias("sequence"), F.col("ts").alias("created_at"))
    return delta.next_sequences(runs)


CONTRACT = {"type": "object", "required": ["k"], "additionalProperties": False, "properties": {"k": {"type": "integer", "minimum": 10, "maximum": 60}, "more": {"type": "array", "uniqueItems": True, "items": {"type": "string", "pattern": "^[a-z]"}}}}


@query("""WITH e AS (SELECT event_id, (props->>'$.k')::BIGINT AS k, event_id % 6 AS m FROM events)
SELECT event_id, CASE WHEN m = 1 THEN '$.k: type' WHEN k < 10 THEN '$.k: minimum' WHEN k > 60 THEN '$.k: maximum' WHEN m = 2 THEN '$.x: additionalProperties' WHEN m = 3 THEN '$.more: uniqueItems' WHEN m = 4 THEN '$.more[1]: pattern' END AS fault FROM e WHERE m < 5 UNION ALL SELECT event_id, '$.k: required' FROM e WHERE m = 5""")
def q_contract_faults(spark, sf_dir):
    from lodestrata.sources import contracts

    m, k = F.col("event_id") % 6, F.get_json_object("props", "$.k")
    more = F.when(m == 2, ', "x": 1').when(m == 3, ', "more": ["a", "a"]').when(m == 4, ', "more": ["a", "B"]').otherwise("")
    text_ = F.when(m == 5, "{}").otherwise(F.concat(F.lit('{"k": '), F.when(m == 1, F.concat(F.lit('"'), k, F.lit('"'))).otherwise(k), more, F.lit("}")))
    return table(spark, sf_dir, "events").select("event_id", contracts.faults(text_, CONTRACT).alias("fault"))


# ---- sources: files made of the test tables


@query(
    '''WITH p AS (SELECT p_size AS id, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS n, p_partkey, p_name FROM part)
SELECT id, 0 AS ordinal, '/line=1' AS locator, 'table_header' AS content_type, '["key","a \\"name\\""]' AS text FROM p GROUP BY id UNION ALL
SELECT id, n::INT, '/lines=' || n * 2 || '-' || n * 2 + 1, 'table_row', '[{"column":1,"header":"key","value":"0' || p_partkey || '"},{"column":2,"header":"a \\"name\\"","value":"' || p_name || '\\nx"}]' FROM p'''
)
def q_csv_cells(spark, sf_dir):
    from lodestrata.sources.tabular import read_csv

    record = F.concat(F.lit("0"), F.col("p_partkey").cast("string"), F.lit(';"'), F.col("p_name"), F.lit('\nx"\n'))
    files = table(spark, sf_dir, "part").groupBy(F.col("p_size").alias("id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", record.alias("r")))), lambda x: x["r"]), "").alias("body"))
    return read_csv(files.select("id", F.encode(F.concat(F.lit('key;"a ""name"""\n'), "body"), "utf-8").alias("raw")), "id", "raw", ";", "first-row")


CAPTURED = "f AS (SELECT doc_id AS i, lang || '/' || CASE doc_id % 6 WHEN 0 THEN 'Notes by Gemini ' || doc_id || '.md' WHEN 1 THEN doc_id || '.exe' ELSE doc_id || '.md' END AS path, CASE WHEN doc_id % 6 = 1 THEN 'unsupported_extension' WHEN doc_id % 7 = 2 THEN 'holds_nul' WHEN doc_id % 7 = 3 THEN 'not_utf8' END AS issue, text FROM documents)"


def _captured(spark, sf_dir):
    from lodestrata.sources import capture

    i = F.col("doc_id")
    name = F.when(i % 6 == 0, F.concat(F.lit("Notes by Gemini "), i.cast("string"), F.lit(".md"))).when(i % 6 == 1, F.concat(i.cast("string"), F.lit(".exe"))).otherwise(F.concat(i.cast("string"), F.lit(".md")))
    raw = F.encode("text", "utf-8")
    content = F.when(i % 7 == 2, F.concat(raw, F.unhex(F.lit("00")))).when(i % 7 == 3, F.concat(raw, F.unhex(F.lit("FFFE")))).otherwise(raw)
    files = documents(spark, sf_dir).select(F.col("source").alias("source_id"), F.concat("lang", F.lit("/"), name).alias("relative_path"), F.octet_length(content).cast("long").alias("length"), content.alias("content"))
    return capture.texts(files, "demo", "meetings")


@query(f"WITH {CAPTURED} SELECT path AS relative_path, issue, CASE WHEN issue IS NULL AND trim(text, ' ' || chr(10) || chr(9)) = '' THEN 'blank_file' WHEN i % 6 = 0 THEN 'ai_generated_source' END AS warning, CASE WHEN issue IS NULL THEN md5(text) END AS h FROM f")
def q_captured_texts(spark, sf_dir):
    return _captured(spark, sf_dir).select("relative_path", "issue", "warning", F.md5("text").alias("h"))


@query(f"WITH {CAPTURED}, p AS (SELECT *, CASE WHEN i % 4 = 1 THEN CASE WHEN i % 8 = 1 THEN 'provenance_incomplete' END ELSE 'provenance_missing' END AS a, CASE WHEN i % 4 = 1 AND i % 3 = 0 THEN 'ai_generated_source' WHEN NOT (i % 4 = 1 AND i % 3 = 1) AND i % 6 = 0 THEN 'ai_generated_source' END AS b FROM f) SELECT path AS relative_path, unnest(list_filter([a, b], lambda x: x IS NOT NULL)) AS code FROM p")
def q_provenance_warnings(spark, sf_dir):
    from lodestrata.sources import capture

    files = _captured(spark, sf_dir)
    i = F.regexp_extract("relative_path", r"(\d+)\.", 1).cast("long")
    known = files.where(i % 4 == 1).select("source_id", "relative_path", F.create_map(F.lit("tabs"), F.when(i % 8 == 1, "unknown").otherwise("preserved")).alias("features"), F.array().cast("array<string>").alias("limitations"), F.when(i % 3 == 0, "mixed").when(i % 3 == 1, "human").alias("authorship"))
    found = capture.provenance_warnings(files, known)
    return files.select("evidence_id", "relative_path").join(found, "evidence_id").select("relative_path", "code")


@query("""SELECT conv_id * 100 + turn AS id, 0 AS ordinal, '/header=From' AS locator, 'header' AS content_type, role AS text FROM conversations UNION ALL SELECT conv_id * 100 + turn, 1, '/header=Subject', 'header', 'turn ' || turn FROM conversations
UNION ALL SELECT conv_id * 100 + turn, 2, '/part=1/run=1', 'body', 'start' FROM conversations UNION ALL SELECT conv_id * 100 + turn, 3, '/part=1/run=2', 'quoted_reply', '> ' || conv_id || chr(10) || '> said' FROM conversations UNION ALL SELECT conv_id * 100 + turn, 4, '/part=1/run=3', 'body', 'end' FROM conversations""")
def q_mail_runs(spark, sf_dir):
    from lodestrata.sources.frames import per_document
    from lodestrata.sources.mail import read_eml

    import pyarrow as pa

    c = table(spark, sf_dir, "conversations")
    raw = F.concat(F.lit("From: "), "role", F.lit("\nSubject: turn "), F.col("turn").cast("string"), F.lit("\n\nstart\n> "), F.col("conv_id").cast("string"), F.lit("\n> said\nend\n"))
    return per_document(c.select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.encode(raw, "utf-8").alias("raw")), "id", "raw", read_eml, pa.binary())


@query("SELECT doc_id, 'snapshots/E-' || doc_id || '.original' || e AS original, 'snapshots/E-' || doc_id || '.evidence.md' AS text, 'snapshots/E-' || doc_id || '.extraction.json' AS metadata FROM (SELECT doc_id, ['.docx', '.pdf', '.csv'][doc_id % 3 + 1] AS e FROM documents)")
def q_artefact_paths(spark, sf_dir):
    from lodestrata.sources.capture import artefact_paths

    e = F.element_at(F.array(F.lit(".docx"), F.lit(".pdf"), F.lit(".csv")), (F.col("doc_id") % 3 + 1).cast("int"))
    return documents(spark, sf_dir).select("doc_id", artefact_paths(F.concat(F.lit("E-"), F.col("doc_id").cast("string")), e).alias("p")).select("doc_id", "p.*")


# ---- selections, orders, subsets

@query("""WITH r AS (SELECT doc_id, 2 AS a, 3 AS b FROM documents WHERE n_chars > 0 AND len(string_split(text, chr(10))) >= 3 AND doc_id % 2 = 0), n AS (SELECT doc_id, len(string_split(text, chr(10)))::INT AS lines FROM documents), w AS (SELECT doc_id, 1 AS a, lines AS b FROM n WHERE doc_id % 3 = 0),
u AS (SELECT * FROM r UNION ALL SELECT * FROM w), o AS (SELECT *, max(b) OVER (PARTITION BY doc_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM u), g AS (SELECT *, sum(CASE WHEN m IS NULL OR a > m + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM o)
SELECT doc_id, min(a)::INT AS start, max(b)::INT AS "end" FROM g GROUP BY doc_id, g""")
def q_selected_lines(spark, sf_dir):
    n = documents(spark, sf_dir).select("doc_id", F.size(F.split("text", "\n", -1)).alias("lines"))
    ranges = n.where("lines >= 3 and doc_id % 2 = 0").select("doc_id", F.lit(2).alias("start"), F.lit(3).alias("end"))
    return intervals.selected_lines(ranges, n.where("doc_id % 3 = 0").select("doc_id"), n, "doc_id")


@query("WITH l AS (SELECT l_orderkey AS k, l_linenumber AS n, min(l_quantity) AS q FROM lineitem GROUP BY ALL), s AS (SELECT k, n, n * 10 - CASE WHEN q > 40 THEN 12 ELSE 0 END AS a, n * 10 + 9 - CASE WHEN q < 5 THEN 20 ELSE 0 END AS b FROM l), w AS (SELECT *, lag(b) OVER (PARTITION BY k ORDER BY n) AS before FROM s) SELECT k, n AS ordinal FROM w WHERE b < a OR a <= before")
def q_segments_ascend(spark, sf_dir):
    n, q = F.col("ordinal"), F.col("q")
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("ordinal")).agg(F.min("l_quantity").alias("q"))
    rows = rows.select("k", "ordinal", (n * 10 - F.when(q > 40, 12).otherwise(0)).alias("start"), (n * 10 + 9 - F.when(q < 5, 20).otherwise(0)).alias("end"))
    return intervals.not_ascending(rows, ["k"], "ordinal").select("k", "ordinal")


@query("""WITH s AS (SELECT p_partkey AS key, max(p_size + q) AS score FROM part, (SELECT unnest([0, 5]) AS q) WHERE p_partkey % 10 = q % 10 GROUP BY p_partkey), h AS (SELECT key, score, 0 AS hops FROM s), e AS (SELECT p_partkey AS src, p_partkey + 1 AS dst FROM part),
x AS (SELECT * FROM h UNION ALL SELECT DISTINCT e.dst, 0, 1 FROM h JOIN e ON e.src = h.key JOIN part ON p_partkey = e.dst WHERE e.dst NOT IN (SELECT key FROM h)), r AS (SELECT key, score, hops FROM x UNION ALL SELECT 3, 0, 0 WHERE 3 NOT IN (SELECT key FROM x))
SELECT key, row_number() OVER (ORDER BY key = 3 DESC, hops, score DESC, key) AS place FROM r QUALIFY place <= 20""")
def q_context_order(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), "p_size")
    scores = p.where("key % 10 = 0").select(F.lit(1).alias("query"), "key", F.col("p_size").cast("long").alias("score")).unionByName(p.where("key % 10 = 5").select(F.lit(2).alias("query"), "key", (F.col("p_size") + 5).cast("long").alias("score")))
    edges = p.select(F.col("key").alias("src"), (F.col("key") + 1).alias("dst"))
    got = context.bundle(scores, edges, p.select("key", F.lit("payload").alias("payload")), [3], most=20)
    return got.select("key", F.col("place").cast("long").alias("place"))


@query("SELECT user_id, list_contains(list(DISTINCT event_type), 'error') AND list_contains(list(DISTINCT event_type), 'click') AS subset FROM events GROUP BY user_id")
def q_required_subset(spark, sf_dir):
    have = table(spark, sf_dir, "events").groupBy("user_id").agg(coverage.sorted_set("event_type").alias("have"))  # the kinds of an enumeration
    return have.select("user_id", selection.subset(F.array(F.lit("error"), F.lit("click")), F.col("have")).alias("subset"))


@query("SELECT doc_id, source, sum(bit) AS score FROM (SELECT doc_id, source, unnest([1, 2]) AS q, unnest([n_chars % 7, n_chars % 5]) AS bit FROM documents) GROUP BY ALL HAVING sum(bit) > 0")
def q_scores_summed(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", "source", F.explode(F.array(F.col("n_chars") % 7, F.col("n_chars") % 5)).alias("bit"))
    return d.groupBy("doc_id", "source").agg(F.sum("bit").alias("score")).where("score > 0")


@query("SELECT doc_id, (n_chars % 7) AS score, 1 AS query FROM documents WHERE n_chars % 7 >= n_chars % 5 UNION ALL SELECT doc_id, n_chars % 5, 2 FROM documents WHERE n_chars % 5 > n_chars % 7")
def q_best_of_queries(spark, sf_dir):
    d = documents(spark, sf_dir)
    s = d.select(F.lit(1).alias("query"), "doc_id", (F.col("n_chars") % 7).alias("score")).unionByName(d.select(F.lit(2).alias("query"), "doc_id", (F.col("n_chars") % 5).alias("score")))
    return ranking.best(s, "doc_id", "query")


@query(f"WITH {SECOND} SELECT coalesce(n.doc_id, o.doc_id) AS doc_id, CASE WHEN o.doc_id IS NULL THEN 'added' WHEN n.doc_id IS NULL THEN 'removed' WHEN sha256(o.text) = sha256(n.text) THEN 'unchanged' ELSE 'modified' END AS change FROM documents o FULL JOIN second n ON o.doc_id = n.doc_id")
def q_between_runs(spark, sf_dir):
    d = documents(spark, sf_dir)
    sha = lambda x: x.select("doc_id", F.sha2("text", 256).alias("sha256"))
    return delta.between_runs(sha(d), sha(second(d)), "scope", "scope", key="doc_id")


@query("WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents) SELECT doc_id, n::INT AS line_no, last_value(CASE WHEN length(t) < 40 AND t <> '' THEN t END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS heading FROM l")
def q_preceding_heading(spark, sf_dir):
    from lodestrata.plans.registry import exploded

    lines = exploded(documents(spark, sf_dir)).withColumn("short", F.when((F.length("text") < 40) & (F.col("text") != ""), F.col("text")))
    return quotes.preceding(lines, ["doc_id"], "line_no", "short", "heading").select("doc_id", "line_no", "heading")


@query("WITH v AS (SELECT evidence_id, line FROM (SELECT doc_id AS evidence_id, unnest([1, 3, 5])::INT AS line FROM documents)) SELECT evidence_id, line FROM v WHERE line BETWEEN evidence_id % 3 + 1 AND evidence_id % 3 + 2")
def q_selected_passages(spark, sf_dir):
    i = F.col("doc_id")
    pts = documents(spark, sf_dir).select(i.alias("evidence_id"), F.explode(F.array(*map(F.lit, (1, 3, 5)))).alias("line"))
    ranges = documents(spark, sf_dir).select(i.alias("evidence_id"), (i % 3 + 1).cast("int").alias("start"), (i % 3 + 2).cast("int").alias("end"))
    return selection.in_passages(pts, ranges, "evidence_id").select("evidence_id", "line")


# ---- folding, ids, sinks and runs


@query("SELECT doc_id, md5(replace(strip_accents(lower(text)), chr(223), 'ss')) AS folded, md5(nfc_normalize(text)) AS composed, md5(replace(lower(text), chr(223), 'ss')) AS small FROM documents")
def q_folded(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.md5(text.fold("text")).alias("folded"), F.md5(text.nfc("text")).alias("composed"), F.md5(text.casefold("text")).alias("small"))


@query("SELECT p_partkey, array_to_string(list_filter(regexp_split_to_array(lower(p_name || '-' || p_brand), '[^a-z0-9_]+'), lambda x: x <> ''), ' ') AS words FROM part")
def q_alias_keys(spark, sf_dir):
    from lodestrata.operators.mentions import alias_keys

    p = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit("-"), "p_brand").alias("alias"), F.lit("t").alias("target"))
    return alias_keys(p).select("p_partkey", F.array_join("words", " ").alias("words"))


@query("""SELECT doc_id, 'S-' || substr(sha256('["E-' || doc_id || '","r","/p=1",1,' || len(string_split(text, chr(10))) || ',"' || sha256(text) || '"]'), 1, 24) AS segment_id, 'M-' || substr(sha256('["E-' || doc_id || '",7,0,3,"home"]'), 1, 24) AS mention_id, 'INT-' || substr(sha256('["o","' || source || '","R-' || doc_id || '"]'), 1, 24) AS intake_id FROM documents""")
def q_derived_ids(spark, sf_dir):
    e = F.concat(F.lit("E-"), F.col("doc_id").cast("string"))
    n = F.size(F.split("text", "\n", -1))
    return documents(spark, sf_dir).select("doc_id", identity.segment_id(e, F.lit("r"), F.lit("/p=1"), F.lit(1), n, F.sha2("text", 256)).alias("segment_id"), identity.mention_id(e, F.lit(7), F.lit(0), F.lit(3), F.lit("home")).alias("mention_id"), identity.intake_id(F.lit("o"), F.col("source"), F.concat(F.lit("R-"), F.col("doc_id").cast("string"))).alias("intake_id"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'duplicate' WHEN 2 THEN 'constant' ELSE 'syntax' END AS kind FROM events")
def q_strict_json(spark, sf_dir):
    from lodestrata.sources.tabular import json_faults

    m = F.col("event_id") % 4
    said = F.when(m == 0, F.col("props")).when(m == 1, '{"a": 1, "a": 2}').when(m == 2, '{"a": NaN}').otherwise('{"a": ')
    found = table(spark, sf_dir, "events").select("event_id", m.alias("m"), json_faults(said).alias("fault"))
    kind = F.when(F.col("fault").isNull(), None).when(F.col("m") == 1, F.lit("duplicate")).when(F.col("m") == 2, F.lit("constant")).otherwise("syntax")
    return found.select("event_id", kind.alias("kind"))


def _root(spark, name):
    import uuid

    from lodestrata.session import shared_dir

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT doc_id, lang, md5(text) AS h FROM documents")
def q_published_release(spark, sf_dir):
    """A release is put in place whole, logged, pointed to, and read through its pointer."""
    from lodestrata.sources import sinks

    root = _root(spark, "releases")
    d = documents(spark, sf_dir).select("doc_id", "lang", F.md5("text").alias("h"))
    sinks.publish(d.where("doc_id % 2 = 0"), root, "run1", "2026-01-01T00:00:00Z")
    sinks.publish(d, root, "run2", "2026-01-02T00:00:00Z")
    return spark.read.parquet(sinks.pointed(spark, f"{root}/CURRENT")["path"] + "/release")


@query("SELECT unnest([1, 2, 3, 4]) AS step, unnest([true, false, false, true]) AS wrote")
def q_rebuilt_index(spark, sf_dir):
    """An index is written again only if its rows change, whatever their order."""
    from lodestrata.sources import sinks

    root = _root(spark, "index")
    d = documents(spark, sf_dir).select("doc_id", "lang", F.md5("text").alias("h"))
    tries = [d, d, d.repartition(3, "h"), d.where("doc_id <> 7")]
    return spark.createDataFrame([(i + 1, sinks.rebuilt(x, root)) for i, x in enumerate(tries)], "step int, wrote boolean")


@query("SELECT lang, count(*) AS n, 'counts' AS ran FROM documents WHERE doc_id % 3 <> 0 GROUP BY lang")
def q_resumed_run(spark, sf_dir):
    """Stages whose receipts hold are taken over: a change of the last stage alone runs that one again."""
    from lodestrata.operators import runs

    root = _root(spark, "run")
    d = documents(spark, sf_dir).select("doc_id", "lang")
    keep = ("kept", lambda s, t: t["documents"].where("doc_id % 3 <> 0"))
    count = ("counts", lambda s, t: t["kept"].groupBy("lang").agg(F.count("*").alias("n")))
    runs.run(spark, root, {"documents": d}, [keep])
    tables, ran = runs.run(spark, root, {"documents": d.repartition(2, "doc_id")}, [keep, count])
    return tables["counts"].withColumn("ran", F.lit(",".join(ran)))


@query("SELECT 'R' || p_partkey || ' -->|\"' || replace(replace(p_brand, '#', '#35;'), '&', '#38;') || '\"| R' || p_size AS line FROM part")
def q_diagram_lines(spark, sf_dir):
    from lodestrata.operators.views import diagram

    node = lambda c: F.concat(F.lit("R"), F.col(c).cast("string"))
    return diagram(table(spark, sf_dir, "part").select(node("p_partkey").alias("src"), F.col("p_brand").alias("type"), node("p_size").alias("dst")))
