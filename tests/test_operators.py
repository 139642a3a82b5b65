import itertools

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import coverage, delta, graph, intake, intervals, mentions, packets, quotes, ranking, rules, selection, views


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def test_merge_and_partition(spark):
    df = spark.createDataFrame([("k", 1, 3), ("k", 4, 4), ("k", 7, 9), ("k", 8, 12), ("l", 2, 2)], "k string, start int, end int")
    assert rows(intervals.merged(df, ["k"])) == [("k", 1, 4), ("k", 7, 12), ("l", 2, 2)]
    seg = spark.createDataFrame([("k", 1, 4)], "k string, start int, end int")
    sel = spark.createDataFrame([("k", 1, 3)], "k string, start int, end int")
    assert rows(intervals.partitioned(seg, sel, ["k"]), "start", "end", "selected") == [(1, 3, True), (4, 4, False)]


def test_cover_checks_keep_the_order_given(spark):
    df = spark.createDataFrame([("ok", 0, 1, 3, 1, 4), ("ok", 1, 4, 4, 1, 4), ("swapped", 0, 4, 4, 1, 4), ("swapped", 1, 1, 3, 1, 4), ("short", 0, 1, 3, 1, 4)], "k string, o int, start int, end int, seg_start int, seg_end int")
    assert {r[0] for r in rows(intervals.not_covering(df, ["k"], "o"))} == {"swapped", "short"}


def test_selected_lines(spark):
    r = spark.createDataFrame([("a", 2, 3)], "evidence_id string, start int, end int")
    n = spark.createDataFrame([("a", 5), ("b", 2)], "evidence_id string, lines int")
    b = n.where("evidence_id = 'b'").select("evidence_id")
    assert rows(intervals.selected_lines(r, b, n)) == [("a", 2, 3), ("b", 1, 2)]
    assert rows(intervals.selected_lines(r, b, n, composition="intersection")) == []
    assert rows(intervals.selected_lines(r.where("false"), b, n)) == [("b", 1, 2)]
    with pytest.raises(ValueError):
        intervals.selected_lines(spark.createDataFrame([("a", 2, 9)], r.schema), b, n)


def test_packets_fold(spark):
    sizes = [5, 6, 3, 9, 1, 1]
    df = spark.createDataFrame([("f", i + 1, "x" * (s)) for i, s in enumerate(sizes)] + [("g", 1, "y"), ("g", 3, "z")], "f string, line_no int, text string")
    got = rows(packets.packets(df, 11 + 10 + 0, ["f"]))
    # rendered sizes are the text and 11 characters; 21 hold one line of ten
    assert [g[:4] for g in got] == [("f", i + 1, i + 1, i + 1) for i in range(6)] + [("g", 7, 1, 1), ("g", 8, 3, 3)]
    wide = rows(packets.packets(df, 40, ["f"], overhead=2))
    assert [w[2:] for w in wide if w[0] == "f"] == [(1, 2, 35), (3, 4, 36), (5, 6, 26)]
    with pytest.raises(ValueError):
        packets.packets(df, 15, ["f"])


def test_selection(spark):
    f = spark.createDataFrame([("a", "x/a.md", "about lions"), ("b", "y/b.md", "nothing")], "evidence_id string, relative_path string, folded string")
    pick = lambda **k: [r.evidence_id for r in selection.chosen(f, allow_none=True, **k).orderBy("evidence_id").collect()]
    assert pick() == ["a", "b"] and pick(globs=["x/**"], terms=["zebra"]) == ["a"] and pick(globs=["x/**"], terms=["zebra"], composition="intersection") == []
    with pytest.raises(ValueError):
        selection.chosen(f, terms=["zebra"])


def test_mentions(spark):
    al = mentions.alias_keys(spark.createDataFrame([("DEMOB", "demob"), ("Modulo Demo", "demob"), ("Atlas", "one"), ("Atlas Core", "two")], "alias string, target string"))
    lines = spark.createDataFrame([("e", 1, "demob x"), ("e", 2, "Módulo,  Demo!"), ("e", 3, "the Atlas Core"), ("e", 4, "modulo"), ("e", 5, "demo")], "e string, line int, text string")
    got = rows(mentions.mentions(mentions.line_tokens(lines), al, ["e", "line"]), "line", "start", "end", "target", "classification")
    assert got == [(1, 0, 5, "demob", "explicit_alias_candidate"), (2, 0, 13, "demob", "explicit_alias_candidate"), (3, 4, 14, "two", "ambiguous_alias_overlap"), (3, 4, 9, "one", "ambiguous_alias_overlap")]
    with pytest.raises(ValueError):
        mentions.alias_keys(spark.createDataFrame([(" x", "t")], "alias string, target string"))


def test_delta_and_renames(spark):
    old = spark.createDataFrame([("1", "s", "h1"), ("2", "s", "h2"), ("3", "s", "h3"), ("4", "s", "h4"), ("5", "s", "h4")], "logical_id string, source_id string, sha256 string")
    new = spark.createDataFrame([("1", "s", "h1"), ("2", "s", "hx"), ("8", "s", "h3"), ("9", "s", "h3"), ("7", "s", "h4")], old.schema)
    assert dict(rows(delta.status(old, new))) == {"1": "unchanged", "2": "modified", "3": "removed", "4": "removed", "5": "removed", "7": "added", "8": "added", "9": "added"}
    assert rows(delta.renames(old, new)) == [("3", "8")]
    assert delta.between_runs(old, new, "a", "b").count() == 0 and delta.between_runs(old, new, "a", "a", errors=1).count() == 0


def test_quotes_move_and_vanish(spark):
    lines = spark.createDataFrame([("f", i + 1, t) for i, t in enumerate(["new", "A", "B", "A", "B", "C"])], "file string, line_no int, text string")
    q = spark.createDataFrame([(1, "f", "A\nB", 4), (2, "f", "C", 6), (3, "f", "gone\nB", 1), (4, "f", "A", 3)], "quote_id int, file string, quote string, old_start int")
    places = quotes.located(q, lines)
    assert rows(places) == [(1, 2, 3), (1, 4, 5), (2, 6, 6), (4, 2, 2), (4, 4, 4)]
    assert rows(quotes.anchored(q.select("quote_id", "old_start"), places), "quote_id", "start", "status") == [(1, 4, "unchanged"), (2, 6, "unchanged"), (3, None, "vanished"), (4, 2, "moved")]
    rec = spark.createDataFrame([("r1", ["1", "3", "2"]), ("r2", ["3"])], "record_id string, citations array<string>")
    kept = spark.createDataFrame([("1",), ("2",)], "citation_id string")
    got = quotes.remapped(rec, kept).collect()
    assert [(r.record_id, r.citations, r.lost, r.old_to_new) for r in got] == [("r1", ["1", "2"], 1, {0: 0, 2: 1})]


def test_ranking(spark):
    df = spark.createDataFrame([("a", "demo", "", "x"), ("b", "", "demo", "y"), ("c", "", "", "z")], "key string, aliases string, title string, statement string")
    fields = {k: (F.col(k), ranking.WEIGHTS[k]) for k in ("aliases", "title", "statement")}
    found = ranking.scored(df, "key", fields, ranking.terms_of("DEMO"))
    assert rows(found, "key", "score") == [("a", 5), ("b", 4)]
    assert rows(ranking.scored(df, "key", fields, []), "key", "score") == [("a", 0), ("b", 0), ("c", 0)]
    edges = spark.createDataFrame([("a", "c"), ("b", "c"), ("c", "d")], "src string, dst string")
    more = ranking.expanded(found, edges, df, "key", 2)
    assert [tuple(r) for r in ranking.top(more, "key", 3).collect()] == [("a", 5, 0, None), ("b", 4, 0, None), ("c", 0, 1, "a")]
    few = ranking.within_budget(more, [F.asc("hops"), F.asc("key")], F.lit(10), 25, F.col("key") == "a")
    assert rows(few, "key") == [("a",), ("b",)]


def test_components_and_cycles(spark):
    e = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (7, 7), (200, 200), (None, 3)]
    got = dict(rows(graph.connected_components(spark.createDataFrame(e, "a long, b long"))))
    assert all(got[i] == 0 for i in range(61)) and got[102] == 100 and got[200] == 200
    star = [(0, i) for i in range(1, 400)]
    assert set(dict(rows(graph.connected_components(spark.createDataFrame(star, "a long, b long")))).values()) == {0}


def test_cycles_and_long_chains(spark):
    chain = [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(1100)]
    assert graph.reachable_cycles(spark.createDataFrame(chain, "src string, dst string")).count() == 0
    e = spark.createDataFrame([*chain, ("a", "b"), ("b", "a"), ("b", "c"), ("s", "s"), ("x", "y"), ("y", "z"), ("z", "x"), ("x", "a")], "src string, dst string")
    assert rows(graph.reachable_cycles(e)) == [("a", "b"), ("b", "a"), ("s", "s"), ("x", "y"), ("y", "z"), ("z", "x")]


def test_opposing_and_states(spark):
    a = spark.createDataFrame([("a", "b", "supersedes"), ("b", "a", "refines"), ("a", "c", "refines")], "owner string, target string, type string")
    assert rows(graph.opposing(a)) == [("a", "b", ["refines", "supersedes"])]
    e = spark.createDataFrame([("b", "current"), ("c", "historical")], "key string, visibility string")
    assert {r.target: r.target_state for r in graph.target_state(a, e).collect()} == {"a": "unavailable", "b": "current", "c": "historical"}


def test_coverage(spark):
    exp, dec = spark.createDataFrame([("a",), ("b",)], "id string"), spark.createDataFrame([("b",), ("b",), ("c",)], "id string")
    assert rows(coverage.faults(dec, exp, "id")) == [("a", "missing"), ("b", "duplicate"), ("c", "unknown")]
    codes = coverage.code_index(spark.createDataFrame([(1, "RF-01 and US00001, xRF-2"), (2, "rf-01 RF-01")], "id int, text string"), coverage.CODES, "id")
    assert rows(codes) == [("RF-01", [1, 2]), ("US00001", [1])]
    with pytest.raises(ValueError):
        coverage.capped(exp, 1)
    df = spark.createDataFrame([("s", "match"), ("s", "other"), ("t", None)], "g string, status string")
    assert rows(coverage.fidelity(df, "g")) == [("s", 2, 1, 0.5), ("t", 0, 0, None)]
    pr = spark.createDataFrame([("x", "deferred"), ("x", "used"), ("y", "triaged_out"), ("z", None)], "k string, d string")
    assert dict(rows(pr.groupBy("k").agg(intervals.rollup(F.col("d"))))) == {"x": "used", "y": "triaged_out", "z": "reviewed_no_record"}


def test_intake(spark):
    led = spark.createDataFrame([("a", "current", "d1", "f"), ("b", "current", "d1", "f"), ("c", "current", "d1", "g")], "item_id string, status string, digest string, family string")
    vis = spark.createDataFrame([("a", "d1", "f", False, True), ("d", "d1", "f", True, True), ("c", "d2", "g", True, True), ("e", "d", "h", True, False), ("w", "d", "i", False, True)], "item_id string, digest string, family string, current boolean, authorised boolean")
    got = intake.discovered(led, vis)
    assert dict(rows(got, "item_id", "status")) == {"a": "superseded", "b": "unavailable", "c": "stale", "d": "current", "e": "unauthorized", "w": "withdrawn"}
    o = spark.createDataFrame([("k", "x", 1), ("k", "x", 2), ("k", "y", 3), ("k", None, 4)], "k string, v string, at int")
    assert rows(intake.slowly_changing(o, "k", "v", "at")) == [("k", "x", 1, 3), ("k", "y", 3, 4), ("k", None, 4, None)] or rows(intake.slowly_changing(o, "k", "v", "at")) == sorted([("k", "x", 1, 3), ("k", "y", 3, 4), ("k", None, 4, None)], key=str)


def test_timeline_does_not_depend_on_input_order(spark):
    base = [("e1", "r1", "known", "2026-01-01 17:00:00", "t"), ("e2", "r1", "known", "2026-01-01 12:00:00", "t"), ("e3", "r2", "unknown", None, "t"), ("e0", "r2", "conflicting", None, "t")]
    for p in itertools.permutations(base, 4):
        df = spark.createDataFrame(list(p), "event_id string, record_id string, status string, sort_ts string, text string")
        got = {r.event_id: r.place for r in views.timeline(df.withColumn("sort_ts", F.col("sort_ts").cast("timestamp"))).collect()}
        assert got == {"e2": 1, "e1": 2, "e3": 3, "e0": 4}
        if p[0][0] == "e2":
            break


def valid(spark):
    files = spark.createDataFrame([("E1", "req", "requirements", "a.md", "h1", ["one", "two"]), ("E2", "repo", "repository", "b.py", "h2", ["x = 1"])], "evidence_id string, source_id string, source_type string, relative_path string, sha256 string, lines array<string>")
    records = spark.createDataFrame([("REQ-001", "requirement", "observed", "s", []), ("UNC-001", "uncertainty", "unresolved", "s", ["why?"])], "record_id string, kind string, epistemic_status string, statement string, open_questions array<string>")
    cites = spark.createDataFrame([("REQ-001", 0, "E1", 1, 2, "one\ntwo", "S1"), ("UNC-001", 0, "E2", 1, 1, "x = 1", None)], "record_id string, ordinal int, evidence_id string, start int, end int, quote string, segment_id string")
    rel = spark.createDataFrame([("UNC-001", "conflicts_with", "REQ-001")], "src string, type string, dst string")
    cov = spark.createDataFrame([("E1", "used", None), ("E2", "used", None)], "evidence_id string, disposition string, method string")
    seg = spark.createDataFrame([("S1", "E1", 0, 1, 2)], "segment_id string, evidence_id string, ordinal int, start int, end int")
    scov = spark.createDataFrame([("S1", "used", None)], "segment_id string, disposition string, method string")
    icov = spark.createDataFrame([("S1", 0, 1, 2, "used", None)], "segment_id string, ordinal int, start int, end int, disposition string, method string")
    ev = spark.createDataFrame([("EVT-1", "REQ-001", "known", "2026-01", "2026-02", "month", [0])], "event_id string, record_id string, status string, value string, end_value string, precision string, evidence_refs array<int>")
    ass = spark.createDataFrame([("UNC-001", "refines", "REQ-001", "observed")], "owner string, type string, target string, status string")
    att = spark.createDataFrame([("REQ-001", 0, "home", False), ("UNC-001", 0, "R1", True)], "record_id string, citation_ordinal int, class string, linked boolean")
    return {"files": files, "records": records, "citations": cites, "relations": rel, "coverage": cov, "segments": seg, "segment_coverage": scov, "interval_coverage": icov, "events": ev, "assertions": ass, "attributions": att}


# table, new column values, the rule that must object
MUTATIONS = [
    ("files", {"evidence_id": "'E1'"}, "V3_unique_evidence"), ("files", {"relative_path": "'../x'"}, "PF7_safe_paths"), ("files", {"source_id": "'Bad Id'"}, "PF8_identifiers"), ("files", {"lines": "array('a\\u0000b')"}, "V5_line_content"),
    ("records", {"record_id": "'REQ-001'"}, "V10_unique_records"), ("records", {"kind": "'decision'"}, "V15_prefix_is_kind"), ("records", {"epistemic_status": "'observed'"}, "V18_uncertainty_is_open"),
    ("citations", {"quote": "'other'"}, "V13_exact_citations"), ("citations", {"end": "99"}, "V13_exact_citations"), ("citations", {"evidence_id": "'E9'"}, "V13_exact_citations"), ("citations", {"segment_id": "'S9'"}, "V14_within_segment"), ("citations", {"evidence_id": "'E1'"}, "V20_used_means_cited"),
    ("relations", {"dst": "'NONE-1'"}, "V17_relations"), ("relations", {"dst": "src"}, "V17_relations"), ("coverage", {"disposition": "'deferred'"}, "V25_nothing_deferred"), ("coverage", {"method": "'m'"}, "V12_triage_names_its_method"), ("coverage", {"disposition": "'seen'"}, "V12_known_disposition"), ("coverage", {"evidence_id": "'E7'"}, "V11_file_coverage"),
    ("segments", {"end": "9"}, "W5_segments_ascend"), ("segment_coverage", {"segment_id": "'S7'"}, "V21_segment_coverage"), ("segment_coverage", {"disposition": "'deferred'"}, "V22_rollup"), ("interval_coverage", {"end": "1"}, "V22_intervals_partition"), ("interval_coverage", {"disposition": "'triaged_out'"}, "V22_used_intervals_are_cited"),
    ("events", {"evidence_refs": "array(4)"}, "V26_events"), ("events", {"end_value": "'2025'"}, "V26_events"), ("events", {"precision": "'day'"}, "V26_events"), ("assertions", {"target": "owner"}, "V24_assertions"), ("assertions", {"target": "'X'"}, "V24_assertions"), ("attributions", {"class": "'R2'"}, "V23_attributions"), ("attributions", {"linked": "false", "class": "'R1'"}, "V23_attributions"),
]


def test_a_valid_run_has_no_violations(spark):
    t = valid(spark)
    rules.require(t, absent="skip")
    with pytest.raises(ValueError, match="V30_index run: not checked: no table entries, releases"):
        rules.require(t)  # what can't be checked does not pass
    assert {r.code for r in rules.hints(t).collect()} == {"single_line_citations"}


@pytest.mark.parametrize("name, change, want", MUTATIONS)
def test_mutations_are_found(spark, name, change, want):
    t = valid(spark)
    t[name] = t[name].withColumns({k: F.expr(v) for k, v in change.items()})
    assert want in {r.rule for r in rules.violations(t, [want]).collect()}


def test_require_raises(spark):
    t = valid(spark)
    t["relations"] = t["relations"].withColumn("dst", F.lit("NONE-1"))
    with pytest.raises(ValueError, match="V17_relations"):
        rules.require(t, ["V17_relations"])


def routed(spark):
    from lodestrata.operators import routing  # noqa: F401  its rules join the others

    t = valid(spark)
    t["projects"] = spark.createDataFrame([("home", "team", ["Home"]), ("orion", "team", ["Orion", "Orion Core"]), ("far", "other", ["Orion"])], "id string, domain string, names array<string>")
    t["disclosures"] = spark.createDataFrame([("home", "orion", "req", "**/*.md")], "from_project string, to_project string, source_id string, path_pattern string")
    t["home"] = spark.createDataFrame([("home",)], "project_id string")
    t["mentions"] = spark.createDataFrame([("M1", "E1", 1, None, "orion", ["S1"])], "mention_id string, evidence_id string, line int, end_line int, target string, segment_ids array<string>")
    t["assessments"] = spark.createDataFrame([("M1", "R1", "referred", "REF1", ["REQ-001"])], "mention_id string, class string, disposition string, referral_id string, homes array<string>")
    t["referrals"] = spark.createDataFrame([("REF1", "orion", "R1", ["REQ-001"], "E1", "S1", 1, 2, "one\ntwo", "req", "a.md", "a.md")], "referral_id string, target string, class string, homes array<string>, evidence_id string, segment_id string, start int, end int, quote string, source_id string, relative_path string, include_pattern string")
    t["links"] = spark.createDataFrame([("REQ-001", "orion")], "record_id string, target string")
    t["selected"] = spark.createDataFrame([("E1", 1, 2)], "evidence_id string, start int, end int")
    t["releases"] = spark.createDataFrame([("home", "run1", "current")], "project_id string, run_id string, visibility string")
    t["entries"] = spark.createDataFrame([("home:run1:REQ-001", "home", "run1", "REQ-001", "current")], "key string, project_id string, run_id string, record_id string, visibility string")
    t["publications"] = spark.createDataFrame([(0, "run1", 1, "2026-01-01", None), (1, "run2", 2, "2026-01-02", None)], "ordinal int, run_id string, sequence int, created_at string, rollback_reason string")
    t["reviews"] = spark.createDataFrame([("run1", "approve", "Ada", "2026-01-02", "2026-01-01", ["REQ-001", "UNC-001"], {"a": True})], "run_id string, decision string, reviewer string, reviewed_at string, created_at string, approved array<string>, checks map<string,boolean>")
    t["investigations"] = spark.createDataFrame([], "record_id string, scope array<string>, present boolean")
    t["manual_mentions"] = spark.createDataFrame([("MM1", "E1", "S1", "rep1", 1, 1, "one", "orion")], "mention_id string, evidence_id string, segment_id string, representation_sha256 string, start int, end int, quote string, target string")
    t["segment_hashes"] = spark.createDataFrame([("S1", "rep1")], "segment_id string, representation_sha256 string")
    t["report_digests"] = spark.createDataFrame([("registry", "d1", "d1"), ("mentions", "d2", "d2")], "name string, expected string, found string")
    t["proposal"] = spark.createDataFrame([("home", "run1", "1.1", "0.6", "1.1", "home", "run1")], "project_id string, run_id string, schema_version string, records_schema_version string, registry_version string, run_project_id string, run_run_id string")
    t["intake"] = spark.createDataFrame([("I1", "I1", "far", "home", "f", None, "current", "2026-01-01", "r1"), ("I2", "I2", "far", "home", "f", "I1", "current", "2026-01-01", "r1")], "item_id string, expected_id string, origin_project string, target_project string, family string, supersedes string, source_status string, first_seen string, origin_review_sha256 string").withColumn("first_seen", F.to_timestamp("first_seen"))
    t["observations"] = spark.createDataFrame([("I1", 0, "stale"), ("I1", 1, "current"), ("I2", 0, "current")], "item_id string, ordinal int, status string")
    t["decisions"] = spark.createDataFrame([("I1", 0, "defer", "Ada", "later", "2026-01-02", "r1", None), ("I1", 1, "accept", "Ada", "now", "2026-01-03", "r1", "full_file")], "item_id string, ordinal int, decision string, reviewer string, reason string, reviewed_at string, origin_review_sha256 string, capture_mode string").withColumn("reviewed_at", F.to_timestamp("reviewed_at"))
    t["tasks"] = spark.createDataFrame([("I1", "proposed_capture_reconciliation")], "item_id string, status string")
    t["records"] = t["records"].withColumn("run_id", F.lit("run1")).withColumn("project_id", F.lit("home"))
    t["digests"] = spark.createDataFrame([("manifest", "a", "a"), ("segments", "b", "b")], "name string, expected string, found string")
    t["scope"] = spark.createDataFrame([("run1", "s", "s")], "run_id string, expected string, found string")
    t["documents"] = spark.createDataFrame([("E1", "h0", "h1", "a", "b", "c")], "evidence_id string, original_sha256 string, text_sha256 string, original_path string, text_path string, metadata_path string")
    t["rebuilt_segments"] = t["segments"]
    t["live"] = t["files"].select("evidence_id", "sha256")
    t["run"] = spark.createDataFrame([("run1", "home", "0.6")], "run_id string, project_id string, schema_version string")
    t["bindings"] = spark.createDataFrame([("home", "run1", "records.json", "d", "d")], "project_id string, run_id string, artefact string, reviewed string, released string")
    t["permissions"] = spark.createDataFrame([("run1", "home", "run1", "home", "Ada", "kept for audit", "2026-01-01")], "run_id string, target_project string, this_run string, this_project string, authorised_by string, reason string, authorised_at string").withColumn("authorised_at", F.to_timestamp("authorised_at"))
    t["dependencies"] = spark.createDataFrame([("far", "records.json", "d", "d")], "project_id string, artefact string, pinned string, live string")
    t["locations"] = spark.createDataFrame([("run1", "l", "l", "c", "c")], "run_id string, expected_location string, location string, expected_config string, config string")
    t["requests"] = spark.createDataFrame([("Q1", "E1", 1, 2)], "request_id string, evidence_id string, start int, end int")
    return t


ROUTING = [
    ("projects", {"names": "array('Orion')", "domain": "'team'"}, "V27_registry"), ("disclosures", {"to_project": "'far'"}, "V27_registry"), ("reviews", {"decision": "'reject'"}, "V28_review"), ("reviews", {"approved": "array('REQ-001')"}, "V28_review"), ("publications", {"sequence": "2 - ordinal"}, "V29_publication_order"), ("entries", {"visibility": "'historical'"}, "V30_index"), ("entries", {"key": "'x'"}, "V30_index"),
    ("assessments", {"mention_id": "'M9'"}, "V35_one_assessment_each"), ("mentions", {"segment_ids": "array()"}, "V37_mentions_have_segments"), ("assessments", {"homes": "array('REQ-9')"}, "V38_homes_exist"), ("assessments", {"class": "'R2'"}, "V39_to_V42_classes"), ("assessments", {"disposition": "'dismissed'"}, "V39_to_V42_classes"), ("disclosures", {"path_pattern": "'b/**'"}, "V43_home_links_are_granted"), ("disclosures", {"path_pattern": "'b/**'"}, "V48_referral_target"),
    ("referrals", {"class": "'R4'"}, "V44_referrals_agree"), ("referrals", {"start": "2"}, "V45_referral_covers_its_mention"), ("referrals", {"quote": "'x'"}, "V46_referral_quotes"), ("selected", {"end": "1"}, "V47_referral_in_selection"), ("coverage", {"disposition": "'deferred'"}, "V47_referral_was_read"), ("interval_coverage", {"disposition": "'triaged_out'"}, "V47_referral_was_read"), ("referrals", {"include_pattern": "'**'"}, "V48_referral_target"), ("referrals", {"target": "'far'"}, "V48_referral_target"),
    ("assessments", {"disposition": "'linked_home'"}, "V49_only_referred_have_referrals"), ("assessments", {"class": "'R2'"}, "V50_target_only_is_not_cited"), ("assessments", {"homes": "array('UNC-001')"}, "V51_homes_hold_the_mention"), ("assessments", {"disposition": "'linked_home'"}, "V51_every_referral_is_used"), ("links", {"target": "'far'"}, "V52_links_agree"), ("records", {"kind": "'investigation'"}, "V19_investigations"),
    ("report_digests", {"found": "null"}, "V31_registry_and_scan"), ("proposal", {"registry_version": "'1.0'"}, "V31_registry_and_scan"), ("proposal", {"run_id": "'run9'"}, "V32_referrals_belong_to_the_run"), ("proposal", {"schema_version": "'1.0'"}, "V32_referrals_belong_to_the_run"),
    ("manual_mentions", {"quote": "'x'"}, "V34_manual_references"), ("manual_mentions", {"representation_sha256": "'x'"}, "V34_manual_references"), ("manual_mentions", {"end": "9"}, "V34_manual_references"), ("manual_mentions", {"target": "'far'"}, "V34_manual_references"), ("manual_mentions", {"target": "'home'"}, "V34_manual_references"), ("manual_mentions", {"mention_id": "'M1'"}, "V34_manual_references"), ("selected", {"start": "2"}, "V34_manual_references_selected"),
    ("intake", {"expected_id": "'I9'"}, "V53_intake_identities"), ("intake", {"origin_project": "'home'"}, "V53_intake_identities"), ("intake", {"source_status": "'stale'"}, "V53_intake_status_is_the_last_observed"), ("observations", {"ordinal": "-ordinal"}, "V53_intake_status_is_the_last_observed"),
    ("decisions", {"reviewer": "' '"}, "V53_intake_decisions"), ("decisions", {"reviewed_at": "timestamp'2025-01-01'"}, "V53_intake_decisions"), ("decisions", {"reviewed_at": "timestamp'2999-01-01'"}, "V53_intake_decisions"), ("decisions", {"capture_mode": "'full_file'"}, "V53_intake_decisions"), ("decisions", {"ordinal": "-ordinal"}, "V53_intake_decisions"), ("tasks", {"status": "'x'"}, "V53_intake_tasks"), ("decisions", {"decision": "'defer'"}, "V53_intake_tasks"), ("intake", {"supersedes": "'I9'"}, "V53_intake_lineage"), ("intake", {"supersedes": "item_id"}, "V53_intake_lineage"), ("intake", {"family": "item_id"}, "V53_intake_lineage"),
    ("digests", {"found": "null"}, "V1_digests"), ("digests", {"name": "'manifest'"}, "V1_digests"), ("scope", {"found": "'x'"}, "V2_scope"), ("documents", {"text_sha256": "original_sha256"}, "V4_documents"), ("documents", {"text_path": "original_path"}, "V4_documents"), ("documents", {"evidence_id": "'E9'"}, "V4_documents"), ("rebuilt_segments", {"end": "1"}, "V7_segments_rebuild"), ("live", {"sha256": "'x'"}, "V8_live_bytes"), ("live", {"evidence_id": "'E9'"}, "V8_live_bytes"), ("run", {"run_id": "'run9'"}, "V9_records_of_the_run"), ("run", {"schema_version": "'9'"}, "V9_records_of_the_run"), ("bindings", {"released": "null"}, "V54_release_gate"), ("bindings", {"reviewed": "'x'"}, "V54_release_gate"), ("publications", {"run_id": "'run7'"}, "V54_release_gate"), ("permissions", {"run_id": "'run9'"}, "V55_context"), ("permissions", {"reason": "' '"}, "V55_context"), ("permissions", {"authorised_at": "timestamp'2999-01-01'"}, "V55_context"), ("dependencies", {"live": "null"}, "V55_context"), ("locations", {"config": "'x'"}, "V59_location"), ("locations", {"location": "null"}, "V59_location"),
    ("requests", {"end": "3"}, "V56_requests"), ("requests", {"evidence_id": "'E9'"}, "V56_requests"), ("projects", {"id": "'other'"}, "V61_target_is_registered"),
]


def test_a_valid_routing_has_no_violations(spark):
    t = routed(spark)
    names = [n for n in rules.RULES if n >= "V27" or n.startswith("V19")]
    assert rules.violations(t, names).collect() == []
    rules.require(t)


@pytest.mark.parametrize("name, change, want", ROUTING)
def test_routing_mutations_are_found(spark, name, change, want):
    t = routed(spark)
    t[name] = t[name].withColumns({k: F.expr(v) for k, v in change.items()})
    assert want in {r.rule for r in rules.violations(t, [want]).collect()}


def test_too_many_references(spark, monkeypatch):
    from lodestrata.operators import referrals

    monkeypatch.setattr(referrals, "MOST", 1)
    assert rules.violations(routed(spark), ["V33_references_in_number"]).count() == 1


def test_index(spark):
    from lodestrata.operators import index

    projects = spark.createDataFrame([("a", "r2"), ("b", "r1")], "project_id string, current_run_id string")
    releases = spark.createDataFrame([("a", "r1"), ("a", "r2"), ("b", "r1"), ("c", "r1")], "project_id string, run_id string")
    records = spark.createDataFrame([("a", "r1", "X", "decision", "observed"), ("a", "r2", "X", "decision", "observed"), ("b", "r1", "Y", "requirement", "proposal"), ("c", "r1", "Z", "decision", "observed")], "project_id string, run_id string, record_id string, kind string, epistemic_status string")
    whole, now = index.build(projects, releases, records, True), index.build(projects, releases, records)
    assert sorted((r.key, r.visibility) for r in whole["entries"].collect()) == [("a:r1:X", "historical"), ("a:r2:X", "current"), ("b:r1:Y", "current")]
    assert sorted(r.key for r in now["entries"].collect()) == ["a:r2:X", "b:r1:Y"]
    assert index.generation(whole) == index.generation({k: v.repartition(3) for k, v in whole.items()}) != index.generation(now)
    assert [r.key for r in index.eligible(whole["entries"], "all", "a", "decision").orderBy("key").collect()] == ["a:r1:X", "a:r2:X"]
    for wrong in ({"view": "old"}, {"kind": "x"}, {"status": "x"}, {"view": "historical", "include_history": False}, {"project_id": "c", "projects": projects}):
        with pytest.raises(ValueError):
            index.eligible(whole["entries"], **wrong)
    with pytest.raises(ValueError, match="no current approved release"):
        index.build(projects, releases.where("run_id <> 'r2'"), records)
    with pytest.raises(ValueError):
        index.build(projects, releases, records, most_entries=1)
    assert {r.project_id: (r.releases, r.entries, r.current_entries) for r in index.summary(whole).collect()} == {"a": (2, 2, 1), "b": (1, 1, 1)}


def test_reanchored_proposal(spark):
    from lodestrata.operators import reanchor

    records = spark.createDataFrame([("A", ["a0", "a1", "a2"]), ("B", ["b0"]), ("C", ["c0"])], "record_id string, citations array<string>")
    kept = spark.createDataFrame([("a0",), ("a2",), ("c0",), ("f1",)], "citation_id string")
    events = spark.createDataFrame([("A", "E1", [0, 2]), ("A", "E2", [1]), ("B", "E3", [0])], "record_id string, event_id string, refs array<int>")
    relations = spark.createDataFrame([("A", "refines", "B"), ("A", "refines", "C"), ("B", "refines", "A")], "src string, type string, dst string")
    got = reanchor.proposal(records, kept, events, relations)
    assert [(r.record_id, r.citations, r.lost) for r in got["records"].orderBy("record_id").collect()] == [("A", ["a0", "a2"], 1), ("C", ["c0"], 0)]
    assert [r.record_id for r in got["dropped"].collect()] == ["B"]
    assert [(r.event_id, r.refs) for r in got["events"].collect()] == [("E1", [0, 1])]
    assert [(r.src, r.dst) for r in got["relations"].collect()] == [("A", "C")]
    assert sorted((r.code, r.subject) for r in got["questions"].collect()) == [("lost_citations", "1"), ("lost_event", "E2"), ("lost_relation", "refines:B")]
    findings = spark.createDataFrame([("C", 0, ["f0"]), ("C", 1, ["f0", "f1"]), ("A", 0, ["f0"])], "record_id string, finding int, citations array<string>")
    got = reanchor.proposal(records, kept, events, relations, findings)
    assert [(r.record_id, r.lost) for r in got["records"].collect()] == [("C", 2)] and [(r.record_id, r.finding) for r in got["findings"].collect()] == [("C", 1)]
    files = lambda *x: spark.createDataFrame(x, "logical_id string, evidence_id string, text_sha256 string, representation_sha256 string")
    old, new = files(("f", "o1", "t", None), ("g", "o2", "t", None), ("h", "o3", "t", None)), files(("f", "n1", "t", None), ("g", "n2", "u", None), ("h", "n3", "t", None), ("i", "n4", "t", None))
    declared = spark.createDataFrame([("o1", "triaged_out", "m"), ("o2", "reviewed_no_record", None), ("o3", "used", None)], "evidence_id string, disposition string, method string")
    cited = spark.createDataFrame([("n4",)], "evidence_id string")
    said = lambda approved: {r.evidence_id: (r.disposition, r.method, r.why) for r in reanchor.coverage(new, old, declared, cited, approved).collect()}
    assert said(True) == {"n1": ("triaged_out", "m", "carried_over"), "n2": ("deferred", None, "new_or_changed"), "n3": ("deferred", None, "new_or_changed"), "n4": ("used", None, "cited")}
    assert said(False)["n1"] == ("deferred", None, "not_approved")


def test_captures_and_links(spark):
    from lodestrata.operators import referrals

    a = spark.createDataFrame([("1", "full_file", "accept", "y", "h", "h", "h", None, "q"), ("2", "full_file", "accept", "y", "h", "h", "o", None, "q"), ("3", "scoped_export", "accept", "y", "h", "h", "h", "q", "q"), ("4", "scoped_export", "accept", "y", "h", "h", "o", "a\nq\nb", "q"), ("5", "scoped_export", "accept", "y", "h", "h", "o", "aq", "q"), ("6", "scoped_export", "accept", "y", "h", "h", "o", None, "q"), ("7", "full_file", "accept", " ", "h", "h", "h", None, "q"), ("8", "full_file", "accept", "y", "h", "g", "g", None, "q")], "item_id string, mode string, decision string, reason string, stated_sha256 string, actual_sha256 string, origin_sha256 string, text string, quote string")
    assert [r.verdict for r in referrals.captures(a).orderBy("item_id").collect()] == ["ok", "not_the_original", "whole_file_as_export", "ok", "quote_not_kept", "not_text", "not_accepted", "bytes_changed"]


def test_preceding_headings_and_pages(spark):
    from lodestrata.operators import quotes, views

    rows = spark.createDataFrame([("p", 1, "H1"), ("p", 2, None), ("p", 3, "H2"), ("p", 4, None), ("q", 1, None)], "page string, pos int, h string")
    assert [r.above for r in quotes.preceding(rows, ["page"], "pos", "h", "above").orderBy("page", "pos").collect()] == [None, "H1", "H1", "H2", None]
    many = spark.createDataFrame([("k", i, f"l{i}") for i in range(25)] + [("j", 0, "x")], "kind string, o int, l string")
    got = views.pages(many, ["kind"], "o", F.col("l"), size=10).collect()
    assert sorted((r.kind, r.page, r.text.count("\n") + 1) for r in got) == [("j", 1, 1), ("k", 1, 10), ("k", 2, 10), ("k", 3, 5)]
    assert "\n".join(r.text for r in sorted(got, key=lambda r: r.page) if r.kind == "k") == "\n".join(f"l{i}" for i in range(25))


def test_briefings_and_reports(spark):
    from lodestrata.operators import context

    rows = spark.createDataFrame([(2, "b", "observed", "second"), (1, "a", "proposal", "first")], "place int, key string, epistemic_status string, statement string")
    said = context.briefing(rows, 3).first().briefing
    assert said.startswith("PRIOR KNOWLEDGE") and "a [proposal]: first\nb [observed]: second\nOmitted results: 3." in said
    assert context.report(None) == {"context_mode": "explicit_none", "context_check": "frozen_integrity", "context_omitted_count": 0}
    assert context.report(rows, 3, True) == {"context_mode": "pinned_prior_knowledge", "context_check": "prospective", "context_omitted_count": 3}


def test_artefact_paths_are_checked(spark):
    from lodestrata.sources.capture import artefact_paths

    df = spark.createDataFrame([("E-1", ".docx")], "e string, x string")
    assert df.select(artefact_paths(F.col("e"), F.col("x")).alias("p")).first().p.original == "snapshots/E-1.original.docx"
    for bad in (("F-1", ".docx"), ("E-1", ".exe")):
        with pytest.raises(Exception, match="no document"):
            spark.createDataFrame([bad], "e string, x string").select(artefact_paths(F.col("e"), F.col("x"))).collect()
