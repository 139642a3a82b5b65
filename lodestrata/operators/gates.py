"""Gates before a run is used or published: bindings by digest, and what a release must agree with; the rules join `rules.RULES`.

Tables beyond those of `rules` and `routing`:

digests          name, expected, found: of the manifest, segments, snapshots and metadata, as bound and as recomputed
scope            run_id, expected, found: the capture's scope fingerprint as stated and as recomputed
documents        evidence_id, original_sha256, text_sha256, original_path, text_path, metadata_path
rebuilt_segments segment_id, evidence_id, ordinal, start, end: segments made again from the snapshots
live             evidence_id, sha256: what the sources hold now
run              run_id, project_id, schema_version (one row)
bindings         project_id, run_id, artefact, reviewed, released: digests that a review approved and that a release holds
permissions      run_id, target_project, this_run, this_project, authorised_by, reason, authorised_at: who allowed prior knowledge to be kept
dependencies     project_id, artefact, pinned, live: digests of what a context was made of, then and now
locations        run_id, expected_location, location, expected_config, config: digests
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.operators.referrals import human
from lodestrata.operators.rules import _of, _twice, rule

# Versions of records that the engine reads.
VERSIONS = ("0.1", "0.2", "0.3", "0.4", "0.5", "0.6")


@rule("V1_digests", "digests")
def _(t):
    return _of(t["digests"].where("found is null or expected <> found"), "name", F.when(F.col("found").isNull(), "missing").otherwise("differs")).unionByName(_twice(t["digests"], "name"))


@rule("V2_scope", "scope")
def _(t):
    return _of(t["scope"].where("not (expected <=> found)"), "run_id", "the scope does not recompute")


@rule("V4_documents", "documents", "files")
def _(t):
    d = t["documents"]
    names = [F.col(c) for c in ("original_path", "text_path", "metadata_path")]
    same = d.where(F.col("original_sha256") == F.col("text_sha256"))
    place = d.where(F.size(F.array_distinct(F.array(*names))) < 3)
    gone = d.join(t["files"].select("evidence_id"), "evidence_id", "left_anti")
    return _of(same, "evidence_id", "the text is the original").unionByName(_of(place, "evidence_id", "two artefacts at one place")).unionByName(_of(gone, "evidence_id", "unknown file"))


@rule("V7_segments_rebuild", "segments", "rebuilt_segments")
def _(t):
    cols = ["segment_id", "evidence_id", "ordinal", "start", "end"]
    a, b = t["segments"].select(cols), t["rebuilt_segments"].select(cols)
    return _of(a.exceptAll(b), "segment_id", "is not made again").unionByName(_of(b.exceptAll(a), "segment_id", "is not there"))


@rule("V8_live_bytes", "files", "live")
def _(t):
    now = t["live"].select("evidence_id", F.col("sha256").alias("now"))
    return _of(t["files"].join(now, "evidence_id", "left").where("not (sha256 <=> now)"), "evidence_id", F.when(F.col("now").isNull(), "gone").otherwise("changed"))


@rule("V9_records_of_the_run", "records", "run")
def _(t):
    run = t["run"].select(F.col("run_id").alias("this_run"), F.col("project_id").alias("this_project"), "schema_version")
    old = run.where(~F.col("schema_version").isin(*VERSIONS))
    bad = t["records"].join(F.broadcast(run.limit(1)), F.lit(True)).where("not (run_id <=> this_run) or not (project_id <=> this_project)")  # one row
    return _of(bad, "record_id", "another run or project").unionByName(_of(old, "this_run", "schema_version"))


@rule("V54_release_gate", "releases", "bindings", "publications")
def _(t):
    b = t["bindings"].where("released is null or reviewed is null or reviewed <> released")
    once = t["publications"].select("run_id").distinct()
    return _of(b, F.concat_ws(":", "project_id", "run_id", "artefact"), "not what was approved").unionByName(_of(t["releases"].join(once, "run_id", "left_anti"), F.concat_ws(":", "project_id", "run_id"), "not in the publication history"))


@rule("V59_location", "locations")
def _(t):
    x = t["locations"]
    return _of(x.where("not (expected_location <=> location)"), "run_id", "moved").unionByName(_of(x.where("not (expected_config <=> config)"), "run_id", "another configuration"))


@rule("V55_context", "permissions", "dependencies")
def _(t):
    p = t["permissions"]
    other = p.where("not (run_id <=> this_run) or not (target_project <=> this_project)")
    blank = p.where(~human(F.col("authorised_by"), F.col("reason"), F.col("authorised_at"), F.lit("0001-01-01").cast("timestamp"), F.current_timestamp()))
    stale = t["dependencies"].where("not (pinned <=> live)")
    return _of(other, "run_id", "another run or project").unionByName(_of(blank, "run_id", "no person, reason or time")).unionByName(_of(stale, F.concat_ws(":", "project_id", "artefact"), "changed since the context was made"))
