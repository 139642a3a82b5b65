"""The derived index over approved releases: entries under qualified keys, with the evidence that each record cites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.coverage import capped
from lodestrata.sources.sinks import digest

VIEWS = ("current", "historical", "all")
KINDS = ("requirement", "decision", "uncertainty", "investigation")
STATUSES = ("observed", "interpretation", "proposal", "unresolved")
RUN = ["project_id", "run_id"]


def evidence_links(citations: DataFrame, files: DataFrame, segments: DataFrame) -> DataFrame:
    """citations with where each comes from.

    citations: project_id, run_id, record_id, role (record or finding),
    finding_index, citation_index, evidence_id, segment_id, start, end. files:
    project_id, run_id, evidence_id and columns that describe a file.
    segments: project_id, run_id, segment_id, original_locator. A citation of
    an unknown file or segment keeps its row with nulls; rules object to it.
    """
    f = files.select(*[F.col(c).alias(c if c not in (*RUN, "evidence_id") else f"f_{c}") for c in files.columns])
    s = segments.select(*[F.col(c).alias(f"s_{c}") for c in (*RUN, "segment_id")], "original_locator")
    same = lambda p, *cols: [F.col(c) == F.col(f"{p}_{c}") for c in cols]
    out = citations.join(f, same("f", *RUN, "evidence_id"), "left").join(s, same("s", *RUN, "segment_id"), "left")
    return out.drop(*[f"f_{c}" for c in (*RUN, "evidence_id")], *[f"s_{c}" for c in (*RUN, "segment_id")])


def key_of() -> Column:
    return F.concat_ws(":", "project_id", "run_id", "record_id")


def build(projects: DataFrame, releases: DataFrame, records: DataFrame, include_history: bool = False, most_releases: int = 1000, most_entries: int = 10_000) -> dict[str, DataFrame]:
    """projects, releases and entries of an index.

    projects: project_id, current_run_id and what describes a project.
    releases: project_id, run_id. records: project_id, run_id, record_id and
    what a record holds. A project without its current release among the
    releases raises, and so does passing a cap: an index never drops rows.
    """
    mine = releases.join(projects.select("project_id", "current_run_id"), "project_id")
    shown = mine.withColumn("visibility", F.when(F.col("run_id") == F.col("current_run_id"), "current").otherwise("historical")).drop("current_run_id")
    if lost := projects.join(shown.where("visibility = 'current'"), "project_id", "left_anti").limit(1).collect():
        raise ValueError(f"no current approved release: {lost[0].project_id}")
    if not include_history:
        shown = shown.where("visibility = 'current'")
    shown = capped(shown, most_releases, "releases")
    entries = records.join(shown.select(*RUN, "visibility"), RUN).withColumn("key", key_of())
    return {"projects": projects, "releases": shown, "entries": capped(entries, most_entries, "entries")}


def generation(index: dict[str, DataFrame]) -> str:
    """The identity of an index's content, whatever the order of its rows."""
    from lodestrata.functions.identity import digest_of

    return "IDX-" + digest_of({name: digest(df) for name, df in index.items()})[:24]


def eligible(entries: DataFrame, view: str = "current", project_id: str | None = None, kind: str | None = None, status: str | None = None, projects: DataFrame | None = None, include_history: bool = True) -> DataFrame:
    """Entries that a lookup may see; what it asks for must exist."""
    if view not in VIEWS or kind not in (None, *KINDS) or status not in (None, *STATUSES):
        raise ValueError("the view, kind or status is invalid")
    if view == "historical" and not include_history:
        raise ValueError("the index was built without history")
    if project_id is not None and projects is not None and not projects.where(F.col("project_id") == project_id).limit(1).count():
        raise ValueError("the project is outside the index")
    out = entries if view == "all" else entries.where(F.col("visibility") == view)
    for column, value in (("project_id", project_id), ("kind", kind), ("epistemic_status", status)):
        out = out if value is None else out.where(F.col(column) == value)
    return out


def summary(index: dict[str, DataFrame]) -> DataFrame:
    """How many projects, releases and entries there are, and how many of each project are current."""
    e = index["entries"].groupBy("project_id").agg(F.count("*").alias("entries"), F.count_if(F.col("visibility") == "current").alias("current_entries"))
    r = index["releases"].groupBy("project_id").agg(F.count("*").alias("releases"))
    return index["projects"].select("project_id").join(r, "project_id", "left").join(e, "project_id", "left").select("project_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("releases", "entries", "current_entries")])
