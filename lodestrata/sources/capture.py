"""Capture of scoped files: scan, decode, freeze, explode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions import globs, identity
from lodestrata.functions.text import extension, machine_written, split_lines

#: Bytes of a file that capture reads at most, unless told otherwise.
LARGEST = 2_000_000


def _relative(root: str) -> Column:
    """The path below the root; both may be any URI that Spark reads."""
    tail = root.rstrip("/").split("://", 1)[-1].removeprefix("file:")
    return F.regexp_replace(F.col("path"), "^.*?" + "".join(f"\\{c}" if not c.isalnum() and c not in "/_-" else c for c in tail) + "/", "")


def scanned(spark: SparkSession, root: str, source_id: str, include: list[str], exclude: list[str] = (), largest: int = LARGEST) -> DataFrame:
    """source_id, relative_path, length and content of the files in scope below a root.

    The path and size predicates stand before the content is read: a file
    outside the scope is listed but never opened.
    """
    out = [f"**/{f}/**" for f in globs.FOLDERS]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    rows = files.withColumn("relative_path", _relative(root)).where(globs.selected(F.col("relative_path"), list(include), [*exclude, *out]))
    return rows.where(F.col("length") <= largest).select(F.lit(source_id).alias("source_id"), "relative_path", "length", "content")


def left_out(spark: SparkSession, root: str, source_id: str, include: list[str], exclude: list[str] = (), largest: int = LARGEST) -> DataFrame:
    """Issues for what a scan does not take: excluded entries, and files that are too large. Contents are not read."""
    out = [f"**/{f}/**" for f in globs.FOLDERS]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).withColumn("relative_path", _relative(root))
    inside = globs.selected(F.col("relative_path"), list(include), [*exclude, *out])
    code = F.when(~inside, "excluded").when(F.col("length") > largest, "file_too_large")
    return files.select(F.lit(source_id).alias("source_id"), F.col("relative_path").alias("path"), code.alias("code")).where("code is not null")


def members(spark: SparkSession, root: str, source_id: str, paths: list[str]) -> DataFrame:
    """Only the named members are opened, no folder is listed; a missing one raises."""
    for p in paths:
        globs.check_pattern(p)
    files = spark.read.format("binaryFile").load([f"{root.rstrip('/')}/{p}" for p in paths])
    return files.select(F.lit(source_id).alias("source_id"), _relative(root).alias("relative_path"), "length", "content")


def texts(files: DataFrame, project: str, source_type: str) -> DataFrame:
    """Files with what they hold as text: issue (null if it is text), text, lines, sha256 and ids. Bytes that are no UTF-8 are an issue, never replaced."""
    known = extension(F.col("relative_path")).isin(*globs.TEXT_EXTENSIONS)
    raw = F.col("content")
    valid = F.is_valid_utf8(raw.cast("string"))
    text = F.regexp_replace(F.when(valid, raw.cast("string")), r"^\uFEFF", "")
    issue = F.when(~known, "unsupported_extension").when(F.position(F.lit(b"\x00"), raw) > 0, "holds_nul").when(~valid, "not_utf8")
    sha = F.sha2(raw, 256)
    rep = identity.representation_sha(sha)
    rows = files.select("source_id", F.lit(source_type).alias("source_type"), "relative_path", "length", sha.alias("sha256"), issue.alias("issue"), F.when(issue.isNull(), text).alias("text"), identity.logical_id(F.lit(project), F.col("source_id"), F.col("relative_path")).alias("logical_id"), identity.evidence_id(F.lit(project), F.col("source_id"), F.col("relative_path"), sha).alias("evidence_id"), rep.alias("representation_sha256"))
    blank = F.when(F.col("text").rlike(r"\A(?U)\s*\z") & F.col("issue").isNull(), "blank_file")
    return rows.withColumn("warning", F.coalesce(blank, F.when(machine_written(F.col("relative_path")) & (F.col("source_type") != "repository"), "ai_generated_source"))).withColumn("lines", split_lines(F.col("text")))


def lines(captured: DataFrame) -> DataFrame:
    """evidence_id, line_no from 1, text: the table that most operators read."""
    return captured.where("issue is null").select("evidence_id", F.posexplode("lines").alias("pos", "text")).select("evidence_id", (F.col("pos") + 1).alias("line_no"), "text")


def provenance_warnings(files: DataFrame, provenance: DataFrame) -> DataFrame:
    """(evidence_id, code): how far origin and authorship of files are established.

    provenance has source_id, relative_path, features (map), limitations
    (array) and authorship.
    """
    p = provenance.withColumn("known", F.lit(True))
    rows = files.join(p, ["source_id", "relative_path"], "left")
    weak = F.exists(F.map_values("features"), lambda v: v.isin("unknown", "not_preserved")) | (F.size("limitations") > 0)
    origin = F.when(F.col("known").isNotNull(), F.when(weak, "provenance_incomplete")).when(F.col("source_type") != "repository", "provenance_missing").otherwise("repository_revision_unrecorded")
    author = F.when(F.col("authorship").isin("ai_generated", "mixed"), "ai_generated_source").when(F.col("authorship").isNull() & (F.col("source_type") != "repository") & machine_written(F.col("relative_path")), "ai_generated_source")
    return rows.select("evidence_id", F.explode(F.array_compact(F.array(origin, author))).alias("code"))


def unused_provenance(files: DataFrame, provenance: DataFrame) -> DataFrame:
    return provenance.join(files, ["source_id", "relative_path"], "left_anti")


def prior_runs(runs: DataFrame, project: str, current: str) -> DataFrame:
    """All other runs of the project, blocked ones included: they took a sequence number."""
    return runs.where((F.col("project_id") == project) & (F.col("run_id") != current))


def artefact_paths(evidence: Column, ext: Column) -> Column:
    """struct(original, text, metadata): where the frozen parts of a document lie below its run; an id or extension that is none raises."""
    known = evidence.startswith("E-") & ext.isin(*globs.DOCUMENT_EXTENSIONS, ".csv")
    at = F.concat(F.lit("snapshots/"), evidence)
    paths = F.struct(F.concat(at, F.lit(".original"), ext).alias("original"), F.concat(at, F.lit(".evidence.md")).alias("text"), F.concat(at, F.lit(".extraction.json")).alias("metadata"))
    return F.when(known, paths).otherwise(F.raise_error(F.concat(F.lit("no document: "), evidence, ext)).cast("struct<original:string,text:string,metadata:string>"))
