"""Selection of files and passages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.globs import matches


def holds_term(folded: Column, terms: list[str]) -> Column:
    """Whether a folded text holds any folded term."""
    return F.exists(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(folded, t)) if terms else F.lit(False)


def chosen(files: DataFrame, ids: list[str] | None = None, globs: list[str] | None = None, terms: list[str] | None = None, composition: str = "union", *, key: str = "evidence_id", path: str = "relative_path", folded: str = "folded", allow_none: bool = False) -> DataFrame:
    """The files that the supplied groups of selectors choose together; without any group all of them.

    An empty choice raises, unless allow_none.
    """
    flags = []
    if ids:
        flags.append(F.col(key).isin(ids))
    if globs:
        flags.append(matches(F.col(path), *globs))
    if terms:
        flags.append(holds_term(F.col(folded), terms))
    test = F.lit(not flags)
    for i, f in enumerate(flags):
        test = f if not i else (test & f if composition == "intersection" else test | f)
    out = files.where(test)
    if not allow_none and out.limit(1).count() == 0:
        raise ValueError("nothing was selected")
    return out


def permitted(rows: DataFrame, grants: DataFrame) -> DataFrame:
    """Rows (from_project, to_project, source_id, path) that a grant (the same, with a compiled `path_regex`) allows within one information domain."""
    g = grants.select(*[F.col(c).alias(f"g_{c}") for c in grants.columns])
    same = [F.col(c) == F.col(f"g_{c}") for c in ("from_project", "to_project", "source_id")]
    return rows.join(g, [*same, F.col("from_domain") == F.col("to_domain"), F.expr("path rlike g_path_regex")], "left_semi")


def subset(needed: Column, have: Column) -> Column:
    """Whether an array has all of another's elements."""
    return F.size(F.array_except(needed, have)) == 0


def in_passages(points: DataFrame, ranges: DataFrame, key: str = "evidence_id", line: str = "line") -> DataFrame:
    """Points (key, line) inside any selected range (key, start, end) of their file."""
    r = ranges.select(F.col(key).alias("__key"), F.col("start").alias("__start"), F.col("end").alias("__end"))
    return points.join(r, (F.col(key) == F.col("__key")) & F.col(line).between(F.col("__start"), F.col("__end")), "left_semi")
