"""Differences between two captures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def status(old: DataFrame, new: DataFrame, key: str = "logical_id", compared: tuple[str, ...] = ("sha256",)) -> DataFrame:
    """key and change (added, removed, modified or unchanged) for each key of either side; nulls equal nulls."""
    a = old.select(F.col(key).alias("o_key"), *[F.col(c).alias(f"o_{c}") for c in compared])
    b = new.select(F.col(key).alias("n_key"), *[F.col(c).alias(f"n_{c}") for c in compared])
    same = F.lit(True)
    for c in compared:
        same = same & F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}"))
    change = F.when(F.col("o_key").isNull(), "added").when(F.col("n_key").isNull(), "removed").when(same, "unchanged").otherwise("modified")
    return a.join(b, F.col("o_key") == F.col("n_key"), "full_outer").select(F.coalesce("n_key", "o_key").alias(key), change.alias("change"))


def renames(old: DataFrame, new: DataFrame, key: str = "logical_id", content: tuple[str, ...] = ("source_id", "sha256"), equal: tuple[str, ...] = ()) -> DataFrame:
    """(renamed_from, renamed_to): an added row with the content of exactly one removed row, which is used once, by the first added row that also equals it in `equal`."""
    removed = old.join(new.select(key), key, "left_anti").select(F.col(key).alias("renamed_from"), *content, *[F.col(c).alias(f"o_{c}") for c in equal])
    added = new.join(old.select(key), key, "left_anti").select(F.col(key).alias("renamed_to"), *content, *equal)
    group = Window.partitionBy(*content)
    single = removed.withColumn("n", F.count("*").over(group)).where("n = 1").drop("n")
    both = single.join(added, list(content))
    for c in equal:
        both = both.where(F.col(f"o_{c}").eqNullSafe(F.col(c)))
    first = F.row_number().over(Window.partitionBy("renamed_from").orderBy("renamed_to"))
    return both.withColumn("nth", first).where("nth = 1").select("renamed_from", "renamed_to")


def comparable(old_scope: str, new_scope: str, errors: int) -> bool:
    """Only complete captures of the same scope are compared: absence elsewhere is no deletion."""
    return errors == 0 and old_scope == new_scope


def between_runs(old: DataFrame, new: DataFrame, old_scope: str, new_scope: str, errors: int = 0, **how) -> DataFrame:
    """status(), or no rows where the captures can't be compared."""
    out = status(old, new, **how)
    return out if comparable(old_scope, new_scope, errors) else out.where("false")


def next_sequence(runs: DataFrame, now: str, project: str) -> int:
    """The next capture's number; a clock that went back by more than ten minutes raises."""
    r = runs.where(F.col("project_id") == project).agg(F.coalesce(F.max("sequence"), F.lit(0)) + 1, F.max("created_at") > F.lit(now).cast("timestamp") + F.expr("interval 600 seconds")).first()
    if r[1]:
        raise ValueError("the clock is behind an earlier capture")
    return int(r[0])


def newer_than(runs: DataFrame, baseline: str) -> DataFrame:
    """Ready runs of the baseline's project after it, by (sequence, created_at)."""
    at = F.struct("sequence", "created_at")
    b = runs.where(F.col("run_id") == baseline).select(F.col("project_id").alias("b_project"), at.alias("b_at"))
    return runs.join(b, (F.col("project_id") == F.col("b_project")) & (at > F.col("b_at"))).where("status = 'ready'").drop("b_project", "b_at")


def changed_fields(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key and the sorted names of fields that differ, for keys of both sides; null-safe."""
    a = old.select(F.col(key), *[F.col(f).alias(f"o_{f}") for f in fields])
    diff = F.array_compact(F.array(*[F.when(~F.col(f"o_{f}").eqNullSafe(F.col(f)), F.lit(f)) for f in sorted(fields)]))
    return new.select(key, *fields).join(a, key).select(key, diff.alias("fields")).where("size(fields) > 0")


def set_difference(old: DataFrame, new: DataFrame, group: str) -> DataFrame:
    """How many rows of a group came and went, as sets: group, added, removed."""
    a, b = old.distinct().withColumn("side", F.lit(1)), new.distinct().withColumn("side", F.lit(2))
    both = a.unionByName(b).groupBy(*old.columns).agg(F.sum("side").alias("side"))
    return both.groupBy(group).agg(F.count_if(F.col("side") == 2).alias("added"), F.count_if(F.col("side") == 1).alias("removed")).where("added + removed > 0")


def next_sequences(runs: DataFrame) -> DataFrame:
    """project_id, the number of its next capture and the time of its latest; `next_sequence` is the same for one project, with the clock's guard."""
    return runs.groupBy("project_id").agg((F.coalesce(F.max("sequence"), F.lit(0)) + 1).cast("long").alias("next"), F.max("created_at").alias("latest"))
