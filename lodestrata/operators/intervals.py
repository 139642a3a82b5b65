"""Operators on line ranges, both ends included, counted from 1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How a rollup chooses: the first of these that any part has.
PRIORITY = ("used", "deferred", "triaged_out", "reviewed_no_record")


def merged(df: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Ranges of a key joined where they overlap or touch."""
    order = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.when(reach.isNull() | (F.col(start) > reach + 1), 1).otherwise(0)
    part = F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("__new", opened).withColumn("__part", part).groupBy(*keys, "__part").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__part")


def partitioned(segments: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Each segment (keys, start, end) cut at the ends of the ranges (keys, start, end) within it, with `selected` for the parts in a range."""
    inside = segments.alias("s").join(ranges.alias("r"), [F.col(f"s.{k}") == F.col(f"r.{k}") for k in keys] + [F.col("r.start") <= F.col("s.end"), F.col("s.start") <= F.col("r.end")], "left")
    at = lambda c: c
    cuts = F.array_compact(F.array(F.col("s.start"), F.when(F.col("r.start") > F.col("s.start"), F.col("r.start")), F.when(F.col("r.end") < F.col("s.end"), F.col("r.end") + 1)))
    points = inside.select(*[F.col(f"s.{k}").alias(k) for k in keys], at(F.col("s.start")).alias("seg_start"), at(F.col("s.end")).alias("seg_end"), F.explode(cuts).alias("start")).distinct()
    order = Window.partitionBy(*keys, "seg_start", "seg_end").orderBy("start")
    parts = points.withColumn("end", F.coalesce(F.lead("start").over(order) - 1, F.col("seg_end")))
    hit = parts.alias("p").join(ranges.alias("r"), [F.col(f"p.{k}") == F.col(f"r.{k}") for k in keys] + [F.col("r.start") <= F.col("p.start"), F.col("p.end") <= F.col("r.end")], "left_semi").select(*keys, "seg_start", "start").distinct().withColumn("selected", F.lit(True))
    return parts.join(hit, [*keys, "seg_start", "start"], "left").select(*keys, "seg_start", "seg_end", "start", "end", F.coalesce("selected", F.lit(False)).alias("selected"))


def not_covering(df: DataFrame, keys: list[str], ordinal: str, seg_start: str = "seg_start", seg_end: str = "seg_end") -> DataFrame:
    """Segments whose ranges, in the order given, don't run from start to end without gap or overlap: keys and the number of faults."""
    order = Window.partitionBy(*keys).orderBy(ordinal)
    expected = F.coalesce(F.lag("end").over(order) + 1, F.col(seg_start))
    last = F.lead(ordinal).over(order).isNull() & (F.col("end") != F.col(seg_end))
    fault = (F.col("start") != expected).cast("int") + last.cast("int") + (F.col("end") < F.col("start")).cast("int")
    return df.withColumn("__fault", fault).groupBy(*keys).agg(F.sum("__fault").alias("faults")).where("faults > 0")


def not_ascending(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Rows that start at or before the end of the row before them, or end before they start."""
    order = Window.partitionBy(*keys).orderBy(ordinal)
    return df.withColumn("__before", F.lag("end").over(order)).where("start <= __before or end < start").drop("__before")


def containing(points: DataFrame, ranges: DataFrame, keys: list[str], at: str = "line", value: str = "segment_id") -> DataFrame:
    """points with `found`, the sorted values of all ranges that a point lies in; an empty array where there is none."""
    r = ranges.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("start").alias("__start"), F.col("end").alias("__end"), F.col(value).alias("__value"))
    on = [F.col(k) == F.col(f"__{k}") for k in keys] + [F.col(at).between(F.col("__start"), F.col("__end"))]
    return points.join(r, on, "left").groupBy(*points.columns).agg(F.array_sort(F.collect_set("__value")).alias("found"))


def overlapping(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of ranges of a key that share a line: the columns of a, and those of b as b_*."""
    b = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns])
    return a.join(b, [F.col(k) == F.col(f"b_{k}") for k in keys] + [F.col("start") <= F.col("b_end"), F.col("b_start") <= F.col("end")])


def within_first(citations: DataFrame, segments: DataFrame, keys: list[str], value: str = "segment_id") -> DataFrame:
    """citations with `within`, the first segment by start that holds all of a citation; null where none does."""
    s = segments.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("start").alias("__start"), F.col("end").alias("__end"), F.col(value).alias("__value"))
    on = [F.col(k) == F.col(f"__{k}") for k in keys] + [F.col("__start") <= F.col("start"), F.col("end") <= F.col("__end")]
    return citations.join(s, on, "left").groupBy(*citations.columns).agg(F.min_by("__value", F.struct("__start", "__value")).alias("within"))


def rollup(disposition: Column) -> Column:
    """Aggregate: the first of PRIORITY that the group has; reviewed_no_record where it has none."""
    rank = F.array_position(F.array(*map(F.lit, PRIORITY)), disposition)
    best = F.min(F.when(rank > 0, rank))
    return F.element_at(F.array(*map(F.lit, PRIORITY)), F.coalesce(best, F.lit(len(PRIORITY))).cast("int"))


def selected_lines(ranges: DataFrame, chosen: DataFrame, lengths: DataFrame, key: str = "evidence_id", composition: str = "union") -> DataFrame:
    """Selected ranges from explicit ranges and chosen files; lengths has key and lines.

    Without ranges the chosen files count whole; without chosen files the
    ranges do; an intersection keeps ranges in chosen files, a union widens
    chosen files to all their lines. A range beyond its file's end raises.
    """
    whole = chosen.join(lengths, key).select(key, F.lit(1).alias("start"), F.col("lines").cast("int").alias("end")).where("end > 0")
    beyond = ranges.join(lengths, key, "left").where("lines is null or end > lines or start < 1 or end < start")
    if beyond.limit(1).count():
        raise ValueError(f"a range is out of its file: {beyond.first()}")
    plain = ranges.select(key, F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))
    if ranges.limit(1).count() == 0:
        return merged(whole, [key])
    if chosen.limit(1).count() == 0:
        return merged(plain, [key])
    if composition == "intersection":
        return merged(plain.join(chosen.select(key).distinct(), key, "left_semi"), [key])
    return merged(plain.unionByName(whole), [key])
