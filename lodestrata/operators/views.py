"""Derived views: orders, timelines, groupings and documents made of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.text import escaped_markdown, mermaid_label
from lodestrata.operators.coverage import sorted_set


def placed(df: DataFrame, order: list[Column], into: str = "place") -> DataFrame:
    """df with each row's place from 1 in a total order.

    A single ordered window would bring all rows to one task. Rows are dealt
    by sampled ranges instead, numbered within their partition, and shifted by
    the counts of the partitions before. The frame is written on the way.
    """
    from lodestrata.session import written

    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    t = written(ranged.withColumn("__pid", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id()), "placed")
    counts = t.groupBy("__pid").agg(F.count("*").alias("__n"), F.min("__row").alias("__first"))  # a row a partition
    before = counts.select("__pid", "__first", F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return t.join(before, "__pid").select(*df.columns, (F.col("__row") - F.col("__first") + F.col("__before") + 1).alias(into))


def running(df: DataFrame, order: list[str], value: str, into: str) -> DataFrame:
    """df with the sum of `value` over all rows before each in a total order, made like `placed`."""
    from lodestrata.session import written

    ranged = df.repartitionByRange(*order).withColumn("__pid", F.spark_partition_id())
    t = written(ranged, "running")
    sums = t.groupBy("__pid").agg(F.sum(value).alias("__sum"))  # a row a partition
    starts = sums.select("__pid", F.coalesce(F.sum("__sum").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__start"))
    inside = F.coalesce(F.sum(value).over(Window.partitionBy("__pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return t.withColumn("__inside", inside).join(starts, "__pid").select(*df.columns, (F.col("__start") + F.col("__inside")).alias(into))


def timeline(events: DataFrame) -> DataFrame:
    """events (event_id, record_id, status, sort_ts, text) in their groups: dated ones by instant, then unknown, then conflicting ones; ties by ids and text."""
    group = F.when(F.col("status").isin("known", "approximate"), 0).when(F.col("status") == "unknown", 1).otherwise(2)
    order = ["grp", F.asc_nulls_last("sort_ts"), "event_id", "record_id", "text"]
    return placed(events.withColumn("grp", group), [F.col(c) if isinstance(c, str) else c for c in order]).drop("grp")


def open_questions(records: DataFrame) -> DataFrame:
    """(record_id, question) of each open question; an uncertainty without any asks its statement."""
    fallback = F.when((F.size("open_questions") == 0) & (F.col("kind") == "uncertainty"), F.array("statement")).otherwise(F.col("open_questions"))
    return records.select("record_id", F.explode(fallback).alias("question"))


def outbox(referrals: DataFrame, target: str = "target") -> DataFrame:
    """target, how many referrals, and their sorted ids."""
    return referrals.groupBy(target).agg(F.count("*").alias("n"), sorted_set("referral_id").alias("referral_ids"))


def pages(rows: DataFrame, group: list[str], order: str, line: Column, size: int = 1000) -> DataFrame:
    """Markdown pages of at most `size` lines: group, page (from 1) and text. Lines are placed over sampled ranges, so that a large group is many pages and no single task's work."""
    from lodestrata.session import written

    rows = rows.select(*group, F.col(order).alias("__o"), line.alias("__l"))
    at = placed(rows, [F.asc_nulls_first(g) for g in group] + [F.asc("__o"), F.asc("__l")], "__place")
    at = written(at, "pages")
    first = at.groupBy(*group).agg(F.min("__place").alias("__first"))
    same = at.join(first.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], "__first"), [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group)])
    number = F.expr(f"(__place - __first) div {size} + 1").cast("int")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__place", "__l"))), lambda x: x["__l"]), "\n")
    return same.groupBy(*group, number.alias("page")).agg(text.alias("text"))


def page(rows: DataFrame, group: list[str], order: str, line: Column) -> DataFrame:
    """A Markdown page for each group: its lines in order. A page holds one group's rows, which its reader reads as one text; `pages` bounds them."""
    return rows.select(*group, F.struct(F.col(order).alias("o"), line.alias("l")).alias("x")).groupBy(*group).agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["l"]), "\n").alias("page"))


def record_line(id_: Column, title: Column, status: Column) -> Column:
    return F.concat(F.lit("- **"), id_, F.lit("** "), escaped_markdown(title), F.lit(" ("), status, F.lit(")"))


def diagram(edges: DataFrame, src: str = "src", dst: str = "dst", kind: str = "type") -> DataFrame:
    """Lines of a flow chart, a row an edge."""
    return edges.select(F.concat(F.col(src), F.lit(' -->|"'), mermaid_label(F.col(kind)), F.lit('"| '), F.col(dst)).alias("line"))


def record_changes(old: DataFrame, new: DataFrame, fields: list[str], key: str = "record_id") -> DataFrame:
    """key, change (added, removed, changed or retained) and the fields that changed."""
    a = old.select(F.col(key).alias("o_key"), *[F.col(f).alias(f"o_{f}") for f in fields])
    diff = F.array_compact(F.array(*[F.when(~F.col(f"o_{f}").eqNullSafe(F.col(f)), F.lit(f)) for f in sorted(fields)]))
    both = a.join(new.select(key, *fields), F.col("o_key") == F.col(key), "full_outer")
    change = F.when(F.col("o_key").isNull(), "added").when(F.col(key).isNull(), "removed").when(F.size(diff) > 0, "changed").otherwise("retained")
    return both.select(F.coalesce(key, "o_key").alias(key), change.alias("change"), F.when(change == "changed", diff).otherwise(F.array().cast("array<string>")).alias("fields"))


def coverage_stub(files: DataFrame, chosen: DataFrame, method: str, key: str = "evidence_id") -> DataFrame:
    """A first declaration for each file: chosen ones are deferred, others triaged out by the method."""
    c = chosen.select(key).distinct().withColumn("__in", F.lit(True))
    here = F.col("__in").isNotNull()
    return files.select(key).join(c, key, "left").select(key, F.when(here, "deferred").otherwise("triaged_out").alias("disposition"), F.when(~here, F.lit(method)).alias("method"))
