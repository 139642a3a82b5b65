"""Completeness of declarations, dispositions and other small aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.identity import json_array


def faults(declared: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """(key, fault): missing, unknown or duplicate declarations. Each expected key is to be declared once."""
    missing = expected.select(key).distinct().join(declared.select(key), key, "left_anti").select(key, F.lit("missing").alias("fault"))
    unknown = declared.select(key).distinct().join(expected.select(key), key, "left_anti").select(key, F.lit("unknown").alias("fault"))
    twice = declared.groupBy(key).count().where("count > 1").select(key, F.lit("duplicate").alias("fault"))
    return missing.unionByName(unknown).unionByName(twice)


def edge_faults(edges: DataFrame, nodes: DataFrame, src: str = "src", kind: str = "type", dst: str = "dst", node: str = "id") -> DataFrame:
    """(src, type, dst, fault): an edge to nowhere, to itself, or twice."""
    e = edges.select(F.col(src).alias("src"), F.col(kind).alias("type"), F.col(dst).alias("dst"))
    dangling = e.join(nodes.select(F.col(node).alias("dst")), "dst", "left_anti").select("src", "type", "dst", F.lit("dangling").alias("fault"))
    own = e.where("src = dst").select("src", "type", "dst", F.lit("self").alias("fault"))
    twice = e.groupBy("src", "type", "dst").count().where("count > 1").select("src", "type", "dst", F.lit("duplicate").alias("fault"))
    return dangling.unionByName(own).unionByName(twice)


def warning_summary(issues: DataFrame) -> DataFrame:
    """code, n and a digest of the sorted (code, source, path) triples; nulls count as empty."""
    e = lambda c: F.coalesce(F.col(c), F.lit(""))
    triple = json_array(e("code"), e("source_id"), e("path"))
    # The digest needs all triples of a code in one value: issues are bounded by the capture's caps.
    items = F.transform(F.array_sort(F.collect_list(F.struct(e("code").alias("c"), e("source_id").alias("s"), e("path").alias("p"), triple.alias("t")))), lambda x: x["t"])
    return issues.groupBy("code").agg(F.count("*").alias("n"), F.sha2(F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")), 256).alias("digest"))


def counts(df: DataFrame, value: str, group: list[str] | None = None) -> DataFrame:
    """A map from value to count for each group."""
    by = group or []
    c = df.groupBy(*by, value).count()
    return c.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(value, "count")))).alias("counts"))


def sorted_set(c: Column | str) -> Column:
    return F.array_sort(F.collect_set(c))


def code_index(texts: DataFrame, pattern: str, key: str, text: str = "text") -> DataFrame:
    """code and the sorted keys of texts that hold it."""
    found = texts.select(key, F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?U){pattern}"), F.lit(0)))).alias("code"))
    return found.groupBy("code").agg(sorted_set(key).alias("keys"))


# Codes of requirements and stories.
CODES = r"\b(?:RNF|RF|US|HU)-?[0-9]{1,6}\b"


def milestone(df: DataFrame, group: str, kind: str, kinds: list[str], related: Column) -> DataFrame:
    """group, the kinds it lacks and whether it has any relation; told, never a gate."""
    have = F.collect_set(kind)
    return df.groupBy(group).agg(F.array_sort(F.array_except(F.array(*map(F.lit, kinds)), have)).alias("missing"), F.bool_or(related).alias("has_relation"))


def fidelity(df: DataFrame, group: str, status: str = "status") -> DataFrame:
    """group, declared, matched and their ratio; null where nothing was declared."""
    n, m = F.count(status), F.count_if(F.col(status) == "match")
    return df.groupBy(group).agg(n.alias("declared"), m.alias("matched"), F.when(n > 0, m / n).alias("match_fraction"))


def capped(df: DataFrame, most: int, what: str = "rows") -> DataFrame:
    """df, or an error if it has more than `most` rows: a cap never truncates."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} {what}")
    return df
