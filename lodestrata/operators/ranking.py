"""Ranked lexical lookup: all terms must hit, fields weigh, relations expand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What a hit in a field is worth.
WEIGHTS = {"aliases": 5, "title": 4, "statement": 2, "questions": 1, "events": 1}


def terms_of(text: str) -> list[str]:
    """Sorted distinct words of a query, case away."""
    return sorted(set(text.casefold().split()))


def scored(rows: DataFrame, key: str, fields: dict[str, tuple[Column, int]], terms: list[str]) -> DataFrame:
    """key, score and reasons (term, fields, points) of the rows in which every term is part of some field.

    Fields are folded columns with weights; each of a term's fields counts
    once. The terms are few and live in the expression: one scan, no join and
    no shuffle. Without terms every row scores 0.
    """
    reasons = []
    for t in terms:
        hit = [F.when(F.contains(c, F.lit(t)), F.struct(F.lit(name).alias("name"), F.lit(w).alias("weight"))) for name, (c, w) in fields.items()]
        hits = F.array_compact(F.array(*hit))
        reasons.append(F.struct(F.lit(t).alias("term"), F.transform(hits, lambda h: h["name"]).alias("fields"), F.aggregate(hits, F.lit(0), lambda a, h: a + h["weight"]).alias("points")))
    why = F.array(*reasons) if reasons else F.array().cast("array<struct<term:string,fields:array<string>,points:int>>")
    out = rows.select(key, why.alias("reasons"))
    if terms:
        out = out.where(F.forall("reasons", lambda r: r["points"] > 0))
    return out.select(key, F.aggregate("reasons", F.lit(0), lambda a, r: a + r["points"]).cast("long").alias("score"), "reasons")


def scored_batch(rows: DataFrame, key: str, fields: dict[str, tuple[Column, int]], queries: DataFrame, most: int = 10_000) -> DataFrame:
    """(query, key, score, matched terms) for a table of queries (query, terms: array): one pass over rows for all of them.

    The query table is small by contract, at most `most` terms, and broadcast;
    rows are scanned once.
    """
    if queries.select(F.explode("terms")).limit(most + 1).count() > most:
        raise ValueError(f"more than {most} terms")
    terms = queries.select("query", F.size("terms").alias("n"), F.explode("terms").alias("term"))
    points = sum((F.when(F.contains(c, F.col("term")), F.lit(w)).otherwise(0) for c, w in fields.values()), F.lit(0))
    hits = rows.crossJoin(F.broadcast(terms)).select("query", "n", key, "term", points.alias("points")).where("points > 0")
    return hits.groupBy("query", "n", key).agg(F.sum("points").cast("long").alias("score"), F.count("*").alias("found")).where("found = n").select("query", key, "score")


def best(scores: DataFrame, key: str, order: str) -> DataFrame:
    """Of several queries' scores for a key the highest; the first query wins ties."""
    return scores.groupBy(key).agg(F.max_by(F.struct(order, "score"), F.struct("score", -F.col(order))).alias("b")).select(key, f"b.{order}", "b.score")


def top(ranked: DataFrame, key: str, limit: int = 50) -> DataFrame:
    """By hops, then score, then key; a sort of the first `limit` rows only."""
    if not 1 <= limit <= 1000:
        raise ValueError("the limit is 1 to 1000")
    return ranked.orderBy(F.asc("hops"), F.desc("score"), F.asc(key)).limit(limit)


def top_counted(ranked: DataFrame, key: str, limit: int = 50) -> tuple[DataFrame, int, int]:
    """The same, with how many rows there are and how many of them are left out."""
    total = ranked.count()
    return top(ranked, key, limit), total, max(0, total - limit)


def expanded(ranked: DataFrame, edges: DataFrame, pool: DataFrame, key: str, hops: int = 2) -> DataFrame:
    """ranked (key, score) and what its rows lead to over edges (src, dst) within the pool: key, score, hops, via.

    The first hop that reaches a key counts, by the least source; at most two
    hops, so the joins are unrolled.
    """
    if not 0 <= hops <= 2:
        raise ValueError("at most two hops")
    seen = ranked.select(key, "score", F.lit(0).alias("hops"), F.lit(None).cast(dict(ranked.dtypes)[key]).alias("via"))
    frontier = seen.select(F.col(key).alias("src"))
    inside = edges.join(pool.select(F.col(key).alias("dst")), "dst", "left_semi")
    for hop in range(1, hops + 1):
        found = frontier.join(inside, "src").groupBy("dst").agg(F.min("src").alias("via")).join(seen.select(F.col(key).alias("dst")), "dst", "left_anti")
        new = found.select(F.col("dst").alias(key), F.lit(0).cast("long").alias("score"), F.lit(hop).alias("hops"), "via")
        seen, frontier = seen.unionByName(new), new.select(F.col(key).alias("src"))
    return seen


def within_budget(ranked: DataFrame, order: list[Column], size: Column, budget: int, required: Column) -> DataFrame:
    """The longest head of the ranking whose sizes sum to the budget at most; required rows may not fall off, or it raises.

    ranked has been limited to a context's few rows, so one window holds it.
    """
    total = F.sum(size).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rows = ranked.withColumn("__total", total)
    if rows.where(required & (F.col("__total") > budget)).limit(1).count():
        raise ValueError("required rows pass the budget")
    return rows.where(F.col("__total") <= budget).drop("__total")
