"""Graph operators over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.session import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component) for each node on an edge; component is the smallest node reachable.

    Alternating large-star and small-star rounds: each round links every node
    to the least neighbour known so far, which needs O(log n) rounds also on
    long chains. Each round's edges are written to the shared folder, so the
    lineage stays short; the driver sees one count and one checksum a round.
    Loops and repeated edges are harmless, edges with a null end are ignored.
    """
    pair = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    nodes_alone = pair.where("u = v").select("u")
    e = written(pair.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    found = e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
    alone = nodes_alone.distinct().select(F.col("u").alias("node"), F.col("u").alias("component"))
    return found.unionByName(alone).groupBy("node").agg(F.min("component").alias("component"))


def reachable_cycles(edges: DataFrame, src: str = "src", dst: str = "dst", rounds: int = 40) -> DataFrame:
    """Edges that lie on a cycle: whose target reaches their source again.

    Nodes that no cycle passes are peeled off first, those without a way in
    or out, many at a time by pointer doubling: each node that has one way out
    jumps along it, which halves long chains each round. On what is left the
    closure grows by doubling, with pairs kept distinct.
    """
    e = written(edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where("src is not null and dst is not null").distinct(), "edges")
    core = _core(e, rounds * 50)
    paths = written(core, "paths")
    n = paths.count()
    for _ in range(rounds):
        a, b = paths.alias("a"), paths.alias("b")
        longer = a.join(b, F.col("a.dst") == F.col("b.src")).select(F.col("a.src").alias("src"), F.col("b.dst").alias("dst"))
        paths = written(paths.unionByName(longer).distinct(), "paths")
        now = paths.count()
        if now == n:
            break
        n = now
    else:
        raise RuntimeError("the closure did not settle")
    back = paths.select(F.col("src").alias("dst"), F.col("dst").alias("src"))
    return e.join(back, ["src", "dst"], "left_semi")


def _core(e: DataFrame, rounds: int) -> DataFrame:
    """Edges between nodes that have a way in and a way out that never ends: no others can be on a cycle.

    A node's longest way out is found by doubling over functional steps: each
    node points to its least successor, and pointers double until they end at
    a sink or never do. Only nodes with a single successor are settled this
    way; the rest is peeled round by round.
    """
    one = e.groupBy("src").agg(F.min("dst").alias("to"), F.count("*").alias("n"))
    jump = written(one.where("n = 1").select("src", "to"), "jump")
    for _ in range(32):  # 2^32 steps
        j = jump.alias("j")
        k = jump.select(F.col("src").alias("mid"), F.col("to").alias("next"))
        new = written(j.join(k, F.col("to") == F.col("mid"), "left").select("src", F.coalesce("next", "to").alias("to")), "jump")
        moved = new.join(jump.select("src", F.col("to").alias("was")), "src").where("to <> was").limit(1).count()
        jump = new
        if not moved:
            break
    sinks = e.select(F.col("dst").alias("node")).distinct().join(e.select(F.col("src").alias("node")), "node", "left_anti")
    dead = jump.join(sinks, F.col("to") == F.col("node"), "left_semi").select("src")
    left = written(e.join(dead, "src", "left_anti"), "core")
    n = left.count()
    for _ in range(rounds):
        outs, ins = left.select(F.col("src").alias("dst")).distinct(), left.select(F.col("dst").alias("src")).distinct()
        left = written(left.join(outs, "dst", "left_semi").join(ins, "src", "left_semi"), "core")
        now = left.count()
        if now in (n, 0):
            return left
        n = now
    return left


def opposing(assertions: DataFrame, owner: str = "owner", target: str = "target", kind: str = "type") -> DataFrame:
    """Pairs of nodes that assertions of different types connect: lo, hi and the sorted types."""
    pair = assertions.select(F.least(owner, target).alias("lo"), F.greatest(owner, target).alias("hi"), kind)
    return pair.groupBy("lo", "hi").agg(F.array_sort(F.collect_set(kind)).alias("types")).where("size(types) > 1")


def target_state(assertions: DataFrame, entries: DataFrame, target: str = "target", key: str = "key", visibility: str = "visibility") -> DataFrame:
    """assertions with `target_state`: unavailable, current or historical."""
    e = entries.select(F.col(key).alias("__key"), F.col(visibility).alias("__state"))
    return assertions.join(e, F.col(target) == F.col("__key"), "left").withColumn("target_state", F.coalesce("__state", F.lit("unavailable"))).drop("__key", "__state")
