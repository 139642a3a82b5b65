"""Sharding by a k-d tree over metadata.

The space of metadata columns is split again and again at weighted medians
along the dimension that is widest in the node, until the leaves reach the
target bytes. A median is found on all rows of all nodes of a level at once:
rows are counted by (node, bin) with sums of bytes made in each task, the bin
in which a node reaches its share is divided further, and after a few rounds
the cut is exact to one key. Keys are the rank of a dimension's whole value
among all values, of any type that Spark can order, followed by a hash of the
row, so that a hot value (a source with a third of all rows, a group of copies,
rows that repeat) is divided as well. A dimension's width in a node is the
range of its values there as a share of their range over all rows; text has no
distances and counts by its ranks. The driver sees at most NODES * BINS sums a
round.

Law: `bytes`. Shards differ by about one document's size for each split.

Cases: null texts count as none and weigh one byte; a null in a dimension
sorts first; a null doc_id sorts by its text's hash; repeated rows are rows of
their own; a very long text is one row of its size; an empty table gives no
rows; further columns, whatever their names, are ignored by `sharded` and
carried by `write_shards`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.common import fresh, numbered, table, text_column
from lodestrata.session import written

#: Bins of a node's keys in a round, as a power of two.
BIN_BITS = 12
#: Bits of a value's rank and of the hash behind it; ranks that need more lose their last bits, which the hash then stands for.
VALUE_BITS, HASH_BITS = 31, 31
#: A cut this near to its share, as a part of a leaf, is not made finer.
NEAR = 1e-4
#: Leaves at most, which bounds what the driver holds.
NODES = 4096


NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz", "boolean")


def _width_value(name: str, kind: str) -> Column:
    """A value as a number whose distances count; null for text and other types."""
    if kind in ("date",):
        return F.unix_date(name).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double") if kind in NUMERIC or kind.startswith("decimal") else F.lit(None).cast("double")


def _prepared(docs: DataFrame, dimensions: list[str]) -> DataFrame:
    """A small row for each row of docs, written once: what the tree needs, without the text. k0, k1 and so on are keys, w0, w1 and so on what widths are measured by."""
    kinds = dict(docs.dtypes)
    text = text_column()
    size = (F.octet_length(text) + 1).cast("long")
    tie = F.shiftright(F.xxhash64(F.col("doc_id"), text, F.monotonically_increasing_id()), 64 - HASH_BITS).bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    rows = docs.select(F.col("doc_id"), size.alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), tie.alias("tie"), *[F.col(f"`{d}`").alias(f"d{i}") for i, d in enumerate(dimensions)])
    rows = written(rows, "rows")
    for i, d in enumerate(dimensions):
        values = rows.select(F.col(f"d{i}").alias("v")).where("v is not null").distinct()
        ranks = written(numbered(values, [], ["v"], "rank"), "ranks")
        shift = max(0, int(ranks.count()).bit_length() - VALUE_BITS)
        rank = F.coalesce(F.shiftright(F.col("rank") + 1, shift), F.lit(0)).cast("long")
        width = _width_value(f"d{i}", kinds[d])
        rows = rows.join(ranks, F.col(f"d{i}") == F.col("v"), "left").select("*", F.shiftleft(rank, HASH_BITS).bitwiseOR(F.col("tie")).alias(f"k{i}"), (width if kinds[d] in NUMERIC or kinds[d].startswith("decimal") else rank.cast("double")).alias(f"w{i}")).drop("v", "rank")
    return written(rows.drop("tie", *[f"d{i}" for i in range(len(dimensions))]), "shards")


def _array(values: list[int | None]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def plan(rows: DataFrame, n_dims: int, shards: int | None, target: int | None) -> list[dict]:
    """The tree: nodes with `dim` and `cut` (keys below go left), or leaves with `shard`. Children come after their parents."""
    keys, widths = [f"k{i}" for i in range(n_dims)], [f"w{i}" for i in range(n_dims)]
    total = rows.agg(F.sum("size")).first()[0] or 0
    leaves = shards or max(1, -(-total // max(1, target)))
    if leaves > NODES:
        raise ValueError(f"at most {NODES} leaves")
    tree: list[dict] = [{"leaves": leaves, "bytes": total}]
    level = [0]
    while level := [i for i in level if tree[i]["leaves"] > 1]:
        placed = with_node(rows, tree, n_dims).select("size", *keys, *widths, "node").where(F.col("node").isin(level))
        spread = {r.node: r for r in placed.groupBy("node").agg(*[f(k).alias(f"{n}_{k}") for k in [*keys, *widths] for n, f in (("lo", F.min), ("hi", F.max))]).collect()}
        for i in level:
            if r := spread.get(i):
                ranges = [(r[f"hi_{w}"] or 0.0) - (r[f"lo_{w}"] or 0.0) for w in widths]
                whole = tree[0].setdefault("ranges", ranges)
                best = keys[max(range(n_dims), key=lambda i: ranges[i] / whole[i] if whole[i] > 0 else 0.0)]
                tree[i] |= {"dim": keys.index(best), "lo": r[f"lo_{best}"], "hi": r[f"hi_{best}"] + 1, "below": 0}
            else:
                tree[i] |= {"dim": 0, "lo": 0, "hi": 1, "below": 0}
            tree[i]["share"] = tree[i]["bytes"] * (tree[i]["leaves"] // 2) / tree[i]["leaves"]
        open_nodes = [i for i in level if tree[i]["hi"] - tree[i]["lo"] > 1]
        while open_nodes:
            size = max(open_nodes) + 1
            width = {i: max(1, -(-(tree[i]["hi"] - tree[i]["lo"]) >> BIN_BITS)) for i in open_nodes}
            get = lambda what: F.try_element_at(_array([what(i) if i in width else None for i in range(size)]), (F.col("node") + 1).cast("int"))
            key = F.try_element_at(F.array(*map(F.col, keys)), F.try_element_at(_array([tree[i].get("dim", 0) + 1 for i in range(size)]), (F.col("node") + 1).cast("int")).cast("int"))
            inside = placed.where(F.col("node").isin(open_nodes)).withColumn("key", key).withColumn("lo", get(lambda i: tree[i]["lo"])).withColumn("hi", get(lambda i: tree[i]["hi"])).withColumn("w", get(lambda i: width[i])).where("key >= lo and key < hi")
            sums: dict[int, list] = {i: [] for i in open_nodes}
            for r in inside.groupBy("node", F.expr("(key - lo) div w").alias("bin")).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect():
                sums[r.node].append((r.bin, r.bytes, r.rows))
            still = []
            for i in open_nodes:
                n = tree[i]
                for b, w, rows_in in sorted(sums[i]):
                    if n["below"] + w > n["share"]:
                        lo = n["lo"] + b * width[i]
                        n["lo"], n["hi"] = lo, min(n["hi"], lo + width[i])
                        if n["hi"] - n["lo"] > 1 and rows_in > 1 and w > NEAR * total / leaves:
                            still.append(i)
                        elif n["share"] - n["below"] > w / 2:  # the last bin goes to the nearer side
                            n["below"] += w
                            n["lo"] = n["hi"]
                        break
                    n["below"] += w
                else:
                    n["lo"] = n["hi"]
            open_nodes = still
        below = level
        level = []
        for i in below:
            n = tree[i]
            left = n["leaves"] // 2
            n |= {"cut": n["lo"], "left": len(tree), "right": len(tree) + 1}
            tree += [{"leaves": left, "bytes": n["below"]}, {"leaves": n["leaves"] - left, "bytes": n["bytes"] - n["below"]}]
            level += [n["left"], n["right"]]
    order, todo = 0, [0]
    while todo:
        n = tree[i := todo.pop()]
        if "left" in n:
            todo += [n["right"], n["left"]]
        else:
            tree[i]["shard"], order = order, order + 1
    return tree


def with_node(rows: DataFrame, tree: list[dict], n_dims: int) -> DataFrame:
    """rows with the `node` that each lies in: a step a level, each a lookup in arrays of the tree."""
    depth, level = 0, [0]
    while level := [c for i in level for c in ((tree[i]["left"], tree[i]["right"]) if "left" in tree[i] else ())]:
        depth += 1
    keys = F.array(*[F.col(f"k{i}") for i in range(n_dims)])
    dim, cut, left, right = (_array([n.get(k, d) for n in tree]) for k, d in (("dim", 0), ("cut", None), ("left", None), ("right", None)))
    rows = rows.withColumn("node", F.lit(0).cast("long"))
    for _ in range(depth):  # a projection each, so that expressions don't nest
        at = (F.col("node") + 1).cast("int")
        below = F.try_element_at(keys, (F.try_element_at(dim, at) + 1).cast("int")) < F.try_element_at(cut, at)
        rows = rows.withColumn("node", F.coalesce(F.when(below, F.try_element_at(left, at)).otherwise(F.try_element_at(right, at)), F.col("node")))
    return rows


def sharded(docs: DataFrame, shards: int | None = None, target: int | None = None, dimensions: tuple[str, ...] = ("n_chars", "source", "lang")) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in doc_id order) for each row; either so many shards or leaves of about target bytes."""
    rows = _prepared(docs, list(dimensions))
    tree = plan(rows, len(dimensions), shards, target)
    shard = F.try_element_at(F.array(*[F.lit(n.get("shard", -1)) for n in tree]), (F.col("node") + 1).cast("int"))
    return numbered(with_node(rows, tree, len(dimensions)).select("doc_id", "size", "text_crc32", shard.alias("shard")), ["shard"], ["doc_id", "text_crc32", "size"])


def write_shards(docs: DataFrame, path: str, **how) -> None:
    """docs as Parquet, a folder shard=N for each shard, with all their columns."""
    text = text_column()
    ident, crc, size, shard = fresh(docs, "__id", "__crc", "__size", "shard")
    placed = sharded(docs, **how).groupBy("doc_id", "text_crc32", "size").agg(F.min("shard").alias(shard)).toDF(ident, crc, size, shard)
    placed = written(placed, "placed")
    same = F.col("doc_id").eqNullSafe(F.col(ident)) & (F.crc32(F.encode(text, "utf-8")) == F.col(crc)) & (F.octet_length(text) + 1 == F.col(size))
    docs.join(placed, same).drop(ident, crc, size).write.partitionBy(shard).parquet(path)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sharded(table(spark, sf_dir, "documents"), shards=16)
    return s.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
