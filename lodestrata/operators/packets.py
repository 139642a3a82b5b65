"""Packing of numbered lines into packets of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.operators.views import running


def packets(lines: DataFrame, max_chars: int = 16_000, keys: list[str] | None = None, order: list[str] | None = None, overhead: str | int = 0, oversize: str = "raise") -> DataFrame:
    """keys, packet_no, start_line, end_line, chars and lines for each packet.

    lines has the keys (one file), line_no and text, and only selected lines.
    Consecutive lines go into a packet until the next, rendered as a numbered
    line, would pass max_chars; header and footer (`overhead`, a column or a
    number) count. A gap between lines starts a packet; a line that alone
    passes the limit raises, or, if oversize is `alone`, is a packet of its own
    beyond the limit. Packet numbers run on from file to file in the order
    given. A file's lines are folded in one array, island by island; files are
    numbered over sampled ranges.
    """
    if oversize not in ("raise", "alone"):
        raise ValueError("oversize is raise or alone")
    keys = keys or ["evidence_id"]
    head = F.col(overhead) if isinstance(overhead, str) else F.lit(overhead)
    order = order or keys
    size = F.length(F.format_string("L%06d", F.col("line_no"))) + 4 + F.length("text")
    rows = lines.select(*dict.fromkeys([*keys, *order]), F.col("line_no").cast("int").alias("line_no"), size.alias("size"), head.cast("int").alias("head"))
    over = rows.where(F.col("head") + F.col("size") > max_chars)
    if oversize == "raise" and (found := over.limit(1).collect()):
        raise ValueError(f"one line exceeds the packet budget: {found[0]}")
    by_file = Window.partitionBy(*keys).orderBy("line_no")
    island = rows.withColumn("island", F.col("line_no") - F.row_number().over(by_file))
    arrays = island.groupBy(*dict.fromkeys([*keys, *order]), "island", "head").agg(F.array_sort(F.collect_list(F.struct("line_no", "size"))).alias("ls"))
    start = F.struct(F.array().cast("array<struct<a:int,b:int,chars:int>>").alias("done"), F.lit(None).cast("int").alias("a"), F.lit(None).cast("int").alias("b"), F.lit(0).alias("chars"))

    def step(acc, x):
        full = acc["a"].isNotNull() & (acc["chars"] + x["size"] > max_chars)
        done = F.when(full, F.concat(acc["done"], F.array(F.struct(acc["a"].alias("a"), acc["b"].alias("b"), acc["chars"].alias("chars"))))).otherwise(acc["done"])
        fresh = full | acc["a"].isNull()
        return F.struct(done.alias("done"), F.when(fresh, x["line_no"]).otherwise(acc["a"]).alias("a"), x["line_no"].alias("b"), F.when(fresh, F.col("head") + x["size"]).otherwise(acc["chars"] + x["size"]).alias("chars"))

    folded = F.aggregate("ls", start, step, lambda acc: F.concat(acc["done"], F.array(F.struct(acc["a"].alias("a"), acc["b"].alias("b"), acc["chars"].alias("chars")))))
    cut = arrays.select(*dict.fromkeys([*keys, *order]), F.explode(folded).alias("p")).select(*dict.fromkeys([*keys, *order]), F.col("p.a").alias("start_line"), F.col("p.b").alias("end_line"), F.col("p.chars").alias("chars"))
    counts = cut.groupBy(*dict.fromkeys([*keys, *order])).agg(F.count("*").alias("__n"))
    before = running(counts, list(order), "__n", "__before").select(*keys, "__before")
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("start_line"))
    return cut.withColumn("__nth", nth).join(before, keys).select(*keys, (F.col("__before") + F.col("__nth")).cast("long").alias("packet_no"), "start_line", "end_line", "chars")
