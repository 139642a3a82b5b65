"""What the corpus operators share."""

from __future__ import annotations

import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata import batches
from lodestrata.batches import BATCH_BYTES, BATCH_ROWS, RELEASE_BYTES, released, small_batches  # noqa: F401
from lodestrata.session import written

#: The white space of the word definition, as a regular expression.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_column(name: str = "text") -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def in_batches(df: DataFrame, make: Callable, schema, ends: bool = False) -> DataFrame:
    return batches.in_batches(df, make, schema, ends, lambda: released())


_RESIDENT: dict = {}


def resident(key: tuple, build: Callable):
    """What build() makes, kept by the worker process for later tasks that ask for the same; one thing at a time."""
    if key not in _RESIDENT:
        _RESIDENT.clear()
        gc.unfreeze()
        gc.collect()
        released()
        _RESIDENT[key] = build()
        gc.freeze()  # large tables that stay
    return _RESIDENT[key]


def arrow_schema(**kinds: str) -> tuple[str, pa.Schema]:
    """The same columns for Spark and for Arrow."""
    known = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return ", ".join(f"`{k}` {v}" for k, v in kinds.items()), pa.schema([(k, known[v]) for k, v in kinds.items()])


def numbered(df: DataFrame, groups: list[str], order: list[str], into: str = "slot") -> DataFrame:
    """Gapless numbers from 0 within each group, in the given order; equal rows in any order.

    A group may hold most of the rows: rows are dealt by sampled ranges of
    (groups, order), each partition numbers its own, and offsets come from one
    count a partition and group. The frame is written once on the way.
    """
    pid, row, n, first, other, before_ = fresh(df, "__pid", "__row", "__n", "__first", "__p", "__before")
    g_ = fresh(df, *[f"__g{i}" for i in range(len(groups))])
    keys = [*groups, *order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    t = written(ranged.withColumn(pid, F.spark_partition_id()).withColumn(row, F.monotonically_increasing_id()), "numbered")
    counts = t.groupBy(*groups, pid).agg(F.count("*").alias(n), F.min(row).alias(first))
    before = Window.partitionBy(*groups).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(g).alias(x) for x, g in zip(g_, groups, strict=True)], F.col(pid).alias(other), first, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(before_))
    same = F.col(pid) == F.col(other)
    for x, g in zip(g_, groups, strict=True):
        same = same & F.col(g).eqNullSafe(F.col(x))
    joined = t.join(starts, same)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(row) - F.col(first) + F.col(before_)).alias(into))


def hashed_share(h: Column, rows: int, total: int) -> Column:
    """Whether a uniform 64-bit hash lies in a share of its range that holds about `rows` of `total` rows, and a little more.

    A fit's bounded sample takes the rows of least hash; this keeps all others
    from being sent to where the least are found.
    """
    if total <= 2 * rows:
        return F.lit(True)
    return h < F.lit(-(1 << 63) + int((1 << 64) * min(1.0, (1.1 * rows + 100) / total)))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like those given that no column of df has, whatever its case."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out


#: Bits of the set that `likely` broadcasts, as a power of two: 2 MB, whatever the data's size.
LIKELY_BITS = 24


def likely(df: DataFrame, key: Column, keys: DataFrame, into: str) -> DataFrame:
    """df with a boolean `into`: false only where the hash `key` is surely not among the hashes in the one column of keys.

    A set of a fixed number of bits goes to all tasks; the fuller it gets, the
    more rows are called likely, so that what follows must not rely on it.
    """
    bit = lambda c: F.pmod(c, F.lit(1 << LIKELY_BITS))
    word, mask = fresh(df, "__word", "__mask")
    b = bit(F.col(keys.columns[0]))
    words = keys.select(F.shiftright(b, 6).alias(word), F.call_function("shiftleft", F.lit(1).cast("long"), b.bitwiseAND(F.lit(63)).cast("int")).alias(mask)).groupBy(word).agg(F.bit_or(mask).alias(mask))
    at = fresh(df, "__at")[0]
    out = df.withColumn(at, bit(key))
    joined = out.join(F.broadcast(words), F.shiftright(F.col(at), 6) == F.col(word), "left")  # at most 2^(LIKELY_BITS - 6) rows
    there = F.call_function("shiftright", F.coalesce(F.col(mask), F.lit(0).cast("long")), F.col(at).bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(there, F.lit(False)).alias(into))


def bit_set(keys: DataFrame) -> bytes:
    """The same set as bytes for Python workers: bit h mod 2^LIKELY_BITS for each hash in the one column of keys."""
    import numpy as np

    bit = F.pmod(F.col(keys.columns[0]), F.lit(1 << LIKELY_BITS))
    word = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))
    out = np.zeros(1 << (LIKELY_BITS - 6), np.int64)
    for at, mask in keys.select(F.shiftright(bit, 6).alias("at"), word.alias("m")).groupBy("at").agg(F.bit_or("m")).collect():  # at most 2^(LIKELY_BITS - 6) rows
        out[at] = mask
    return out.tobytes()
