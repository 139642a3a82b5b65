"""Sinks: create-only writes, versions behind a pointer, append-only logs."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def create(df: DataFrame, path: str, *partitions: str) -> None:
    """A table that must not be there yet."""
    df.write.mode("errorifexists").partitionBy(*partitions).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def digest(df: DataFrame) -> str:
    """A digest of a table's rows, their columns and nulls, that does not depend on their order: made from sums over four parts of each row's SHA-256."""
    cols = sorted(df.columns)
    # In JSON every value has its name, so a null is no gap that another column could fill.
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]), {"ignoreNullFields": "false"})
    h = df.select(F.sha2(row, 256).alias("h"))
    part = lambda i: F.sum(F.conv(F.substring("h", 16 * i + 1, 16), 16, 10).cast("decimal(38,0)"))
    r = h.agg(F.count("*"), *[part(i) for i in range(4)]).first()
    return hashlib.sha256(json.dumps([cols, [str(x or 0) for x in r]]).encode()).hexdigest()


def commit(tables: dict[str, DataFrame], root: str, name: str) -> str:
    """Several tables at once: written aside, then renamed together; a failure leaves nothing behind."""
    spark = next(iter(tables.values())).sparkSession
    target, aside = f"{root}/{name}", f"{root}/.tmp-{uuid.uuid4().hex}"
    if exists(spark, target):
        raise FileExistsError(target)
    fs, _ = _fs(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    try:
        for t, df in tables.items():
            df.write.parquet(f"{aside}/{t}")
        if not fs.rename(path(aside), path(target)):
            raise OSError(f"{target} could not be put in place")
    except BaseException:
        fs.delete(path(aside), True)
        raise
    return target


def point(spark: SparkSession, pointer: str, value: dict) -> None:
    """Replace a small pointer file in one step."""
    fs, p = _fs(spark, pointer)
    path = spark._jvm.org.apache.hadoop.fs.Path
    aside = path(f"{pointer}.{uuid.uuid4().hex}")
    out = fs.create(aside)
    out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(aside), fs.makeQualified(p), options)


def pointed(spark: SparkSession, pointer: str) -> dict | None:
    if not exists(spark, pointer):
        return None
    return json.loads(spark.read.text(pointer, wholetext=True).first()[0])


def publish(df: DataFrame, root: str, run_id: str, at: str) -> None:
    """A release: a version of its own, then the log, then the pointer, in this order."""
    spark = df.sparkSession
    path = commit({"release": df}, root, run_id)
    spark.createDataFrame([(run_id, at, digest(df))], "run_id string, at string, digest string").coalesce(1).write.mode("append").json(f"{root}/publications")
    point(spark, f"{root}/CURRENT", {"run_id": run_id, "path": path})


def rebuilt(df: DataFrame, root: str) -> bool:
    """Write a derived table under its digest and point to it; equal rows write nothing. Returns whether it wrote."""
    spark = df.sparkSession
    name = "IDX-" + uuid.uuid5(uuid.NAMESPACE_OID, digest(df)).hex[:24]
    now = pointed(spark, f"{root}/CURRENT") if exists(spark, root) else None
    if now and now["run_id"] == name:
        return False
    if not exists(spark, f"{root}/{name}"):
        commit({"index": df}, root, name)
    point(spark, f"{root}/CURRENT", {"run_id": name, "path": f"{root}/{name}"})
    return True
