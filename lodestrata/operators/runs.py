"""Staged runs with receipts: a stage runs again unless its receipt still holds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestrata.functions.identity import digest_of
from lodestrata.sources import sinks

Stage = tuple[str, Callable[[SparkSession, dict[str, DataFrame]], DataFrame]]


def receipts(spark: SparkSession, root: str) -> dict[str, dict]:
    known = sinks.pointed(spark, f"{root}/RECEIPTS")
    return {r["stage"]: r for r in known["receipts"]} if known else {}


def run(spark: SparkSession, root: str, inputs: dict[str, DataFrame], stages: list[Stage]) -> tuple[dict[str, DataFrame], list[str]]:
    """The tables of all stages, and the names of the stages that ran.

    A stage sees the inputs and all earlier stages' tables. Its receipt binds
    the digests of what it saw and of what it made; the longest head of stages
    whose receipts hold, outputs included, is taken over, and all that follow
    run and write new tables. Earlier tables are never overwritten. A table is
    written aside and put in place in one step, so that one that is there is
    whole, and the receipts are one small file that is replaced in one step.
    """
    known = receipts(spark, root)
    tables, ran, resumed = dict(inputs), [], True
    seen = {k: sinks.digest(v) for k, v in sorted(inputs.items())}
    for n, (name, stage) in enumerate(stages):
        need = digest_of([name, seen])
        old = known.get(name)
        if resumed and old and old["inputs"] == need and sinks.exists(spark, old["path"]):
            df = spark.read.parquet(old["path"])
            if sinks.digest(df) == old["output"]:
                tables[name], seen = df, seen | {name: old["output"]}
                continue
        resumed = False
        folder = f"{name}-{digest_of([need, len(ran)])[:16]}"
        path = f"{root}/tables/{folder}/table"
        if not sinks.exists(spark, f"{root}/tables/{folder}"):
            sinks.commit({"table": stage(spark, tables)}, f"{root}/tables", folder)
        df = spark.read.parquet(path)
        out = sinks.digest(df)
        known[name] = {"stage": name, "ordinal": n, "inputs": need, "output": out, "path": path}
        sinks.point(spark, f"{root}/RECEIPTS", {"receipts": [known[s] for s, _ in stages[: n + 1] if s in known]})
        tables[name], seen = df, seen | {name: out}
        ran.append(name)
    return tables, ran
