"""A ledger of items that are observed again and again."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def discovered(ledger: DataFrame, visible: DataFrame, key: str = "item_id") -> DataFrame:
    """The next state of every item: key, status, digest and `observed`, whether an observation is to be appended.

    ledger has key, status, digest and family; visible has key, digest, family,
    current (bool) and authorised (bool). An item that is no longer seen is
    unavailable; one that may not be seen any more is unauthorized; one whose
    release is not current is superseded where a later item of its family is,
    else withdrawn; one that changed is stale until it is observed anew.
    """
    old = ledger.select(F.col(key).alias("o_key"), F.col("status").alias("o_status"), F.col("digest").alias("o_digest"))
    alive = visible.where("current and authorised").select(F.col("family").alias("a_family")).distinct()
    new = visible.join(alive, F.col("family") == F.col("a_family"), "left")
    both = old.join(new, F.col("o_key") == F.col(key), "full_outer")
    status = (
        F.when(F.col(key).isNull(), "unavailable")
        .when(~F.col("authorised"), "unauthorized")
        .when(~F.col("current") & F.col("a_family").isNotNull(), "superseded")
        .when(~F.col("current"), "withdrawn")
        .when(F.col("o_digest").isNotNull() & (F.col("o_digest") != F.col("digest")), "stale")
        .otherwise("current")
    )
    out = both.select(F.coalesce(key, "o_key").alias(key), status.alias("status"), F.coalesce("digest", "o_digest").alias("digest"), "o_status", "o_digest")
    return out.select(key, "status", "digest", (F.col("o_status").isNull() | (F.col("o_status") != F.col("status")) | ~F.col("o_digest").eqNullSafe(F.col("digest"))).alias("observed"))


def slowly_changing(observations: DataFrame, key: str, value: str, at: str) -> DataFrame:
    """Versions of each key: value, valid_from and valid_to (null while it holds); equal values in a row are one version."""
    order = Window.partitionBy(key).orderBy(at)
    changed = observations.withColumn("__was", F.lag(F.struct(value)).over(order)).where(F.col("__was").isNull() | ~F.col("__was")[value].eqNullSafe(F.col(value)))
    return changed.select(key, value, F.col(at).alias("valid_from"), F.lead(at).over(order).alias("valid_to"))


def last_decision(decisions: DataFrame, item: str, at: list[str], fields: list[str]) -> DataFrame:
    """The latest decision of each item; exact repeats count once."""
    d = decisions.dropDuplicates([item, *at, *fields])
    return d.groupBy(item).agg(F.max_by(F.struct(*fields), F.struct(*at)).alias("d"), F.count("*").alias("decisions")).select(item, "d.*", "decisions")


def predecessor(items: DataFrame, family: str, ordinal: str, key: str) -> DataFrame:
    """items with `previous`, the item of the same family before it in the ledger."""
    return items.withColumn("previous", F.lag(key).over(Window.partitionBy(family).orderBy(ordinal)))
