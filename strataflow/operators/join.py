"""Attaching a dimension, and routing what has no match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A dimension is broadcast up to so many rows; it is counted first. Beyond, both sides are shuffled and AQE splits
#: skewed keys.
BROADCAST_ROWS = 200_000


def sized(dim: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """dim, marked for broadcast if it has at most `limit` rows. The count stops there."""
    return F.broadcast(dim) if dim.limit(limit + 1).count() <= limit else dim


def tagged(facts: DataFrame, dim: DataFrame, key: str, measured: bool = False) -> DataFrame:
    """facts with the dimension's columns and `matched`: one left join. dim has one row per key. Null keys don't match.
    A dimension that was measured before, by sized(), is not counted again."""
    marked = dim.withColumn("matched", F.lit(True))
    return facts.join(marked if measured else sized(marked), key, "left").withColumn("matched", F.col("matched").isNotNull())


def attach(facts: DataFrame, dim: DataFrame, key: str, reason: str = "no_tissue_match") -> tuple[DataFrame, DataFrame]:
    """(matched with the dimension's columns, unmatched with a reason): an inner and an anti join, for callers that want
    one of them. Who needs both writes tagged() once and gives that to split()."""
    dim = sized(dim)
    return facts.join(dim, key), facts.join(dim, key, "left_anti").withColumn("reason", F.lit(reason))


def split(both: DataFrame, columns: list[str], reason: str = "no_tissue_match") -> tuple[DataFrame, DataFrame]:
    """The two sides of tagged(); the unmatched one has `columns` and the reason."""
    return both.where("matched").drop("matched"), both.where("not matched").select(*columns, F.lit(reason).alias("reason"))


def lookup(facts: DataFrame, dim: DataFrame, key: str, value: str, fallback: str) -> DataFrame:
    """value by key, or the fallback."""
    return facts.join(sized(dim), key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(fallback)))


def overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of left that right has."""
    return left.select(key).join(right.select(key), key, "left_semi").distinct()
