"""Profiles of tables and dimensions."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions.scalars import is_zero, null_class, skew_class


def sample_columns(columns: list[str], size: int = 200, seed: int = 42) -> list[str]:
    """The same random columns in every run."""
    return random.Random(seed).sample(columns, min(size, len(columns)))


def null_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, nulls and zeros per column with percentages and a verdict; one pass, one row before it is turned."""
    sums = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        sums += [F.count_if(F.col(c).isNull()).alias(f"n{i}"), F.count_if(is_zero(F.col(c))).alias(f"z{i}")]
    one = df.agg(*sums)
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col("n").alias("total"), F.col(f"n{i}").alias("nulls"), F.col(f"z{i}").alias("zeros")) for i, c in enumerate(columns))))
    out = one.select(rows.alias("x")).select("x.*")
    pct = lambda c, d: F.round(F.coalesce(F.try_divide(F.col(c) * 100.0, F.col("total").cast("double")), F.lit(0.0)), d)
    return out.withColumn("null_pct", pct("nulls", 4)).withColumn("zero_pct", pct("zeros", 2)).withColumn("verdict", null_class(F.col("null_pct")))


def value_counts(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def top(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    return value_counts(df, key).orderBy(F.desc("n"), key).limit(k)


def bottom(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    return value_counts(df, key).orderBy("n", key).limit(k)


def skew(df: DataFrame, key: str) -> DataFrame:
    """Distinct values, largest and smallest count with their values (ties: least value), ratio (999 for none)."""
    c = value_counts(df, key)
    one = c.agg(F.count(F.lit(1)).alias("distinct_values"), F.max(F.struct("n", F.lit(0))).getField("n").alias("largest"), F.min("n").alias("smallest"), F.min(F.struct((-F.col("n")).alias("m"), F.col(key).alias("v"))).getField("v").alias("largest_value"), F.min(F.struct("n", F.col(key).alias("v"))).getField("v").alias("smallest_value"))
    ratio = F.coalesce(F.round(F.try_divide(F.col("largest").cast("double"), F.col("smallest").cast("double")), 1), F.lit(999.0))
    return one.withColumn("ratio", ratio).withColumn("skew", skew_class(F.col("ratio")))


def zero_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*(F.count(F.when(is_zero(F.col(c)), F.col(c))).alias(f"{c}_zeros") for c in columns))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Surplus rows over distinct keys; null is a value."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct_keys")).withColumn("duplicates", F.col("total") - F.col("distinct_keys"))


def dimensions(df: DataFrame, ids: list[str]) -> DataFrame:
    """Rows, columns and shape: wide from over 100 columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_columns"), F.lit(len(df.columns) - len(ids)).alias("n_value_columns"), F.lit("Wide" if len(df.columns) > 100 else "Long").alias("topology"))


def long_sizes(df: DataFrame, array: str, group: str, row_bytes: int = 40) -> DataFrame:
    """What the long form of an array column comes to: rows, cells, GB at row_bytes a cell, and feature rows (positions
    times groups)."""
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.size(array)).alias("long_rows"), F.max(F.size(array)).alias("width"), F.count_distinct(group).alias("groups"))
    return one.select("n_rows", "long_rows", F.round(F.col("long_rows") * row_bytes / F.lit(float(1 << 30)), 6).alias("long_gb"), (F.col("width") * F.col("groups")).alias("feature_rows"))
