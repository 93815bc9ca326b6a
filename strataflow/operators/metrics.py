"""Metrics of layers, each from one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.scalars import is_zero, share


def silver_measures(keys: list[str], value: str) -> list[Column]:
    """What can be measured row by row of a long form, hence on its write too."""
    v = F.col(value).cast("double")
    return [
        *(F.count_if(F.col(k).isNull()).alias(f"nulls_{k}") for k in keys),
        F.count_if(v.isNull()).alias("nulls_value"),
        F.count_if(F.isnan(v)).alias("nan_value"),
        F.count_if(is_zero(v)).alias("zero_count"),
    ]


def gold_measures(keys: list[str]) -> list[Column]:
    return [*(F.count_if(F.col(k).isNull()).alias(f"nulls_{k}") for k in keys), F.min("sample_count").alias("min_sample_count"), F.avg("zero_fraction").alias("mean_zero_fraction")]


def with_share(m: dict) -> dict:
    """Measures of a long form with their share of zeros, 0 for no rows."""
    return m | {"zero_fraction": m["zero_count"] / m["row_count"] if m["row_count"] else 0.0}


def silver(df: DataFrame, keys: list[str], value: str, group: str) -> DataFrame:
    """Rows, nulls per key and of the value, NaNs, zeros and their share, distinct groups."""
    one = df.agg(F.count(F.lit(1)).alias("row_count"), *silver_measures(keys, value), F.count_distinct(group).alias("group_count"))
    return one.withColumn("zero_fraction", share(F.col("zero_count"), F.col("row_count")))


def gold(features: DataFrame, keys: list[str], group: str) -> DataFrame:
    """Rows, nulls per key, distinct groups, least sample count, unweighted mean share of zeros."""
    return features.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(group).alias("group_count"), *gold_measures(keys))


def closure(both: DataFrame, source: DataFrame, columns: int) -> DataFrame:
    """Whether the matched and unmatched rows of a tagged join make up the source's rows times columns; each side is
    counted once."""
    kinds = both.select("matched").unionAll(source.select(F.lit(None).cast("boolean").alias("matched")))
    one = kinds.agg(F.count_if("matched").alias("silver_count"), F.count_if(~F.col("matched")).alias("quarantine_count"), F.count_if(F.col("matched").isNull()).alias("source_count"))
    return one.withColumn("expected_total", F.col("source_count") * columns).withColumn("closes", F.col("silver_count") + F.col("quarantine_count") == F.col("expected_total"))
