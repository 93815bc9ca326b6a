"""Features of groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions.scalars import is_zero, log_value

RESERVOIR = 10


#: Accuracy of the sketch that brackets the median of large groups: ranks are within rows / SKETCH.
SKETCH = 10_000


def group_features(df: DataFrame, keys: list[str], value: str, double: bool = False, large_groups: bool = False) -> DataFrame:
    """mean, population deviation (null for one row) and exact median of ln(1 + value), rows and share of zeros.

    Null values are left out, so a group of nulls only is absent; zeros count everywhere. Keys stay as they are, null
    ones too. Results are floats unless double is asked for.

    One aggregation, combined before its shuffle; its median holds a group's distinct values, which suits groups of up
    to some millions of rows. With large_groups, mergeable sketches bracket the median first and only the values inside
    the bracket are held, two rows in SKETCH and those of equal value counted once; the result is the same.
    """
    v = F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull()).select(*keys, v.alias("__v"), log_value(v).alias("__l"))
    num = "double" if double else "float"
    out = [
        F.avg("__l").cast(num).alias("mean_log1p"),
        F.when(F.count(F.lit(1)) >= 2, F.stddev_pop("__l")).cast(num).alias("std_log1p"),
        F.count(F.lit(1)).cast("int").alias("sample_count"),
        F.avg(F.when(is_zero(F.col("__v")), 1.0).otherwise(0.0)).cast(num).alias("zero_fraction"),
    ]
    if large_groups:
        one = large_with_median(rows, keys, out).withColumn("median_log1p", F.col("__median").cast(num))
    else:
        one = rows.groupBy(*keys).agg(*out, F.percentile("__l", 0.5).cast(num).alias("median_log1p"))
    return one.select(*keys, "mean_log1p", "std_log1p", "median_log1p", "sample_count", "zero_fraction")


def large_with_median(rows: DataFrame, keys: list[str], measures: list[Column]) -> DataFrame:
    """keys, the measures and __median, the exact median of __l with bounded buffers; the rows are read twice. With the
    measures a sketch gives two values that the median lies between; values below are counted, those inside are counted
    by value, and the middle is read off the running counts."""
    edge = F.percentile_approx("__l", [0.5 - 2 / SKETCH, 0.5 + 2 / SKETCH], SKETCH)
    bracket = rows.groupBy(*keys).agg(F.struct(*measures).alias("__m"), edge.alias("__e"), F.count("__l").alias("__n")).withColumnsRenamed({k: f"__{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    x = F.col("__l")
    held = rows.select(*keys, "__l").join(bracket, same).where(x.isNull() | (x <= F.col("__e")[1]))
    # One row below the bracket stands for all of them; each value inside is one row with its count.
    place = F.when(x >= F.col("__e")[0], x)
    counted = held.groupBy(*keys, place.alias("__x")).agg(F.count("__l").alias("__c"), F.first("__n").alias("__n"), F.first("__m").alias("__m"))
    run = Window.partitionBy(*keys).orderBy(F.col("__x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = counted.withColumn("__to", F.sum("__c").over(run))
    # Ranks (n + 1) div 2 and n div 2 + 1, from 1: the one middle value or both.
    at = lambda rank: F.min(F.when(F.col("__to") >= rank, F.col("__x")))
    middle = upto.groupBy(*keys).agg(at(F.floor((F.col("__n") + 1) / 2)).alias("__a"), at(F.floor(F.col("__n") / 2) + 1).alias("__b"), F.first("__m").alias("__m"))
    return middle.select(*keys, "__m.*", ((F.col("__a") + F.col("__b")) / 2).alias("__median"))


def reservoir_median(df: DataFrame, keys: list[str], value: str, order: list[Column], size: int = RESERVOIR) -> DataFrame:
    """Median of the `size` rows of least order in each group; with a hash as order, of a uniform sample that is the
    same in every run. The rank filter is applied before the shuffle as well."""
    w = Window.partitionBy(*keys).orderBy(*order)
    kept = df.where(F.col(value).isNotNull()).select("*", F.row_number().over(w).alias("__at")).where(F.col("__at") <= size)
    return kept.groupBy(*keys).agg(F.percentile(log_value(F.col(value)), 0.5).alias("reservoir_median"), F.count(F.lit(1)).alias("reservoir_size"))


def groups_per(features: DataFrame, key: str) -> DataFrame:
    return features.groupBy(key).agg(F.count(F.lit(1)).alias("groups"))


def validate_genes(features: DataFrame, key: str) -> DataFrame:
    """Least mean and greatest zero share of each key: housekeeping keys have a high floor, specific ones many zeros."""
    return features.groupBy(key).agg(F.min("mean_log1p").alias("min_mean"), F.max("zero_fraction").alias("max_zero_fraction"))
