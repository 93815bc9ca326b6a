"""Mergeable states: features of groups and distinct counts that are kept up to date from new files only.

A state table has one row per key. New files give such a table, and two tables are merged to one by a combined
aggregation, so the work of an update follows what is new and the number of keys, not the rows before.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from strataflow.functions.scalars import is_zero, log_value
from strataflow.operators.reshape import quoted
from strataflow.sources import versions

#: Parameter of the KLL sketches. Medians of groups of up to so many rows are exact; beyond, their rank is within
#: median_error() of the middle, in 99 of 100 groups.
SKETCH = 512
#: Parameter of the HLL sketches: a relative standard error of 1.04 / sqrt(2 ** HLL), 0.8 %.
HLL = 14


def median_error(sketch: int = SKETCH) -> float:
    """The rank error of a KLL sketch's quantiles at 99 % confidence, as a share of the group's rows."""
    return 2.296 / sketch**0.9723


def feature_states(df: DataFrame, keys: list[str], value: str, sketch: int = SKETCH) -> DataFrame:
    """keys, n, mean, m2, zeros, sketch of ln(1 + value) per group; null values are left out."""
    v = F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull()).select(*keys, v.alias("__v"), log_value(v).alias("__l"))
    one = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("__l").alias("mean"), F.var_pop("__l").alias("__var"), F.count_if(is_zero(F.col("__v"))).alias("zeros"), F.kll_sketch_agg_double("__l", F.lit(sketch)).alias("sketch"))
    return one.select(*keys, "n", "mean", (F.col("__var") * F.col("n")).alias("m2"), "zeros", "sketch")


def merge_features(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """One state per key of two tables with one each; null is a key."""
    n = F.sum("n")
    # Of two parts, the squares between them are (difference of means)^2 n1 n2 / n, where 2 n1 n2 = n^2 - n1^2 - n2^2.
    between = (F.max("mean") - F.min("mean")) ** 2 * (n.cast("double") ** 2 - F.sum(F.col("n").cast("double") ** 2)) / (2 * n)
    one = a.unionByName(b).groupBy(*keys).agg(n.alias("n"), (F.sum(F.col("n") * F.col("mean")) / n).alias("mean"), (F.sum("m2") + between).alias("m2"), F.sum("zeros").alias("zeros"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return one


def features_of(states: DataFrame, keys: list[str], double: bool = False, sketch: int = SKETCH) -> DataFrame:
    """The columns of group_features() from states."""
    num = "double" if double else "float"
    # The items of ranks n / 2 and n / 2 + 1, rounded up: one and the same for odd n.
    middle = lambda rank: F.kll_sketch_get_quantile_double("sketch", F.lit(rank))
    return states.select(
        *keys,
        F.col("mean").cast(num).alias("mean_log1p"),
        F.when(F.col("n") >= 2, F.sqrt(F.col("m2") / F.col("n"))).cast(num).alias("std_log1p"),
        ((middle(0.5) + middle(0.5 + 0.25 / sketch)) / 2).cast(num).alias("median_log1p"),
        F.col("n").cast("int").alias("sample_count"),
        (F.col("zeros") / F.col("n")).cast(num).alias("zero_fraction"),
    )


def exact_distinct(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """by, in_file: the exact number of distinct values of a column that are not null. Of whole numbers, 64 neighbours
    are one row with a bit each, so that tasks send words of bits, not values; others are sent once a task."""
    v, whole = F.col(quoted(column)), isinstance(df.schema[column].dataType, IntegralType)
    word = F.shiftright(v.cast("long"), 6) if whole else v
    bit = F.expr(f"shiftleft(1L, cast({quoted(column)} & 63 as int))") if whole else F.lit(1).cast("long")
    words = df.where(v.isNotNull()).select(*by, word.alias("__word"), bit.alias("__bit")).groupBy(*by, "__word").agg(F.bit_or("__bit").alias("__bits"))
    return words.groupBy(*by).agg(F.sum(F.bit_count("__bits")).cast("long").alias("in_file"))


def exact_distincts(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, exact_count: distinct values that are not null, of each column by itself."""
    one = [exact_distinct(df, c, []).select(F.lit(c).alias("column"), F.coalesce("in_file", F.lit(0)).alias("exact_count")) for c in columns]
    return reduce(DataFrame.unionByName, one)


def distinct_states(df: DataFrame, columns: list[str], lg: int = HLL) -> DataFrame:
    """file, column, known (rows that are not null), in_file (exact distinct values), sketch, per file and column. Files
    are told apart by a 64-bit hash of their path where their values are counted."""
    name = F.col("_metadata.file_path")
    rows = df.select(name.alias("__file"), F.xxhash64(name).alias("__at"), *map(quoted, columns))
    one = rows.groupBy("__at", "__file").agg(*(F.struct(F.lit(c).alias("column"), F.count(quoted(c)).alias("known"), F.hll_sketch_agg(quoted(c), F.lit(lg)).alias("sketch")).alias(f"s{i}") for i, c in enumerate(columns)))
    one = one.select("__at", F.col("__file").alias("file"), F.inline(F.array(*(f"s{i}" for i in range(len(columns))))))
    exact = reduce(DataFrame.unionByName, [exact_distinct(rows, c, ["__at"]).withColumn("column", F.lit(c)) for c in columns])
    return one.join(exact, ["__at", "column"], "left").select("file", "column", "known", F.coalesce("in_file", F.lit(0)).alias("in_file"), "sketch")


def distinct_estimates(states: DataFrame) -> DataFrame:
    """column, known, least (an exact lower bound: the fullest file's count), estimate: the union of all files'
    sketches, without a scan of the data."""
    return states.groupBy("column").agg(F.sum("known").alias("known"), F.max("in_file").alias("least"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def listing(spark: SparkSession, source: str) -> DataFrame:
    """path, length, modified of the Parquet files below a folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(source)
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


def refresh(spark: SparkSession, source: str, path: str, make: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """The state of all files below source, kept at path as a layer with versions, with the list of files in it.

    Only files that the last version did not have are read. If one of its files has gone or changed, the state is made
    anew from all. A run that dies leaves the old version, and of two at a time one is refused. A source without files
    raises.
    """
    seen, now = versions.last_number(spark, path), versions.current(spark, path)
    files, old = listing(spark, source), None
    fresh = files
    if now:
        done = spark.read.parquet(f"{now['folder']}/files")
        if done.join(files, files.columns, "left_anti").isEmpty():
            fresh, old = files.join(done, files.columns, "left_anti"), spark.read.parquet(f"{now['folder']}/states")
    # Names only; Spark's own file index holds them on the driver too.
    names = sorted(r.path for r in fresh.select("path").collect())
    if not names:
        if old is None:
            raise FileNotFoundError(f"no Parquet files below {source}")
        return old
    new, folder = make(spark.read.option("basePath", source).parquet(*names)), versions.new_folder(path)
    (new if old is None else merge(old, new)).write.parquet(f"{folder}/states")
    files.write.parquet(f"{folder}/files")
    versions.commit(spark, path, folder, seen, {"files": len(names)})
    versions.clean(spark, path)
    return spark.read.parquet(f"{folder}/states")
