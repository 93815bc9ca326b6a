"""Sources: Parquet tables, wide matrices, tab-separated dimensions, JSON documents, object stores, generated matrices."""

from __future__ import annotations

import json
from bisect import bisect_right
from itertools import accumulate
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strataflow.functions.scalars import strip
from strataflow.sources import versions


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def value_columns(df: DataFrame, ids: list[str]) -> list[str]:
    """All columns that are not ids, from the schema alone."""
    return [c for c in df.columns if c not in set(ids)]


def columns_with_prefix(df: DataFrame, *prefixes: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefixes)]


def layer(spark: SparkSession, path: str, partitions: tuple[str, ...] = ("tissue_id",), skip_corrupt: bool = False, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """A partitioned layer in Parquet or another format of this session (delta, say). Partition values are strings, as
    written: '01' stays '01'. An empty layer needs its schema. Corrupt files raise unless they are to be skipped, which
    loses their rows. Of a layer with versions, the current one."""
    path = versions.resolve(spark, path)
    reader = spark.read.format(fmt).option("ignoreCorruptFiles", str(skip_corrupt).lower())
    if fmt != "parquet":
        return reader.load(path)
    seen = schema or reader.load(path).schema
    return reader.schema(StructType([StructField(f.name, StringType() if f.name in partitions else f.dataType) for f in seen])).load(path)


def files_below(spark: SparkSession, path: str) -> DataFrame:
    """Every Parquet file under a folder, nested ones too, apart from log folders."""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path)


def dimension(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """(key, value) of a tab-separated file with a header, or of a folder of such files in the order of their names.
    Lines are read with their place, so that of repeated keys the last valid line wins; short lines and blank keys or
    values are left out; quotes are literal. The header is that of the first file."""
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    lines = spark.read.option("wholetext", "false").text(path)
    files = lines.inputFiles()
    head = spark.read.text(unquote(min(files))).first() if files else None
    names = [c.strip() for c in head[0].split("\t")] if head else []
    missing = [c for c in (key, value) if c not in names]
    if missing:
        raise KeyError(f"{path} has no column {', '.join(missing)}")
    i, j = names.index(key), names.index(value)
    rows = lines.select(F.split("value", "\t", -1).alias("f"), place.alias("at")).where(f"size(f) > {max(i, j)}").select(strip(F.col("f")[i]).alias(key), strip(F.col("f")[j]).alias(value), "at")
    rows = rows.where((F.col(key) != "") & (F.col(value) != "") & ~((F.col(key) == key) & (F.col(value) == value)))
    return last_wins(rows, key, value, "at")


def last_wins(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One value per key: that of the greatest order; an aggregation, so it combines before its shuffle."""
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def json_document(spark: SparkSession, path: str) -> dict:
    """A small JSON document through Spark's file systems; {} if there is none."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return {}
    text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    return json.loads(text)


def object_store(spark: SparkSession, endpoint: str, access: str, secret: str) -> None:
    """S3A settings of this session; the caller takes the keys from its environment."""
    conf = spark._jsc.hadoopConfiguration()
    for k, v in {"endpoint": endpoint, "access.key": access, "secret.key": secret, "path.style.access": "true"}.items():
        conf.set(f"fs.s3a.{k}", v)


def synthetic_matrix(spark: SparkSession, rows: int, columns: int, zero_share: float = 0.5, seed: int = 7, location: float = 1.5, deviation: float = 2.0) -> DataFrame:
    """A generated wide matrix: a cell is zero with zero_share, else log-normal."""
    cells = [F.when(F.rand(seed + i) < zero_share, 0.0).otherwise(F.exp(F.randn(seed + columns + i) * deviation + location)).cast("float").alias(f"sample{i}") for i in range(columns)]
    return spark.range(rows).select(F.concat(F.lit("entity"), "id").alias("Name"), F.concat(F.lit("symbol"), F.col("id") % 1000).alias("Description"), *cells)


def synthetic_dimension(spark: SparkSession, columns: int, weights: dict[str, int]) -> DataFrame:
    """The groups of the generated columns: column i has the group in whose cumulative share of all weights it lies."""
    bounds, total = list(accumulate(weights.values())), sum(weights.values())
    groups = [list(weights)[bisect_right(bounds, (i + 0.5) / columns * total)] for i in range(columns)]
    return spark.createDataFrame([(f"sample{i}", g) for i, g in enumerate(groups)], "sample_id string, tissue_id string")
