"""Sinks: partitioned layers that are checked before they are published, copies, quarantine, JSON documents."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from strataflow.operators.join import sized
from strataflow.operators.reshape import quoted
from strataflow.sources import versions
from strataflow.sources.files import fs as _fs
from strataflow.sources.files import delete, names, write_once, write_text
from strataflow.sources.footers import row_count
from strataflow.sources.readers import layer


#: Long rows of one partition value that one write task takes.
ROWS_PER_TASK = 5_000_000


def write_layer(df: DataFrame, path: str, partition: str, codec: str = "snappy", spread: dict | None = None, records_per_file: int = 1_000_000, fmt: str = "parquet", measures: list[Column] | None = None) -> dict | None:
    """One atomic overwrite, a folder per partition value. With spread, of spread_for(), a value's rows
    are dealt to as many tasks as it needs; without it, each task writes what it holds.

    measures are taken on the way, of the rows that are written, and returned. They stand after the last shuffle: the
    tasks of a job's last stage count once, however often they are tried, while a shuffle's may count again.
    """
    if spread is not None:
        df = spread_rows(df, partition, spread)
    seen = Observation() if measures else None
    if seen:
        df = df.observe(seen, *measures)
    df.write.format(fmt).mode("overwrite").partitionBy(partition).option("compression", codec).option("maxRecordsPerFile", records_per_file).save(path)
    return seen.get if seen else None


def spread_for(df: DataFrame, partition: str, rows: int = ROWS_PER_TASK) -> dict:
    """Tasks of about equal size for each partition value with more than `rows` rows. The values are counted, so small
    ones are not dealt out; the driver gets total / rows heavy ones at most."""
    counts = df.groupBy(F.col(partition).alias("value")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows)
    return {r["value"]: -(-r["n"] // rows) for r in counts.collect()}


def spread_rows(df: DataFrame, partition: str, spread: dict) -> DataFrame:
    """df dealt to a task for each part of a heavy value; light values share the session's number of tasks, each whole
    in one. The part comes from the row's data, so that a retried task deals its rows as before."""
    spark, light = df.sparkSession, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    firsts = accumulate(spread.values(), initial=light)
    kind = StructType([StructField("__value", df.schema[partition].dataType), StructField("__parts", IntegerType()), StructField("__first", IntegerType())])
    heavy = spark.createDataFrame([(v, n, first) for (v, n), first in zip(spread.items(), firsts, strict=False)], kind)
    row = F.xxhash64(*[F.col(quoted(c)) for c in df.columns])
    task = F.coalesce(F.col("__first") + F.pmod(row, F.col("__parts")), F.pmod(F.xxhash64(partition), F.lit(light)))
    dealt = df.join(sized(heavy), F.col(partition).eqNullSafe(F.col("__value")), "left").repartitionById(light + sum(spread.values()), task.cast("int"))
    return dealt.drop(*kind.names)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """df with the columns, order and types of schema, for a layer of that schema; a missing column raises."""
    return df.to(schema)


def replace_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Moves staged to path. What is there steps aside first and comes back if the move fails, so a run that dies
    between the two moves has lost nothing: the layer then lies beside its place as `.previous`."""
    fs, target = _fs(spark, path)
    made = spark._jvm.org.apache.hadoop.fs.Path
    aside = made(f"{path}.previous")
    if not fs.exists(made(staged)):
        raise OSError(f"there is no {staged}")
    if fs.exists(target):
        fs.delete(aside, True)
        if not fs.rename(target, aside):
            raise OSError(f"could not move {path} aside")
    if not fs.rename(made(staged), target):
        if fs.exists(aside):
            fs.rename(aside, target)
        raise OSError(f"could not move {staged} to {path}")
    fs.delete(aside, True)


def publish(spark: SparkSession, df: DataFrame, path: str, partition: str, check: Callable[[DataFrame | dict], None], codec: str = "snappy", spread: dict | None = None, schema: StructType | None = None, measures: list[Column] | None = None) -> DataFrame:
    """Writes a new data folder, realigned to schema if one is given, checks what was written, then makes it the layer by
    one pointer; a failed check leaves the old layer, and a publisher that came between makes this one fail.

    check gets the written layer, or its measures as a dict if some are named: those come from the write itself, with
    row_count and group_count (of the partition's folders) from the files. They must agree with the rows that the
    footers of the written files give; if they don't, they are measured again by a scan.
    """
    seen, folder = versions.last_number(spark, path), versions.new_folder(path)
    df = conform(df, schema) if schema else df
    try:
        found = write_layer(df, folder, partition, codec, spread, measures=[F.count(F.lit(1)).alias("row_count"), *measures] if measures else None)
        written = layer(spark, folder, (partition,), schema=df.schema)
        check(measured(spark, written, folder, partition, found, measures) if measures else written)
    except Exception:
        delete(spark, folder)
        raise
    versions.commit(spark, path, folder, seen)
    versions.clean(spark, path)
    return layer(spark, path, (partition,), schema=df.schema)


def measured(spark: SparkSession, written: DataFrame, folder: str, partition: str, found: dict, measures: list[Column]) -> dict:
    groups = len([n for n in names(spark, folder) if n.startswith(f"{partition}=") and not n.endswith("=__HIVE_DEFAULT_PARTITION__")])
    if found["row_count"] != row_count(spark, folder):
        found = written.agg(F.count(F.lit(1)).alias("row_count"), *measures).first().asDict()
    return found | {"group_count": groups}


def write_quarantine(df: DataFrame, path: str) -> None:
    """Overwritten by each run, so that a repeated run doesn't repeat rows."""
    df.write.mode("overwrite").parquet(path)


def copy_raw(spark: SparkSession, source: str, target: str) -> dict:
    """A byte copy that never replaces a file, checked by size; its metadata. A missing source gives {}."""
    fs, src = _fs(spark, source)
    if not fs.exists(src):
        return {}
    to, dst = _fs(spark, target)
    jvm = spark._jvm
    if not to.exists(dst):
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, src, to, dst, False, spark._jsc.hadoopConfiguration())
    size, copied = (f.getContentSummary(p).getLength() for f, p in ((fs, src), (to, dst)))
    if size != copied:
        raise OSError(f"{target} has {copied} bytes, {source} has {size}")
    return {"source": source, "path": target, "bytes": copied, "copied_at_utc": datetime.now(UTC).isoformat()}


def is_complete(spark: SparkSession, path: str, expected: int) -> bool:
    """Whether a layer is there with the expected rows; footers answer, no data page is read."""
    folder = versions.resolve(spark, path)
    where, p = _fs(spark, folder)
    return bool(where.exists(p)) and row_count(spark, folder) == expected


def save_json(spark: SparkSession, data: dict, path: str) -> None:
    """A JSON document, indented, non-ASCII kept."""
    write_text(spark, path, json.dumps(data, indent=2, ensure_ascii=False))
