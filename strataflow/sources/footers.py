"""Answers from Parquet footers: rows, nulls and ranges of row groups, read by tasks, without a data page.

A footer says how many rows a row group has; its column chunks may have counts of nulls and least and greatest values.
Where a chunk has no such statistics, or a store can't be opened beside Spark, the file is scanned for that column.
Ranges are given for numbers, dates and timestamps; texts may be cut in footers.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, TimestampNTZType, TimestampType

from strataflow.operators.reshape import quoted
from strataflow.session import shared_folder
from strataflow.sources.files import write_once

SCHEMA = "file string, row_group int, rows long, column string, nulls long, low string, high string"
ARROW = pa.schema([("file", pa.string()), ("row_group", pa.int32()), ("rows", pa.int64()), ("column", pa.string()), ("nulls", pa.int64()), ("low", pa.string()), ("high", pa.string())])


def opened(path: str):
    """A Parquet file for its footer, on the machine of the task."""
    import pyarrow.fs
    import pyarrow.parquet

    local = re.match(r"file:/+(.*)", path)
    if local:
        return pyarrow.parquet.ParquetFile("/" + local[1])
    store, inside = pyarrow.fs.FileSystem.from_uri(path)
    return pyarrow.parquet.ParquetFile(inside, filesystem=store)


def row_groups(path: str, file: str) -> Iterator[dict]:
    """One row per row group and top-level column, and one without a column per row group. A file that can't be opened
    is one row without anything."""
    try:
        with opened(path) as source:
            meta = source.metadata
            leaves = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
            for g in range(meta.num_row_groups):
                group = meta.row_group(g)
                yield {"file": file, "row_group": g, "rows": group.num_rows}
                for name in source.schema_arrow.names:
                    said = group.column(leaves[name]).statistics if name in leaves else None
                    bounds = said is not None and said.has_min_max and said.physical_type != "BYTE_ARRAY"
                    yield {"file": file, "row_group": g, "rows": group.num_rows, "column": name, "nulls": said.null_count if said is not None and said.has_null_count else None, "low": str(said.min) if bounds else None, "high": str(said.max) if bounds else None}
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        yield {"file": file}


def read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, file in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield pa.RecordBatch.from_pylist(list(row_groups(path, file)), schema=ARROW)


def footers(spark: SparkSession, path: str) -> DataFrame:
    """file, row_group, rows, column, nulls, low, high of every Parquet file below path; a null column stands for the
    row group itself. Values are texts, file is as _metadata.file_path has it."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return listed.select("path", "_metadata.file_path").mapInArrow(read_footers, SCHEMA)


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a layer. Where a footer can't be read here, Spark counts."""
    told = footers(spark, path).where("column is null").agg(F.sum("rows"), F.count_if(F.col("row_group").isNull())).first()
    return files_of(spark, path).count() if told[1] else told[0] or 0


def files_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path)


def kind_of(kind: DataType) -> str | None:
    """The type in which a range is compared, or None for columns without ranges."""
    return kind.simpleString() if isinstance(kind, NumericType | DateType | TimestampType | TimestampNTZType) else None


def column_profile(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """column, rows, nulls, low, high (as texts, NaN left out) per column of the files below path: from footers where
    they say it, and from a scan of that column of a file where one of its row groups does not."""
    table = files_of(spark, path)
    kinds = {f.name: kind_of(f.dataType) for f in table.schema if columns is None or f.name in columns}
    told = write_once(spark, footers(spark, path), f"{shared_folder(spark)}/footers-{uuid.uuid4().hex}")
    ranged = [c for c, k in kinds.items() if k]
    # A row group of nulls only has no range. An unreadable file says nothing of any column.
    silent = F.col("nulls").isNull() | (F.col("column").isin(ranged) & F.col("low").isNull() & (F.col("nulls") < F.col("rows")))
    by_file = told.where(F.col("column").isin(list(kinds))).groupBy("column", "file").agg(F.bool_or(silent).alias("scan"), F.collect_list(F.struct("rows", "nulls", "low", "high")).alias("groups"))
    by_file = by_file.unionByName(told.where("row_group is null").select("file", F.explode(F.array(*map(F.lit, kinds))).alias("column"), F.lit(True).alias("scan"), F.lit(None).cast(by_file.schema["groups"].dataType).alias("groups")))
    by_file = write_once(spark, by_file, f"{shared_folder(spark)}/footers-{uuid.uuid4().hex}")
    to_scan = {r[0] for r in by_file.where("scan").select("column").distinct().collect()}
    said = by_file.where("not scan").select("column", F.explode("groups").alias("g")).select("column", "g.*")
    own = F.col("_metadata.file_path").alias("file")
    parts = []
    for kind in set(kinds.values()):
        value = (lambda c, k=kind: F.nanvl(F.col(c).cast(k), F.lit(None)) if k in ("float", "double") else F.col(c).cast(k or "string"))
        low, high = (text(how(value(c))).alias(c) for how, c in ((F.min, "low"), (F.max, "high")))
        mine = [c for c, k in kinds.items() if k == kind]
        one = said.where(F.col("column").isin(mine)).select("column", "rows", "nulls", *(F.col(c) if kind else F.lit(None).cast("string").alias(c) for c in ("low", "high")))
        for c in (c for c in mine if c in to_scan):
            files = by_file.where(F.col("scan") & (F.col("column") == c)).select("file")
            cells = table.select(F.col(quoted(c)).alias("low"), own).join(files, "file", "left_semi").withColumn("high", F.col("low"))
            bounds = (low, high) if kind else (F.lit(None).cast("string").alias("low"), F.lit(None).cast("string").alias("high"))
            one = one.unionByName(cells.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("low").isNull()).alias("nulls"), *bounds).select(F.lit(c).alias("column"), "rows", "nulls", "low", "high"))
        parts.append(one.groupBy("column").agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), low, high))
    return reduce(DataFrame.unionByName, parts)


def text(c: Column) -> Column:
    return c.cast("string")
