"""Files and folders through Spark's file systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def fs(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    where, p = fs(spark, path)
    return bool(where.exists(p))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it isn't there."""
    where, p = fs(spark, path)
    return sorted(x.getPath().getName() for x in where.listStatus(p)) if where.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    where, p = fs(spark, path)
    source = where.open(p)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def write_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> None:
    """Without replace, a file that is there raises: of several writers one creates it."""
    where, p = fs(spark, path)
    out = where.create(p, replace)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def delete(spark: SparkSession, path: str) -> None:
    where, p = fs(spark, path)
    where.delete(p, True)


def write_once(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """df written and read again: what is used several times is then computed once."""
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
