"""Scalar expressions with the semantics that the layers need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends (trim() takes blanks only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def is_zero(c: Column) -> Column:
    """Zero of either sign; not NaN."""
    return c.cast("double") == F.lit(0.0)


def log_value(c: Column) -> Column:
    """ln(1 + x) in double precision; null from -1 down."""
    return F.log1p(c.cast("double"))


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def partition_value(c: Column) -> Column:
    """The unescaped value of a `name=value` folder."""
    return F.url_decode(F.regexp_replace(F.substring_index(c, "=", -1), r"\+", "%2B"))


def digest(c: Column) -> Column:
    """First 16 hex digits of SHA-256."""
    return F.substring(F.sha2(c.cast("string"), 256), 1, 16)


def skew_class(ratio: Column) -> Column:
    return F.when(ratio > 10, "SEVERE").when(ratio > 5, "MODERATE").otherwise("LOW")


def null_class(percent: Column) -> Column:
    return F.when(percent < 0.1, "clean").when(percent < 1, "acceptable").otherwise("review")
