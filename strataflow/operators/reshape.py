"""Wide to long."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Up to so many value columns unpivot is planned as one Expand; beyond, record batches are turned in the tasks.
EXPAND_LIMIT = 100
#: Columns of one slice. Batches are cut by bytes; a Parquet reader holds 4,096 rows of a slice, 100 MB.
SLICE = 5_000
#: Long rows of one batch that is returned.
CELLS = 500_000


def to_long(df: DataFrame, ids: list[str], values: list[str], name: str = "sample_id", value: str = "tpm_value", kind: str = "float", width: int = SLICE) -> DataFrame:
    """One row per row and value column; zeros and nulls stay. Values are cast to `kind`.

    Wide input goes by slices of `width` columns, each a scan of its own columns only, so that no task holds whole rows
    of a 20,000-column table; a slice is one node of the plan, whatever its width.
    """
    if len(values) <= EXPAND_LIMIT:
        cast = df.select(*ids, *(F.col(f"`{v}`").cast(kind).alias(v) for v in values))
        return cast.unpivot(ids, values, name, value)
    cell = df.sparkSession.createDataFrame([], f"v {kind}").schema["v"].dataType
    schema = StructType([*(df.schema[c] for c in ids), StructField(name, StringType(), False), StructField(value, cell)])
    # A slice is one column made from one text: a column object for each column would cost the driver seconds, as would
    # a function over so many columns.
    cells = lambda group: "array(" + ", ".join(f"cast({quoted(v)} as {kind})" for v in group) + ") as cells"
    parts = (df.selectExpr(*map(quoted, ids), cells(group)).mapInArrow(turner(group), schema) for group in column_groups(values, width))
    return reduce(DataFrame.unionAll, parts)


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def turner(values: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Record batches of ids and one array of the slice's cells to batches of ids, column name and cell, of about CELLS
    rows. The cells stay the buffer that Arrow holds; ids are repeated and names tiled around it."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, rows = len(values), max(1, CELLS // len(values))
        names = pa.array(values, pa.string())
        tiled = names.take(pa.array(np.tile(np.arange(width, dtype=np.int32), rows)))
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                place = pa.array(np.repeat(np.arange(part.num_rows, dtype=np.int32), width))
                keys = [c.take(place) for c in part.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*keys, tiled.slice(0, len(place)), part.columns[-1].flatten()], names=[*part.schema.names[:-1], "name", "value"])

    return turn


def array_to_long(df: DataFrame, ids: list[str], array: str, position: str = "pos", value: str = "value") -> DataFrame:
    """One row per element of an array column; null and empty arrays give none."""
    return df.select(*ids, F.posexplode(array).alias(position, value))


def column_groups(values: list[str], size: int) -> list[list[str]]:
    return [values[i : i + size] for i in range(0, len(values), size)]
