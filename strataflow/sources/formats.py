"""Sources that a session can name: `spark.read.format("tsv_dimension")` and `format("wide_matrix")`, after register().

Both open files with pyarrow, on the machine of the task: local files and the stores that pyarrow knows. A store that
only Spark reads is for readers.dimension() and reshape.to_long(), which give the same rows.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

#: Bytes of a dimension that one partition takes.
PART = 256 << 20
#: Columns of one partition of a matrix.
SLICE = 2_000
#: Long rows of one batch.
CELLS = 500_000


def register(spark: SparkSession) -> None:
    """Makes both formats known to the session and lets it push filters down to them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (DimensionSource, MatrixSource):
        spark.dataSource.register(source)


def store_of(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path)


def files_below(path: str, suffix: str = "") -> list[tuple[str, int]]:
    """Names and sizes of the files at path, in order; hidden ones are left out."""
    store, inside = store_of(path)
    info = store.get_file_info(inside)
    if info.type == pyarrow.fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == pyarrow.fs.FileType.File:
        return [(inside, info.size)]
    found = store.get_file_info(pyarrow.fs.FileSelector(inside, recursive=True))
    return sorted((f.path, f.size) for f in found if f.type == pyarrow.fs.FileType.File and not f.base_name.startswith(("_", ".")) and f.base_name.endswith(suffix))


def wanted(filters: list[Filter], columns: Iterable[str]) -> tuple[dict[str, set], list[Filter]]:
    """The values that equalities and lists allow each of the columns, and the filters that are left to Spark."""
    allowed, left = {}, []
    for f in filters:
        if isinstance(f, EqualTo | In) and len(f.attribute) == 1 and f.attribute[0] in columns:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            c = f.attribute[0]
            allowed[c] = allowed[c] & values if c in allowed else values
        else:
            left.append(f)
    return allowed, left


@dataclass
class Share(InputPartition):
    number: int
    of: int


class DimensionSource(DataSource):
    """Options path, key, value: the two columns of a tab-separated file or folder with headers, by the rules of
    readers.dimension(): the last valid line of a key wins. A partition reads the lines and keeps its share of the
    keys, by their hash, so a key's lines meet in one; up to PART bytes are one partition."""

    @classmethod
    def name(cls) -> str:
        return "tsv_dimension"

    def schema(self) -> StructType:
        return StructType([StructField(self.options["key"], StringType()), StructField(self.options["value"], StringType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return DimensionReader(self.options["path"], schema.names[0], schema.names[1])


class DimensionReader(DataSourceReader):
    def __init__(self, path: str, key: str, value: str):
        self.path, self.key, self.value = path, key, value
        self.files, self.allowed = files_below(path), {}
        header = next(self.lines(), [])
        missing = [c for c in (key, value) if c not in header]
        if missing:
            raise KeyError(f"{path} has no column {', '.join(missing)}")
        self.at = header.index(key), header.index(value)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        self.allowed, left = wanted(filters, [self.key])
        return left

    def partitions(self) -> list[Share]:
        n = max(1, -(-sum(size for _, size in self.files) // PART))
        return [Share(i, n) for i in range(n)]

    def lines(self) -> Iterator[list[str]]:
        store, _ = store_of(self.path)
        for file, _ in self.files:
            with store.open_input_stream(file) as raw, io.TextIOWrapper(raw, "utf-8", newline="\n") as text:
                for line in text:
                    yield [f.strip(" ") for f in line.rstrip("\r\n").split("\t")]

    def read(self, partition: Share) -> Iterator[tuple[str, str]]:
        i, j = self.at
        keys, kept = self.allowed.get(self.key), {}
        for f in self.lines():
            if len(f) <= max(i, j) or not f[i] or not f[j] or (f[i], f[j]) == (self.key, self.value):
                continue
            if zlib.crc32(f[i].encode()) % partition.of == partition.number and (keys is None or f[i] in keys):
                kept[f[i]] = f[j]
        yield from kept.items()


@dataclass
class Slice(InputPartition):
    file: str
    group: int
    first: int
    columns: list[str]


class MatrixSource(DataSource):
    """Options path, ids (names joined by commas), and name and value of the long columns: the long form of a wide
    Parquet matrix of numbers. A partition is a slice of SLICE columns of one row group, so its plan does not grow with
    the width; filters on the long name choose columns before anything is read, filters on ids choose rows."""

    @classmethod
    def name(cls) -> str:
        return "wide_matrix"

    def ids(self) -> list[str]:
        return self.options.get("ids", "Name,Description").split(",")

    def schema(self) -> StructType:
        from pyspark.sql.pandas.types import from_arrow_type
        from pyspark.sql.types import FloatType

        store, _ = store_of(self.options["path"])
        file = files_below(self.options["path"], ".parquet")[0][0]
        have = pq.read_schema(file, filesystem=store)
        ids = [StructField(c, from_arrow_type(have.field(c).type)) for c in self.ids()]
        return StructType([*ids, StructField(self.options.get("name", "sample_id"), StringType()), StructField(self.options.get("value", "tpm_value"), FloatType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return MatrixReader(self.options["path"], schema, int(self.options.get("width", SLICE)))


class MatrixReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, width: int):
        self.path, self.names, self.width, self.allowed = path, schema.names, width, {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        self.allowed, left = wanted(filters, self.names[:-1])
        return left

    def partitions(self) -> list[Slice]:
        store, _ = store_of(self.path)
        ids, out = self.names[:-2], []
        columns = self.allowed.get(self.names[-2])
        for file, _ in files_below(self.path, ".parquet"):
            meta = pq.read_metadata(file, filesystem=store)
            own = [c for c in meta.schema.to_arrow_schema().names if c not in ids and (columns is None or c in columns)]
            out += [Slice(file, g, i, own[i : i + self.width]) for g in range(meta.num_row_groups) for i in range(0, len(own), self.width)]
        return out or [Slice("", 0, 0, [])]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        if not partition.columns:
            return
        store, _ = store_of(self.path)
        ids = self.names[:-2]
        table = pq.ParquetFile(partition.file, filesystem=store).read_row_group(partition.group, columns=[*ids, *partition.columns])
        for c in ids:
            if c in self.allowed:
                table = table.filter(pc.is_in(table.column(c), pa.array(list(self.allowed[c]), table.schema.field(c).type)))
        table, n = table.combine_chunks(), table.num_rows
        step = max(1, CELLS // max(n, 1))
        names = pa.array(partition.columns, pa.string())
        for i in range(0, len(partition.columns) if n else 0, step):
            group = partition.columns[i : i + step]
            place = pa.array(np.tile(np.arange(n), len(group)))
            cells = pa.concat_arrays([chunk.cast(pa.float32()) for c in group for chunk in table.column(c).chunks])
            keys = [table.column(c).take(place).combine_chunks() for c in ids]
            yield pa.RecordBatch.from_arrays([*keys, names.take(pa.array(np.repeat(np.arange(i, i + len(group)), n))), cells], names=self.names)
