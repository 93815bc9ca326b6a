"""Key sets at scale: duplicates behind a filter, and overlaps of groups by bitmaps or by lists."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.operators.reshape import quoted
from strataflow.session import shared_folder

#: Positions of the filter per row: so rarely do two keys share one.
ROOM = 1_024
#: Positions that one task of the second stage takes, about.
SLICE_ROWS = 1_000_000
#: Bits of one bitmap, as Spark's bitmap functions have them.
BITS = 32_768
#: Groups up to which one task takes the bitmaps of all of them; pairs of rows that a task counts beyond that, about.
DENSE, PAIRS = 2_000, 4_000_000
#: Groups that are broadcast with their numbers, at most; ids gathered before packed arrays are sent.
TOLD, FLUSH = 500_000, 500_000


def positions_of(df: DataFrame, keys: list[str], space: int) -> DataFrame:
    return df.select("*", F.pmod(F.xxhash64(*map(quoted, keys)), F.lit(space)).alias("__at"))


def packed(positions: np.ndarray) -> bytes:
    """Sorted positions as gaps, byte planes apart, compressed: some log2(space / positions) bits each."""
    gaps = np.diff(positions, prepend=0).astype("<u8")
    planes = gaps.view(np.uint8).reshape(-1, 8).T
    used = int(np.flatnonzero(planes.any(axis=1))[-1]) + 1 if planes.any() else 1
    return zlib.compress(np.uint32(len(gaps)).tobytes() + np.ascontiguousarray(planes[:used]).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    raw = zlib.decompress(data)
    n = int(np.frombuffer(raw[:4], np.uint32)[0])
    planes = np.frombuffer(raw[4:], np.uint8).reshape(-1, n)
    full = np.zeros((8, n), np.uint8)
    full[: len(planes)] = planes
    return np.cumsum(np.ascontiguousarray(full.T).view("<u8").ravel()).astype(np.int64)


def filter_parts(width: int):
    """The filter of one partition: each position once, cut into slices of `width`; those met twice here once more."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = [b.column(0).to_numpy(zero_copy_only=False) for b in batches]
        values, counts = np.unique(np.concatenate(at) if at else np.zeros(0, np.int64), return_counts=True)
        for own in (values, values[counts > 1]):
            for piece in np.split(own, np.flatnonzero(np.diff(own // width)) + 1) if len(own) else []:
                slot = int(piece[0]) // width
                yield pa.RecordBatch.from_pydict({"slot": pa.array([slot], pa.int32()), "bits": pa.array([packed(piece - slot * width)], pa.binary())})

    return part


def hit_twice(width: int):
    """The positions of a slot that more than one filter part holds."""

    def slot(table: pa.Table) -> pa.Table:
        number = table.column("slot")[0].as_py()
        at = np.sort(np.concatenate([unpacked(x) for x in table.column("bits").to_pylist()]))
        again = np.unique(at[1:][at[1:] == at[:-1]]) + number * width
        return pa.table({"__at": pa.array(again, pa.int64())})

    return slot


def duplicates(df: DataFrame, keys: list[str], rows: int | None = None) -> DataFrame:
    """total, distinct_keys, duplicates of profiling.duplicates(), null being a value, but shuffling few bytes a key.

    Every partition sends a filter of its keys: positions in a space of ROOM places a row, as compressed gaps, some two
    or three bytes each. Positions that two filters share, or that one partition met twice, are looked up in the rows,
    and only those rows are counted exactly. Keys are read twice; a unique key's rows stay where they are, but for one
    in ROOM that shares its place by chance.
    """
    rows = df.count() if rows is None else rows
    space = max(rows, 1) * ROOM
    slots = -(-rows // SLICE_ROWS) or 1
    width = -(-space // slots)
    placed = positions_of(df.select(*map(quoted, keys)), keys, space)
    parts = placed.select("__at").mapInArrow(filter_parts(width), "slot int, bits binary")
    twice = parts.groupBy("slot").applyInArrow(hit_twice(width), "__at long")
    surplus = placed.join(twice, "__at", "left_semi").groupBy(*map(quoted, keys)).agg((F.count(F.lit(1)) - 1).alias("more")).agg(F.coalesce(F.sum("more"), F.lit(0)).alias("duplicates"))
    return surplus.select(F.lit(rows).cast("long").alias("total"), (F.lit(rows) - F.col("duplicates")).cast("long").alias("distinct_keys"), "duplicates")


def coded(ids: DataFrame, key: str) -> DataFrame:
    """(key, code): the distinct ids that are not null, numbered without gaps from 0, in their order. Partitions number
    their own ids and are put one after another by their sizes, of which there are as many as partitions."""
    spark = ids.sparkSession
    shared_folder(spark)  # where the checkpoint goes
    one = ids.where(F.col(key).isNotNull()).select(key).distinct()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = one.repartitionByRange(tasks, key).sortWithinPartitions(key).select(key, F.monotonically_increasing_id().alias("__n")).checkpoint()
    part, place = F.shiftright("__n", 33), F.col("__n").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    return ranged.withColumn("__part", part).join(F.broadcast(starts), "__part").select(key, (F.col("__start") + place).alias("code"))


def bitmaps(df: DataFrame, group: str, key: str, codes: DataFrame) -> DataFrame:
    """(group, bucket, bits): the keys of each group as bitmaps of BITS bits; null groups and keys are left out."""
    own = df.where(F.col(group).isNotNull()).select(group, key).join(codes, key)
    at = F.col("code") + 1
    return own.groupBy(group, F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))


def shared_bits(table: pa.Table) -> pa.Table:
    """Common keys of all pairs of groups in one bucket: a product of bit matrices, in steps of columns."""
    names = table.column(0).combine_chunks()
    raw = np.frombuffer(b"".join(table.column(2).to_pylist()), np.uint8).reshape(len(names), -1)
    common = np.zeros((len(names), len(names)), np.int64)
    for at in range(0, raw.shape[1], 512):
        bits = np.unpackbits(raw[:, at : at + 512], axis=1).astype(np.float32)
        common += (bits @ bits.T).astype(np.int64)
    i, j = np.nonzero(np.triu(common))
    return pa.table({"a": names.take(pa.array(i)), "b": names.take(pa.array(j)), "n": pa.array(common[i, j])})


def group_lists(df: DataFrame, group: str, key: str, codes: DataFrame) -> DataFrame:
    """(sizes, ids): of each key the codes of its groups, rising, each once; many keys' lists packed into a row."""
    own = df.where(F.col(group).isNotNull() & F.col(key).isNotNull()).select(group, key).join(codes, group)
    first = F.row_number().over(Window.partitionBy(key).orderBy("code")) == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def send(ids: np.ndarray, new: np.ndarray) -> pa.RecordBatch:
            again = np.append(False, (ids[1:] == ids[:-1]) & ~new[1:])
            ids, new = ids[~again], new[~again]
            sizes = np.diff(np.append(np.flatnonzero(new), len(ids))).astype(np.int32)
            return pa.RecordBatch.from_pydict({"sizes": pa.array([sizes.tobytes()], pa.binary()), "ids": pa.array([ids.tobytes()], pa.binary())})

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            held.append((batch.column(0).to_numpy().astype(np.int32), batch.column(1).to_numpy(zero_copy_only=False)))
            if sum(len(x) for x, _ in held) >= FLUSH:
                ids, new = (np.concatenate(x) for x in zip(*held, strict=True))
                last = int(np.flatnonzero(new)[-1])  # this list may go on in the next batch
                if last:
                    yield send(ids[:last], new[:last])
                held = [(ids[last:], new[last:])]
        ids, new = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (np.zeros(0, np.int32), np.zeros(0, bool))
        if len(ids):
            yield send(ids, new)

    return own.select("code", first.alias("first")).mapInArrow(run, "sizes binary, ids binary")


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The integers of the ranges [start, start + count), one range after the other."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def ends_of(sizes: np.ndarray) -> np.ndarray:
    """Of each place in lists of these sizes, where its list ends."""
    return np.repeat(np.cumsum(sizes), sizes)


def weights(lists: DataFrame) -> DataFrame:
    """(code, w): of each group the pairs that it makes with itself and later groups, over all lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sizes, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                sizes, ids = np.frombuffer(sizes, np.int32), np.frombuffer(ids, np.int32)
                code, at = np.unique(ids, return_inverse=True)
                w = np.bincount(at, weights=ends_of(sizes) - np.arange(len(ids))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(w)], ["code", "w"])

    return lists.mapInArrow(run, "code long, w long").groupBy("code").agg(F.sum("w").alias("w"))


def dealt(lists: DataFrame, width: int, split: dict[int, int], heavy: bool) -> DataFrame:
    """(block, part, sizes, own, ids): to each block of `width` groups, from each list with any of them, the list from the
    first of them on, and how many of the block's groups it starts with. Lists of a block in `split` are dealt over so
    many parts. Only the blocks in `split`, if heavy, else only the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sizes, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                sizes, ids = np.frombuffer(sizes, np.int32), np.frombuffer(ids, np.int32)
                ends, block = ends_of(sizes), ids // width
                start = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (ends[1:] != ends[:-1])))
                own, rest, block = np.diff(np.append(start, len(ids))), (ends - np.arange(len(ids)))[start], block[start]
                values, at = np.unique(block, return_inverse=True)
                part = np.arange(len(start)) % np.array([split.get(b, 1) for b in values.tolist()])[at]
                take = np.array([(b in split) == heavy for b in values.tolist()])[at]
                order = np.flatnonzero(take)
                order = order[np.lexsort((part[order], block[order]))]
                start, own, rest, block, part = (x[order] for x in (start, own, rest, block, part))
                edge = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (part[1:] != part[:-1]))) if len(order) else np.zeros(0, np.int64)
                for i, j in zip(edge.tolist(), [*edge[1:].tolist(), len(order)], strict=True):
                    packs = (rest[i:j].astype(np.int32), own[i:j].astype(np.int32), ids[spread(start[i:j], rest[i:j])])
                    yield pa.RecordBatch.from_arrays([pa.array([int(block[i])], pa.int64()), pa.array([int(part[i])], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in packs)], ["block", "part", "sizes", "own", "ids"])

    return lists.mapInArrow(run, "block long, part int, sizes binary, own binary, ids binary")


def counted_pairs(table: pa.Table) -> pa.Table:
    """(a, b, n): in how many lists of a job each pair stands whose first is of its block."""
    sizes, own, ids = (np.concatenate([np.frombuffer(x.as_py(), np.int32) for x in table.column(c)]).astype(np.int64) for c in ("sizes", "own", "ids"))
    first = spread(np.cumsum(sizes) - sizes, own)
    count = np.repeat(np.cumsum(sizes), own) - first
    pairs, n = np.unique(np.repeat(ids[first], count) << 32 | ids[spread(first, count)], return_counts=True)
    return pa.table({"a": pairs >> 32, "b": pairs & 0xFFFFFFFF, "n": n})


def listed_overlaps(df: DataFrame, group: str, key: str, groups: DataFrame, known: int) -> DataFrame:
    """overlaps() for many groups, of which `known` are coded in groups (group, code).

    A key's groups are a list of codes. Blocks of consecutive codes get the lists that hold a group of theirs, from that
    group on, and count their pairs, some PAIRS to a task: what is shuffled is at most an id for each pair of rows, and
    no table of all groups by all groups is made. A block of twice as many pairs and more, such as that of a group with
    very many keys, is dealt over parts by lists, whose counts are added up.
    """
    told = F.broadcast if known <= TOLD else lambda d: d
    lists = group_lists(df, group, key, told(groups)).checkpoint()
    w = weights(lists).checkpoint()
    total = w.agg(F.sum("w")).first()[0] or 0
    width = max(1, known * PAIRS // max(total, 1))
    # Blocks of twice their share and more only, of which there are few.
    blocks = w.groupBy(F.floor(F.col("code") / width).alias("block")).agg(F.sum("w").alias("w")).where(F.col("w") >= 2 * PAIRS).collect()
    split = {r.block: -(-r.w // PAIRS) for r in blocks}
    schema = "a long, b long, n long"
    pairs = dealt(lists, width, split, False).groupBy("block", "part").applyInArrow(counted_pairs, schema)
    if split:
        parts = dealt(lists, width, split, True).groupBy("block", "part").applyInArrow(counted_pairs, schema)
        pairs = pairs.unionByName(parts.groupBy("a", "b").agg(F.sum("n").alias("n")))
    a, b = (groups.select(F.col(group).alias(f"__{x}"), F.col("code").alias(x)) for x in "ab")
    return pairs.join(told(a), "a").join(told(b), "b").select(F.col("__a").alias("a"), F.col("__b").alias("b"), "n")


def overlaps(df: DataFrame, group: str, key: str, codes: DataFrame | None = None) -> DataFrame:
    """(a, b, n): how many distinct keys two groups share, for a <= b with any; a = b gives a group's own number.

    Up to DENSE groups: one bucket's bitmaps of all groups meet in one task, 4 KB a group, and give its counts; no keys
    are joined, and what is summed is pairs of groups, not pairs of rows. More groups: listed_overlaps().
    """
    kind = df.schema[group].dataType.simpleString()
    groups = coded(df, group)
    known = groups.count()
    if known > DENSE:
        return listed_overlaps(df, group, key, groups, known)
    maps = bitmaps(df, group, key, codes or coded(df, key)).select(group, "bucket", "bits")
    # A bitmap of fewer bytes cannot occur: Spark's are all of BITS / 8.
    return maps.groupBy("bucket").applyInArrow(shared_bits, f"a {kind}, b {kind}, n long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "n").groupBy("a", "b").agg(F.sum("n").alias("n"))
