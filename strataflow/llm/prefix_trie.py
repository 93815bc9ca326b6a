"""Operator 12: the prefix trie of conversations, from padded matrices of turn ids.

A turn's id is two 64-bit hashes of its role and text under different seeds. Conversations, as sequences of ids, are
dealt by ranges of (sequence, conv_id) to shards of about equal rows, so copies of one conversation fill as many shards
as they need. A shard lays its sequences out as a matrix of local ids padded with 0, in blocks of WIDTH depths that only
hold the rows that reach them; lexsort orders a block, and the column-wise change masks, OR-accumulated from left to
right, mark where the nodes of every depth start. Going back from the deepest column, reduceat sums members, children,
leaves and savings of all nodes of a depth at once.

Only nodes on the path of a shard's first or last sequence can have members in another shard. They leave the shard as
partial sums under a fingerprint of their path and are added up, together with corrections for neighbouring shards: of
the path that the last sequence of one and the first of the next share, each node was started twice. The other nodes are
whole. The hash over the members that end in a node on such a path is fed with slices of PART ids in order.

Turns are ordered by turn, null first, then role and SHA-256 of the text; null roles and texts are empty. Equal rows are
separate turns. Rows of a null conv_id take no part. Other columns are left out. An empty table gives no nodes. A
conversation's ids (some 100 bytes a turn, whatever its texts) are one row.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.graph import shared_folder
from strataflow.llm.oracles import crc32
from strataflow.sources.sinks import write_once

#: Turns of one shard, about.
SHARD = 200_000
#: Depths of one block of the matrix.
WIDTH = 16
#: conv_ids in one slice of a list that is hashed across shards.
PART = 512
EMPTY = hashlib.sha256(b"").hexdigest()
#: What a shard returns: whole nodes, whole nodes whose parent is not, partial nodes, slices of end lists, edges.
WHOLE, ORPHAN, PARTIAL, ENDS, EDGE = range(5)
OUT = "kind int, shard int, depth long, key binary, parent_key binary, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, part int, ids string, first array<struct<a:long,b:long,n:int>>, last array<struct<a:long,b:long>>"
TURN = pa.struct([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int32())])
SCHEMA = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("depth", pa.int64()), ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("part", pa.int32()), ("ids", pa.string()), ("first", pa.list_(TURN)), ("last", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))])
FIX = "depth long, key binary, n_children long, n_leaves long, saved_tokens long"


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, ids, sizes): each conversation's turn ids in order, with the bytes of their texts."""
    own = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    own = own.select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("sha"), F.xxhash64(F.lit(1), "role", "text").alias("a"), F.xxhash64(F.lit(2), "role", "text").alias("b"), F.octet_length("text").alias("n"))
    seq = own.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "sha", "a", "b", "n"))).alias("s"))
    return seq.select("conv_id", F.expr("transform(s, x -> named_struct('a', x.a, 'b', x.b))").alias("ids"), F.expr("transform(s, x -> x.n)").alias("sizes"))


def rebuilt(seqs: DataFrame) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of conversation c - c % 5, h = crc32(c) % 9."""
    own = seqs.withColumn("base", F.expr("conv_id - conv_id % 5")).withColumn("h", F.expr("cast(crc32(cast(conv_id as string)) % 9 as int)"))
    heads = seqs.where("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.slice("ids", 1, 8).alias("i8"), F.slice("sizes", 1, 8).alias("s8"))
    join = lambda head, c: F.expr(f"case when {head} is null then slice({c}, h + 1, size({c})) else concat(slice({head}, 1, h), slice({c}, h + 1, size({c}))) end")
    return own.join(heads, "base", "left").select("conv_id", join("i8", "ids").alias("ids"), join("s8", "sizes").alias("sizes"))


def path_keys(ids: np.ndarray) -> list[bytes]:
    """Fingerprints of all prefixes of a sequence of (a, b)."""
    h, out = hashlib.sha256(), [b""]
    for turn in np.ascontiguousarray(ids, dtype="<i8"):
        h.update(turn.tobytes())
        out.append(h.copy().digest()[:16])
    return out


def outermost(flat: np.ndarray, off: np.ndarray, size: np.ndarray, pick) -> int:
    """A row of the least or greatest sequence, as pick says; an ended sequence is less than its extensions."""
    rows, d = np.arange(len(size)), 0
    while True:
        v = np.zeros(len(rows), np.int64)
        there = size[rows] > d
        v[there] = flat[off[rows[there]] + d]
        best = pick(v)
        rows = rows[v == best]
        if best == 0 or len(rows) == 1:
            return int(rows[0])
        d += 1


class Block:
    """WIDTH depths from `at` of the rows that are longer, in lexsorted order; acc marks the starts of nodes."""

    def __init__(self, at: int, rows: np.ndarray, group: np.ndarray, carry: np.ndarray, shard: Shard):
        depth = at + np.arange(min(WIDTH, int(shard.size[rows].max()) - at))
        inside = depth[None, :] < shard.size[rows][:, None]
        place = np.where(inside, shard.off[rows][:, None] + depth[None, :], 0)
        m = np.where(inside, shard.flat[place], 0)
        order = np.lexsort((shard.conv[rows], *m.T[::-1], group))
        self.at, self.rows, self.inside = at, rows[order], inside[order]
        self.bytes = np.where(self.inside, shard.bytes[place[order]], 0)
        m, group = m[order], group[order]
        change = np.ones(m.shape, bool)
        change[1:] = m[1:] != m[:-1]
        # Rows of another group, or after a row that ended earlier, differ before this block.
        change[1:, 0] |= group[1:] != group[:-1]
        self.acc = np.logical_or.accumulate(change, axis=1)
        self.longer = shard.size[self.rows] > at + m.shape[1]
        self.group = np.cumsum(self.acc[:, -1])


class Shard:
    def __init__(self, table: pa.Table, number: int):
        self.number = number
        ids = table.column("ids").combine_chunks()
        self.conv = table.column("conv_id").to_numpy()
        self.size = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.off = np.concatenate([[0], np.cumsum(self.size)])[:-1]
        flat = ids.flatten()
        self.a, self.b = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        self.bytes = table.column("sizes").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        if len(self.bytes) == 0:
            self.bytes = np.zeros(1, np.int64)
        self.flat = self.local_ids() if len(self.a) else np.zeros(1, np.int64)
        self.ends = [outermost(self.flat, self.off, self.size, f) for f in (np.min, np.max)]
        self.keys = [path_keys(self.sequence(r)) for r in self.ends]

    def local_ids(self) -> np.ndarray:
        """Ranks of (a, b) from 1, in the order by which the shards were dealt."""
        order = np.lexsort((self.b, self.a))
        a, b = self.a[order], self.b[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(new)
        return out

    def sequence(self, row: int) -> np.ndarray:
        s = slice(self.off[row], self.off[row] + self.size[row])
        return np.stack([self.a[s], self.b[s]], axis=1)

    def blocks(self) -> list[Block]:
        rows, at, out = np.flatnonzero(self.size > 0), 0, []
        group = np.zeros(len(rows), np.int64)
        while len(rows):
            out.append(b := Block(at, rows, group, group, self))
            rows, group, at = b.rows[b.longer], b.group[b.longer], at + WIDTH
        return out

    def edge(self) -> pa.RecordBatch:
        first, last = (self.sequence(r) for r in self.ends)
        n = self.bytes[self.off[self.ends[0]] : self.off[self.ends[0]] + self.size[self.ends[0]]]
        one = [{"a": int(a), "b": int(b), "n": int(k)} for (a, b), k in zip(first, n, strict=True)]
        return batch([{"kind": EDGE, "shard": self.number, "first": one, "last": [{"a": int(a), "b": int(b)} for a, b in last]}])

    def nodes(self) -> Iterator[pa.RecordBatch]:
        """All nodes, deepest first; a depth's nodes are given when their parents are known."""
        n = len(self.conv)
        leaf, after, tail = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        least, code = np.zeros(n, np.int64), np.zeros(n, np.int8)
        held = None
        for b in reversed(self.blocks()):
            unpaid = np.cumsum(np.where(b.acc, 0, b.bytes)[:, ::-1], axis=1)[:, ::-1] + tail[b.rows][:, None]
            starts_next = after[b.rows]
            for k in reversed(range(b.acc.shape[1])):
                held, out = self.level(b.at + k + 1, b.rows, np.flatnonzero(b.acc[:, k]), b.inside[:, k], starts_next, unpaid[:, k], leaf, least, code, held)
                yield from out
                starts_next = (b.acc[:, k] & b.inside[:, k]).astype(np.int64)
            # Of the rows that this block holds only; the others have no turn here.
            tail[b.rows], after[b.rows] = unpaid[:, 0], starts_next
        rows = np.argsort(self.conv, kind="stable")
        held, out = self.level(0, rows, np.zeros(1, np.int64), np.ones(n, bool), after[rows], tail[rows], leaf, least, code, held)
        yield from out
        yield from self.given(held, None, None)

    def level(self, depth, rows, starts, inside, starts_next, unpaid, leaf, least, code, held):
        """The nodes of one depth, held until their parents are known, and those of the depth below, which now are."""
        count = np.diff(np.append(starts, len(rows)))
        node = inside[starts]
        children = np.add.reduceat(starts_next, starts)
        leaf[rows[starts[node & (children == 0)]]] = 1
        low = np.minimum.reduceat(self.conv[rows], starts)
        # Which nodes hold the first row of the shard (1) or the last (2), on whose paths nodes may go on elsewhere.
        at = np.zeros(len(starts), np.int8)
        for mark, r in ((2, self.ends[1]), (1, self.ends[0])):
            if self.size[r] >= depth:
                at[np.searchsorted(starts, int(np.flatnonzero(rows == r)[0]), side="right") - 1] = mark
        # A member that ends here: its node is whole or partial, its id goes to that node's list.
        end = np.flatnonzero(self.size[rows] == depth)
        owner = np.searchsorted(starts, end, side="right") - 1
        cut = np.flatnonzero(np.diff(owner, prepend=-1))
        lists = {int(owner[i]): rows[x] for i, x in zip(cut, np.split(end, cut[1:]), strict=False)}
        mine = {"depth": depth, "top": rows[starts[node]], "at": at[node], "conv_id": low[node], "n_convs": count[node], "n_children": children[node], "n_leaves": np.add.reduceat(leaf[rows], starts)[node], "saved_tokens": np.add.reduceat(unpaid, starts)[node], "lists": [lists.get(int(i)) for i in np.flatnonzero(node)]}
        least[rows], code[rows] = np.repeat(low, count), np.repeat(at, count)
        return mine, self.given(held, least, code)

    def given(self, held, least, code) -> Iterator[pa.RecordBatch]:
        if held is None:
            return
        d, n, at = held["depth"], len(held["top"]), held["at"]
        up = code[held["top"]] if code is not None else np.zeros(n, np.int8)
        keys = lambda marks, depth: [self.keys[m - 1][depth] if m else None for m in marks]
        shown = [EMPTY if x is None else hashlib.sha256(",".join(map(str, self.conv[x])).encode()).hexdigest() if not m else None for x, m in zip(held["lists"], at, strict=True)]
        columns = {
            "kind": pa.array(np.where(at > 0, PARTIAL, np.where(up > 0, ORPHAN, WHOLE)).astype(np.int32)),
            "shard": pa.array(np.full(n, self.number, np.int32)),
            "depth": pa.array(np.full(n, d, np.int64)),
            "key": pa.array(keys(at, d), pa.binary()),
            "parent_key": pa.array(keys(up, d - 1), pa.binary()),
            "parent_conv_id": pa.array(least[held["top"]] if least is not None else np.zeros(n, np.int64), mask=up > 0 if least is not None else np.ones(n, bool)),
            "ends_sha256": pa.array(shown, pa.string()),
        } | {c: pa.array(held[c]) for c in ("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")}
        yield pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in SCHEMA], schema=SCHEMA)
        for m, x in zip(at, held["lists"], strict=True):
            if m and x is not None:
                for i in range(0, len(x), PART):
                    yield batch([{"kind": ENDS, "shard": self.number, "depth": d, "key": self.keys[m - 1][d], "part": i // PART, "ids": ",".join(map(str, self.conv[x[i : i + PART]]))}])


def batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=SCHEMA)


def shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = [b for b in batches if b.num_rows]
    if got:
        shard = Shard(pa.Table.from_batches(got), TaskContext.get().partitionId())
        yield shard.edge()
        yield from shard.nodes()


def corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What neighbouring shards counted twice on the path that the one's last and the other's first sequence share."""
    for b in batches:
        out = []
        for r in b.to_pylist():
            first, last = r["first"], r["before"]
            same = next((i for i, (x, y) in enumerate(zip(first, last)) if (x["a"], x["b"]) != (y["a"], y["b"])), min(len(first), len(last)))  # noqa: B905
            keys, sizes = path_keys(np.array([(x["a"], x["b"]) for x in first[:same]], np.int64).reshape(-1, 2)), [x["n"] for x in first[:same]]
            saved = np.cumsum(sizes[::-1], dtype=np.int64)[::-1].tolist()
            for d in range(same + 1):
                out.append({"depth": d, "key": keys[d], "n_children": -int(d < same), "n_leaves": -int(same == len(last)), "saved_tokens": saved[max(d, 1) - 1] if same else 0})
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("depth", pa.int64()), ("key", pa.binary()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64())]))


def hash_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per node over its slices, which come in order; only the hash's state is held."""
    names, now, h = pa.schema([("key", pa.binary()), ("ends", pa.string())]), None, None
    for b in batches:
        out = []
        for key, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist(), strict=True):
            if key != now:
                if h is not None:
                    out.append((now, h.hexdigest()))
                now, h = key, hashlib.sha256(ids.encode())
            else:
                h.update(b"," + ids.encode())
        yield pa.RecordBatch.from_pylist([{"key": k, "ends": e} for k, e in out], schema=names)
    if h is not None:
        yield pa.RecordBatch.from_pylist([{"key": now, "ends": h.hexdigest()}], schema=names)


def trie_nodes(seqs: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    conv_id: smallest member; a node's members are the sequences that start with it. n_leaves and saved_tokens are over
    the node's subtree: childless nodes, and bytes of the last text times members but one. seqs has the columns of
    sequences(), one row per conv_id.
    """
    spark = seqs.sparkSession
    folder = f"{shared_folder(spark)}/trie-{uuid.uuid4().hex}"
    seqs = write_once(spark, seqs, f"{folder}/sequences")
    turns = seqs.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard))
    found = seqs.repartitionByRange(shards, "ids", "conv_id").mapInArrow(shard_nodes, OUT)
    found.write.partitionBy("kind").parquet(f"{folder}/nodes")
    nodes = spark.read.schema(OUT).parquet(f"{folder}/nodes")
    kind = lambda k: nodes.where(F.col("kind") == k)
    # One row per shard; the order of shards is that of the sequences.
    edges = kind(EDGE).select("first", F.lag("last").over(Window.orderBy("shard")).alias("before")).where("before is not null")
    fixes = edges.mapInArrow(corrections, FIX).select("depth", "key", F.lit(None).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("n_convs"), "n_children", "n_leaves", "saved_tokens")
    sums = [F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"))]
    parents = kind(PARTIAL).select("depth", "key", "parent_key", *fixes.columns[2:]).unionByName(fixes.withColumn("parent_key", F.lit(None).cast("binary")))
    shared = parents.groupBy("depth", "key").agg(F.max("parent_key").alias("parent_key"), *sums)
    ends = kind(ENDS).select("key", "shard", "part", "ids").repartition("key").sortWithinPartitions("key", "shard", "part").select("key", "ids").mapInArrow(hash_parts, "key binary, ends string")
    shared = write_once(spark, shared.join(ends, "key", "left"), f"{folder}/shared")
    tops = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("top"))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    orphans = kind(ORPHAN).join(tops, "parent_key", "left").withColumn("parent_conv_id", F.col("top")).select(*names)
    paths = shared.join(tops, "parent_key", "left").select("conv_id", "depth", F.col("top").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"))
    return kind(WHOLE).select(*names).unionByName(orphans).unionByName(paths)


ORACLE = f"""
with own as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
placed as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as i, sha256(role || chr(0) || text) as id, strlen(text) as n from own),
convs as (select distinct conv_id, conv_id - conv_id % 5 as base, {crc32("cast(conv_id as varchar)")} % 9 as h from own),
built as (
  select c.conv_id, p.i, p.id, p.n from convs c join placed p on p.conv_id = c.base and p.i <= h union all
  select c.conv_id, h + p.i, p.id, p.n from convs c join placed p on p.conv_id = c.conv_id and p.i > h),
seqs as (select c.conv_id, coalesce(list(id order by i) filter (where id is not null), []) as s, coalesce(list(n order by i) filter (where id is not null), []) as ns from convs c left join built b using (conv_id) group by c.conv_id),
steps as (select conv_id, len(s) as whole, unnest(range(len(s) + 1)) as d, s, ns from seqs),
members as (select conv_id, d, whole, s[:d] as path, case when d > 0 then ns[d] else 0 end as n from steps),
nodes as (select path, d, min(conv_id) as conv_id, count(*) as n_convs, max(n) as n,
  sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where whole = d), '')) as ends from members group by path, d),
kids as (select path[:d - 1] as path, count(*) as k from nodes where d > 0 group by 1),
full_nodes as (select n.*, coalesce(k, 0) as k from nodes n left join kids using (path)),
upward as (select path[:u] as path, case when k = 0 then 1 else 0 end as leaf, (n_convs - 1) * n as saved from (select *, unnest(range(d + 1)) as u from full_nodes)),
sums as (select path, sum(leaf) as n_leaves, sum(saved) as saved from upward group by path)
select a.conv_id, cast(a.d as bigint) as depth, p.conv_id as parent_conv_id, a.n_convs, a.k as n_children, cast(n_leaves as bigint) as n_leaves, cast(saved as bigint) as saved_tokens, a.ends as ends_sha256
from full_nodes a join sums using (path) left join nodes p on a.d > 0 and p.path = a.path[:a.d - 1]
"""
