"""Operator 9: n-gram Jaccard join over a prefix tree.

1. Each document becomes its set of distinct k-word shingles (64-bit fingerprints). Documents of equal sets are one
   class, held by its smallest doc_id; only classes go on.
2. Shingles are dealt by fingerprint to shards as packed arrays; each shard finds the shingles of two documents or
   more and their frequency. Hot shingles are known beforehand, from the counts of the first pass: they are HOT at most,
   whatever the input, all with two HOT-th parts of all shingles among them. They are dealt by document instead and
   take that pass's count as their frequency, which only orders them, so no shard holds all documents of one. A class with fewer shared shingles than the threshold asks for links with nothing and ends here.
3. Sets are put in one global order, rare shingles first. Linked sets share a shingle among the first
   n - ceil(t n) + 1 of each; classes that share one there are joined into candidate groups (components of
   star-shaped edges, never all pairs).
4. Groups are joined in a prefix tree: sets, in global order with the frequent shingles first, are stored in a radix tree;
   a set walks it sharing the overlap of each path with all sets below, and leaves a subtree when the shingles that
   remain, in the set or below, cannot reach the threshold. Every link between classes is found.
   A group over LIMIT shingles is cut into tiles, each joined with itself and with every other tile of the group, in
   tasks of their own.
5. Components over the links and the classes' members give component_id. n_links counts the other documents that a
   document links with: the members of all linked classes and the others of its own. class_links() gives the pairs.

Counts, candidates and thresholds cover all documents; there is no cap. Null or empty texts have an empty set and link
with nothing. doc_id identifies a document; rows of a null doc_id give n_shingles and a null component_id and n_links. Repeated
texts are one class. Other columns are left out.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.graph import components, keep
from strataflow.llm.textops import Words, mix, shingle_sets, signed, slices

K, NUM, DEN = 5, 75, 100
#: Shingles that one task of the tree join holds for a side.
LIMIT = 600_000
#: Shingles gathered before packed arrays are sent, and characters of text for one shard.
FLUSH, SHARD_CHARS = 500_000, 8_000_000
#: Hot shingles: those counted for one HOT-th part of all shingles at least, so there are no more than so many.
HOT = 200_000


def set_rows(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, d1, d2, g, c): size and digest of each document's set; and, with g, shingles that make up a HOT-th
    part of a flush of them, with their count c in it. Summed over flushes, the count of a shingle falls short of its
    documents by less than a HOT-th part of all shingles."""

    def heavy(held: list[np.ndarray]) -> pa.RecordBatch:
        g, c = np.unique(np.concatenate(held), return_counts=True)
        much = c >= max(2, -(-sum(map(len, held)) // HOT))
        none = pa.nulls(int(much.sum()), pa.int64())
        return pa.RecordBatch.from_arrays([none] * 4 + [pa.array(signed(g[much])), pa.array(c[much].astype(np.int64))], ["doc_id", "n", "d1", "d2", "g", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for part in slices(batch):
                row, h = shingle_sets(Words(part.column(1), lower=True), k)
                edge = np.searchsorted(row, np.arange(part.num_rows + 1))
                sums = np.zeros((2, len(h) + 1), np.uint64)
                np.cumsum(h, out=sums[0, 1:])
                np.cumsum((h ^ (h >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25) ^ (h >> np.uint64(32)), out=sums[1, 1:])
                d = sums[:, edge[1:]] - sums[:, edge[:-1]]
                none = pa.nulls(part.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(edge)), pa.array(signed(np.ascontiguousarray(d[0]))), pa.array(signed(np.ascontiguousarray(d[1]))), none, none], ["doc_id", "n", "d1", "d2", "g", "c"])
                held.append(h)
                count += len(h)
                if count >= FLUSH:
                    yield heavy(held)
                    held, count = [], 0
        if count:
            yield heavy(held)

    return docs.mapInArrow(run, "doc_id long, n long, d1 long, d2 long, g long, c long")


def hot_shingles(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hot shingles, rising, and their counts; HOT at most."""
    total = rows.agg(F.sum("n")).first()[0] or 0
    found = rows.where("g is not null").groupBy("g").agg(F.sum("c").alias("c")).where(F.col("c") >= max(2.0, total / HOT)).toArrow()
    g, c = found.column("g").to_numpy().astype(np.int64).view(np.uint64), found.column("c").to_numpy().astype(np.int64)
    order = np.argsort(g)
    return g[order], c[order]


def packed(docs: DataFrame, k: int, shards: int, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(shard, docs, sizes, counts, grams, dfs): per shard, documents and the fingerprints of theirs that fall in it;
    dfs only for hot shingles, which are in shards by document, from `shards` on."""
    told = docs.sparkSession.sparkContext.broadcast(hot)

    def send(doc: np.ndarray, size: np.ndarray, h: np.ndarray, shard: np.ndarray, df: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        order = np.argsort(shard, kind="stable")
        doc, size, h, shard = doc[order], size[order], h[order], shard[order]
        df = df[order] if df is not None else None
        edge = np.flatnonzero(np.append(np.append(True, shard[1:] != shard[:-1]), True)) if len(shard) else np.zeros(1, np.int64)
        for lo in range(0, len(edge) - 1, 256):
            rows: list[list] = [[], [], [], [], [], []]
            for i, j in zip(edge[:-1][lo : lo + 256].tolist(), edge[1:][lo : lo + 256].tolist(), strict=True):
                first = np.flatnonzero(np.append(True, doc[i + 1 : j] != doc[i : j - 1]))
                for col, x in zip(rows, (int(shard[i]), doc[i:j][first].tobytes(), size[i:j][first].astype(np.int32).tobytes(), np.diff(np.append(first, j - i)).astype(np.int32).tobytes(), h[i:j].tobytes(), df[i:j].tobytes() if df is not None else None), strict=True):
                    col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), *(pa.array(x, pa.binary()) for x in rows[1:])], ["shard", "docs", "sizes", "counts", "grams", "dfs"])

    def both(held: list) -> Iterator[pa.RecordBatch]:
        grams, counts = told.value
        doc, size, h = (np.concatenate(x) for x in zip(*held, strict=True))
        at = np.minimum(np.searchsorted(grams, h), max(0, len(grams) - 1))
        is_hot = grams[at] == h if len(grams) else np.zeros(len(h), bool)
        cold = ~is_hot
        yield from send(doc[cold], size[cold], h[cold], (h[cold] >> np.uint64(44)).astype(np.int64) % shards, None)
        if is_hot.any():
            d = doc[is_hot]
            yield from send(d, size[is_hot], h[is_hot], shards + (mix(d.view(np.uint64)) % np.uint64(shards)).astype(np.int64), counts[at[is_hot]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for part in slices(batch):
                row, h = shingle_sets(Words(part.column(1), lower=True), k)
                size = np.bincount(row, minlength=part.num_rows)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                held.append((ids[row], size[row], h))
                n += len(h)
                if n >= FLUSH:
                    yield from both(held)
                    held, n = [], 0
        if n:
            yield from both(held)

    return docs.mapInArrow(run, "shard int, docs binary, sizes binary, counts binary, grams binary, dfs binary")


def shared(parts: DataFrame) -> DataFrame:
    """(doc_id, n, m, grams, dfs): of each shard, a document's shingles that another one has, and their frequencies."""

    def run(table: pa.Table) -> pa.Table:
        cat = lambda c, t: np.concatenate([np.frombuffer(x.as_py(), t) for x in table.column(c)])
        docs, sizes, counts, grams = cat("docs", np.int64), cat("sizes", np.int32), cat("counts", np.int32), cat("grams", np.uint64)
        which = np.repeat(np.arange(len(docs)), counts)
        if table.column("dfs").null_count:
            order = np.argsort(grams)
            g = grams[order]
            first = np.append(True, g[1:] != g[:-1])
            df = np.diff(np.append(np.flatnonzero(first), len(g)))[np.cumsum(first) - 1]
            two = df > 1
            which, g, df = which[order][two], g[two], df[two].astype(np.int64)
            order = np.argsort(which, kind="stable")
            which, g, df = which[order], g[order], df[order]
        else:
            g, df = grams, cat("dfs", np.int64)
        edge = np.flatnonzero(np.append(np.append(True, which[1:] != which[:-1]), True)) if len(which) else np.zeros(1, np.int64)
        at = which[edge[:-1]]
        spans = list(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True))
        return pa.table({"doc_id": docs[at], "n": sizes[at].astype(np.int64), "m": np.diff(edge).astype(np.int64), "grams": pa.array([g[i:j].tobytes() for i, j in spans], pa.binary()), "dfs": pa.array([df[i:j].tobytes() for i, j in spans], pa.binary())})

    return parts.groupBy("shard").applyInArrow(run, "doc_id long, n long, m long, grams binary, dfs binary")


def ordered(grams: list, dfs: list) -> np.ndarray:
    """A set's shared shingles in global order: rare first, ties by fingerprint."""
    g = np.concatenate([np.frombuffer(x, np.uint64) for x in grams])
    f = np.concatenate([np.frombuffer(x, np.int64) for x in dfs])
    return g[np.lexsort((g, f))]


def order_sets(docs: DataFrame, num: int, den: int) -> DataFrame:
    """(doc_id, n, grams, prefix): grams in global order; prefix, those of them among the set's first
    n - ceil(t n) + 1 shingles, unshared ones coming first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for i in range(batch.num_rows):
                doc, n = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                g = ordered(batch.column(2)[i].as_py(), batch.column(3)[i].as_py())
                size = n - -(-num * n // den) + 1 - (n - len(g))
                for col, x in zip(out, (doc, n, g.tobytes(), signed(g[: max(0, size)]).tolist()), strict=True):
                    col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.list_(pa.int64()))], ["doc_id", "n", "grams", "prefix"])

    return docs.mapInArrow(run, "doc_id long, n long, grams binary, prefix array<long>")


class Tree:
    """A radix tree over sets as ascending arrays of ranks, in flat arrays. Nodes stand level by level, so that the
    children of a node are neighbours; node i covers order[lo[i]:hi[i]], of which the first own[i] end at it."""

    def __init__(self, sets: list[np.ndarray], sizes: list[int]):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">i4").tobytes())
        lens, ns = np.array([len(sets[i]) for i in order]), np.array([sizes[i] for i in order])
        todo, rows, edges, at = [(0, len(order), 0)] if order else [], [], [], 0
        while at < len(todo):
            lo, hi, depth = todo[at]
            at += 1
            first, last = sets[order[lo]], sets[order[hi - 1]]
            m = min(len(first), len(last))
            differ = np.flatnonzero(first[depth:m] != last[depth:m])
            end = depth + int(differ[0]) if len(differ) else m
            i, child = lo, len(todo)
            while i < hi and lens[i] == end:
                i += 1
            own = i - lo
            while i < hi:
                j = bisect_right(order, sets[order[i]][end], i, hi, key=lambda x: sets[x][end])
                todo.append((i, j, end))
                i = j
            edges.append(first[depth:end])
            rows.append((lo, own, child, len(todo) - child, end - depth, end, int(ns[lo:hi].min()), int(ns[lo:hi].max()), int(lens[lo:hi].max()), int(edges[-1][-1]) if end > depth else -1))
        self.order, self.edges = np.array(order, np.int64), np.concatenate(edges) if edges else np.zeros(0, np.int32)
        cols = np.array(rows, np.int64).reshape(-1, 10).T
        self.lo, self.own, self.child, self.children, self.size, self.end, self.least, self.most, self.longest, self.last = cols
        self.start = np.cumsum(self.size) - self.size


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The integers of the ranges [start, start + count), one range after the other."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def partners(sets: list[np.ndarray], sizes: list[int], left: int, num: int, den: int, same: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(x, ys): all sets ys that link with x, between sets[:left] and sets[left:], or, if same, among sets[:left], each
    pair once. Sets are arrays of global ranks, rising. The tree holds the sets of the first side; a walk takes the
    nodes of one level together."""
    tree = Tree(sets[:left], sizes[:left])
    if not len(tree.order):
        return
    size = np.array(sizes, np.int64)
    mark = np.zeros(2 + max((int(s[-1]) for s in sets if len(s)), default=0), bool)
    for x in range(left) if same else range(left, len(sets)):
        own, n, out = sets[x], sizes[x], []
        mark[own] = True
        node, have = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(node):
            # Sizes that can link with n at all; then the overlap that is still possible below.
            fit = ~(too_small(tree.most[node], n, num, den) | too_small(n, tree.least[node], num, den))
            node, have = node[fit], have[fit]
            hit = np.append(0, np.cumsum(mark[tree.edges[spread(tree.start[node], tree.size[node])]]))
            stop = np.cumsum(tree.size[node])
            have = have + hit[stop] - hit[stop - tree.size[node]]
            rest = np.minimum(tree.longest[node] - tree.end[node], len(own) - np.searchsorted(own, tree.last[node], "right"))
            need = -(-num * (n + np.maximum(tree.least[node], -(-num * n // den))) // (num + den))
            fit = have + rest >= need
            node, have = node[fit], have[fit]
            y = tree.order[spread(tree.lo[node], tree.own[node])]
            both = np.repeat(have, tree.own[node])
            y = y[den * both >= num * (n + size[y] - both)]
            out.append(y[y < x] if same else y)
            have = np.repeat(have, tree.children[node])
            node = spread(tree.child[node], tree.children[node])
        mark[own] = False
        ys = np.concatenate(out)
        if len(ys):
            yield x, ys


def links_within(sets: list[np.ndarray], sizes: list[int], left: int, num: int, den: int, same: bool) -> list[tuple[int, int]]:
    """Every link of partners() as a pair."""
    return [(x, y) for x, ys in partners(sets, sizes, left, num, den, same) for y in ys.tolist()]


def too_small(a: int, b: int, num: int, den: int) -> bool:
    """Whether a set of a elements is too small for a link with one of b."""
    return den * a < num * b


def job_sets(table: pa.Table) -> tuple[pa.Table, list[np.ndarray], list[int], int, bool]:
    """The job's rows, their sets as ranks, sizes, how many are of the first side, and whether it is joined with itself."""
    table = table.sort_by([("side", "ascending"), ("doc_id", "ascending")])
    raw = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("grams")]
    left = int(np.sum(table.column("side").to_numpy() == 0))
    # Ranks in this job's own order, frequent first: sets of one group then share long beginnings.
    values, code, count = np.unique(np.concatenate(raw), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int32)
    rank[np.lexsort((values, -count))] = np.arange(len(values), dtype=np.int32)
    code = rank[code]
    cuts = np.cumsum([len(x) for x in raw])[:-1]
    return table, [np.sort(x) for x in np.split(code, cuts)], table.column("n").to_pylist(), left, bool(table.column("same")[0].as_py())


def tree_join(tiles: DataFrame, num: int, den: int) -> DataFrame:
    """tiles: (job, same, side, doc_id, n, members, grams). Of each job, rows (a, b, null) that connect what its links
    connect, and (a, null, w): members w of all classes that link with a. Rows grow with the sets, not with the links."""

    def run(table: pa.Table) -> pa.Table:
        table, sets, sizes, left, same = job_sets(table)
        ids, members = table.column("doc_id").to_numpy(), table.column("members").to_numpy()
        total, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
        edges: list[tuple[int, int]] = []
        for x, ys in partners(sets, sizes, left, num, den, same):
            total[x] += members[ys].sum()
            total[ys] += members[x]
            new, at = np.unique(label[ys], return_index=True)
            at = at[new != label[x]]
            if len(at):
                edges += [(x, y) for y in ys[at].tolist()]
                label[np.isin(label, label[ys[at]])] = label[x]
        linked = np.flatnonzero(total)
        a, b = np.array(edges, np.int64).reshape(-1, 2).T
        none = pa.nulls(len(linked), pa.int64())
        return pa.table({"a": np.concatenate([ids[a], ids[linked]]), "b": pa.chunked_array([pa.array(ids[b], pa.int64()), none]), "w": pa.chunked_array([pa.nulls(len(a), pa.int64()), pa.array(total[linked])])})

    return tiles.groupBy("job").applyInArrow(run, "a long, b long, w long")


def tree_pairs(tiles: DataFrame, num: int, den: int) -> DataFrame:
    """Every link (a, b) of each job, sent on in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sets, sizes, left, same = job_sets(pa.Table.from_batches(batches))
        ids = table.column("doc_id").to_numpy()
        for x, ys in partners(sets, sizes, left, num, den, same):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[x], ids[ys])), pa.array(np.maximum(ids[x], ids[ys]))], ["a", "b"])

    return tiles.groupBy("job").applyInArrow(run, "a long, b long")


def candidates(docs: DataFrame, num: int, den: int, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sets of all documents, classes (n, d1, d2, rep, members), and the tiles of the tree join."""
    own = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    rows = keep(set_rows(own, k))
    sets, hot = rows.where("g is null").select("doc_id", "n", "d1", "d2"), hot_shingles(rows)
    classes = sets.where("n > 0 and doc_id is not null").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("members"))
    chars = own.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(32, chars // SHARD_CHARS)
    # Copies are counted along (texts need no shuffle then); only classes' smallest members go on from here.
    rows = shared(packed(own.where("text is not null and doc_id is not null"), k, shards, hot))
    common = rows.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").groupBy("doc_id").agg(F.max("n").alias("n"), F.sum("m").alias("m"), F.collect_list("grams").alias("grams"), F.collect_list("dfs").alias("dfs"))
    common = common.where(f"{den} * m >= {num} * n").select("doc_id", "n", "grams", "dfs")
    left = keep(order_sets(common, num, den))
    first = left.select("doc_id", F.explode("prefix").alias("g"))
    star = first.groupBy("g").agg(F.min("doc_id").alias("hub"), F.count(F.lit(1)).alias("c")).where("c > 1")
    group = components(first.join(star, "g").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct())
    # Tiles of a group: a hash deals its sets into as many as its shingles need.
    held = left.select("doc_id", "n", "grams").join(group.withColumnsRenamed({"node": "doc_id", "component": "g"}), "doc_id")
    weight = held.groupBy("g").agg(F.sum(F.length("grams") / 8).alias("w"))
    held = held.join(classes.select(F.col("rep").alias("doc_id"), "members"), "doc_id").join(weight, "g").withColumn("t", F.greatest(F.lit(1), F.ceil(F.col("w") / LIMIT)).cast("int")).drop("w")
    held = held.withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("t")).cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("t") - 1)))
    held = held.select(F.struct("g", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).alias("job"), (F.col("own") == F.col("other")).alias("same"), F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "doc_id", "n", "members", "grams")
    return sets, classes, held


def class_links(docs: DataFrame, num: int = NUM, den: int = DEN, k: int = K) -> tuple[DataFrame, DataFrame]:
    """(a, b), a < b: every link between classes, each named by its smallest doc_id; and the membership (doc_id, rep)
    of documents that have shingles. Documents of one class link with each other besides."""
    sets, classes, tiles = candidates(docs, num, den, k)
    return tree_pairs(tiles, num, den), sets.where("doc_id is not null").join(classes, ["n", "d1", "d2"]).select("doc_id", "rep")


def jaccard_join(docs: DataFrame, num: int = NUM, den: int = DEN, k: int = K) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links per document."""
    sets, classes, tiles = candidates(docs, num, den, k)
    found = keep(tree_join(tiles, num, den))
    label = components(found.where("b is not null").select("a", "b"))
    other = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("w").alias("w"))
    whole = classes.join(label.withColumnRenamed("node", "rep"), "rep", "left").join(other, "rep", "left")
    whole = whole.select("n", "d1", "d2", F.coalesce("component", "rep").alias("component_id"), (F.coalesce("w", F.lit(0)) + F.col("members") - 1).alias("n_links"))
    n_links = F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0)))
    return sets.join(whole, ["n", "d1", "d2"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), n_links.alias("n_links"))


ORACLE = f"""
with recursive own as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as words from documents),
grams as (select distinct doc_id, array_to_string(words[i : i + {K - 1}], ' ') as gram from (select doc_id, words, unnest(range(1, greatest(len(words) - {K - 2}, 2))) as i from own where len(words) > 0)),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
pairs as (select a.doc_id as x, b.doc_id as y, count(*) as c from grams a join grams b on a.gram = b.gram and a.doc_id != b.doc_id group by all),
links as (select x, y from pairs join sizes s on s.doc_id = x join sizes t on t.doc_id = y where {DEN} * c >= {NUM} * (s.n + t.n - c)),
reach(x, y) as (select x, y from links union select r.x, l.y from reach r join links l on r.y = l.x)
select o.doc_id, coalesce(n, 0) as n_shingles, least(o.doc_id, coalesce((select min(y) from reach where x = o.doc_id), o.doc_id)) as component_id,
  (select count(*) from links where x = o.doc_id) as n_links
from own o left join sizes using (doc_id)
"""
