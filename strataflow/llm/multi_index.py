"""Operator 3: nearest neighbours by an inverted multi-index.

The two halves of a normalised vector are quantised separately; a cell is a pair of centroids and every vector is
indexed in its cell. A query walks the cells by rising sum of its two half distances, with a heap over the rows of
sorted half distances, until the cells walked hold a share of the index, the reach; all their entries are reranked by
exact cosine.

Codebooks are k-means over a sample of distinct vectors, those of least hash: SAMPLE of them and SAMPLE_BYTES at most.
The number of centroids grows with the fourth root of the index (CENTROIDS times it). The reach is read off the same
sample: the share of it that PROBES of its vectors must walk to find GOAL of their nearest neighbours. In a larger index
neighbours are nearer, so it errs to the safe side; clustered vectors need a few hundredths, isotropic noise nearly half.
Every vector is indexed; nothing is capped. Recall@5 against brute force is measured in the tests (0.9 at least).

Equal vectors are one entry with its TOP + 1 smallest ids, so any number of copies costs one comparison. Work is dealt
by first centroid, in blocks of BLOCK entries and QUERIES queries; a task sends on ids and scores only. Where vectors
are parallel, all that tie with the nearest ones are scored, and the smallest ids stay.

Vectors that are null, empty, zero, of another length than most, or hold a null or non-finite component take no part.
Rows with a null vec_id take no part. Repeated vec_ids count once (the smallest vector by content). Fewer candidates
than TOP give fewer rows; an empty table gives none. Ties of score go to the smaller vec_id. Other columns stay out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.graph import keep

TOP, EVERY, GOAL, CENTROIDS, PROBES = 5, 50, 0.97, 5, 400
SAMPLE, SAMPLE_BYTES = 20_000, 32 << 20
BLOCK, QUERIES = 8_192, 16_384
#: What the cosine by matrix product may differ from the exact one, with a wide margin.
SLACK = 1e-9
SCHEMA = "query_id long, rank int, vec_id long, score double"
PAIRS = "query_id long, vec_id long, score double"


def kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = nearest(x, c)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        count = np.bincount(own, minlength=len(c))
        c[count > 0] = sums[count > 0] / count[count > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x @ c.T - (c * c).sum(axis=1) / 2).argmax(axis=1)


def gaps(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances to all centroids, less the vector's own square, which the order of cells doesn't need."""
    return (c * c).sum(axis=1) - 2 * (x @ c.T)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings the largest component near 1: exact, and no square over- or underflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def normal(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosine of one vector with rows, both scaled; the same sum for each row, so equal rows score equally."""
    return (v * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((v * v).sum(axis=1)))


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, v): valid vectors as doubles, one per vec_id. Only ids are shuffled where none repeats."""
    v = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    good = "vec_id is not null and v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x != 0)"
    valid = v.where(good)
    twice = keep(valid.groupBy("vec_id").count().where("count > 1").select("vec_id"))
    if twice.isEmpty():
        return valid
    one = valid.join(twice, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("v").alias("v"))
    return valid.join(twice, "vec_id", "left_anti").union(one)


def walk(d1: np.ndarray, d2: np.ndarray, sizes: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Occupied cells by rising d1 + d2 until they hold `least` entries."""
    o1, o2 = np.argsort(d1, kind="stable").tolist(), np.argsort(d2, kind="stable").tolist()
    a, b, have = d1[o1].tolist(), d2[o2].tolist(), sizes[np.ix_(o1, o2)].tolist()
    heap, out, got = [(a[0] + b[0], 0, 0)], [], 0
    while heap and got < least:
        _, i, j = heapq.heappop(heap)
        if have[i][j]:
            out.append((o1[i], o2[j]))
            got += have[i][j]
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return out


def reach_of(x: np.ndarray, c1: np.ndarray, c2: np.ndarray, top: int, goal: float) -> float:
    """The share of the sample x whose cells must be walked to find `goal` of the nearest neighbours inside it."""
    half, n = c1.shape[1], len(x)
    asked = np.linspace(0, n - 1, min(PROBES, n)).astype(int)
    own1, own2 = nearest(x[:, :half], c1), nearest(x[:, half:], c2)
    need = []
    for i in asked.tolist():
        cos = x @ x[i]
        cos[i] = -np.inf
        near = np.argsort(-cos, kind="stable")[: min(top, n - 1)]
        far = gaps(x[i : i + 1, :half], c1)[0][own1] + gaps(x[i : i + 1, half:], c2)[0][own2]
        need += np.searchsorted(np.sort(far), far[near], "right").tolist()
    return float(np.quantile(need, goal)) / n if need else 1.0


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def best_of(cos: np.ndarray, q: np.ndarray, who: list[int], v: np.ndarray, ids: list[list[int]], top: int) -> Iterator[tuple[int, int, float]]:
    """(query, id, score) of the `top` nearest in cos, by exact score and id. cos is -inf where a cell was not walked."""
    take = min(top + 1, cos.shape[1])  # one more: the query itself may be among them
    floor = np.partition(cos, cos.shape[1] - take, axis=1)[:, cos.shape[1] - take] - SLACK
    for r, least in enumerate(floor.tolist()):
        cols = np.flatnonzero((cos[r] >= least) & (cos[r] > -np.inf))
        score = cosines(q[r], v[cols])
        # Of equal scores the smallest ids; only so many entries can matter.
        found = [(-s, x) for s, c in zip(score.tolist(), cols.tolist(), strict=True) for x in ids[c] if x != who[r]]
        for s, x in heapq.nsmallest(top, found):
            yield who[r], x, -s


def search(rows: DataFrame, top: int = TOP, every: int = EVERY, reach: float | None = None, cells: int | None = None, queries: DataFrame | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: each query's `top` nearest of the entries that its walk reached. reach and cells
    (centroids a half) are found as said above unless given. queries: (vec_id, v) as in usable()."""
    spark = rows.sparkSession
    valid = usable(rows)
    dims = valid.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if dims is None:
        return spark.createDataFrame([], SCHEMA)
    dim = dims["dim"]
    valid = valid.where(F.size("v") == dim)
    if dim == 1:  # a zero more changes no cosine and gives the second half a component
        pad = F.concat("v", F.array(F.lit(0.0)))
        valid, dim = valid.withColumn("v", pad), 2
        queries = queries.withColumn("v", pad) if queries is not None else None
    valid = keep(valid)
    # Equal vectors are one entry. The rank filter runs before the shuffle too, so copies don't gather.
    order = Window.partitionBy("v").orderBy("vec_id")
    entries = keep(valid.withColumn("at", F.row_number().over(order)).where(F.col("at") <= top + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    n = entries.count()
    few = entries.orderBy(F.xxhash64("v"), "v").limit(max(1, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))).select("v").toArrow()
    book = normal(matrix(few.column("v").combine_chunks(), dim))
    half, k = dim // 2, cells or int(min(256, max(8, round(CENTROIDS * n**0.25))))
    c1, c2 = kmeans(book[:, :half], k), kmeans(book[:, half:], k)
    share = reach_of(book, c1, c2, top, GOAL) if reach is None else reach
    held = spark.sparkContext.broadcast((c1, c2))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = held.value
        for batch in batches:
            if batch.num_rows:
                x = normal(matrix(batch.column(0), dim))
                yield pa.RecordBatch.from_arrays([pa.array(nearest(x[:, :half], a).astype(np.int32)), pa.array(nearest(x[:, half:], b).astype(np.int32)), *batch.columns], ["c1", "c2", "v", "ids"])

    index = keep(entries.select("v", "ids").mapInArrow(assign, "c1 int, c2 int, v array<double>, ids array<long>"))
    sizes = np.zeros((len(c1), len(c2)), np.int64)
    for r in index.groupBy("c1", "c2").count().collect():  # at most a row a cell
        sizes[r["c1"], r["c2"]] = r["count"]
    told = spark.sparkContext.broadcast(sizes)
    asked = valid.where(F.col("vec_id") % every == 0) if queries is None else queries
    rounds = max(1, -(-asked.count() // QUERIES))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (a, b), have = held.value, told.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = normal(matrix(batch.column(1), dim))
            d1, d2 = gaps(x[:, :half], a), gaps(x[:, half:], b)
            who, first, seen = [], [], []
            for q in range(len(x)):
                walked: dict[int, list[int]] = {}
                for i, j in walk(d1[q], d2[q], have, share * have.sum()):
                    walked.setdefault(i, []).append(j)
                who += [q] * len(walked)
                first += walked
                seen += walked.values()
            at = pa.array(who, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(first, pa.int32()), batch.column(0).take(at), batch.column(1).take(at), pa.array(seen, pa.list_(pa.int32()))], ["c1", "query_id", "q", "seen"])

    probes = asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")).mapInArrow(probe, "c1 int, query_id long, q array<double>, seen array<int>")
    # Blocks by first centroid: a row a centroid.
    blocks = F.broadcast(spark.createDataFrame([(i, max(1, -(-int(s) // BLOCK))) for i, s in enumerate(sizes.sum(axis=1))], "c1 int, blocks int"))
    each = lambda count: F.explode(F.sequence(F.lit(0), count - 1))
    left = index.join(blocks, "c1").withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")).withColumn("round", each(F.lit(rounds))).select("c1", "block", "round", "c2", "v", "ids")
    right = probes.join(blocks, "c1").withColumn("block", each(F.col("blocks"))).withColumn("round", F.pmod(F.xxhash64("query_id"), F.lit(rounds)).cast("int")).select("c1", "block", "round", "query_id", "q", "seen")

    def rerank(entry: pa.Table, query: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if entry.num_rows and query.num_rows:
            entry = entry.sort_by("c2")
            v, q = scaled(matrix(entry.column("v").combine_chunks(), dim)), scaled(matrix(query.column("q").combine_chunks(), dim))
            vn, qn = normal(v), normal(q)
            cell, edge = np.unique(entry.column("c2").to_numpy(), return_index=True)
            edge = np.append(edge, len(v))
            ids, who, seen = entry.column("ids").to_pylist(), query.column("query_id").to_pylist(), query.column("seen").to_pylist()
            for lo in range(0, len(q), 512):
                some = seen[lo : lo + 512]
                went = np.zeros((len(some), len(c2)), bool)
                for r, cols in enumerate(some):
                    went[r, cols] = True
                cos = np.full((len(some), len(v)), -np.inf)
                for c, i, j in zip(cell.tolist(), edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    r = np.flatnonzero(went[:, c])
                    cos[r, i:j] = qn[lo + r] @ vn[i:j].T
                out += best_of(cos, q[lo : lo + 512], who[lo : lo + 512], v, ids, top)
        cols = list(zip(*out, strict=True)) if out else [[], [], []]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    key = ["c1", "block", "round"]
    scored = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(rerank, PAIRS)
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
