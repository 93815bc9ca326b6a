"""Operator 10: benchmark passages in documents, by SimHash of item-sized windows.

For an item of m words, the windows of a document are all runs of m words (the whole document, if shorter). Windows
worth a fingerprint are those that hold as many of the item's shingles as the least similarity needs, in any order; a
window with fewer cannot reach it, so the others are left out exactly.
A 64-bit SimHash of the window's shingle counts is looked up in RADIUS + 1 tables of bit blocks, by item length: two
fingerprints within RADIUS bits agree in at least one block, so no fingerprint within the radius is missed. What is
found is verified by exact weighted similarity: sum of least counts over sum of greatest counts of k-word shingles.

RADIUS lies over four standard deviations above the mean distance at the least similarity: there 17 % of the bits
differ, so blocks that guarantee a match hold under 64 / 25 bits. Tables of such blocks return most items of a length;
no split of any number of bits does better with a guarantee (1 / 0.17 bits a block at most). The shingle count before
and the distance after do the pruning.

Words are runs of non-space bytes in lower case (A-Z). The benchmark is the stated query set; it is taken in blocks of
BLOCK items, each broadcast (at most BLOCK items are held at once), and every block is run against all documents. The
number of blocks changes no row: of all windows and all texts of an item_id, the one of greatest similarity stays, the
first of equal ones.
Null or empty texts and items match nothing. A document or item under k words is one shingle, its whole sequence.
Rows that repeat a doc_id, a null one too, count as one document and give its best window. Other columns are left out.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.textops import Words, mix, slices

K, LEAST, RADIUS, BLOCK = 5, 0.75, 24, 10_000
SCHEMA = "doc_id long, item_id long, start_word int, similarity double"


def simhash(grams: np.ndarray) -> int:
    """64 majority bits over the grams, each with its count as weight."""
    bits = (mix(grams)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    most = 2 * bits.sum(axis=0, dtype=np.int64) > len(grams)
    return int((most.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def bit_blocks(f: int, blocks: int) -> list[tuple[int, int]]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(i, (f >> edges[i]) & ((1 << (edges[i + 1] - edges[i])) - 1)) for i in range(blocks)]


def similarity(a: Counter, b: Counter) -> float:
    both = sum(min(n, b[g]) for g, n in a.items() if g in b)
    return both / (sum(a.values()) + sum(b.values()) - both)


class Items:
    """The items of one block with their shingles, fingerprints and bit-block tables by length."""

    def __init__(self, ids: list[int], texts: list[str], k: int, radius: int):
        words = Words(pa.array(texts, pa.string()), lower=True)
        total = words.prefix()
        self.ids, self.counts, self.length, self.code = ids, [], [], []
        self.tables: dict[tuple[int, int, int], list[int]] = {}
        where: list[tuple[int, int, int]] = []
        for q in range(len(ids)):
            i, j = int(words.first[q]), int(words.first[q + 1])
            at = np.arange(i, max(j - k + 1, i + 1) if j > i else i)
            grams = words.runs(at, np.minimum(at + k, j), total)
            self.length.append(j - i)
            self.counts.append(Counter(grams.tolist()))
            self.code.append(simhash(grams) if j > i else 0)
            where += [(g, q, p) for p, g in enumerate(grams.tolist())]
            for block in bit_blocks(self.code[-1], radius + 1) if j > i else ():
                self.tables.setdefault((j - i, *block), []).append(q)
        where.sort()
        self.gram = np.array([x[0] for x in where], np.uint64)
        self.owner = np.array([x[1] for x in where], np.int64)
        self.place = np.array([x[2] for x in where], np.int64)


def scan_document(grams: np.ndarray, n: int, hits: np.ndarray, items: Items, radius: int, least: float, k: int) -> Iterator[tuple[int, int, float]]:
    """(item, start, similarity) of the best window of each item found in one document. grams: of all starts."""
    starts: set[tuple[int, int]] = set()
    places: dict[int, list[int]] = defaultdict(list)
    for p in hits.tolist():
        lo, hi = np.searchsorted(items.gram, grams[p], "left"), np.searchsorted(items.gram, grams[p], "right")
        for q in set(items.owner[lo:hi].tolist()):
            places[q].append(p)
    for q, at in places.items():
        size = min(items.length[q], n)
        held, own = max(1, size - k + 1), max(1, items.length[q] - k + 1)
        # Shared shingles that the least similarity needs; windows with so many span need places in a row.
        need = max(1, math.ceil(least * (held + own) / (1 + least) - 1e-9))
        for first, last in zip(at, at[need - 1 :], strict=False):
            starts.update((size, s) for s in range(max(0, last - held + 1), min(first, n - size) + 1))
    best: dict[int, tuple[float, int]] = {}
    lengths = sorted(set(items.length))
    for size, s in sorted(starts):
        part = grams[s : s + max(1, size - k + 1)]
        code, counts = simhash(part), None
        for m in lengths if size == n else (size,):
            near: set[int] = set()
            for block in bit_blocks(code, radius + 1):
                near.update(items.tables.get((m, *block), ()))
            for q in near:
                if m >= size and (code ^ items.code[q]).bit_count() <= radius:
                    counts = counts or Counter(part.tolist())
                    x = similarity(counts, items.counts[q])
                    if x >= least and (q not in best or (x, -s) > (best[q][0], -best[q][1])):
                        best[q] = (x, s)
    return ((q, s, x) for q, (x, s) in sorted(best.items()))


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, k: int = K, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, start_word, similarity): for each item that a document holds, its most similar window (the
    first of equal ones). Documents without any give no row."""
    spark = docs.sparkSession
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "text").where("text is not null")
    asked = benchmark.selectExpr("cast(item_id as long) item_id", "text").where("text is not null and item_id is not null").distinct()
    # The query set in blocks of a fixed size, so what is broadcast at once does not grow with it.
    parts = max(1, -(-asked.count() // BLOCK))
    out = []
    for i in range(parts):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == i).orderBy("item_id", "text").collect()
        held = spark.sparkContext.broadcast(([r[0] for r in rows], [r[1] for r in rows]))
        out.append(docs.mapInArrow(scanner(held, least, k, radius), SCHEMA))
    best = F.max(F.struct("similarity", (-F.col("start_word")).alias("back")))
    return reduce(DataFrame.union, out).groupBy("doc_id", "item_id").agg(best.alias("x")).select("doc_id", "item_id", (-F.col("x.back")).alias("start_word"), "x.similarity")


def scanner(held, least: float, k: int, radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*held.value, k, radius)
        # One bit per low 20 bits of a shingle first: most shingles end there.
        sieve = np.zeros(1 << 20, bool)
        sieve[(items.gram & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column(1), lower=True)
                if not len(words.hash) or not len(items.gram):
                    continue
                total = words.prefix()
                count = np.diff(words.first)
                grams, at = words.grams(k, total)
                short = np.flatnonzero((count > 0) & (count < k))
                if len(short):
                    grams = np.concatenate([grams, words.runs(words.first[short], words.first[short + 1], total)])
                    at = np.concatenate([at, words.first[short]])
                maybe = np.flatnonzero(sieve[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)])
                maybe = maybe[np.isin(grams[maybe], items.gram)]
                rows: list[tuple] = []
                ids = part.column(0)
                for r in np.unique(words.row[at[maybe]]).tolist():
                    i, j = int(words.first[r]), int(words.first[r + 1])
                    own = np.arange(i, max(i + 1, j - k + 1))
                    mine = words.runs(own, np.minimum(own + k, j), total)
                    hits = np.sort(at[maybe][words.row[at[maybe]] == r]) - i
                    rows += [(ids[r].as_py(), items.ids[q], s, x) for q, s, x in scan_document(mine, j - i, hits, items, radius, least, k)]
                if rows:
                    d, q, s, x = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(q, pa.int64()), pa.array(s, pa.int32()), pa.array(x, pa.float64())], ["doc_id", "item_id", "start_word", "similarity"])

    return run
