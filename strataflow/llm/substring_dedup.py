"""Operator 2: words in repeated windows, by counting windows over anchored blocks.

This stands in for a relative Lempel-Ziv parse, whose greedy factors cannot give the result asked for: a window counts
if it starts anywhere else, whichever factors it lies across, and a longest match in one block hides shorter ones in
others, so every window near a factor's border has to be looked up by itself anyway. What is kept of the parse is its
division of labour: long stretches that stand elsewhere are decided as a whole, and only what is around their ends is
looked at window by window.

Blocks are cut by content: in every window of `window` words the k-word gram of least fingerprint is its anchor, so equal
windows carry equal anchors wherever they stand, and the windows of one anchor at one place form its context.

* A context that stands elsewhere as a whole is repeated with all its windows.
* Where it doesn't, but the anchor stands elsewhere, a repeated stretch may begin or end inside it. These contexts, and
  one copy of each differing context of such anchors, are compared window by window.

Every window belongs to exactly one context, so both steps together decide each window. All counts are aggregations
that combine before their shuffle: a passage in a third of all documents is a count, never a group in one task.

Equality is that of 128 bits (64 of the anchor and 64 of the context or window).
Nulls and empty texts have no words. Texts shorter than a window lose nothing. Every row is a document of its own, also
where doc_id is null or repeated, so equal rows lose all their windows. Spans belong to a doc_id with a text (a null
doc_id: with a second hash of the text), so rows that share a doc_id don't meet. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.graph import keep
from strataflow.llm.textops import Words, signed, slices

WINDOW, GRAM = 35, 8
KEY = ["d", "t"]
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def contexts(words: Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of each anchor with windows: anchor and context fingerprints, row, first and last window (word indices in the
    row's own count), and the first window's index in the slice."""
    none = np.zeros(0, np.int64)
    n = len(words.hash) - window + 1
    if n <= 0:
        return none.view(np.uint64), none.view(np.uint64), none, none, none, none
    total = words.prefix()
    at = np.arange(len(words.hash) - gram + 1)
    grams = words.runs(at, at + gram, total)
    least = sliding_window_view(grams, window - gram + 1).argmin(axis=1)
    ok = np.flatnonzero(words.row[:n] == words.row[window - 1 :])
    if not len(ok):
        return none.view(np.uint64), none.view(np.uint64), none, none, none, none
    anchor = ok + least[ok]
    new = np.ones(len(ok), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (np.diff(ok) != 1)
    lo = ok[new]
    hi = ok[np.append(np.flatnonzero(new)[1:], len(ok)) - 1]
    anchor = anchor[new]
    whole = words.runs(lo, hi + window, total) + (anchor - lo).astype(np.uint64)
    row = words.row[lo]
    base = words.first[row]
    return grams[anchor], whole, row, lo - base, hi - base, lo


def find_contexts(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """docs: d, t, text. (a, c, ds, ts, lo, hi): contexts with their places; equal ones of one slice of texts are one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                a, c, row, lo, hi, _ = contexts(Words(part.column(2)), window, gram)
                if not len(a):
                    continue
                order = np.lexsort((c, a))
                a, c, row, lo, hi = (x[order] for x in (a, c, row, lo, hi))
                first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (c[1:] != c[:-1])))
                ends = pa.array(np.append(first, len(a)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, x) for x in (part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)))]
                yield pa.RecordBatch.from_arrays([pa.array(signed(a[first])), pa.array(signed(c[first])), *lists], ["a", "c", "ds", "ts", "lo", "hi"])

    return docs.mapInArrow(run, "a long, c long, ds array<long>, ts array<long>, lo array<int>, hi array<int>")


def window_rows(docs: DataFrame, window: int) -> DataFrame:
    """docs: d, t, text, spans array<struct<a, lo, hi, n>>. One row per window of the spans; n copies each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                words = Words(part.column(2))
                total = words.prefix()
                spans = part.column(3)
                flat = spans.flatten()
                row = np.repeat(np.arange(part.num_rows), np.asarray(spans.value_lengths()))
                lo, hi, n, a = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("lo", "hi", "n", "a"))
                size = (hi - lo + 1).astype(np.int64)
                which = np.repeat(np.arange(len(lo)), size)
                pos = lo[which] + np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
                start = words.first[row[which]] + pos
                h = words.runs(start, start + window, total)
                yield pa.RecordBatch.from_arrays([pa.array(a[which]), pa.array(signed(h)), *(part.column(k).take(pa.array(row[which])) for k in (0, 1)), pa.array(pos.astype(np.int32)), pa.array(n[which])], ["a", "w", *KEY, "pos", "n"])

    return docs.mapInArrow(run, "a long, w long, d long, t long, pos int, n long")


def strip_spans(docs: DataFrame, window: int) -> DataFrame:
    """docs: doc_id, text, spans array<struct<lo, hi>> of repeated windows (first words). Removes the words covered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column(1))
                spans = part.column(2)
                flat = spans.flatten()
                row = np.repeat(np.arange(part.num_rows), np.nan_to_num(np.asarray(spans.value_lengths().to_numpy(zero_copy_only=False), float)).astype(np.int64))
                depth = np.zeros(len(words.hash) + 1, np.int64)
                if len(flat):
                    lo, hi = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("lo", "hi"))
                    np.add.at(depth, words.first[row] + lo, 1)
                    np.add.at(depth, words.first[row] + hi + window, -1)
                gone = np.cumsum(depth)[:-1] > 0
                removed = np.zeros(len(gone) + 1, np.int64)
                np.cumsum(gone, out=removed[1:])
                data = words.data.tobytes()
                out: list[list] = [[], [], []]
                for r in range(part.num_rows):
                    i, j = int(words.first[r]), int(words.first[r + 1])
                    cut = int(removed[j] - removed[i])
                    if cut == 0:
                        kept = b" ".join(data[words.start[i] : words.end[j - 1]].split()) if j > i else b""
                    else:
                        left = i + np.flatnonzero(~gone[i:j])
                        kept = b" ".join([data[s:e] for s, e in zip(words.start[left].tolist(), words.end[left].tolist(), strict=True)])
                    out[0].append(j - i)
                    out[1].append(cut)
                    out[2].append(hashlib.sha256(kept).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return docs.mapInArrow(run, SCHEMA)


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(d, t, spans): runs of first words of windows that also start elsewhere. docs: d, t, text."""
    # The index is dealt by anchor once, after equal contexts were combined slice by slice; what only one place has
    # ends here.
    dealt = find_contexts(docs, window, gram).repartition("a")
    by_anchor = Window.partitionBy("a").orderBy("c")
    index = dealt.withColumn("n", F.sum(F.size("ds")).over(Window.partitionBy("a", "c"))).withColumn("first", ~F.col("c").eqNullSafe(F.lag("c").over(by_anchor)))
    index = index.withColumn("kinds", F.sum(F.col("first").cast("long")).over(Window.partitionBy("a"))).where("n > 1 or kinds > 1")
    index = keep(index)
    asked = index.where("kinds > 1 and first").select(F.col("ds")[0].alias("d"), F.col("ts")[0].alias("t"), F.struct("a", F.col("lo")[0].alias("lo"), F.col("hi")[0].alias("hi"), "n").alias("s"))
    asked = asked.groupBy(*KEY).agg(F.collect_list("s").alias("spans"))
    # Read twice below; the shuffled texts are one exchange, shared with the last join.
    windows = window_rows(docs.join(asked, KEY).select(*KEY, "text", "spans"), window)
    # Contexts of several copies are decided; their windows only count for the others.
    twice = windows.groupBy("a", "w").agg(F.sum("n").alias("total"), F.min("n").alias("least")).where("total > 1 and least = 1")
    inside = windows.where("n = 1").join(twice.select("a", "w"), ["a", "w"], "left_semi").select(*KEY, F.struct(F.col("pos").alias("lo"), F.col("pos").alias("hi")).alias("s"))
    places = index.where("n > 1").select(F.explode(F.arrays_zip("ds", "ts", "lo", "hi")).alias("x"))
    whole = places.select(F.col("x.ds").alias("d"), F.col("x.ts").alias("t"), F.struct("x.lo", "x.hi").alias("s"))
    # A set: equal rows share a key and have the same spans.
    return whole.union(inside).groupBy(*KEY).agg(F.collect_set("s").alias("spans"))


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document: words, words removed and the digest of the words kept."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("t"))
    own = own.withColumn("d", F.coalesce("doc_id", F.xxhash64(F.lit(7), "text")))
    spans = repeated_spans(own.select(*KEY, "text"), window, gram)
    return strip_spans(own.join(spans, KEY, "left").select("doc_id", "text", "spans"), window)


ORACLE = f"""
with own as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from documents),
wins as (select doc_id, i, array_to_string(words[i : i + {WINDOW - 1}], ' ') as win from (select doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) as i from own where len(words) >= {WINDOW})),
gone as (select distinct doc_id, unnest(range(i, i + {WINDOW})) as pos from (select *, count(*) over (partition by win) as n from wins) where n > 1),
said as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as pos from own),
kept as (select doc_id, count(g.pos) as n_removed, string_agg(word, ' ' order by s.pos) filter (where g.pos is null) as text from said s left join gone g using (doc_id, pos) group by doc_id)
select o.doc_id, len(words) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(k.text, '')) as kept_sha256 from own o left join kept k using (doc_id)
"""
