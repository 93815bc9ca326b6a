"""Operator 6: language identification by nearest centroid.

A text is the vector of its hashed byte 1- to 3-gram counts (of letters and single blanks), damped by log1p, weighted by
inverse document frequency and scaled to length 1. Each language has up to CLUSTERS centroids (spherical k-means over its
training vectors); the prediction is the language of the centroid of greatest cosine. A text is rejected where that
cosine is below SHARE of what is usual at its length, or where it has no letter: short texts are far from any centroid
by nature, a long one is so if it is noise, another script, or one word over and over.

Fitting reads at most PER_LANG labelled rows of a language, those of least hash of doc_id (fewer where languages are so
many that there would be over SAMPLE rows in all), and their vectors are made by the executors; idf belongs to the
classifier and comes from the same rows. What is usual at a length is the median over pieces of these texts, one a text,
of lengths from 4 to 2,048 bytes. The rest covers all rows and whole texts.

Null texts and texts without a letter are `und` with score 0 and rejected. Rows whose lang is null never train.
Without training rows every text is `und` and rejected. Repeated rows give repeated rows; other columns stay out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.textops import slices, text_bytes

DIM, PER_LANG, CLUSTERS, ROUNDS, SHARE, SAMPLE = 4096, 400, 4, 12, 0.5, 8_000
#: A cluster holds this share of its language's rows at least.
FEW = 0.02
#: Lengths in bytes of the pieces that tell what cosine is usual.
PIECES = [4 << i for i in range(10)]
#: Bytes as the n-grams see them: ASCII letters in lower case, other ASCII as one blank, the rest as it is.
SEEN = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256)], np.uint8)


def counts(texts: pa.Array) -> np.ndarray:
    """log1p counts of the hashed n-grams, one row per text."""
    data, off = text_bytes(texts)
    n = len(texts)
    out = np.zeros(n * DIM, np.float32)
    b = SEEN[data].astype(np.uint32)
    blank = b == 32
    pair = np.append(False, blank[1:] & blank[:-1]) if len(b) else blank
    row = np.repeat(np.arange(n, dtype=np.int64), np.diff(off))
    code = np.zeros(len(b), np.uint32)
    for size in (1, 2, 3):
        m = len(b) - size + 1
        if m <= 0:
            break
        code = code[:m] * np.uint32(256) + b[size - 1 :]
        ok = row[:m] == row[size - 1 :]
        # Runs of blanks, and a blank alone, say nothing.
        for i in range(1, size):
            ok &= ~pair[i : i + m]
        if size == 1:
            ok &= ~blank
        slot = ((code * np.uint32(2654435761)) ^ np.uint32(size * 0x35EBCA6B)) >> np.uint32(20)
        out += np.bincount((row[:m] * DIM + slot)[ok], minlength=n * DIM).astype(np.float32)
    return np.log1p(out.reshape(n, DIM))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]
    #: Logarithms of text lengths, rising, and the cosine that is usual there.
    lengths: np.ndarray
    usual: np.ndarray

    def least(self, sizes: np.ndarray) -> np.ndarray:
        """The cosine below which texts of these lengths are rejected."""
        return SHARE * np.interp(np.log(np.maximum(sizes, 1)), self.lengths, self.usual)


def kmeans(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means; starts from the vector nearest the mean, then each time the one farthest from all starts."""
    first = int(np.argmax(x @ unit(x.mean(axis=0))))
    picks, near = [first], x @ x[first]
    while len(picks) < min(k, len(x)):
        picks.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[picks[-1]])
    c = x[picks]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = np.stack([unit(x[own == i].mean(axis=0)) if (own == i).any() else c[i] for i in range(len(c))])
    return c


def pieces(texts: pa.Array, ids: list[str]) -> tuple[list[bytes], list[int]]:
    """Of each text its first bytes, so many as its id picks, or all if it is shorter; no character is cut."""
    out = []
    for text, k in zip(texts.to_pylist(), ids, strict=True):
        out.append(text.encode("utf-8", "surrogatepass")[: PIECES[crc32(k.encode()) % len(PIECES)]].decode("utf-8", "ignore"))
    return out, [len(t.encode()) for t in out]


def fit(labelled: DataFrame, per_lang: int = PER_LANG, clusters: int = CLUSTERS) -> Model:
    """labelled: doc_id, text, lang. The bound on what reaches the driver: per_lang rows a language and SAMPLE rows in
    all, two vectors of DIM float16 each (128 MB); at least `clusters` rows a language."""
    rows = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    sizes = rows.groupBy("lang").count().collect()  # one row a language
    few = max(clusters, min(per_lang, SAMPLE // max(1, len(sizes))))
    # Only hashes below a share that holds four times the rows asked for are ranked, so a language of a third of all
    # rows is no large group.
    h = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 40))
    share = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, 4.0 * few / r["count"])))]) if sizes else F.lit(None).cast("map<string,double>")
    ranked = rows.select("doc_id", "lang").where(h <= F.element_at(share, F.col("lang")) * float(1 << 40))
    order = Window.partitionBy("lang").orderBy(h, "doc_id")
    sample = ranked.withColumn("at", F.row_number().over(order)).where(F.col("at") <= few).select("doc_id", "lang")
    # At most SAMPLE ids: small enough to send to every task.
    picked = rows.join(F.broadcast(sample), ["doc_id", "lang"], "left_semi").select("doc_id", "text", "lang")
    half = lambda x: pa.array([v.astype(np.float16).tobytes() for v in x], pa.binary())

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (x.slice(lo, 256) for x in slices(batch) for lo in range(0, x.num_rows, 256)):
                if part.num_rows:
                    ids = part.column(0).cast(pa.string())
                    short, size = pieces(part.column(1), ids.to_pylist())
                    yield pa.RecordBatch.from_arrays([part.column(2), half(counts(part.column(1))), ids, half(counts(pa.array(short, pa.string()))), pa.array(size, pa.int32())], ["lang", "v", "k", "p", "n"])

    got = sorted(map(tuple, picked.mapInArrow(vectors, "lang string, v binary, k string, p binary, n int").collect()), key=lambda r: (r[0], r[2], r[1]))
    if not got:
        return Model(np.ones(DIM, np.float32), np.zeros((0, DIM), np.float32), [], np.zeros(1), np.zeros(1))
    whole = lambda i: np.stack([np.frombuffer(r[i], np.float16).astype(np.float32) for r in got])
    x = whole(1)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
    x, p, size = unit(x * idf), unit(whole(3) * idf), np.array([r[4] for r in got])
    label = np.array([r[0] for r in got])
    cents, names, near = [], [], np.zeros(len(got))
    for lang in sorted(set(label.tolist())):
        c = kmeans(x[label == lang], clusters, ROUNDS)
        # Starts lie far apart, so odd texts get clusters of their own; a cluster of hardly any texts is no language.
        size_of = np.bincount(np.argmax(x[label == lang] @ c.T, axis=1), minlength=len(c))
        c = c[size_of >= min(size_of.max(), max(2, FEW * (label == lang).sum()))]
        near[label == lang] = (p[label == lang] @ c.T).max(axis=1)
        cents.append(c)
        names += [lang] * len(c)
    # Medians by octave of length; longer pieces are never farther off than shorter ones.
    octave = np.log2(np.maximum(size, 1)).astype(int)
    at = [o for o in sorted(set(octave.tolist()))]
    usual = np.maximum.accumulate([np.median(near[octave == o]) for o in at])
    lengths = np.array([np.log(np.maximum(size[octave == o], 1)).mean() for o in at])
    return Model(idf, np.concatenate(cents).astype(np.float32), names, lengths, usual)


def predict(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """The columns of carry, then lang_pred, score and rejected. The model is a few hundred vectors at most."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            for part in slices(batch, 0):
                n = part.num_rows
                letters = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                names, score, refused = ["und"] * n, np.zeros(n), np.ones(n, bool)
                for lo in range(0, n if m.langs else 0, 512):
                    piece = part.column(0).slice(lo, 512)
                    x = unit(counts(piece) * m.idf)
                    cos = x @ m.centroids.T
                    best = cos.argmax(axis=1)
                    least = m.least(np.diff(text_bytes(piece)[1]))
                    top = np.clip(cos[np.arange(len(best)), best], 0, 1)
                    for i, c in enumerate(best.tolist()):
                        if letters[lo + i]:
                            names[lo + i], score[lo + i], refused[lo + i] = m.langs[c], float(top[i]), bool(top[i] < least[i])
                yield pa.RecordBatch.from_arrays([*part.columns[2:], pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(refused, pa.bool_())], [*carry, "lang_pred", "score", "rejected"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in carry), "lang_pred string", "score double", "rejected boolean"])
    has_letter = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    return docs.select("text", has_letter.alias("__letters"), *carry).mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document stays out of training."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected per document; learns only from documents that are not held out."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
    model = fit(own.where(~F.col("held_out")))
    return predict(own, model, ["doc_id", "held_out"])
