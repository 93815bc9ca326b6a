"""Word and window fingerprints over Arrow text batches, with numpy.

Texts stay the bytes that Arrow holds. A word is a run of bytes outside space and 0x09-0x0D. Its fingerprint is a
64-bit polynomial of its bytes read off one prefix sum, so that no Python string is made per word; fingerprints of
runs of words come from a second prefix sum over the words. Work goes by slices of about CHUNK bytes, so memory does
not follow the batch size; a longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
U = np.uint64
_BASE, _BASE2 = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n at least."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK + 1)
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=U)
            p[0] = 1
            made.append(np.cumprod(p, dtype=U))
        have = _powers[base] = (made[0], made[1])
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the offsets of its rows; null rows are empty."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    n = len(texts)
    if n == 0 or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    return np.frombuffer(texts.buffers()[2], dtype=np.uint8)[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: int = 1) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about CHUNK bytes of text each, no row split."""
    _, off = text_bytes(batch.column(column))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + CHUNK, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j


class Words:
    """The words of a slice of texts: fingerprint, row, byte span; first[r] is the index of the first word of row r."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        data, off = text_bytes(texts)
        self.data, n = data, len(data)
        self.rows = len(texts)
        if n == 0:
            self.hash, self.row = np.zeros(0, U), np.zeros(0, np.int64)
            self.start = self.end = np.zeros(0, np.int64)
            self.first = np.zeros(self.rows + 1, np.int64)
            return
        seen = _LOWER[data] if lower else data
        word = ~_SPACE[data]
        cut = np.zeros(n + 1, bool)
        cut[off] = True
        cut[n] = True
        before = np.empty(n, bool)
        before[0] = True
        before[1:] = ~word[:-1]
        after = np.empty(n, bool)
        after[-1] = True
        after[:-1] = ~word[1:]
        self.start = np.flatnonzero(word & (before | cut[:-1]))
        self.end = np.flatnonzero(word & (after | cut[1:])) + 1
        up, down = powers(_BASE, n + 1)
        total = np.zeros(n + 1, U)
        np.cumsum((seen.astype(U) + U(1)) * up[:n], out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start])
        self.first = np.searchsorted(self.start, off, side="left")
        self.row = np.repeat(np.arange(self.rows), np.diff(self.first))

    def prefix(self) -> np.ndarray:
        up, _ = powers(_BASE2, len(self.hash) + 1)
        total = np.zeros(len(self.hash) + 1, U)
        np.cumsum(self.hash * up[: len(self.hash)], out=total[1:])
        return total

    def runs(self, start: np.ndarray, end: np.ndarray, total: np.ndarray | None = None) -> np.ndarray:
        """Fingerprints of the word runs [start, end)."""
        total = self.prefix() if total is None else total
        _, down = powers(_BASE2, len(self.hash) + 1)
        return mix((total[end] - total[start]) * down[start] + (end - start).astype(U))

    def grams(self, k: int, total: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of all k-word runs inside one row, with their first words."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, U), np.zeros(0, np.int64)
        at = np.flatnonzero(self.row[:n] == self.row[k - 1 :])
        return self.runs(at, at + k, total), at


def shingle_sets(words: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles by row: (row, fingerprint) sorted by row and fingerprint. A row of fewer words gives
    its whole sequence as one shingle, a row without words none."""
    total = words.prefix()
    h, at = words.grams(k, total)
    row = words.row[at]
    count = np.diff(words.first)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        h = np.concatenate([h, words.runs(words.first[short], words.first[short + 1], total)])
        row = np.concatenate([row, short])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    if len(h):
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        h, row = h[keep], row[keep]
    return row, h


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
