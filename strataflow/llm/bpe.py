"""Operator 5: byte-level BPE by backtracking over longest matches, and decoding with an offset table.

One walk of an Aho-Corasick automaton of the vocabulary over a piece gives the longest tokens one after the other. A token
may follow another only if the merges would not have joined across them; that is read from a table of compatible pairs,
filled as pairs occur. From the first pair that does not fit on, a second walk gives the longest token at each place, and
shorter ones are tried. Where none fits, the last token is taken back and the place is closed, so each place is visited a
bounded number of times. Pieces are cut beforehand by the tokenizer's own pattern, as the library does.

Nulls are empty texts: no ids, empty decoding. Repeated rows give repeated rows, as do rows of a null doc_id; other
columns are left out.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Entries of one worker's caches of pieces and of compatible pairs, about 120 MB in all. Of pieces the older half goes when
#: the newer one is full, of pairs all; results do not depend on it.
CACHE, PAIRS = 400_000, 300_000
#: Fixed value: the pre-tokenizer's public pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, the others in
    order from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Pieces(dict):
    """Ids of pieces as bytes, made where they are missing. Holds the newer half of the cache, `older` the other one."""

    def __init__(self, make: Callable[[str], bytes]):
        self.make, self.older = make, {}

    def __missing__(self, piece: str) -> bytes:
        got = self.older.get(piece)
        if got is None:
            got = self.make(piece)
        if len(piece) <= 64:
            if len(self) >= CACHE // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = got
        return got


class Bpe:
    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = {c: b for b, c in enumerate(byte_letters())}
        raw = lambda s: bytes(to_byte[c] for c in s)
        vocab, model = spec["model"]["vocab"], spec["model"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.id_of = {raw(t): i for t, i in vocab.items() if t not in self.special}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank, self.parts = {}, {}
        for r, (a, b) in enumerate(pairs):
            left, right = self.id_of[raw(a)], self.id_of[raw(b)]
            made = self.id_of[self.bytes_of[left] + self.bytes_of[right]]
            self.rank.setdefault((left, right), (r, made))
            self.parts.setdefault(made, (left, right, r))
        self.trie = ahocorasick.Automaton()
        for b, i in self.id_of.items():
            self.trie.add_word(b.decode("latin-1"), i)
        self.trie.make_automaton()
        self.cut = regex.compile(PATTERN)
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        size = max([*self.bytes_of, *self.special.values()]) + 1
        table = [self.bytes_of.get(i, b"") for i in range(size)]
        for text, i in self.special.items():
            table[i] = text.encode()
        self.blob = np.frombuffer(b"".join(table), np.uint8)
        self.offset = np.zeros(size + 1, np.int64)
        self.size_of = [len(b) for b in table]
        np.cumsum(self.size_of, out=self.offset[1:])
        #: The next shorter token that a token begins with, else -1.
        self.shorter_of = [next((self.id_of[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in self.id_of), -1) for b in table]
        self.fits: dict[int, bool] = {}
        self.pieces = Pieces(self.made)

    def compatible(self, left: int, right: int) -> bool:
        """Whether left then right is what the merges make of their bytes: undo the younger token's last merge step by
        step; no pair that stands at the border then may have a merge that would have come before."""
        key = left << 32 | right
        if key not in self.fits:
            a, b, before, ok = left, right, (1 << 60), True
            # On a tie of ranks the merge further left is done first, so a pair on the border loses to left's own
            # merge of the same rank but wins against right's.
            while True:
                pair = self.rank.get((a, b))
                if pair is not None and 2 * pair[0] < before:
                    ok = False
                    break
                ra, rb = (self.parts[x][2] if x in self.parts else -1 for x in (a, b))
                if ra < 0 and rb < 0:
                    break
                if ra > rb:
                    before, a = 2 * ra, self.parts[a][1]
                else:
                    before, b = 2 * rb + 1, self.parts[b][0]
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            self.fits[key] = ok
        return self.fits[key]

    def piece(self, data: bytes) -> list[int]:
        """Ids of one piece. Each token of the vocabulary is what merging its own bytes gives."""
        if data in self.id_of:
            return [self.id_of[data]]
        if not data:
            return []
        text, size, known, shorter = data.decode("latin-1"), self.size_of, self.fits.get, self.shorter_of
        tokens, out, left = [i for _, i in self.trie.iter_long(text)], [], -1
        for token in tokens:
            if left >= 0 and not (self.compatible(left, token) if (fit := known(left << 32 | token)) is None else fit):
                break
            out.append(token)
            left = token
        else:
            return out
        # Up to here the longest tokens fit; the next one does not.
        n, at, longest, closed = len(data), sum([size[i] for i in out]), self.longest(text), bytearray(len(data) + 1)
        token = shorter[token]
        while True:
            while token >= 0:
                if not closed[at + size[token]] and (left < 0 or (self.compatible(left, token) if (fit := known(left << 32 | token)) is None else fit)):
                    break
                token = shorter[token]
            if token < 0:  # nothing fits here: take the last token back
                closed[at] = 1
                token = out.pop()
                at -= size[token]
                left = out[-1] if out else -1
                continue
            out.append(token)
            left = token
            at += size[token]
            if at == n:
                return out
            token = longest[at]

    def longest(self, text: str) -> list[int]:
        """The longest token that starts at each byte: one walk of the automaton, which names all tokens by their end, so
        that of one start the longest comes last."""
        out, size = [0] * len(text), self.size_of
        for end, token in self.trie.iter(text):
            out[end + 1 - size[token]] = token
        return out

    def made(self, piece: str) -> bytes:
        ids = self.piece(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> np.ndarray:
        out, at = [], 0
        for m in self.marks.finditer(text) if self.marks else ():
            out += map(self.pieces.__getitem__, self.cut.findall(text[at : m.start()]))
            out.append(np.asarray([self.special[m[0]]], "<u4").tobytes())
            at = m.end()
        out += map(self.pieces.__getitem__, self.cut.findall(text[at:] if at else text))
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """Gathers the bytes of all ids from the blob by offset; what is no UTF-8 becomes U+FFFD."""
        if not len(ids):
            return ""
        start, size = self.offset[ids], self.offset[ids.astype(np.int64) + 1] - self.offset[ids]
        first = np.cumsum(size) - size
        take = np.repeat(start - first, size) + np.arange(int(size.sum()))
        return self.blob[take].tobytes().decode("utf-8", errors="replace")


@lru_cache(2)
def tokenizer(path: str) -> Bpe:
    return Bpe(path)


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """Per document: ids and the text decoded from them, as counts and digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            out: list[list] = [[], [], []]
            for text in batch.column(1):
                ids = bpe.encode(text.as_py() or "")
                out[0].append(len(ids))
                out[1].append(hashlib.sha256(ids.tobytes()).hexdigest())
                out[2].append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)
