"""Vectorised hashing of words, shingles and byte strings of whole Arrow text columns.

Everything here works on one chunk of documents inside a task: the texts' bytes back to back, with document offsets.
Hashes are polynomials modulo 2^64 over random 64-bit byte codes, so any substring's hash follows from two prefix sums.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits (xor-shift-multiply finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """n well-mixed 64-bit numbers of a seed."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + mix(np.array([seed], dtype=U64)))


def spaces(punctuation: bool = False) -> np.ndarray:
    """Table of the 256 byte values: which part words. White space, and ASCII punctuation where wanted."""
    out = np.zeros(256, dtype=bool)
    out[[0x20, *range(0x09, 0x0E)]] = True
    if punctuation:
        out[[b for b in range(128) if not chr(b).isalnum()]] = True
    return out


def lower() -> np.ndarray:
    """Table of the 256 byte values with A-Z in lower case."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


class Chunk(NamedTuple):
    first: int
    count: int
    data: np.ndarray
    offsets: np.ndarray


def chunks(column: pa.Array, limit: int = CHUNK):
    """The column's texts as UTF-8 bytes, in runs of documents of at most ``limit`` bytes (or one longer one); null: empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("") if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column.fill_null(b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    buffers = column.buffers()
    if not len(column):
        return
    at = np.frombuffer(buffers[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield Chunk(first, last - first, data[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


class Rolling:
    """Hashes of substrings of one chunk."""

    def __init__(self, base: int, codes: np.ndarray):
        self.base, self.codes = base | 1, codes
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def powers(self, n: int) -> None:
        if len(self.up) < n + 1:
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(n + 1, b, U64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self.powers(len(data))
        out = np.zeros(len(data) + 1, U64)
        np.cumsum(self.codes[data] * self.up[: len(data)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.down[start]


class Words(NamedTuple):
    hash: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    per_doc: np.ndarray


class WordHasher:
    """Words of a chunk as 64-bit hashes: the same for the same bytes, in any process."""

    def __init__(self, separators: np.ndarray):
        self.word, self.lower = ~separators, lower()
        self.rolling = Rolling(int(stream(1, 77)[0]), stream(256, 78))

    def __call__(self, c: Chunk) -> Words:
        data = self.lower[c.data]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = self.word[data]
        starts, ends = inside[1:] & ~inside[:-1], ~inside[1:] & inside[:-1]
        cuts = c.offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        cuts = cuts[inside[cuts] & inside[cuts + 1]]
        starts[cuts] = True
        ends[cuts] = True
        start, end = np.flatnonzero(starts[:-1] if not starts[-1] else starts), np.flatnonzero(ends)
        doc = np.searchsorted(c.offsets, start, side="right") - 1
        h = mix(self.rolling.between(self.rolling.sums(data), start, end) + (end - start).astype(U64))
        return Words(h, doc, start, end, np.bincount(doc, minlength=c.count))


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every run of n words; a document of fewer words gives its whole sequence as one."""
    factors = stream(n, 79) | U64(1)
    total = len(w.hash)
    first = np.concatenate([[0], np.cumsum(w.per_doc)])
    h, doc = np.zeros(0, U64), np.zeros(0, np.int64)
    if total >= n:
        h = w.hash[: total - n + 1] * factors[0]
        for k in range(1, n):
            h = h + w.hash[k : total - n + 1 + k] * factors[k]
        whole = w.doc[: total - n + 1] == w.doc[n - 1 :]
        h, doc = mix(h[whole]), w.doc[: total - n + 1][whole]
    short = np.flatnonzero((w.per_doc > 0) & (w.per_doc < n))
    if len(short):
        tail = np.array([(w.hash[first[d] : first[d + 1]] * factors[: w.per_doc[d]]).sum(dtype=U64) + U64(w.per_doc[d]) for d in short], dtype=U64)
        h, doc = np.concatenate([h, mix(tail)]), np.concatenate([doc, short])
        order = np.argsort(doc, kind="stable")
        h, doc = h[order], doc[order]
    return h, doc


def sets(h: np.ndarray, doc: np.ndarray, count: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each document; ``doc`` ascends."""
    at = np.searchsorted(doc, np.arange(count + 1))
    return [np.unique(h[at[d] : at[d + 1]]) for d in range(count)]
