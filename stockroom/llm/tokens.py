"""Words, word hashes and Rabin-Karp window hashes of a batch of texts, vectorised in numpy.

A word is a maximal run of bytes other than ASCII white space (space, tab, \\n, \\v, \\f, \\r).
Hashes are 64-bit and depend on the bytes alone, so every task and every run agrees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
CHUNK = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply, shift, xor): spreads every input bit over the result."""
    with np.errstate(over="ignore"):
        x = x.astype(U64)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def space_table() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[9, 10, 11, 12, 13, 32]] = True
    return t


BASE = 0x9E3779B97F4A7C15 | 1
SPACE = space_table()
BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x632BE59BD9B4E019 & (2**55 - 1)))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    p = np.full(max(n, 1), base % 2**64, U64)
    p[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(p, dtype=U64)


class Batch:
    """Texts (bytes) laid end to end, one newline between two of them.

    starts, ends: byte range of each word; doc: index of its text; first: index of each text's
    first word, with the number of words at the end (so text i has words first[i]:first[i+1]).
    """

    def __init__(self, texts: list[bytes]):
        self.n = len(texts)
        self.buf = np.frombuffer(b"\n".join(texts), np.uint8)
        size = np.fromiter(map(len, texts), np.int64, self.n)
        self.at = np.concatenate(([0], np.cumsum(size + 1)))[: self.n]
        self.size = size
        sp = SPACE[self.buf]
        step = np.diff(np.concatenate(([True], sp, [True])).view(np.int8))
        self.starts, self.ends = np.flatnonzero(step == -1), np.flatnonzero(step == 1)
        self.first = np.append(np.searchsorted(self.starts, self.at), len(self.starts))
        self.doc = np.repeat(np.arange(self.n), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        return span_hashes(self.buf, self.starts, self.ends)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; spans are in order and do not overlap."""
    out = np.zeros(len(starts), U64)
    i = 0
    inverse = pow(BASE, -1, 2**64)
    pw = ipw = powers(BASE, 1)
    with np.errstate(over="ignore"):
        while i < len(starts):
            j = max(int(np.searchsorted(ends, starts[i] + CHUNK, "right")), i + 1)
            a, b = int(starts[i]), int(ends[j - 1])
            if len(pw) < b - a + 1:
                pw, ipw = powers(BASE, b - a + 1), powers(inverse, b - a + 1)
            total = np.zeros(b - a + 1, U64)
            np.cumsum(BYTE[buf[a:b]] * pw[: b - a], out=total[1:])
            s, e = starts[i:j] - a, ends[i:j] - a
            out[i:j] = mix((total[e] - total[s]) * ipw[s] + (e - s).astype(U64))
            i = j
    return out


def windows(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hash of every window of k consecutive words inside one text, and the index of
    its first word. Texts shorter than k words have none."""
    n = np.diff(first)
    m = np.maximum(n - k + 1, 0)
    at = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(m)[:-1])), m) + np.arange(int(m.sum()))
    if not len(at):
        return np.zeros(0, U64), at
    with np.errstate(over="ignore"):
        h = np.zeros(len(words) - k + 1, U64)
        p = 1
        for i in range(k):
            h += words[i: len(words) - k + 1 + i] * U64(p)
            p = p * BASE % 2**64
    return mix(h[at]), at


def parts(sizes, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most ``limit`` bytes together (one text at least)."""
    i, total = 0, 0
    for j, n in enumerate(sizes):
        if j > i and total + n > limit:
            yield i, j
            i, total = j, 0
        total += n
    if i < len(sizes):
        yield i, len(sizes)


def text_parts(column, limit: int = 2 << 20) -> Iterator[tuple[int, int, list]]:
    """An Arrow column of texts a few megabytes at a time: (from, to, bytes or None of each)."""
    import pyarrow.compute as pc
    for i, j in parts(pc.fill_null(pc.binary_length(column), 0).to_pylist(), limit):
        yield i, j, column.slice(i, j - i).to_pylist()


def blob(x) -> bytes:
    """A text as bytes; null is empty."""
    return b"" if x is None else bytes(x)
