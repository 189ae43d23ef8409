"""Words of Arrow text columns as 64-bit hashes, without a Python loop over words.

All functions work on the UTF-8 bytes of a whole batch of texts. A word's hash is a
polynomial in random per-byte values (prefix sums give every word of the batch at
once) with a final mix; equal words have equal hashes in every batch and session.
Distinct words collide with probability about 2**-64 a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ._shared import ship

ship(__name__)

# Bytes that make up words, after A-Z became a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
AS_IS = np.arange(256, dtype=np.uint8)
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
LETTERS_DIGITS = np.zeros(256, dtype=bool)
LETTERS_DIGITS[0x30:0x3A] = LETTERS_DIGITS[0x61:0x7B] = LETTERS_DIGITS[0x80:] = True

BYTE_VALUES = np.random.Generator(np.random.PCG64(20240101)).integers(1, 2 ** 64 - 1, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 2 ** 64)
#: Texts are worked on in slices of about so many bytes, however many rows or partitions there are.
SLICE_BYTES = 2_000_000


def mix64(h: np.ndarray) -> np.ndarray:
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[:1] = 1
    return np.cumprod(p, dtype=np.uint64)


def bytes_of(texts) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array one after the other, and the n + 1 places where texts begin; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, at, data = texts.buffers()
    at = np.frombuffer(at, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


def slices(batches, column: str = "text", size: int = SLICE_BYTES):
    """Arrow batches cut into batches of about ``size`` bytes of text (one long text may be more)."""
    for b in batches:
        _, at = bytes_of(b.column(b.schema.get_field_index(column)))
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + size)) - 1)
            j = min(j, b.num_rows)
            yield b.slice(i, j - i)
            i = j


def tokens(data: np.ndarray, at: np.ndarray, is_word: np.ndarray, fold: np.ndarray = LOWER):
    """Hash, text number and first token number per text of all words: (hashes, doc, first) of lower-cased ``data``.

    ``first`` has n + 1 entries: text i has the tokens first[i] .. first[i+1] - 1.
    ``fold`` maps the bytes first; ``AS_IS`` keeps upper and lower case apart.
    """
    n, texts = len(data), len(at) - 1
    if n == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(texts + 1, np.int64)
    low = fold[data]
    w = is_word[low]
    cut = np.zeros(n + 1, dtype=bool)
    cut[at] = True  # words end where texts end
    begins = w.copy()
    begins[1:] &= ~w[:-1] | cut[1:n]
    ends = w.copy()
    ends[:-1] &= ~w[1:] | cut[1:n]
    starts = np.flatnonzero(begins)
    stops = np.flatnonzero(ends) + 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[low] * _powers(BASE, n), out=sums[1:])
    h = (sums[stops] - sums[starts]) * _powers(BASE_INVERSE, n)[starts]
    h = mix64(h + (stops - starts).astype(np.uint64))
    first = np.searchsorted(starts, at)
    doc = np.repeat(np.arange(texts), np.diff(first))
    return h, doc, first


def words_of(texts, is_word: np.ndarray):
    return tokens(*bytes_of(texts), is_word)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k hashes, whether or not it crosses texts: len(h) - k + 1 values."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[i:i + n]
    return mix64(out)


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of all runs of k words within a text; a text of fewer, but not none, is one run."""
    texts = len(first) - 1
    n = np.diff(first)
    if len(h) == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    g = grams(h, k)
    doc = np.repeat(np.arange(texts), n)
    inside = doc[:len(g)] == doc[k - 1:k - 1 + len(g)] if len(g) else np.empty(0, bool)
    out, of = g[inside], doc[:len(g)][inside]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        acc = n[short].astype(np.uint64)
        for i in range(k - 1):
            more = n[short] > i
            nxt = h[np.minimum(first[short] + i, len(h) - 1)]
            acc = np.where(more, acc * np.uint64(0xD6E8FEB86659FD93) + nxt, acc)
        out, of = np.concatenate([out, mix64(acc)]), np.concatenate([of, short])
    return out, of


def distinct_by_text(values: np.ndarray, of: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, one text after the other, and their n + 1 places."""
    order = np.lexsort((values, of))
    v, d = values[order], of[order]
    keep = np.ones(len(v), dtype=bool)
    keep[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    v, d = v[keep], d[keep]
    return v, np.searchsorted(d, np.arange(texts + 1))


def binary_column(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """Array i is data[at[i]:at[i+1]] as little-endian bytes."""
    data = np.ascontiguousarray(data)
    off = (at.astype(np.int64) * data.itemsize)
    if len(at) and off[-1] < 2 ** 31 - 1:
        return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(data)])
    return pa.array([data[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())
