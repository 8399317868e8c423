"""Vectorised text helpers for Arrow batches.

A block is a run of whole texts of one Arrow batch whose UTF-8 bytes lie in one
numpy array (about ``BLOCK_BYTES``; a longer text is a block of its own), so
that hashing costs a few numpy calls a block instead of Python work a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_U64 = np.uint64
_powers = (np.ones(1, _U64), np.ones(1, _U64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    global _powers
    have = len(_powers[0])
    if have < n:
        size = max(n, 2 * have, 1 << 16)
        out = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            f = np.full(size, b, _U64)
            f[0] = 1
            out.append(np.multiply.accumulate(f))
        _powers = (out[0], out[1])
    return _powers


def release_tables() -> None:
    """Drop the tables; the next text makes its own."""
    global _powers
    _powers = (np.ones(1, _U64), np.ones(1, _U64))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over all 64."""
    h = h ^ (h >> _U64(30))
    h = h * _U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U64(27))
    h = h * _U64(0x94D049BB133111EB)
    return h ^ (h >> _U64(31))


def signed(h: np.ndarray) -> np.ndarray:
    """64-bit codes as Spark longs."""
    return h.view(np.int64)


def blocks(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts; a null text is empty."""
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    n = len(texts)
    if not n:
        return
    bufs = texts.buffers()
    offs = np.frombuffer(bufs[1], kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + block_bytes, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def doc_of(offs: np.ndarray, counts_at: np.ndarray) -> np.ndarray:
    """Index of the document in which each (ascending) byte position lies."""
    edges = np.searchsorted(counts_at, offs)
    return np.repeat(np.arange(len(offs) - 1), np.diff(edges))


def words(buf: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document index of the maximal runs of word bytes; none crosses documents."""
    mask = is_word[buf]
    n = len(mask)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    first = mask.copy()
    first[1:] &= ~mask[:-1] | edge[1:n]
    last = mask.copy()
    last[:-1] &= ~mask[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, doc_of(offs, starts)


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Running Karp-Rabin sums, for span_hash."""
    s = np.zeros(len(buf) + 1, _U64)
    inverse = _power_tables(len(buf) + 1)[1]
    np.cumsum((buf.astype(_U64) + _U64(1)) * inverse[: len(buf)], out=s[1:])
    return s


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; equal bytes, equal hash, wherever they stand."""
    power = _power_tables(len(sums))[0]
    return mix((sums[ends] - sums[starts]) * power[starts] + (ends - starts).astype(_U64))


def gram_hash(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive codes of one document, and the index of each gram's first code."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, _U64), np.zeros(0, np.int64)
    power = _power_tables(n + 1)[0]
    g = np.zeros(m, _U64)
    for i in range(n):
        g += h[i : i + m] * power[n - i]
    at = np.flatnonzero(doc[:m] == doc[n - 1 :])
    return mix(g[at]), at


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """A-Z as a-z; all other bytes as they are."""
    return _LOWER[buf]


def slices(values: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Offsets that cut values, ordered by document, into one list a document."""
    return np.searchsorted(doc, np.arange(n_docs + 1))


def list_array(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Word bytes: all but space and the five control characters from tab to carriage return.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Word bytes: digits, lower-case letters and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
