"""Vectorised word splitting and hashing over Arrow text buffers.

A batch of texts is one byte buffer with offsets, as Arrow holds it.  Words are maximal
runs of word bytes that do not cross a text border.  All work is numpy over the buffer;
no Python object is made per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_MIX_A, _MIX_B = U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
SLICE_BYTES = 1 << 20


def word_bytes(separators: bytes) -> np.ndarray:
    """Table over byte values: True for bytes of words."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


#: [^\x20\x09-\x0D]+
SPACED = word_bytes(b" \t\n\x0b\x0c\r")
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z: ASCII letters, digits and all non-ASCII bytes
ALNUM = word_bytes(bytes(b for b in range(128) if not chr(b).isalnum()))

KEEP = np.arange(256, dtype=np.uint8)
LOWER = KEEP.copy()
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> U(33))
    x *= _MIX_A
    x ^= x >> U(33)
    x *= _MIX_B
    return x ^ (x >> U(33))


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; SLICE_BYTES of them are kept, longer tables are made for one use."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES), U(base))
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) == SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """Hash of values[start[i]:end[i]] for spans in order that do not overlap; table translates the values first.

    Spans are taken in groups of SLICE_BYTES values, so memory does not follow the length of values.
    """
    out = np.zeros(len(start), U)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + SLICE_BYTES, "right")))
        a, b = int(start[i]), int(end[j - 1])
        part = values[a:b] if table is None else table[values[a:b]]
        run = np.zeros(b - a + 1, U)
        np.cumsum(part * _power(_BASE, b - a), out=run[1:])
        back = np.append(_power(_BASE_INV, b - a), U(0))
        out[i:j] = (run[end[i:j] - a] - run[start[i:j] - a]) * back[start[i:j] - a]
        i = j
    return mix(out + (end - start).astype(U))


@dataclass
class Words:
    """Words of a batch: hash, byte range and text index of each; first[i]:first[i+1] are those of text i."""

    buf: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.hash)


def split_words(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray = SPACED, fold: np.ndarray = KEEP, hashed: bool = True) -> Words:
    """Words of the texts buf[offsets[i]:offsets[i+1]]; offsets[0] is 0 and offsets[-1] is len(buf)."""
    n_docs = len(offsets) - 1
    if not len(buf):
        none = np.zeros(0, np.int64)
        return Words(buf, np.zeros(0, U), none, none, none, np.zeros(n_docs + 1, np.int64))
    if fold is not KEEP:
        buf = fold[buf]
    inside = table[buf]
    border = np.zeros(len(buf) + 1, bool)
    border[offsets] = True
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | border[:-1]))
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | border[1:])) + 1
    first = np.searchsorted(start, offsets).astype(np.int64)
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    hashes = np.zeros(0, U)
    if hashed:
        hashes = span_hashes(buf, start, end, _BYTE)
    return Words(buf, hashes, start, end, doc, first)


def windows(w: np.ndarray, n: int) -> np.ndarray:
    """Hash of w[i:i+n] for each i, by doubling: the hash of a window joins those of its halves."""
    if len(w) < n:
        return np.zeros(0, U)
    out, have, block, step = None, 0, w, 1
    while True:
        if n & step:
            if out is None:
                out, have = block, step
            else:  # out covers have words, block the next step words
                m = min(len(out), len(block) - have)
                out = out[:m] * U(pow(_BASE, step, 1 << 64)) + block[have : have + m]
                have += step
        if have == n:
            return mix(out[: len(w) - n + 1] + U(n))
        m = len(block) - step
        block = block[:m] * U(pow(_BASE, step, 1 << 64)) + block[step : step + m]
        step *= 2


def inside_one_text(words: Words, n: int) -> np.ndarray:
    """Whether the n words from each word on are of one text."""
    m = len(words) - n + 1
    return words.doc[:m] == words.doc[n - 1 :] if m > 0 else np.zeros(0, bool)


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, offsets from 0 and null flags of a string or binary Arrow column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, bool)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0], np.asarray(column.is_null())


def slices(offsets: np.ndarray, most: int = SLICE_BYTES, texts: int = 1 << 16):
    """Ranges of at most `texts` texts of about `most` bytes; a longer text is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = min(max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1), i + texts, n)
        yield i, j
        i = j
