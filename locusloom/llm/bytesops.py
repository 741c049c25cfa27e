"""Vectorised work on the UTF-8 bytes of a column of texts: words, shingles, substring hashes.

The hash of ``data[s:e]`` comes from one running sum of ``code[byte] * BASE**position``
modulo 2**64, so the hashes of any number of substrings cost a constant per byte and per
substring. A final mix spreads them over 64 bits.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 19
BASE = 0x9E3779B97F4A7C15
SHINGLE_BASE = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1


def process_cache() -> dict:
    """Dictionary that lives as long as the Python worker, across tasks."""
    return sys.modules.setdefault("_locusloom_llm_cache", types.ModuleType("_locusloom_llm_cache")).__dict__


def space_words() -> np.ndarray:
    """Byte classes of words ``[^\\x20\\x09-\\x0D]+``: True inside a word."""
    table = np.ones(256, dtype=bool)
    table[[0x20, 9, 10, 11, 12, 13]] = False
    return table


def letter_words() -> np.ndarray:
    """Byte classes of words of ASCII letters, digits and all bytes from 0x80."""
    table = np.zeros(256, dtype=bool)
    for low, high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
        table[low:high] = True
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and its inverse modulo 2**64 for ``i < n`` (kept for the worker's life up to two segments)."""
    cache = process_cache()
    known = cache.get("powers")
    if known is None or len(known[0]) < n:
        size = max(n, 2 * SEGMENT)
        up, down = np.full(size, BASE, np.uint64), np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        known = (np.cumprod(up), np.cumprod(down))
        if size == 2 * SEGMENT:
            cache["powers"] = known
    return known


def byte_codes(lower: bool) -> np.ndarray:
    """64-bit code of each byte; with ``lower`` A-Z get the codes of a-z."""
    codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    if lower:
        codes[0x41:0x5B] = codes[0x61:0x7B]
    return codes


class Prefix:
    """Hashes of substrings of one block of bytes."""

    def __init__(self, data: np.ndarray, codes: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes[data] * up[: len(data)], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(raw ^ ((ends - starts).astype(np.uint64) * np.uint64(BASE)))


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    first, last = int(places[0]), int(places[-1])
    held = np.frombuffer(data, np.uint8, last - first, first) if last > first else np.zeros(0, np.uint8)
    return held, places - first


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the index of the first word of each row (one more at the end)."""
    word = inside[data]
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    bounds = offsets[1:-1]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    start[inner] |= word[inner]
    end[inner - 1] |= word[inner - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """Hash of each span; spans are disjoint and in order, and work goes by blocks of them."""
    out, codes, i = np.empty(len(starts), np.uint64), byte_codes(lower), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, "right")))
        low = int(starts[i])
        block = Prefix(data[low : int(ends[j - 1])], codes)
        out[i:j] = block.hashes(starts[i:j] - low, ends[i:j] - low)
        i = j
    return out


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes (signed 64 bits) of one row's word hashes.

    With fewer words than ``width`` the whole sequence is the one shingle; without words
    there is none.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    size = min(n, width)
    total = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        total = total * np.uint64(SHINGLE_BASE) + words[j : n - size + 1 + j]
    return np.unique(mix(total).view(np.int64))


def shingle_rows(column: pa.Array, width: int, inside: np.ndarray) -> Iterator[np.ndarray]:
    """:func:`shingles` of every row, in order."""
    data, offsets = buffers(column)
    starts, ends, firsts = word_spans(data, offsets, inside)
    hashed = span_hashes(data, starts, ends, lower=True)
    for i in range(len(offsets) - 1):
        yield shingles(hashed[firsts[i] : firsts[i + 1]], width)


def pieces(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts take about ``limit`` bytes; a longer text stands alone."""
    sizes = np.diff(buffers(batch.column(column))[1])
    ends = np.cumsum(sizes)
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + limit, "right")))
        yield batch.slice(i, j - i)
        i = j
