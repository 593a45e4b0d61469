"""Words and shingles of whole batches of texts, as numpy arrays of 64-bit hashes.

A batch of texts is one byte buffer. Separators are ASCII, so words can be found in UTF-8 bytes without decoding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_JOIN = np.uint64(0xA0761D6478BD642F)

#: Bytes that end a word, for words ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that end a word, for words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased texts.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins, with the end at last; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held[starts[0]:starts[-1]], starts - starts[0]


class Words:
    """The words of a batch: ``start`` and ``end`` in bytes, ``hash``, and ``first``, the number of words before each text."""

    def __init__(self, texts: pa.Array, ends_word: np.ndarray, lower: bool = True):
        held, starts = buffers(texts)
        self.bytes = LOWER[held] if lower else held
        n = len(held)
        # A separator before the first byte and after the last of each text, so that no word runs over two texts.
        inside = np.zeros(n + 1, bool)
        inside[:n] = ~ends_word[self.bytes]
        before = np.zeros(n + 1, bool)
        before[1:] = inside[:n]
        cut = np.zeros(n + 1, bool)
        cut[starts] = True
        self.start = np.flatnonzero(inside & (~before | cut))
        self.end = np.flatnonzero(before & (~inside | cut))
        self.first = np.searchsorted(self.start, starts)
        self.first[-1] = len(self.start)
        self.hash = self._hashed()

    def _hashed(self) -> np.ndarray:
        """Polynomial hash of each word's bytes, from running sums in blocks that keep the tables small."""
        out = np.empty(len(self.start), np.uint64)
        block = 1 << 16
        at = 0
        while at < len(self.start):
            base = self.start[at]
            upto = max(at + 1, int(np.searchsorted(self.end, base + block, "right")))
            length = int(self.end[upto - 1] - base)
            power, inverse = _powers(length)
            sums = np.empty(length + 1, np.uint64)
            sums[0] = 0
            np.cumsum(_BYTE_VALUE[self.bytes[base:base + length]] * power[:length], out=sums[1:])
            first, last = self.start[at:upto] - base, self.end[at:upto] - base
            out[at:upto] = (sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64) * _STEP
            at = upto
        return mix(out)

    def __len__(self) -> int:
        return len(self.first) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(17, int(length).bit_length())
    if size not in _tables:
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _BASE_INVERSE, np.uint64)
        up[0] = down[0] = 1
        made = np.cumprod(up), np.cumprod(down)
        if size > 1 << 20:  # of one very long word: not kept
            return made
        _tables[size] = made
    return _tables[size]


def joined(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` neighbours; run i starts at i. Shorter input gives none."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= _JOIN
        out += hashes[k:n + k]
    return mix(out)


#: Batches are worked on in pieces of so many bytes of text, or one text if it is longer.
PIECE_BYTES = 2 << 20


def pieces(batch: pa.RecordBatch, text: str, size: int = PIECE_BYTES):
    """Slices of a batch that hold at most ``size`` bytes of text each, or one row."""
    if not batch.num_rows:
        return
    _, starts = buffers(batch.column(text))
    at = 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(starts, starts[at] + size, "right")) - 1)
        yield batch.slice(at, upto - at)
        at = upto
    # What this batch took is not kept for the next task of the worker.
    pa.default_memory_pool().release_unused()
