"""Vectorised scanning of Arrow string columns: words, lines and their hashes, whole texts, a few MB at a time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Texts are scanned in blocks of about this many bytes (one longer text is a block of its own).
BLOCK_BYTES = 512 << 10

# Freed Arrow buffers go back to the system, so that a worker's memory follows its current batch.
pa.set_memory_pool(pa.system_memory_pool())

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BASE2 = np.uint64(0xC2B2AE3D27D4EB4F | 1)
_INV2 = np.uint64(pow(int(_BASE2), -1, 1 << 64))

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept while short, so that one very long text does not hold memory."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * BLOCK_BYTES:
            _POWERS[int(base)] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def running_hash(values: np.ndarray, base=_BASE) -> np.ndarray:
    """Sum over the values before each place, and over all, that the hashes of spans are differences of."""
    c = np.empty(len(values) + 1, np.uint64)
    c[0] = 0
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(base, len(values)), out=c[1:])
    return c


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base=_BASE, inv=_INV, running=None) -> np.ndarray:
    """Hash of values[s:e] for each span, independent of the span's place; ``running``: their ``running_hash``, if at hand."""
    c = running_hash(values, base) if running is None else running
    h = c[ends]
    h -= c[starts]
    h *= powers(inv, len(values) + 1)[starts]
    h += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mixed(h)


def gram_hashes(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words (length n-k+1)."""
    n = len(word_hash)
    if n < k:
        return np.empty(0, np.uint64)
    c = np.empty(n + 1, np.uint64)
    c[0] = 0
    np.cumsum(word_hash * powers(_BASE2, n), out=c[1:])
    return mixed((c[k:] - c[: n - k + 1]) * powers(_INV2, n + 1)[: n - k + 1])


@dataclass
class Block:
    """Some whole texts: their bytes one after another, and where each begins (``offsets`` has one more entry)."""

    first_row: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def words(self, is_space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of each word, and the first word of each text (one more entry)."""
        n = len(self.data)
        inside = np.empty(n + 1, bool)
        np.take(~is_space, self.data, out=inside[:n])
        inside[n] = False
        full = self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]
        before = np.zeros(n + 1, bool)
        before[1:] = inside[:n]
        before[full] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.zeros(n, bool)
        after[:] = inside[1:]
        after[full[full > 0] - 1] = False
        ends = np.flatnonzero(inside[:n] & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of each line (split at \\n; an empty text has one empty line), and each text's first line."""
        cuts = np.flatnonzero(self.data == 10)
        per_row = np.searchsorted(cuts, self.offsets)
        count = np.diff(per_row) + 1
        first = np.concatenate([[0], np.cumsum(count)])
        starts = np.empty(first[-1], np.int64)
        ends = np.empty(first[-1], np.int64)
        own = np.ones(first[-1], bool)
        own[first[:-1]] = False
        starts[first[:-1]] = self.offsets[:-1]
        starts[own] = cuts + 1
        last = np.ones(first[-1], bool)
        last[first[1:] - 1] = False
        ends[first[1:] - 1] = self.offsets[1:]
        ends[last] = cuts
        return starts, ends, first

    def row_sums(self, flags: np.ndarray) -> np.ndarray:
        """Number of true bytes in each text."""
        c = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=c[1:])
        return c[self.offsets[1:]] - c[self.offsets[:-1]]


def blocks(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of an Arrow string or binary array, in row order; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + block_bytes, "right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield Block(row, raw[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


def doc_of(first: np.ndarray) -> np.ndarray:
    """Row number of each item, from the first item of each row."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
