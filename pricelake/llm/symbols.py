"""Vectorised symbol hashing for Arrow text batches.

A batch of texts is one UTF-8 buffer with document offsets. Words (or bytes)
become 64-bit symbol hashes; any run of symbols gets a hash from prefix
polynomials modulo 2**64, so windows of every length cost a few numpy
operations and no Python loop per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Odd multipliers of the two independent polynomial hashes (any odd numbers do).
BASE_A = 0x9E3779B97F4A7C15
BASE_B = 0xC2B2AE3D27D4EB4F
_MASK = (1 << 64) - 1

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse for i < n (modulo 2**64), kept per process."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        inv = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inv):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _powers[base] = (out[0], out[1])
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (splitmix64), so that every bit depends on all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class RunHash:
    """Hashes of runs [start, end) of a symbol array."""

    def __init__(self, symbols: np.ndarray, base: int = BASE_A):
        self.power, self.inverse = powers(base, len(symbols) + 1)
        self.prefix = np.zeros(len(symbols) + 1, dtype=np.uint64)
        np.cumsum(symbols * self.power[: len(symbols)], out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null text is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if texts.offset:
        texts = pa.concat_arrays([texts])
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


#: Bytes of the words ``[^\\x20\\x09-\\x0D]+``.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Bytes of the words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``: digits, a-z and all of non-ASCII characters.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: A-Z to a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def word_spans(raw: np.ndarray, offsets: np.ndarray, kind: np.ndarray = NOT_BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words (runs of ``kind`` bytes) and the number of words before each document."""
    inside = np.zeros(len(raw) + 2, dtype=bool)
    inside[1:-1] = kind[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE_A) -> np.ndarray:
    return RunHash(raw.astype(np.uint64) + np.uint64(1), base).of(starts, ends)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each window of ``w`` consecutive entries."""
    done, out = 1, x
    while done * 2 <= w:
        out = np.minimum(out[: len(out) - done], out[done:])
        done *= 2
    rest = w - done
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def window_runs(symbols: np.ndarray, doc_starts: np.ndarray, k: int, width: int, chunk: int = 1 << 20):
    """Winnow a batch: runs of consecutive ``width``-windows with one anchor.

    The anchor of a window is its leftmost k-gram of least hash. It depends on
    the window's content alone, so equal windows have equal anchors at equal
    offsets. Returns (doc, first, count, anchor hash, anchor position) per run; windows
    first .. first+count-1 (symbol positions in the batch) share the anchor.
    At most ``chunk`` windows are worked on at once; a run may end where a chunk does.
    """
    n = len(symbols) - width + 1
    parts = [_runs_of(symbols[b: b + chunk + width - 1], b, doc_starts, k, width) for b in range(0, max(0, n), chunk)]
    if not parts:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, empty.astype(np.uint64), empty
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _runs_of(symbols: np.ndarray, begin: int, doc_starts: np.ndarray, k: int, width: int):
    n = len(symbols)
    at = np.arange(n - k + 1, dtype=np.int64)
    gram = RunHash(symbols, BASE_B).of(at, at + k)
    low = np.uint64((1 << int(n).bit_length()) - 1)
    # The hash's high bits and the position in one number: the least of a window names the leftmost least k-gram.
    least = _sliding_min((gram & ~low) | at.astype(np.uint64), width - k + 1) & low
    start = np.arange(n - width + 1, dtype=np.int64)
    doc = np.searchsorted(doc_starts, start + begin, side="right") - 1
    fits = start + begin + width <= doc_starts[doc + 1]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | ~fits[:-1]
    new &= fits
    first = np.flatnonzero(new)
    counts = np.add.reduceat(fits.astype(np.int64), first) if len(first) else first
    where = least[first].astype(np.int64)
    return doc[first], first + begin, counts, gram[where], where + begin
