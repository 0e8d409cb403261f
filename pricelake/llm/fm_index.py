"""Bidirectional FM-index over word ids, for phrases up to a fixed depth.

The text of a shard is a ring of word ids (0 separates pieces). Its rotations,
sorted by their first ``depth`` words, give the Burrows-Wheeler transform (the
word before each rotation); the reversed text gives the transform for the
other direction. A phrase is a pair of intervals of one size, one in each
order; extending it by a word on either side narrows both. Ties beyond
``depth`` words don't matter: no phrase is longer.
"""

from __future__ import annotations

import numpy as np

from pricelake.llm.files import ragged


def stable_order(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stable order, sorted keys) of keys that are not negative.

    Key and place are sorted as one number where both fit, which is several
    times faster than sorting places by key.
    """
    key = key.astype(np.int64)
    bits = max(1, (len(key) - 1).bit_length())
    if not len(key) or int(key.max()) >> (63 - bits):
        order = np.argsort(key, kind="stable")
        return order, key[order]
    packed = np.sort((key << bits) | np.arange(len(key)))
    return packed & ((1 << bits) - 1), packed >> bits


def rotations(ids: np.ndarray, depth: int) -> np.ndarray:
    """Where the rotations of a ring begin, sorted by their first ``depth`` ids (by prefix doubling)."""
    rank, width = ids.astype(np.int64), 1
    order = stable_order(rank)[0] if depth == 1 else np.zeros(0, np.int64)
    while width < depth:
        step = min(width, depth - width)
        order, key = stable_order(rank * (int(rank.max()) + 1) + np.roll(rank, -step))
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        width += step
    return order


def transform(ids: np.ndarray, depth: int) -> np.ndarray:
    """Burrows-Wheeler transform of a ring sorted to ``depth``."""
    return ids[rotations(ids, depth) - 1].astype(np.int32)


def both_transforms(ids: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(transform of the text, transform of the reversed text); ``ids`` must not be empty."""
    return transform(ids, depth), transform(ids[::-1].copy(), depth)


def word_intervals(ids: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin, size) of each word's interval; the same in both orders."""
    size = np.bincount(ids, minlength=symbols)
    return np.cumsum(size) - size, size


def last_to_first(bwt: np.ndarray) -> np.ndarray:
    """For each place of a transform, the rank of the rotation that its word leads."""
    out = np.empty(len(bwt), np.int64)
    out[stable_order(bwt)[0]] = np.arange(len(bwt))
    return out


def extend(bwt: np.ndarray, here: np.ndarray, there: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """All one-word extensions of some phrases, on the side that ``bwt`` looks to.

    ``here`` are the begins of the phrases' intervals in the order of ``bwt``,
    ``there`` those in the other order. Returns (phrase, word, here, there,
    size), a row an extension; separators extend nothing.
    """
    place = ragged(here, size)
    owner = np.repeat(np.arange(len(size)), size)
    symbols = int(bwt.max()) + 1 if len(bwt) else 1
    order, key = stable_order(owner * symbols + bwt[place])
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    phrase, word = np.divmod(key[first], symbols)
    # The least place of a word in the interval leads the extension's own interval.
    begin = last_to_first(bwt)[place[order[first]]]
    # In the other order, extensions follow each other by word within the phrase's interval.
    other = there[phrase] + first - (np.cumsum(size) - size)[phrase]
    real = word > 0
    return phrase[real], word[real], begin[real], other[real], count[real]


def inside(begin: np.ndarray, whole_begin: np.ndarray, whole_size: np.ndarray) -> np.ndarray:
    """Which intervals, by their begin, lie in one of the given disjoint intervals."""
    if not len(whole_begin):
        return np.zeros(len(begin), bool)
    order = np.argsort(whole_begin)
    at = np.searchsorted(whole_begin[order], begin, side="right") - 1
    found = order[np.maximum(at, 0)]
    return (at >= 0) & (begin < whole_begin[found] + whole_size[found])
