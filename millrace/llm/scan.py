"""Words and segments of many texts at once, straight from their UTF-8 bytes."""

from __future__ import annotations

import numpy as np

# Odd multipliers for the first 256 places in a word; those of later ones are derived from them.
POWERS = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
VALUES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)[LOWER]


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for first, last in ranges:
        out[first:last + 1] = True
    return out


SPACES = byte_set((9, 13), (32, 32))


def segments(raw: np.ndarray, bounds: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and row of each segment; a segment runs up to and with one of the ``ends`` bytes."""
    first = np.zeros(len(raw) + 1, bool)
    first[1:] = ends[raw]
    first[bounds] = True
    starts = np.flatnonzero(first[:-1])
    return starts, np.searchsorted(bounds, starts, side="right") - 1


def words(raw: np.ndarray, bounds: np.ndarray, inside: np.ndarray,
          prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, list[np.ndarray]]:
    """Start of each word, and its lower-cased 64-bit hash, then those of its first bytes.

    A word is a longest run of ``inside`` bytes within a row.
    """
    if not len(raw):
        return np.zeros(0, np.int64), [np.zeros(0, np.uint64)] * (1 + len(prefixes))
    body = inside[raw]
    first = body.copy()
    first[1:] &= ~body[:-1]
    edges = bounds[bounds < len(raw)]
    first[edges] = body[edges]
    places = np.flatnonzero(body)
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, [np.zeros(0, np.uint64)] * (1 + len(prefixes))
    begin = np.flatnonzero(first[places])
    sizes = np.diff(np.append(begin, len(places)))
    at = (np.arange(len(places)) - np.repeat(begin, sizes))
    parts = VALUES[raw[places]] * POWERS[at & 255]
    if len(at) and at.max() > 255:  # later places get multipliers of their own
        far = np.flatnonzero(at > 255)
        parts[far] *= mixed((at[far] >> 8).astype(np.uint64)) | np.uint64(1)
    out = [mixed(np.add.reduceat(parts, begin))]
    for k in prefixes:
        out.append(mixed(np.add.reduceat(np.where(at < k, parts, np.uint64(0)), begin) + np.uint64(k)))
    return starts, out


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit hash over all its bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))
