"""Anchors: a sample of k-grams such that equal windows hold equal anchors.

An anchor is a k-gram whose hash is the least of some window's k-grams.  Two equal
windows of ``window`` units choose the same k-grams at the same places, so every
window that occurs twice holds an anchor whose hash occurs twice.  The functions
work on whole Arrow batches of texts at once, with numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
#: An odd base and its inverse modulo 2**64.
_BASE = int(_RNG.integers(0, 1 << 63, dtype=np.uint64)) * 2 + 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Units hashed at once, to stay in the processor's cache.
STRETCH = 1 << 15


@dataclass(frozen=True)
class Rule:
    """``window`` units that must agree, ``gram`` units of an anchor; units are words or bytes."""

    window: int
    gram: int
    words: bool

    @property
    def span(self) -> int:
        """k-grams of a window."""
        return self.window - self.gram + 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _POWERS:
        out = []
        for base in (_BASE, _INVERSE):
            p = np.empty(size, dtype=np.uint64)
            p[0], done = 1, 1
            while done < size:  # p[done:2*done] = p[:done] * base**done
                p[done : 2 * done] = p[:done] * np.uint64(pow(base, done, 1 << 64))
                done *= 2
            out.append(p)
        _POWERS[size] = tuple(out)
    return _POWERS[size]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _slices(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each pair (values are uint64)."""
    power, inverse = _powers(len(values) + 1)
    total = np.empty(len(values) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(values * power[: len(values)], out=total[1:])
    return _mixed((total[ends] - total[starts]) * inverse[starts])


def _sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over x[i : i + width], for every i up to len(x) - width."""
    done = 1
    while 2 * done <= width:
        x = op(x[:-done], x[done:])
        done *= 2
    return op(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def _anchors(units: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of one document's units."""
    if len(units) < rule.window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places, hashes = [], []
    step = max(STRETCH, 4 * rule.window)
    last = len(units) - rule.window  # the last window's start
    for at in range(0, last + 1, step):
        stop = min(at + step - 1, last)  # windows at .. stop; their k-grams are the units' own
        part = units[at : stop + rule.window]
        h = _slices(part, np.arange(len(part) - rule.gram + 1), np.arange(rule.gram, len(part) + 1))
        least = _sliding(h, rule.span, np.minimum)
        padded = np.zeros(len(least) + 2 * (rule.span - 1), dtype=np.uint64)
        padded[rule.span - 1 : rule.span - 1 + len(least)] = least
        chosen = np.flatnonzero(_sliding(padded, rule.span, np.maximum) == h)
        places.append(chosen + at)
        hashes.append(h[chosen])
    places, hashes = np.concatenate(places), np.concatenate(hashes)
    if last >= step:  # two stretches may name the same place
        places, first = np.unique(places, return_index=True)
        hashes = hashes[first]
    return places, hashes


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in UTF-8 bytes."""
    space = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    bounds = np.r_[[0] if len(raw) and not space[0] else [], edge, [len(raw)] if len(raw) and not space[-1] else []].astype(np.int64)
    return bounds[0::2], bounds[1::2]


def anchors(text: bytes, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Unit places and signed 64-bit hashes of the anchors of one text."""
    raw = np.frombuffer(text, dtype=np.uint8)
    if rule.words:
        starts, ends = word_bounds(raw)
        if len(starts) < rule.window:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        units = _slices(_BYTE[raw], starts, ends)
    else:
        units = _BYTE[raw]
    places, hashes = _anchors(units, rule)
    return places, hashes.view(np.int64)
