"""A bidirectional FM index over a delimited vocabulary, searched for many queries at once.

The words stand between delimiters in one cyclic text.  An interval of suffix ranks
stands for a pattern; a wavelet matrix over the Burrows-Wheeler transform extends it
to the left, one over the transform of the reversed text to the right, each keeping
the other's interval in step.  All steps act on arrays of intervals.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DELIMITER = 0
#: Symbols of intervals looked at in one step.
STEP = 1 << 21


def rotation_order(text: np.ndarray) -> np.ndarray:
    """Starts of the sorted rotations of a text that is not periodic, by doubling."""
    n, k = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    while True:  # ranks of the first k symbols, then of 2k
        key = rank * n + np.roll(rank, -k)
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.r_[0, np.cumsum(key[order][1:] != key[order][:-1])]
        if rank[order[-1]] == n - 1 or k >= n:
            return order
        k *= 2


class Wavelet:
    """Ranks of symbols in a transformed text."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.bits = max(1, (size - 1).bit_length())
        self.zeros, at = [], symbols
        for b in range(self.bits - 1, -1, -1):
            one = (at >> b) & 1
            self.zeros.append(np.r_[0, np.cumsum(one == 0)].astype(np.int32))
            at = np.r_[at[one == 0], at[one == 1]]
        self.symbols = symbols
        self.before = np.r_[0, np.cumsum(np.bincount(symbols, minlength=size))]
        self.start = np.zeros(size, dtype=np.int64)
        self.start = self._down(np.arange(size), np.zeros(size, np.int64), np.zeros(size, np.int64))[0]

    def _down(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        less = np.zeros(len(c), dtype=np.int64)
        for b, zeros in zip(range(self.bits - 1, -1, -1), self.zeros):
            one = (c >> b & 1).astype(bool)
            a, z = zeros[lo].astype(np.int64), zeros[hi].astype(np.int64)
            less += np.where(one, z - a, 0)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - z, z)
        return lo, hi, less

    def extend(self, c: np.ndarray, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Interval (start, size) of each pattern with ``c`` before it, and how many of its places follow a smaller symbol."""
        a, z, less = self._down(c, lo, lo + size)
        return self.before[c] + a - self.start[c], z - a, less


@dataclass
class States:
    """Patterns found so far: query, place in it, and intervals in the text and the reversed text."""

    query: np.ndarray
    place: np.ndarray
    lo: np.ndarray
    back: np.ndarray
    size: np.ndarray

    def take(self, which: np.ndarray) -> States:
        return States(self.query[which], self.place[which], self.lo[which], self.back[which], self.size[which])

    def moved(self, by: int) -> States:
        return States(self.query, self.place + by, self.lo, self.back, self.size)

    def plus(self, *others: States) -> States:
        both = (self, *others)
        return States(*(np.concatenate([getattr(s, f) for s in both]) for f in ("query", "place", "lo", "back", "size")))

    def __len__(self) -> int:
        return len(self.query)


class FMIndex:
    """An index of distinct words."""

    def __init__(self, words: list[str]):
        flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        self.letters = np.unique(flat)
        length = np.array([len(w) for w in words], dtype=np.int64)
        self.starts = np.cumsum(length + 1) - length - 1  # places of the delimiters before the words
        text = np.zeros(len(flat) + len(words), dtype=np.int64)
        inside = np.ones(len(text), dtype=bool)
        inside[self.starts] = False
        text[inside] = np.searchsorted(self.letters, flat) + 1
        self.size = len(self.letters) + 1
        self.order = rotation_order(text)
        self.left = Wavelet(text[self.order - 1], self.size)
        mirrored = text[::-1]
        self.right = Wavelet(mirrored[rotation_order(mirrored) - 1], self.size)

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Padded symbols of the queries and their lengths; ``size`` stands for a letter that no word has."""
        length = np.array([len(w) for w in words], dtype=np.int64)
        flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        k = np.minimum(np.searchsorted(self.letters, flat), len(self.letters) - 1)
        out = np.full((len(words), int(length.max()) + 1), DELIMITER, dtype=np.int64)
        out[np.arange(out.shape[1]) < length[:, None]] = np.where(self.letters[k] == flat, k + 1, self.size)
        return out, length

    def extend(self, s: States, c: np.ndarray, right: bool) -> States:
        """``s`` with the symbols ``c`` on one side; what is found nowhere is dropped."""
        here = np.flatnonzero(c < self.size)
        s, c = s.take(here), c[here]
        if right:
            back, size, less = self.right.extend(c, s.back, s.size)
            out = States(s.query, s.place, s.lo + less, back, size)
        else:
            lo, size, less = self.left.extend(c, s.lo, s.size)
            out = States(s.query, s.place, lo, s.back + less, size)
        return out.take(np.flatnonzero(size > 0))

    def children(self, s: States, right: bool) -> tuple[States, np.ndarray]:
        """Every state with every letter that stands on that side, and the letter."""
        parts = []
        lo, symbols = (s.back, self.right.symbols) if right else (s.lo, self.left.symbols)
        wide = s.size > self.size
        few = np.flatnonzero(~wide)
        ends = np.cumsum(s.size[few])
        for a in range(0, int(ends[-1]) if len(ends) else 0, STEP):
            some = few[np.searchsorted(ends, a, "right") : np.searchsorted(ends, a + STEP, "right")]
            n = s.size[some]
            at = np.arange(n.sum()) + np.repeat(lo[some] - np.r_[0, np.cumsum(n)[:-1]], n)
            parts.append(np.unique(np.repeat(some, n) * self.size + symbols[at]))
        parts.append((np.flatnonzero(wide)[:, None] * self.size + np.arange(1, self.size)).ravel())
        pairs = np.concatenate(parts)
        which, c = pairs // self.size, pairs % self.size
        letters = np.flatnonzero(c != DELIMITER)
        tagged = s.take(which[letters])
        keep = tagged.place.copy()
        tagged.place = np.arange(len(tagged))  # which pairs are left after the step
        out = self.extend(tagged, c[letters], right)
        letter = c[letters][out.place]
        out.place = keep[out.place]
        return out, letter

    def one_error(self, words: list[str], left_half: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers: the words that differ from a query by one inserted, deleted or
        replaced letter, found with that error in the query's right half (``left_half``: the
        left half is matched exactly and extended to the right) or in its left half."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes, length = self.codes(words)
        split = length // 2
        n = len(words)
        whole = States(np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, len(self.order)))
        if left_half:  # the half's letters from its last to its first, then the delimiter
            todo, side, exact = split, True, lambda q, p: codes[q, split[q] - 1 - p]
            rest, across = length - split, lambda q, p: codes[q, np.minimum(split[q] + p, codes.shape[1] - 1)]
            s = whole
        else:
            todo, side, exact = length - split, False, lambda q, p: codes[q, length[q] - 1 - p]
            rest, across = split, lambda q, p: codes[q, np.maximum(split[q] - 1 - p, 0)]
            s = self.extend(whole, np.full(n, DELIMITER), False)
        done = s.take(np.zeros(0, np.int64))
        while len(s):
            at_end = s.place == todo[s.query]
            done, s = done.plus(s.take(at_end)), s.take(~at_end)
            s = self.extend(s.moved(1), exact(s.query, s.place), False)
        s = self.extend(done, np.full(len(done), DELIMITER), False) if left_half else done
        s = States(s.query, np.zeros(len(s), np.int64), s.lo, s.back, s.size)  # places count across the other half now
        spent, found = s.take(np.zeros(0, np.int64)), []
        while len(s) or len(spent):
            if len(s):
                child, letter = self.children(s, side)
                inner = child.place < rest[child.query]
                replaced = child.take(inner & (letter != across(child.query, child.place))).moved(1)
                inside = s.take(s.place < rest[s.query])
                spent = spent.plus(child, replaced, inside.moved(1))  # inserted, replaced, deleted
                s = self.extend(inside.moved(1), across(inside.query, inside.place), side)
            over = spent.place == rest[spent.query]
            found.append(self.extend(spent.take(over), np.full(int(over.sum()), DELIMITER), side))
            spent = spent.take(~over)
            spent = self.extend(spent.moved(1), across(spent.query, spent.place), side)
        hits = found[0].plus(*found[1:]) if found else spent
        at = np.arange(hits.size.sum()) + np.repeat(hits.lo - np.r_[0, np.cumsum(hits.size)[:-1]], hits.size) if len(hits) else np.zeros(0, np.int64)
        pairs = np.unique(np.repeat(hits.query, hits.size) * len(self.starts) + np.searchsorted(self.starts, self.order[at]))
        return pairs // len(self.starts), pairs % len(self.starts)
