"""Operator 3: exact byte-string deduplication over sorted suffixes.

The suffixes that start at one anchor are sorted by deep-shallow sorting: a
multikey quicksort orders them to a shallow depth, and a blind trie orders each
group that still agrees there.  The common prefixes of neighbours give the
intervals of suffixes that agree on so many bytes; within an interval, the texts
before the anchor are sorted backwards the same way.  Bytes before and after the
anchor that agree with another suffix of the interval make a duplicate span if
they are ``window`` bytes together.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

from demandlake.llm.anchors import Rule
from demandlake.llm.repeats import HOT, Block, remove_repeats

WINDOW_BYTES = 200
ANCHOR_BYTES = 40
#: The quicksort compares this many bytes at a time, for so many levels.
CHARACTER, SHALLOW = 8, 3


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class BlindTrie:
    """Order of strings that share a long prefix.

    Inner nodes hold only the depth at which their strings part and the next
    byte of each branch.  A new string first descends blindly, by those bytes
    alone; one comparison with the leaf it reaches gives its true place.
    """

    def __init__(self, strings: list[bytes], first: int):
        self.strings = strings
        self.top: list = [None, [first]]  # a node: [depth, {next byte: node}], a leaf: [None, equal strings]

    def _byte(self, i: int, depth: int) -> int:
        s = self.strings[i]
        return s[depth] if depth < len(s) else -1  # an end sorts first

    def add(self, i: int) -> None:
        node = self.top
        while node[0] is not None:
            node = node[1].get(self._byte(i, node[0])) or next(iter(node[1].values()))
        leaf = node[1][0]
        own, met = self.strings[i], self.strings[leaf]
        depth = common(own, met)
        if depth == len(own) == len(met):
            node[1].append(i)
            return
        node = self.top
        while node[0] is not None and node[0] < depth:
            node = node[1][self._byte(i, node[0])]
        if node[0] == depth:
            node[1][self._byte(i, depth)] = [None, [i]]
        else:  # the branch parts above this node
            node[0], node[1] = depth, {self._byte(leaf, depth): [node[0], node[1]], self._byte(i, depth): [None, [i]]}

    def order(self) -> list[int]:
        out, waiting = [], [self.top]
        while waiting:
            depth, below = waiting.pop()
            if depth is None:
                out += below
            else:
                waiting += [below[k] for k in sorted(below, reverse=True)]
        return out


def deep_shallow(strings: list[bytes], which: list[int], depth: int = 0) -> list[int]:
    """``which`` in the order of its strings, which agree on the first ``depth`` bytes."""
    out: list[int] = []
    waiting = [(which, depth, 0)]
    while waiting:
        group, at, level = waiting.pop()
        if len(group) < 2:
            out += group
        elif level == SHALLOW:
            trie = BlindTrie(strings, group[0])
            for i in group[1:]:
                trie.add(i)
            out += trie.order()
        else:
            keys = [strings[i][at : at + CHARACTER] for i in group]
            pivot = keys[len(keys) // 2]
            low = [i for i, k in zip(group, keys) if k < pivot]
            same = [i for i, k in zip(group, keys) if k == pivot]
            high = [i for i, k in zip(group, keys) if k > pivot]
            deeper = SHALLOW if len(pivot) < CHARACTER else level + 1  # a short key: the strings end here
            waiting += [(high, at, level), (same, at + len(pivot), deeper), (low, at, level)]
    return out


def _intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of the maximal runs of sorted strings; lcp[k] is that of strings k - 1 and k."""
    stack: list[tuple[int, int]] = []
    for k in range(1, len(lcp) + 1):
        here, start = (lcp[k] if k < len(lcp) else -1), k - 1
        while stack and stack[-1][0] > here:
            depth, start = stack.pop()
            yield depth, start, k - 1
        if here >= 0 and (not stack or stack[-1][0] < here):
            stack.append((here, start))


def suffix_spans(blocks: list[Block], rule: Rule) -> Iterator[tuple[int, int, int]]:
    """(block, start, end), in bytes, of strings of at least ``rule.window`` bytes that another block has too."""
    after = [b.raw[b.at :] for b in blocks]
    before = [b.raw[: b.at][::-1] for b in blocks]
    # Every span holds the anchor, so those of one block make one span.
    left, right = [0] * len(blocks), [0] * len(blocks)
    order = deep_shallow(after, list(range(len(blocks))))
    backward = [0] * len(blocks)
    for place, i in enumerate(deep_shallow(before, list(range(len(blocks))))):
        backward[i] = place
    lcp = [0, *(common(after[a], after[b]) for a, b in zip(order, order[1:]))]
    for depth, first, last in _intervals(lcp):
        if depth < rule.gram:
            continue
        inside = sorted(order[first : last + 1], key=backward.__getitem__)
        near = 0
        for a, b in zip(inside, [*inside[1:], None]):
            ahead = common(before[a], before[b]) if b is not None else 0
            back = max(near, ahead)
            if back + depth >= rule.window:
                left[a], right[a] = max(left[a], back), max(right[a], depth)
            near = ahead
    for i, b in enumerate(blocks):
        if len(b.places) > 1 and len(b.raw) >= rule.window:  # the whole block occurs again
            yield i, 0, len(b.raw)
        elif right[i]:
            yield i, b.at - left[i], b.at + right[i]


def suffix_dedup(docs: DataFrame, window: int = WINDOW_BYTES, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """Removes each byte covered by a ``window``-byte string that also starts elsewhere.

    Result and edge cases: see ``repeats.remove_repeats``; units are the bytes of
    the UTF-8 text, so what is kept need not be valid UTF-8.
    """
    rule = Rule(window, min(ANCHOR_BYTES, window), words=False)
    return remove_repeats(docs, rule, suffix_spans, id_col, text_col, hot)
