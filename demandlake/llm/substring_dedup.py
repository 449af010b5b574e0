"""Operator 2: substring deduplication by relative Lempel-Ziv parsing.

The reference is cut into blocks around its anchors and indexed; each block of a
document is factored greedily against every other block that the index lists.
A factor of at least ``window`` words is a duplicate span.  The parse then goes
back to the factor's boundary: the first window that the factor doesn't cover is
looked up next, so a window that lies across two factors is found as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame

from demandlake.llm.anchors import Rule
from demandlake.llm.repeats import HOT, Block, remove_repeats, without_repeats

WINDOW_WORDS = 35
#: Words of an anchor: fewer make fewer anchors, more make fewer chance matches.
ANCHOR_WORDS = 8


def factor_spans(blocks: list[Block], rule: Rule) -> Iterator[tuple[int, int, int]]:
    """(block, start, end), in words, of the factors of at least ``rule.window`` words.

    All blocks hold the same anchor, so a window of one can only match a window
    of another that starts as many words before it.
    """
    width = rule.window
    index: dict[tuple[int, bytes], list[int]] = {}  # words before the anchor, window -> the first two blocks that have it
    bounds = []
    for i, b in enumerate(blocks):
        ends = list(accumulate(len(w) + 1 for w in b.raw.split(b" ")))
        bounds.append([0, *ends])  # word k is raw[bounds[k] : bounds[k + 1] - 1]
        for s in range(0, min(b.at, len(ends) - width) + 1):
            seen = index.setdefault((b.at - s, b.raw[bounds[i][s] : ends[s + width - 1] - 1]), [])
            if len(seen) < 2:
                seen.append(i)
    for i, b in enumerate(blocks):
        own, n = bounds[i], len(bounds[i]) - 1
        if len(b.places) > 1:  # the whole block occurs again
            if n >= width:
                yield i, 0, n
            continue
        s = 0
        while s <= min(b.at, n - width):
            seen = index[b.at - s, b.raw[own[s] : own[s + width] - 1]]
            other = next((j for j in seen if j != i), None)
            if other is None:
                s += 1
                continue
            ref, there, r = blocks[other].raw, bounds[other], blocks[other].at - (b.at - s) + width
            e = s + width
            while e < n and r < len(there) - 1 and b.raw[own[e] : own[e + 1] - 1] == ref[there[r] : there[r + 1] - 1]:
                e, r = e + 1, r + 1
            yield i, s, e
            s = e - width + 1  # the boundary: the first window beyond the factor


def substring_dedup(docs: DataFrame, window: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """Removes each word covered by a ``window``-word sequence that also starts elsewhere.

    Result and edge cases: see ``repeats.remove_repeats``; words are what lies
    between ASCII blanks, unchanged, and a text of fewer words than the window
    stays whole.
    """
    rule = Rule(window, min(ANCHOR_WORDS, window), words=True)
    return remove_repeats(docs, rule, factor_spans, id_col, text_col, hot)


def without_substrings(docs: DataFrame, window: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """``docs`` with ``kept``: the words that ``substring_dedup`` leaves, joined by one blank; null where all stay."""
    return without_repeats(docs, Rule(window, min(ANCHOR_WORDS, window), words=True), factor_spans, id_col, text_col, hot)
