import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from demandlake.llm.anchors import Rule, anchors
from demandlake.llm.repeats import Block
from demandlake.llm.substring_dedup import factor_spans, substring_dedup, without_substrings
from demandlake.llm.suffix_dedup import deep_shallow, suffix_dedup, suffix_spans


def brute(texts, window, words):
    """For each row: units, removed units, runs, sha256 of the rest."""
    cut = [(t or "").encode().split() if words else list((t or "").encode()) for t in texts]
    seen = Counter(tuple(u[i : i + window]) for u in cut for i in range(len(u) - window + 1))
    out = []
    for u in cut:
        gone = np.zeros(len(u), bool)
        for i in range(len(u) - window + 1):
            if seen[tuple(u[i : i + window])] > 1:
                gone[i : i + window] = True
        left = [x for x, g in zip(u, gone) if not g]
        runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(u) > 0 and gone[0]))
        out.append((len(u), int(gone.sum()), runs, hashlib.sha256(b" ".join(left) if words else bytes(left)).hexdigest()))
    return out


CASES = [(substring_dedup, 35, True), (suffix_dedup, 200, False), (substring_dedup, 9, True), (suffix_dedup, 45, False)]


@pytest.mark.parametrize("operator, window, words", CASES)
@pytest.mark.parametrize("hot", [2000, 2])
def test_equals_brute_force(docs, rows, operator, window, words, hot):
    short = [r for r in rows if r[0] != 500]
    few = docs.where("doc_id is null or doc_id <> 500")
    got = Counter((r["doc_id"], r["n"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in operator(few, window, hot=hot).collect())
    want = brute([r[1] for r in short], window, words)
    assert got == Counter((r[0], *w) for r, w in zip(short, want))


def test_a_long_text_and_an_empty_table(docs, no_docs):
    for operator in (substring_dedup, suffix_dedup):
        assert operator(no_docs).count() == 0
        r = operator(docs.where("doc_id = 500")).first()
        assert r["n"] >= 20_000 and r["n_removed"] == 0


def test_kept_texts_and_other_columns(docs, rows):
    got = without_substrings(docs).collect()
    assert len(got) == len(rows) and got[0]["key"] == "key"
    for r in got:
        if r["kept"] is None:
            continue
        assert len(bytes(r["kept"]).split()) < len(r["text"].encode().split())


def test_random_texts(spark):
    rng = random.Random(11)
    for words, operator, window in ((True, substring_dedup, 6), (False, suffix_dedup, 12)):
        alphabet = ["a", "b", "c"]
        texts = [(" " if words else "").join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(80)]
        table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {r["doc_id"]: (r["n"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in operator(table, window, hot=50).collect()}
        assert [got[i] for i in range(len(texts))] == brute(texts, window, words)


def test_every_window_holds_an_anchor_of_its_own_choice():
    rng = random.Random(2)
    rule = Rule(20, 5, False)
    passage = bytes(rng.randrange(256) for _ in range(20))
    found = []
    for n in (0, 3, 70_000):
        text = bytes(rng.randrange(256) for _ in range(n)) + passage + bytes(rng.randrange(256) for _ in range(n))
        places, hashes = anchors(text, rule)
        assert len(places) == len(set(places.tolist())) and sorted(places) == list(places)
        inside = {(p - n, h) for p, h in zip(places.tolist(), hashes.tolist()) if n <= p <= n + 15}
        found.append(inside)
        gaps = np.diff(np.r_[-1, places, len(text) - 5 + 1])
        assert gaps.max() <= 17
    assert set.intersection(*found)


def test_deep_shallow_order_is_the_sorted_order():
    rng = random.Random(4)
    for _ in range(200):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(0, 30))]
        strings += [s + b"x" * 30 for s in strings[:5]] + strings[:3]
        order = deep_shallow(strings, list(range(len(strings))))
        assert sorted(order) == list(range(len(strings)))
        assert [strings[i] for i in order] == sorted(strings)


def test_finders_on_one_anchor():
    rule = Rule(4, 2, True)
    blocks = [Block(1, b"x k l m n", [((0, 0), 0)]), Block(1, b"y k l m n", [((1, 0), 5)]), Block(1, b"x k l m q", [((2, 0), 9)])]
    assert sorted(factor_spans(blocks, rule)) == [(0, 0, 4), (0, 1, 5), (1, 1, 5), (2, 0, 4)]
    rule = Rule(4, 2, False)
    blocks = [Block(b.at, b.raw.replace(b" ", b""), b.places) for b in blocks]
    assert sorted(suffix_spans(blocks, rule)) == [(0, 0, 5), (1, 1, 5), (2, 0, 4)]
