import random
import re
import zlib
from collections import Counter

import pytest

from demandlake.llm import spelling
from demandlake.llm.fm_index import FMIndex, rotation_order
from demandlake.llm.spelling import near_words, spelling_variants, word_counts


def variants(w, letters):
    out = {w[:i] + w[i + 1 :] for i in range(len(w))}
    out |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
    return (out | {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}) - {w}


def brute_counts(rows, every):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % every == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            counts[low] += 1
    return counts


def brute_groups(counts, least=5, length=6, dominance=5):
    words = {w: n for w, n in counts.items() if n >= least and len(w) >= length}
    letters = {c for w in words for c in w}
    near = {w: variants(w, letters) & words.keys() for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= dominance * words[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()) if words else []


def columns(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def random_words(seed, n):
    rng = random.Random(seed)
    words = set()
    while len(words) < n:
        w = "".join(rng.choice("abéÿ") for _ in range(rng.randint(6, 11)))
        words |= {w, w[:3] + w[4:] + "b", rng.choice(sorted(variants(w, "abé")))}
    return sorted(w for w in words if len(w) >= 6)


def test_rotations_are_sorted():
    rng = random.Random(1)
    for n in (1, 2, 30, 200):
        t = [0] + [rng.randint(1, 3) for _ in range(n)]
        got = rotation_order(__import__("numpy").array(t)).tolist()
        assert got == sorted(range(n + 1), key=lambda i: t[i:] + t[:i])


def test_index_finds_one_error_in_each_half():
    words = random_words(3, 300)
    index, asked = FMIndex(words), words + ["ébabab", "zzzzzz", "abaÿabzz", "bab" * 40]
    for left_half in (True, False):
        q, w = index.one_error(asked, left_half)
        got = {(asked[i], words[j]) for i, j in zip(q, w)}
        want = set()
        for a in asked:
            k = len(a) // 2
            half = [a[:k] + x for x in variants(a[k:], "abéÿ")] if left_half else [x + a[k:] for x in variants(a[:k], "abéÿ")]
            want |= {(a, x) for x in set(half) & set(words) if x != a}
        assert got == want


@pytest.mark.parametrize("shard,queries", [(40_000, 20_000), (40, 7)])
def test_near_words_equal_brute_force(spark, monkeypatch, shard, queries):
    monkeypatch.setattr(spelling, "SHARD", shard)
    monkeypatch.setattr(spelling, "QUERIES", queries)
    words = random_words(5, 400) + ["x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1500]
    got = sorted((r["word"], r["near"]) for r in near_words(spark.createDataFrame([(w,) for w in words], "word string").repartition(3)).collect())
    letters = {c for w in words if len(w) < 100 for c in w}
    short = {w for w in words if len(w) < 100}
    want = [(w, x) for w in short for x in variants(w, letters) & short]
    long = words[-3:]
    want += [(long[0], long[1]), (long[1], long[0]), (long[1], long[2]), (long[2], long[1]), (long[0], long[2]), (long[2], long[0])]
    assert got == sorted(want)


def test_groups_equal_brute_force(spark, docs, rows):
    rng = random.Random(9)
    words = random_words(11, 120)
    text = [(1000 + i, " ".join(rng.choices(words, [1 / (k + 1) ** 2 for k in range(len(words))], k=200)).title()) for i in range(60)]
    plain = spark.createDataFrame(text, "doc_id long, text string")
    for df, given in ((docs, [(r[0], r[1]) for r in rows]), (plain, text)):
        got = columns(spelling_variants(word_counts(df, 6, 19)))
        assert got == brute_groups(brute_counts(given, 19))
    assert any(r[1] for r in got)


def test_chains_ties_nulls_and_nothing(spark, no_docs):
    counts = [("abcdef", 5), ("abcdeg", 25), ("abcdgg", 125), ("abcggg", 625), ("xxxxxx", 5), ("xxxxxy", 25), ("axxxxx", 25), (None, 9), ("abcdef", 0), ("few", 4)]
    got = columns(spelling_variants(spark.createDataFrame(counts, "word string, n long")))
    assert got == brute_groups({w: n for w, n in counts[:7]})
    assert [r[2] for r in got if r[0] == "abcdef"] == ["abcggg"] and [r[1] for r in got if r[0] == "xxxxxx"] == ["axxxxx"]
    assert spelling_variants(word_counts(no_docs, 6, 199)).count() == 0
