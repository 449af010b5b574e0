import random
import re

import numpy as np
import pytest

from demandlake.llm import hyperminhash
from demandlake.llm.hyperminhash import MANTISSA_BITS, estimated, linked_groups, near_duplicates, shingle_set, sketch

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_sets(texts, shingle=5):
    out = []
    for t in texts:
        w = WORD.findall((t or "").encode().lower())
        out.append({tuple(w[i : i + shingle]) for i in range(max(len(w) - shingle + 1, 1))} if w else set())
    return out


def brute(rows, percent, shingle=5):
    """(doc_id, n_shingles, component_id, kept) of all rows, by comparing all pairs."""
    sets = brute_sets([t for _, t in rows], shingle)
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        ids = [x for x in (least.get(find(i)), d) if x is not None]
        least[find(i)] = min(ids) if ids else None
    return sorted(((d, len(sets[i]), least[find(i)], d is not None and d == least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()), key=str)


def edited(rng, words, changes):
    w = list(words)
    for _ in range(changes):
        w[rng.randrange(len(w))] = rng.choice("qrstuvwxyz") * 3
    return " ".join(w)


def near_copy_rows(seed, groups=12, others=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    rows, licence = [], " ".join(word() for _ in range(40))
    for g in range(groups):
        base = [word() for _ in range(rng.choice([5, 6, 7, 9, 15, 40, 120, 400]))]
        rows += [(1000 * g + i, edited(rng, base, rng.randint(0, max(1, len(base) // 60)))) for i in range(rng.randint(2, 12))]
        rows += [(1000 * g + 50 + i, " ".join(base[i:])) for i in range(3)]
    rows += [(50_000 + i, licence + " " + " ".join(word() for _ in range(rng.randint(1, 30)))) for i in range(others)]
    rng.shuffle(rows)
    return rows


def test_equals_brute_force(docs, rows):
    assert result(near_duplicates(docs, 5, 80)) == brute([(r[0], r[1]) for r in rows], 80)


@pytest.mark.parametrize("tile,held", [(2048, 1 << 20), (4, 1500)])
def test_split_groups_and_rounds_lose_no_link(spark, monkeypatch, tile, held):
    monkeypatch.setattr(hyperminhash, "TILE", tile)
    monkeypatch.setattr(hyperminhash, "HELD", held)
    rows = near_copy_rows(tile + held)
    assert result(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 5, 85)) == brute(rows, 85)


def test_filter_passes_every_key_and_few_others(spark, monkeypatch):
    from pyspark.sql import functions as F

    keys = spark.range(500).select(F.xxhash64("id").alias("k"))
    others = spark.range(1000, 11_000).select(F.xxhash64("id").alias("k"))
    test = hyperminhash.bit_filter(keys, "k")
    assert keys.where(test(F.col("k"))).count() == 500 and others.where(test(F.col("k"))).count() < 1000
    monkeypatch.setattr(hyperminhash, "FILTER_BITS", 64)
    assert keys.where(hyperminhash.bit_filter(keys, "k")(F.col("k"))).count() == 500
    assert others.where(hyperminhash.bit_filter(keys.limit(0), "k")(F.col("k"))).count() == 0


def test_sketch_keeps_the_least_hash_of_a_bucket():
    rng = np.random.default_rng(2)
    hashes = np.unique(rng.integers(0, 1 << 64, 400, dtype=np.uint64))
    want = np.zeros(128, dtype=int)
    for b in range(128):
        own = [format(int(h), "064b")[7:] for h in hashes if int(h) >> 57 == b]
        if own:
            bits = min(own)
            zeros = len(bits) - len(bits.lstrip("0"))
            want[b] = (zeros + 1) << MANTISSA_BITS | int((bits[zeros + 1 :] + "0" * 64)[:MANTISSA_BITS], 2)
    assert sketch(hashes).tolist() == want.tolist()
    assert not sketch(hashes[:0]).any()


def test_estimates():
    rng = np.random.default_rng(4)
    for n, shared in ((300, 280), (3000, 1500), (40_000, 0), (40_000, 39_000)):
        off = []
        for _ in range(20):
            h = rng.integers(0, 1 << 64, 2 * n - shared, dtype=np.uint64)
            a, b = np.sort(h[:n]), np.sort(h[n - shared :])
            found, _ = estimated(sketch(a)[None], np.array([n]), sketch(b), n)
            off.append(found[0] - shared / (2 * n - shared))
        assert abs(np.mean(off)) < 0.03 and np.std(off) < 0.08


def test_members_of_the_largest_component_are_not_asked():
    asked = []

    def links_of(y):
        asked.append(y)
        near = np.zeros(1000, dtype=bool)
        near[:990] = y < 990
        return near

    label = linked_groups(1000, links_of)
    assert len(set(label)) == 11 and len(asked) == 11


def test_shingle_sets_and_empty_table(spark, no_docs):
    assert len(shingle_set(None, 5)) == len(shingle_set(" \t", 5)) == 0
    assert len(shingle_set("a b C", 5)) == 1 and shingle_set("A b c", 5) == shingle_set("a\nb  C", 5)
    assert near_duplicates(no_docs, 5, 85).count() == 0
