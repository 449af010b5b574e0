import random
import re

import numpy as np
import xxhash

from demandlake.llm import simhash
from demandlake.llm.simhash import components, fingerprint, links, simhash_components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_fp(t):
    w = WORD.findall((t or "").encode().lower())
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(fps, radius):
    up = list(range(len(fps)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    a = np.array(fps, dtype=np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= radius):
            x, y = find(i), find(int(j))
            up[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(a))]


def test_equals_brute_force(docs, rows):
    fps = [brute_fp(r[1]) for r in rows]
    root = roots(fps, 2)
    least = {}
    for r, k in zip(rows, root):
        ids = [x for x in (least.get(k), r[0]) if x is not None]
        least[k] = min(ids) if ids else None
    want = sorted(((r[0], f, least[k]) for r, f, k in zip(rows, fps, root)), key=str)
    got = sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash_components(docs).collect()), key=str)
    assert got == want


def test_fingerprints_of_few_words():
    assert fingerprint(None) == fingerprint("  ") == 0
    for t in ("A", "a B", "a b C", "x " * 70_000):
        assert fingerprint(t) == brute_fp(t)


def near_copies(n, seed, flips=6):
    rng = random.Random(seed)
    centers = [rng.getrandbits(64) for _ in range(5)]
    out = set()
    while len(out) < n:
        x = rng.choice(centers)
        for _ in range(rng.randint(0, flips)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


def test_large_tiles_are_split_and_no_link_is_lost(spark, monkeypatch):
    fps = near_copies(700, 1)
    want = roots(fps, 2)
    for tile, block in ((2048, 256), (16, 8), (5, 4)):
        monkeypatch.setattr(simhash, "TILE", tile)
        monkeypatch.setattr(simhash, "BLOCK", block)
        nodes = spark.createDataFrame([(x - 2**64 if x >> 63 else x,) for x in fps], "fp long")
        found = {r["node"] % 2**64: r["root"] % 2**64 for r in components(links(nodes, 2)).collect()}
        groups = {}
        for x, k in zip(fps, want):
            groups.setdefault(k, []).append(x)
        for own in groups.values():
            assert len({found.get(x, x) for x in own}) == 1
        assert len({found.get(x, x) for x in fps}) == len(groups)


def test_components_of_a_chain_and_of_nothing(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100)], "u long, v long")
    got = {r["node"]: r["root"] for r in components(chain).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {101: 100}
    assert components(chain.limit(0)).count() == 0


def test_empty_table(no_docs):
    assert simhash_components(no_docs).count() == 0
