import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

import math

import pytest
import xxhash

from demandlake.llm.fingerprints import combine, fingerprint_edits, fingerprint_text, fingerprint_vector, likeness, text_vector
from demandlake.llm.quality import THRESHOLD, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    again = {i + j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(8)}
    failed = len(w) < 20 or 100 * len(again) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again), failed


def test_base_rules_equal_brute_force(docs, rows, spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(300, 0, 0), (None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    got = quality_rules(docs, labels).collect()
    assert len(got) == len(rows)
    want = {(d, t): base(t) for d, t, *_ in rows}
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want[r["doc_id"], r["text"]], r["doc_id"]
        assert not (r["kept"] and r["base_failed"]) and r["score"] is not None
        assert r["kept"] == (not r["base_failed"] and r["score"] >= THRESHOLD)


def h64(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed)


def signed(x):
    return x - 2**64 if x >> 63 else x


def brute_scores(rows, labels):
    """Scores by the formula, in plain Python: hashed uni- and bigrams, smoothed log ratios, level of the held-out."""
    buckets = 1 << 16

    def grams(t):
        hs = [h64(w.encode()) for w in WORD.findall(t or "")]
        low = lambda x: x & (buckets - 1)
        return [low(x) for x in hs] + [low(h64(b.to_bytes(8, "little"), h64(a.to_bytes(8, "little")))) for a, b in zip(hs, hs[1:])]

    good = {d for d, quality, toxic in labels if d is not None and quality == 1 and not toxic}
    held = {d for d in good if signed(h64((1).to_bytes(4, "little"), h64(d.to_bytes(8, "little", signed=True)))) % 4 == 0}
    raw, target = Counter(), Counter()
    for d, t, *_ in rows:
        raw.update(grams(t))
        if d in good - held:
            target.update(grams(t))
    n_raw, n_target = sum(raw.values()) + buckets, sum(target.values())
    prior = 0.1 * n_target or 1.0

    def ratio(b):
        p = (raw[b] + 1) / n_raw
        return float(f"{math.log((target[b] + prior * p) / (n_target + prior) / p):.6f}")

    def mean(t):
        g = grams(t)
        return sum(map(ratio, g)) / max(len(g), 1)

    levels = sorted(mean(t) for d, t, *_ in rows if d in held and len(WORD.findall(t or "")) >= 20)
    at = 0.05 * (len(levels) - 1)
    level = levels[math.floor(at)] + (at - math.floor(at)) * (levels[math.ceil(at)] - levels[math.floor(at)])
    return [mean(t) - level for _, t, *_ in rows]


def test_scores_and_verdicts_equal_brute_force(docs, rows, spark):
    labels = [(i, 1, 0) for i in range(36)] + [(300, 0, 0), (None, 1, 0), (5, None, None), (38, 1, 1), (100, 1, None)]
    want = {(d, t): s for (d, t, *_), s in zip(rows, brute_scores(rows, labels))}
    got = quality_rules(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len({round(s, 3) for s in want.values()}) > 20
    for r in got:
        score = want[r["doc_id"], r["text"]]
        assert r["score"] == pytest.approx(score, abs=1e-9)
        assert r["kept"] == (not base(r["text"])[-1] and score >= THRESHOLD)
    assert min(want.values()) < 0 < max(want.values())


def test_scores_part_trusted_text_from_junk(spark):
    import random

    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(300)]
    good = [(i, " ".join(rng.choice(vocab) for _ in range(250))) for i in range(4000)]
    junk = [(5000 + i, " ".join(rng.choice(vocab) + "%%%" for _ in range(250))) for i in range(400)]
    docs = spark.createDataFrame(good + junk, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 4000, 2)] + [(5000 + i, 0, 0) for i in range(0, 400, 2)], "doc_id long, quality int, toxic int")
    kept = Counter((r["doc_id"] >= 5000, r["kept"]) for r in quality_rules(docs, labels).collect())
    assert kept == {(False, True): 4000, (True, False): 400}


def test_quality_of_nothing_and_without_labels(docs, rows, no_docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules(no_docs, none).count() == 0
    got = quality_rules(docs, none).collect()
    assert all(abs(r["score"]) < 1e-9 and r["kept"] == (not r["base_failed"]) for r in got)


def brute_vector(t):
    """Summed vectors of the pieces: their number, four hashes modulo 2^60, 30 pairs of bits of two of these."""
    total = [0] * 65
    for piece in re.split(r"\n+|(?<=[.!?])[ ]+", t):
        if piece:
            hs = [h64(i.to_bytes(4, "little"), h64(piece.encode())) for i in range(4)]
            own = [1, *hs, *((h >> k & 1) + ((h >> k + 30 & 1) << 30) for h in hs[:2] for k in range(30))]
            total = [(a + b) % 2**60 for a, b in zip(total, own)]
    return total


def brute_likeness(a, b):
    if a == b:
        return 1.0
    lanes = lambda v: [2 * (x >> s & (1 << 30) - 1) - v[0] for x in v[5:] for s in (0, 30)]
    x, y = lanes(a), lanes(b)
    size = sum(u * u for u in x) + sum(u * u for u in y)
    return max(0.0, min(0.999999, 1 - sum((u - v) ** 2 for u, v in zip(x, y)) / size)) if size else 0.0


def test_the_returned_fingerprint_gives_the_likeness(spark):
    texts = ["one line\ntwo lines\nlast one", "one line\nother lines\nlast one", "", "A b. C d! E f?"]
    pairs = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string").select(*[fingerprint_vector(F.col(c)).alias(c) for c in "ab"])
    back = pairs.select(likeness(F.col("a"), F.col("b")).alias("x"), likeness(*[text_vector(fingerprint_text(F.col(c))) for c in "ab"]).alias("y")).collect()
    assert all(r["x"] == r["y"] for r in back)


def test_edits_equal_brute_force(spark, docs, rows):
    distinct = {(d, t or "") for d, t, *_ in rows if d is not None}
    ids = Counter(d for d, _ in distinct)
    plain = docs.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", "text"]).where(~F.col("doc_id").isin([d for d, n in ids.items() if n > 1]))
    text = {d: t for d, t in distinct if ids[d] == 1}
    order = sorted(text, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    got = {r["doc_id"]: r for r in fingerprint_edits(plain).collect()}
    assert set(got) == set(text)
    for d, t in text.items():
        cut = len(t) // 3
        edited = t[: len(t) - cut] + text[after[d]][:cut]
        assert got[d]["n_chars"] == len(t)
        assert got[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest(), d
        own, changed, following = brute_vector(t), brute_vector(edited), brute_vector(text[after[d]])
        assert got[d]["fingerprint"] == "".join(f"{x:015x}" for x in own)
        assert got[d]["edited_fingerprint"] == "".join(f"{x:015x}" for x in changed)
        assert got[d]["near_edited"] == pytest.approx(brute_likeness(own, changed), abs=1e-9)
        assert got[d]["near_next"] == pytest.approx(brute_likeness(own, following), abs=1e-9)
    by_text = {}
    for d, t in text.items():
        by_text.setdefault(t, set()).add(got[d]["fingerprint"])
    assert all(len(f) == 1 for f in by_text.values())


def test_edits_with_repeated_rows_and_null_ids(docs, rows, no_docs, spark):
    assert fingerprint_edits(docs).count() == len(rows)
    assert fingerprint_edits(no_docs).count() == 0
    one = spark.createDataFrame([(1, "abc def")], "doc_id long, text string")
    assert fingerprint_edits(one).first()["edited_sha256"] == hashlib.sha256(b"abc dab").hexdigest()


def test_many_ranges_chain_on(spark):
    n = 5000
    table = spark.range(n).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")).repartition(7)
    got = {r["doc_id"]: r["edited_sha256"] for r in fingerprint_edits(table).collect()}
    for d in (0, 1, 999, 1000, 2500, n - 1):
        t, nxt = str(d), str((d - 1) % n)
        cut = len(t) // 3
        assert got[d] == hashlib.sha256((t[: len(t) - cut] + nxt[:cut]).encode()).hexdigest()


def test_fingerprints_add_take_away_and_forget_order(spark):
    a, b = "one line\ntwo lines\nlast", "more\nand more"
    row = spark.createDataFrame([(a, b, a + "\n" + b, b + "\n" + "last\none line\ntwo lines")], "a string, b string, ab string, ba string").select(*[fingerprint_vector(F.col(c)).alias(c) for c in ("a", "b", "ab", "ba")])
    r = row.select(
        (combine(F.col("a"), F.col("b")) == F.col("ab")).alias("sum"), (combine(F.col("ab"), F.col("b"), -1) == F.col("a")).alias("less"), (F.col("ab") == F.col("ba")).alias("order"),
        (F.col("a") == F.col("b")).alias("differ"), likeness(F.col("a"), F.col("a")).alias("same"), F.length(fingerprint_text(F.col("a"))).alias("len"),
    ).first()
    assert r["sum"] and r["less"] and r["order"] and not r["differ"] and r["same"] == 1.0 and r["len"] == 65 * 15


def test_likeness_follows_the_overlap(spark):
    lines = [f"line {i} with words" for i in range(300)]
    rows = [(k, "\n".join(lines[:200]), "\n".join(lines[k : k + 200])) for k in (0, 50, 100)]
    got = {r["k"]: r["near"] for r in spark.createDataFrame(rows, "k int, x string, y string").select("k", likeness(fingerprint_vector(F.col("x")), fingerprint_vector(F.col("y"))).alias("near")).collect()}
    assert got[0] == 1.0 and abs(got[50] - 0.75) < 0.15 and abs(got[100] - 0.5) < 0.2
