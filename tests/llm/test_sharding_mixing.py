import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from demandlake.llm import ordering
from demandlake.llm.mixing import mix, source_targets
from demandlake.llm.ordering import hex_key, ranges_of, with_prefix
from demandlake.llm.scratch import written
from demandlake.llm.sharding import shard_by_size
from demandlake.llm.words import words_of


def nbytes(t):
    return len((t or "").encode())


def test_shards_hold_near_equal_bytes(docs, rows):
    got = [r.asDict() for r in shard_by_size(docs, 5).collect()]
    assert Counter((g["doc_id"], g["size"], g["text_crc32"]) for g in got) == Counter((d, nbytes(t) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    by = defaultdict(list)
    for g in got:
        by[g["shard"]].append(g)
        assert g["law"] == "bytes" and g["grown_shard"] is None
    total, biggest = sum(g["size"] for g in got), max(g["size"] for g in got)
    assert set(by) <= set(range(5))
    for own in by.values():
        assert sorted(g["slot"] for g in own) == list(range(len(own)))
        assert abs(sum(g["size"] for g in own) - total / 5) <= biggest


def test_shards_of_nothing_and_of_one(no_docs, spark):
    assert shard_by_size(no_docs, 4).count() == 0
    one = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [r["slot"] for r in shard_by_size(one, 4).collect()] == [0]


def test_prefix_sums_over_many_ranges_and_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_RANGE", 50)
    data = [(i if i % 3 else 7, i % 11) for i in range(2000)]  # a third of the rows share a key
    keyed = written(spark.createDataFrame(data, "id long, w long").select(F.concat(hex_key(F.col("id")), F.lit("-"), hex_key(F.monotonically_increasing_id())).alias("k"), "w"), "t")
    splitters, totals = ranges_of(keyed, "k", F.col("w") + 1)
    assert len(splitters) > 20 and sum(n for n, _ in totals) == 2000
    assert max(w for _, w in totals) < 4 * sum(w for _, w in totals) / 40  # overfull ranges were subdivided
    got = sorted((r["row_index"], r["k"], r["w"], r["before"]) for r in with_prefix(keyed, "k", "w").collect())
    running = 0
    for place, (index, k, w, before) in enumerate(got):
        assert (index, before) == (place, running)
        running += w
    assert [g[1] for g in got] == sorted(g[1] for g in got)


def brute_targets(sizes, weights, share, most):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, capped = share * sum(sizes.values()), set()
    while True:
        rest = sum(w[s] for s in names if s not in capped)
        level = (budget - sum(most * sizes[s] for s in capped)) / rest if rest else 0
        more = {s for s in names if s not in capped and most * sizes[s] <= level * w[s]}
        if not more:
            return {s: most * sizes[s] if s in capped else level * w[s] for s in names}
        capped |= more


def test_mix_meets_its_targets(docs, rows):
    size = lambda t: len((t or "").encode().split())
    sized = docs.withColumn("words", F.size(words_of(F.col("text"))))
    run = lambda: sorted(map(str, mix(sized, F.col("words"), [F.col("doc_id"), F.xxhash64("text")], [3, 1, 2], 1.5, 2.0).select("doc_id", "words", "source", "source_size", "target", "copies").collect()))
    assert run() == run()
    got = mix(sized, F.col("words"), [F.col("doc_id"), F.xxhash64("text")], [3, 1, 2], 1.5, 2.0).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((d, t) for d, t, *_ in rows)
    sizes, largest, taken = Counter(), Counter(), Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += size(t)
        largest[s] = max(largest[s], 3 * size(t))  # repeated rows share their fate
    target = brute_targets(sizes, [3, 1, 2], 1.5, 2.0)
    for r in got:
        assert 0 <= r["copies"] <= 2 and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - target[r["source"]]) < 1e-6 * max(1, target[r["source"]])
        assert r["key"] == "key"  # other columns stay
        taken[r["source"]] += r["words"] * r["copies"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s], s


def test_mix_of_nothing_and_of_zero_sizes(no_docs, spark):
    assert mix(no_docs, F.lit(1), [F.col("doc_id")], [3, 1, 2], 1.5, 2.0).count() == 0
    zeros = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, source string")
    assert mix(zeros, F.lit(None).cast("long"), [F.col("doc_id")], [3, 1, 2], 1.5, 2.0).count() == 2


def test_targets_of_many_sources(spark):
    sizes = {f"{i:03d}": (i * 37) % 91 + 1 for i in range(200)} | {None: 5000, "": 3}
    got = source_targets(spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long"), [3, 1, 2], 1.5, 2.0)
    want = brute_targets(sizes, [3, 1, 2], 1.5, 2.0)
    for r in got.collect():
        assert abs(r["target"] - want[r["source"]]) < 1e-6
