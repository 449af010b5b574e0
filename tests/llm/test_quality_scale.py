import math
import random
from collections import Counter

import pytest

from pyspark.sql import functions as F

from demandlake.llm import quality
from demandlake.llm.quality import BUCKETS, PRIOR_SHARE, held_out, log_ratios, ngram_buckets, perhaps_trusted, quality_rules, quantile, trusted_docs
from demandlake.llm.words import words_of


@pytest.mark.parametrize("n_trusted", [50, 500, 20_000])
def test_junk_goes_whatever_the_number_of_trusted_documents(spark, n_trusted):
    rng = random.Random(4)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(300)]
    clean = [(i, " ".join(rng.choice(vocab) for _ in range(60))) for i in range(max(2_000, n_trusted + 500))]
    junk = [(-1 - i, " ".join(rng.choice(vocab) + "%%%" for _ in range(60))) for i in range(200)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(n_trusted)], "doc_id long, quality int, toxic int")
    got = Counter((r["doc_id"] < 0, r["kept"]) for r in quality_rules(docs, labels).select("doc_id", "kept").collect())
    assert got[True, True] <= 10, got  # of 200 junk texts
    assert got[False, False] <= 0.01 * len(clean), got


def test_all_trusted_documents_are_used(spark):
    labels = spark.range(20_500).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    assert trusted_docs(labels).count() == 20_500


@pytest.mark.parametrize("n", [0, 1, 7, 10_001, 30_000])
def test_quantile_is_the_percentile(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([0.0, rng.gauss(0, 1), rng.gauss(0, 1) ** 9]),) for _ in range(n)]
    values = spark.createDataFrame(rows, "m double")
    want = values.selectExpr("percentile(m, 0.05)").first()[0]
    assert quantile(values, 0.05) == (None if want is None else pytest.approx(want, rel=1e-12))


def test_only_texts_that_may_be_trusted_are_moved(spark):
    trusted = spark.range(0, 60_000, 3).select(F.col("id").alias("_id"))
    docs = spark.range(60_000).selectExpr("id as doc_id", "'a' as text").unionAll(spark.sql("select cast(null as long), 'a'"))
    got = Counter((r._doc is not None and r._doc % 3 == 0, r._may) for r in perhaps_trusted(docs, trusted).select("_doc", "_may").collect())
    assert got[True, True] == 20_000 and got[True, False] == 0, got
    assert 0.05 < got[False, True] / 40_001 < 0.2, got
    none = perhaps_trusted(docs, trusted.limit(0))
    assert none.count() == 60_001 and none.where("_may").count() == 0


@pytest.mark.parametrize("most", [0, 4_096])  # 0 maps of one bit each: every text may be trusted
def test_ratios_count_each_document_once(spark, monkeypatch, most):
    rng = random.Random(9)
    if not most:
        monkeypatch.setattr(quality, "MAP_SIZE", 1)
        monkeypatch.setattr(quality, "MOST_MAPS", 1)
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, "", " ".join(rng.choice("abcdef") for _ in range(rng.randint(1, 9)))])) for _ in range(200)]
    docs = spark.createDataFrame(rows + rows[:20], "doc_id long, text string").repartition(3)
    trusted = spark.range(0, 90, 2).select(F.col("id").alias("_id"))
    marked = perhaps_trusted(docs, trusted)
    if not most:
        assert marked.where("_doc is not null and not _may").count() == 0
    got = {r.bucket: r.ratio for r in log_ratios(marked, trusted.where(~held_out(F.col("_id")))).collect()}
    fitted = {r._id for r in trusted.where(~held_out(F.col("_id"))).collect()}
    raw, target = Counter(), Counter()
    for r in docs.select("doc_id", ngram_buckets(words_of(F.col("text"))).alias("b")).collect():
        raw.update(r.b)
        target.update(r.b if r.doc_id in fitted else [])
    n, prior = target.total(), PRIOR_SHARE * target.total()
    for b in range(BUCKETS):
        p = (raw[b] + 1) / (raw.total() + BUCKETS)
        assert got[b] == pytest.approx(math.log((target[b] + prior * p) / (n + prior) / p), abs=1e-9)


def test_texts_meet_the_trusted_ids_in_the_same_way_at_each_size(spark):
    trusted = spark.range(20).select(F.col("id").alias("_id"))
    docs = spark.range(50).selectExpr("id as doc_id", "'a b c' as text")
    marked = perhaps_trusted(docs, trusted)
    plans = []
    real = quality.written
    with pytest.MonkeyPatch.context() as m:
        m.setattr(quality, "written", lambda df, name: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or real(df, name))
        log_ratios(marked, trusted.where(~held_out(F.col("_id"))))
    assert "ShuffledHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]
