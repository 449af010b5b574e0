import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from demandlake.llm.catalog import ORACLE, QUERIES
from demandlake.llm.quality import THRESHOLD
from demandlake.llm.scratch import written

from .conftest import SCHEMA, hard_rows
from .test_quality_fingerprints import base, brute_scores
from .test_repeats import brute
from .test_simhash import brute_fp, roots


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(hard_rows(), SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def rows_of(df):
    return sorted(map(tuple, df.select(corpus_pipeline.COLUMNS).collect()), key=str)


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "SimHash near-dedup", "substring dedup", "mixing sources", "best-fit packing"]
    first = written(steps["quality rules"](spark, docs, folder), "test")
    kept, every = rows_of(first), rows_of(docs)
    scores = brute_scores(every, [(i, 1, 0) for i in range(30)])
    assert kept == [r for r, s in zip(every, scores) if not base(r[1])[-1] and s >= THRESHOLD]

    second = written(steps["SimHash near-dedup"](spark, first, folder), "test")
    group = roots([brute_fp(r[1]) for r in kept], 2)
    groups = {}
    for r, k in zip(kept, group):
        groups.setdefault(k, []).append(r)
    left = rows_of(second)
    assert len(left) == len(groups)
    for own in groups.values():
        ids = [r[0] for r in own if r[0] is not None]
        (stays,) = [r for r in own if r in left][:1]
        assert stays[0] == (min(ids) if ids else None)

    third = written(steps["substring dedup"](spark, second, folder), "test")
    before = rows_of(second)
    gone = {(r[0], w[0]): (r, w) for r, w in zip(before, brute([r[1] for r in before], 35, True))}
    kept3 = rows_of(third)
    assert len(kept3) == sum(w[1] < w[0] for _, w in gone.values())
    whole = {r for r, w in gone.values() if not w[1]}
    cut = sorted((r[0], w[0] - w[1]) for r, w in gone.values() if 0 < w[1] < w[0])
    assert whole <= set(kept3)
    assert sorted((r[0], len(r[1].split(" "))) for r in kept3 if r not in whole) == cut
    assert all(r[4] == len(r[1]) for r in kept3 if r not in whole)

    fourth = written(steps["mixing sources"](spark, third, folder), "test")
    assert set(rows_of(fourth)) <= set(rows_of(third))
    fifth = steps["best-fit packing"](spark, fourth, folder)
    assert fifth.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
    assert fifth.where("piece = 0").count() == fourth.count()


def test_run_and_extra_columns(spark, folder):
    assert set(corpus_pipeline.run(spark, folder).columns) >= {"doc_id", "piece", "start", "length", "sequence_id", "offset"}
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({c: F.lit(c) for c in ("kept", "copies", "fp", "_rows", "score", "t1")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == corpus_pipeline.COLUMNS, name


def test_stages_of_nothing(spark, folder, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, folder).count() == 0, name


def test_queries_are_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLE) <= set(QUERIES)
