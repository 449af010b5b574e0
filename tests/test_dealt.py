"""Writes of many small files, and parses of few long ones, are dealt over tasks."""

import re

from pyspark.sql import functions as F

from demandlake.plans import catalog, derive
from demandlake.sources import sinks as SINK
from demandlake.sources.files import MANIFEST_SCHEMA
from demandlake.streaming import ingest as STREAM
from demandlake.streaming import manifests as MAN


def _tasks(root, suffix):
    return {re.match(r"part-(\d+)", p.name)[1] for p in root.rglob(f"part-*{suffix}")}


def test_landed_files_are_written_by_many_tasks(spark, tmp_path):
    lines = spark.range(40).select(F.concat(F.lit("run-"), "id").alias("run_id"), F.lit("dynamics").alias("view"), F.lit(0).alias("ord"), F.lit("a").alias("line"))
    derive.land(lines, str(tmp_path / "landing"))
    assert len(list((tmp_path / "landing").rglob("*.csv"))) == 40
    assert len(_tasks(tmp_path / "landing", ".csv")) > 1


def test_manifests_are_written_by_many_tasks(spark, tmp_path):
    fields = [F.lit(None).cast(f.dataType).alias(f.name) for f in MANIFEST_SCHEMA.fields if f.name not in ("_corrupt", "exports")]
    none = F.array().cast(MANIFEST_SCHEMA["exports"].dataType).alias("exports")
    runs = spark.range(0, 40, 1, 1).select(F.concat(F.lit("run-"), "id").alias("run_id"), *fields, none)
    for name, write in (("sink", SINK.write_manifests), ("stream", MAN.write_documents)):
        write(runs, str(tmp_path / name))
        assert len(list((tmp_path / name).rglob("*.txt"))) == 40
        assert len(_tasks(tmp_path / name, ".txt")) > 1


def test_long_cells_are_parsed_once_in_many_tasks(spark, tmp_path):
    spark.range(500, 20500, 500, 1).select(
        F.col("id").alias("o_orderkey"), F.lit("1-URGENT").alias("o_orderpriority"), F.lit(12.5).alias("o_totalprice"), F.lit("1996-01-02").cast("date").alias("o_orderdate"),
    ).write.parquet(str(tmp_path / "orders.parquet"))
    got = catalog.long_cells(spark, str(tmp_path))
    assert got.rdd.getNumPartitions() > 1
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not any(line.lstrip(" +-:").startswith("Filter") and "is_valid_utf8" in line for line in plan.splitlines())
    assert plan.count("is_valid_utf8") <= 4


def test_stream_lists_its_folder_by_one_source(spark, tmp_path):
    (tmp_path / "run_id=a" / "view=dynamics").mkdir(parents=True)
    files = STREAM.admitted_files(spark, str(tmp_path), 100)
    plan = files._jdf.queryExecution().analyzed()
    sources = {x.split("StreamingRelation ")[1].split(", [")[0] + x.split(", [")[-1] for x in plan.toString().splitlines() if "StreamingRelation " in x}
    assert len(sources) == 1


def test_the_log_is_aggregated_in_many_tasks(spark, tmp_path):
    spark.range(0, 200, 1, 1).select(F.col("id").alias("c_custkey"), F.lit("x").alias("c_name"), F.lit(0).alias("c_nationkey")).write.parquet(str(tmp_path / "customer.parquet"))
    log = catalog._log(spark, str(tmp_path))
    assert log.rdd.getNumPartitions() > 1
    assert catalog.merge_exports_query(spark, str(tmp_path)).count() == log.select("run_id", "view").distinct().count()


def test_damaged_exports_are_rendered_and_parsed_in_many_tasks(spark):
    ex = derive.damaged_exports(spark.range(0, 100, 1, 1).withColumnRenamed("id", "key"), "key")
    assert ex.rdd.getNumPartitions() > 1
    assert ex.select("run_id").distinct().count() == 100


def test_run_keys_make_each_base_once_for_numbering(spark):
    from demandlake.operators.requests import run_keys

    asked = spark.createDataFrame([(1, "чай"), (2, "чай"), (3, "кофе")], "ord long, phrase string").withColumn("now", F.to_timestamp(F.lit("2026-08-21 10:00:00")))
    got = run_keys(asked, "ord")
    assert [r["run_key"].split("-", 1)[1] for r in got.orderBy("ord").collect()] == ["чай", "чай-2", "кофе"]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # One projection of the slug, for the result: the numbering reads the bases from a table.
    assert sum("regexp_replace" in line for line in plan.splitlines()) == 1


def test_lines_with_paired_quotes_need_no_pattern(spark, tmp_path):
    """patterns are put together once an export, and not at all for lines that keep the state; effects stay the same."""
    import itertools

    from demandlake.functions import records as REC
    from demandlake.functions.hof import let

    lines = ["".join(x) for n in range(6) for x in itertools.product('";a ', repeat=n)]
    rows = spark.createDataFrame([(x, dq, sis) for x in lines for dq in (True, False) for sis in (True, False)], "line string, dq boolean, sis boolean")
    d, q, dq, sis = F.lit(";"), F.lit('"'), F.col("dq"), F.col("sis")
    m = REC._marks(d, q, dq, sis)
    ends = lambda m: F.concat(F.when(REC._is_open(F.col("line"), d, sis, m), "1").otherwise("0"), F.when(REC._is_open(F.concat(q, F.col("line")), d, sis, m), "1").otherwise("0"))
    got = rows.select("line", REC.line_effect(F.col("line"), d, q, dq, sis).alias("e"), let(m, ends).alias("ends")).collect()
    assert {r["line"]: (r["e"], r["ends"]) for r in got if r["e"] != {"11": "1", "10": "s", "01": "k", "00": "0"}[r["ends"]] and '"' in r["line"]} == {}
    # The composed patterns aren't inside the loop over the lines.
    text = let(F.array(F.col("line")), lambda ls: REC._join_records(ls, F.col("line"), F.lit('"'), dq, sis))
    plan = rows.select(text.alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("*+") <= 10  # 18 with a pattern for each line
