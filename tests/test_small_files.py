"""Folders with a file for each run: written, listed and read by tasks, in place as a whole."""

import json
import os

import pytest
from pyspark.sql import functions as F

from demandlake.plans import derive
from demandlake.sources import files as SRC
from demandlake.sources import sinks as SINK
from demandlake.sources import small_files as SMALL
from demandlake.streaming import ingest as STREAM
from demandlake.streaming import manifests as MAN

ODD = ["a", "d=x [1]", "п+р%", "~;,'", "x/y", "#1"]


def _manifests(spark, phrases):
    docs = [(r, json.dumps({"phrase": p, "region": "x", "created_at": "2026-08-21T10:00:00Z", "source_url": "u", "exports": []}, ensure_ascii=False)) for r, p in phrases.items()]
    return SRC.parse_manifests(spark.createDataFrame(docs, "run_id string, document string"))


def _shown(found):
    return {r["run_id"]: r["phrase"] for r in found.collect()}


def test_manifests_are_made_and_read_by_tasks(spark, tmp_path):
    """no checksum file (a process each) beside a document, no list of all documents on the driver."""
    runs = {r: f"чай {r}" for r in ODD}
    SINK.write_manifests(_manifests(spark, runs), str(tmp_path / "m"))
    assert len(list((tmp_path / "m").rglob("*.txt"))) == len(ODD) and not list((tmp_path / "m").rglob("*.crc"))
    assert not [p for p in (tmp_path / "m").iterdir() if p.name.startswith(".")]
    back = SRC.load_manifests(spark, str(tmp_path / "m"), "*.txt")
    assert not back.inputFiles() and _shown(back) == runs
    assert all(r["path"].startswith(f"file://{tmp_path}/m/run_id=") for r in back.select("path").collect())
    # What is written later takes the whole folder's place.
    SINK.write_manifests(_manifests(spark, {"b": "кофе"}), str(tmp_path / "m"))
    assert _shown(SRC.load_manifests(spark, str(tmp_path / "m"), "*.txt")) == {"b": "кофе"}


def test_files_are_listed_on_any_level_once(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"many/{i}").mkdir(parents=True)
        (tmp_path / f"many/{i}/x.txt").write_text(str(i))
    for name in ("top.txt", "many/_a=b.txt", ".hidden.txt", "_hidden.txt", "empty.txt", "other.json"):
        (tmp_path / name).write_text("" if name == "empty.txt" else "t")
    (tmp_path / "_staging").mkdir()
    (tmp_path / "_staging/x.txt").write_text("t")
    got = [r["path"].split(f"{tmp_path}/")[1] for r in SMALL.read_files(spark, str(tmp_path), "*.txt").collect()]
    assert sorted(got) == sorted(["top.txt", "many/_a=b.txt", *[f"many/{i}/x.txt" for i in range(300)]])


def test_a_job_that_fails_leaves_nothing(spark, tmp_path):
    SINK.write_documents(spark.createDataFrame([("a", "old")], "run_id string, document string"), str(tmp_path), "partitions")
    before = sorted(tmp_path.rglob("*"))
    bad = spark.range(20).select(F.concat(F.lit("r"), "id").alias("run_id"), F.when(F.col("id") == 19, F.raise_error(F.lit("stop"))).otherwise(F.lit("new")).alias("document"))
    for mode in ("overwrite", "partitions"):
        with pytest.raises(Exception, match="stop"):
            SINK.write_documents(bad, str(tmp_path), mode)
        assert sorted(tmp_path.rglob("*")) == before
    assert before[-1].read_text() == "old\n"


def test_other_stores_keep_sparks_own_writers(spark, tmp_path):
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.small.link./in", f"file://{tmp_path}")
    root = "viewfs://small/in"
    assert SMALL.mounted(spark, root) is None and SMALL.mounted(spark, str(tmp_path)) == SMALL.mounted(spark, f"file://{tmp_path}") == str(tmp_path)
    SINK.write_manifests(_manifests(spark, {"a": "чай", "d=x": "кофе"}), f"{root}/m")
    assert _shown(SRC.load_manifests(spark, f"{root}/m", "*.txt")) == _shown(SRC.load_manifests(spark, str(tmp_path / "m"), "*.txt")) == {"a": "чай", "d=x": "кофе"}


def _land(spark, root, files):
    rows = [(r, "dynamics", i, x) for r, text in files.items() for i, x in enumerate(text)]
    derive.land(spark.createDataFrame(rows, "run_id string, view string, ord int, line string"), root)


def test_landed_files_are_made_by_tasks(spark, tmp_path):
    """bytes as they are, no checksum files, files of two lands side by side."""
    text = {"a": ["x", "", "\xff\x98#", "#\x01\r"], "none": ["", ""], **{r: ["1"] for r in ODD[1:]}}
    _land(spark, str(tmp_path), text)
    _land(spark, str(tmp_path), {"a": ["y"]})
    assert not list(tmp_path.rglob("*.crc")) and not [p for p in tmp_path.iterdir() if p.name.startswith(".")]
    assert sorted(p.read_bytes() for p in tmp_path.glob("run_id=a/view=dynamics/part-*.csv")) == [b"x\n\xff\x98#\n#\x01\r\n", b"y\n"]
    assert len(list(tmp_path.rglob("*.csv"))) == 2 + len(ODD) - 1
    found = SRC.landing_scan(spark, str(tmp_path)).select(SRC.path_part(F.col("path"), "run_id").alias("r")).distinct().collect()
    assert {x["r"] for x in found} == set(ODD)


def test_the_stream_reads_lists_of_arrivals(spark, tmp_path, monkeypatch):
    """the driver names no landed file; every file counts once, whatever ends a run early."""
    base, root = str(tmp_path), str(tmp_path / "landing")
    runs = spark.createDataFrame([(r, "daily", None, None) for r in ODD], "run_id string, granularity string, date_from date, date_to date")
    day = ["Дата;Число запросов".encode().decode("latin-1"), "01.06.2026;1"]
    drain = lambda **k: STREAM.run_ingest(spark, root, runs, f"{base}/exports", f"{base}/ckpt", **k)
    log = lambda: sorted((r["run_id"], r["row_count"], r["batch_id"]) for r in STREAM.export_log(spark, f"{base}/exports").collect())
    monkeypatch.setattr(STREAM, "admitted_files", None)
    _land(spark, root, {r: day for r in ODD[:3]})
    # The run ends after the list is made: what it lists isn't listed again, nor lost.
    lists = STREAM._lists(spark, root, f"{base}/ckpt")
    STREAM.arrived_files(spark, root, lists)
    STREAM.arrived_files(spark, root, lists)
    _land(spark, root, {ODD[3]: day})
    drain()
    assert [x[:2] for x in log()] == sorted((r, 1) for r in ODD[:4])
    first = log()
    drain()
    assert log() == first
    # Two files a batch, the oldest first, however old.
    _land(spark, root, {r: day + ["02.06.2026;2"] for r in ODD[:3]})
    (old,) = (p for p in (tmp_path / "landing/run_id=a").rglob("*.csv") if len(p.read_text().splitlines()) == 3)
    os.utime(old, (1_000_000_000, 1_000_000_000))
    drain(max_files=1)
    new = [x for x in log() if x not in first]
    assert sorted(x[:2] for x in new) == sorted((r, 2) for r in ODD[:3]) and len({x[2] for x in new}) == 3
    assert min(new, key=lambda x: x[2])[0] == "a"


def test_another_store_is_streamed_by_sparks_source(spark, tmp_path):
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.small2.link./in", f"file://{tmp_path}")
    root = "viewfs://small2/in"
    runs = spark.createDataFrame([(r, "daily", None, None) for r in "ab"], "run_id string, granularity string, date_from date, date_to date")
    _land(spark, f"{root}/landing", {r: ["date;requests", "01.06.2026;1"] for r in "ab"})
    for _ in range(2):
        STREAM.run_ingest(spark, f"{root}/landing", runs, f"{tmp_path}/exports", f"{tmp_path}/ckpt")
    assert sorted((r["run_id"], r["row_count"]) for r in STREAM.export_log(spark, f"{tmp_path}/exports").collect()) == [("a", 1), ("b", 1)]


def _stored(spark):
    return spark.sql("""select 'd=x [1]' run_id, 'dynamics' view, 'daily' granularity, 'f.csv' file_name, 'p' path, timestamp'2026-08-22 10:00:00' modificationTime, true trusted, 2L row_count,
        array(struct('a' header, 'int64' dtype)) dtypes, struct('Дата' field, '01.06.2026' `from`, '02.06.2026' `to`) actual_period""")


def test_documents_of_touched_runs_are_read_by_tasks(spark, tmp_path, monkeypatch):
    """the touched runs aren't named to the driver."""
    MAN.write_documents(_manifests(spark, {r: f"чай {r}" for r in ODD}), str(tmp_path))
    other = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.txt") if "d%3Dx" not in str(p)}
    assert len(other) == len(ODD) - 1 and not list(tmp_path.rglob("*.crc"))
    monkeypatch.setattr(MAN, "load_manifests", None)
    monkeypatch.setattr(MAN, "run_folder", None)
    MAN.upsert_manifests(spark.createDataFrame([(r,) for r in ODD], "run_id string"), _stored(spark), str(tmp_path))
    assert {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.txt") if "d%3Dx" not in str(p)} == other
    back = {r["run_id"]: [e["row_count"] for e in r["exports"]] for r in SRC.load_manifests(spark, str(tmp_path), "*.txt").collect()}
    assert back == {r: [2] if r == "d=x [1]" else [] for r in ODD}
    assert {r["run_id"] for r in MAN._stored_runs(spark, str(tmp_path)).collect()} == set(ODD)


def test_datasets_are_made_and_listed_by_tasks(spark, tmp_path):
    """a Parquet file for each run and file, in place of an earlier one; the listing stays off the driver."""
    cells = spark.createDataFrame([(r, f, i, None if i else "п", i * 0.5) for r in ODD for f in ("x.parquet", "y.parquet") for i in range(3)], "run_id string, file string, row_ord int, text string, v double")
    MAN.write_cells(cells, str(tmp_path))
    MAN.write_cells(cells.filter("run_id = 'a' and file = 'x.parquet' and row_ord < 2"), str(tmp_path))
    assert len(list(tmp_path.rglob("*.parquet"))) == 2 * len(ODD) + 2 * len(ODD) and not list(tmp_path.rglob("*.crc"))
    rows = lambda df: sorted(map(tuple, df.select(*cells.columns).collect()), key=str)
    assert rows(SMALL.small_files(spark).read.parquet(str(tmp_path))) == rows(cells.filter("run_id <> 'a' or file <> 'x.parquet' or row_ord < 2"))
    files = MAN.stored_files(spark, str(tmp_path))
    assert not files.inputFiles() and {tuple(x) for x in files.collect()} == {(r, f) for r in ODD for f in ("x.parquet", "y.parquet")}
