"""Sources, sinks and streaming (cases from the reference's storage/CLI tests)."""

import json

from pyspark.sql import functions as F

from conftest import exports_df
from demandlake.operators import landing as L
from demandlake.plans.ingest import ingest_exports
from demandlake.sources import files as SRC
from demandlake.sources import sinks as SINK
from demandlake.streaming import ingest as STREAM


def test_landing_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Запрос;Показов\nчай;5\n".encode())
    (tmp_path / "b.CSV").write_bytes(b"")
    (tmp_path / "c.txt").write_bytes(b"x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "d.csv").write_bytes(b"a;b\n1;2\n")
    got = {r["file_name"]: r["accepted"] for r in SRC.landing_scan(spark, str(tmp_path)).collect()}
    # zero-length files are never yielded by Spark's file scan (and never accepted)
    assert got == {"a.csv": True, "d.csv": True}


def test_phrase_lines(spark):
    files = spark.createDataFrame([
        (0, bytearray("﻿чай\n\n  кофе  \nчай\n".encode())),
        (1, bytearray("какао\r\nсок\r\n".encode("cp1251"))),
        (2, bytearray(b"\x98\xff")),
    ], "file_ord int, content binary")
    got = [(r["file_ord"], r["phrase_ord"], r["phrase"], r["error_code"]) for r in SRC.phrase_lines(files).orderBy("file_ord", "phrase_ord").collect()]
    assert got == [(0, 0, "чай", None), (0, 1, "  кофе  ", None), (0, 2, "чай", None), (1, 0, "какао", None), (1, 1, "сок", None),
                   (2, None, None, "INVALID_REQUEST")]


def test_large_files_are_listed_for_the_quarantine(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"a;b\n1;2\n")
    (tmp_path / "b.csv").write_bytes(b"a;b\n" + b"1;2\n" * 50)
    scan = SRC.landing_scan(spark, str(tmp_path), limit=100)
    got = {r["file_name"]: (r["content"] is None, r["error_reason"]) for r in scan.collect()}
    assert got == {"a.csv": (False, None), "b.csv": (True, "too_large")}
    SINK.write_quarantine(scan, str(tmp_path / "q"), ["file_name"])
    (row,) = spark.read.parquet(str(tmp_path / "q")).collect()
    assert (row["file_name"], row["error_code"], row["reason"], row["content"]) == ("b.csv", "CSV_FORMAT", "too_large", None) and row["message"]


GOOD = {"phrase": "чай", "region": "Россия", "created_at": "2026-08-21T10:00:00Z", "source_url": "u",
        "exports": [{"view": "dynamics", "file": "dynamics.parquet", "raw_file": None, "row_count": 3, "dtypes": {"б": "string", "а": "int64"}}]}


def test_manifest_source(spark, tmp_path):
    entry = GOOD["exports"][0]
    bad = {
        "duplicate": GOOD | {"exports": [entry] * 2}, "view": GOOD | {"exports": [entry | {"view": "maps"}]}, "hourly": GOOD | {"granularity": "hourly"},
        "no_file": GOOD | {"exports": [{k: v for k, v in entry.items() if k != "file"}]}, "null_dtypes": GOOD | {"exports": [entry | {"dtypes": None}]},
        "no_phrase": {k: v for k, v in GOOD.items() if k != "phrase"},
    }
    for name, doc in {"good": GOOD, "weekly": GOOD | {"granularity": "weekly", "updated_at": "2026-08-22T10:00:00Z"}, **bad}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    (tmp_path / "broken.json").write_text("{not json\n", encoding="utf-8")
    loaded = SRC.load_manifests(spark, str(tmp_path)).withColumn("headers", F.map_keys(F.get("exports", 0)["dtypes"]))
    rows = {r["path"].rsplit("/", 1)[1][:-5]: r for r in loaded.collect()}
    assert len(rows) == len(bad) + 3  # one row a file, however it is indented
    assert {k for k, r in rows.items() if r["error_code"] is None} == {"good", "weekly"}
    assert {r["error_code"] for k, r in rows.items() if k not in ("good", "weekly")} == {"RESUME_MISMATCH"}
    good = rows["good"]
    assert (good["granularity"], good["updated_at"], good["requested_period"]) == ("monthly", None, None)
    assert good["headers"] == ["б", "а"] and good["exports"][0]["dtypes"] == {"а": "int64", "б": "string"}
    assert rows["weekly"]["granularity"] == "weekly" and rows["weekly"]["updated_at"] is not None


def test_manifest_documents_keep_their_nulls(spark, tmp_path):
    document = spark.createDataFrame([("r", json.dumps(GOOD, ensure_ascii=False))], "run_id string, document string")
    SINK.write_manifests(SRC.parse_manifests(document), str(tmp_path))
    (file,) = tmp_path.glob("run_id=r/*.txt")
    back = json.loads(file.read_text(encoding="utf-8"))
    assert back["exports"][0]["dtypes"] == {"б": "string", "а": "int64"} and back["exports"][0]["raw_file"] is None
    assert back["updated_at"] is None and back["requested_period"] is None and back["granularity"] == "monthly"
    assert (back["missing_views"], back["empty_views"], back["status"]) == (["top_popular", "top_related", "regions"], [], "incomplete")


def _file(root, run, name, days, header="Дата;Число запросов;Доля"):
    folder = root / f"run_id={run}" / "view=dynamics"
    folder.mkdir(parents=True, exist_ok=True)
    text = header + "\r" + "".join(f"{d:02d}.06.2026;1 {d:03d};0,0004{d % 10}\r" for d in days)
    (folder / f"{name}.csv").write_bytes(text.encode("utf-8-sig"))


def test_stream_of_landed_files(spark, tmp_path):
    import os

    base, root = str(tmp_path), tmp_path / "landing"
    runs = spark.createDataFrame([(r, "daily", None, None, 0) for r in "abcd"], "run_id string, granularity string, date_from date, date_to date, created_at long")
    runs = runs.withColumn("created_at", F.timestamp_seconds("created_at"))
    drain = lambda **k: STREAM.run_ingest(spark, str(root), runs, f"{base}/exports", f"{base}/ckpt", **k)
    log = lambda: STREAM.export_log(spark, f"{base}/exports")
    _file(root, "a", "1", range(1, 4))
    _file(root, "b", "1", [1, 2, 4])
    _file(root, "c", "1", [])
    drain()
    assert {r["run_id"]: (r["verdict"], r["trusted"]) for r in log().collect()} == {"a": ("ok", True), "b": ("gap", False), "c": ("empty", False)}
    pending = {r["run_id"] for r in STREAM.next_wave(runs, log()).filter("view = 'dynamics'").collect()}
    assert pending == {"b", "c", "d"}
    outcomes = lambda: {r["run_id"]: r["outcome"] for r in L.attempt_outcomes(STREAM.fetch_attempts(log()), STREAM.KEYS).collect()}
    assert outcomes() == {"a": "stored", "b": "failed", "c": "pending"}
    # Two versions in one wave, the older one with the later name; and a broken file.
    _file(root, "a", "9", range(1, 3))
    _file(root, "a", "2", range(1, 7))
    os.utime(root / "run_id=a/view=dynamics/9.csv", (1_700_000_000, 1_700_000_000))
    _file(root, "d", "1", [1], header="Дата;Дата;Доля")
    drain(max_files=2)
    drain()  # nothing new: no change
    cells = STREAM.latest_cells(spark, f"{base}/exports")
    rows = {r["run_id"]: r["n"] for r in cells.filter("col_ord = 0").groupBy("run_id").agg(F.count("text").alias("n")).collect()}
    assert rows.keys() == {"a"} and rows["a"] in (2, 6)  # with two files a batch, either may come last
    assert {r["run_id"]: r["reason"] for r in STREAM.quarantined(spark, f"{base}/exports").collect()} == {"b": "gap", "c": "empty", "d": "duplicate_header"}
    manifests = {r["run_id"]: (len(r["exports"]), r["updated_at"] > r["created_at"]) for r in STREAM.run_manifests(runs, log()).collect()}
    assert manifests == {"a": (1, True), "b": (0, False), "c": (0, False), "d": (0, False)}


def test_a_file_too_large_for_a_row_does_not_stop_the_stream(spark, tmp_path):
    """The reader's own limit is as low as the stream's: to load the file would fail the batch."""
    base, root = str(tmp_path), tmp_path / "landing"
    runs = spark.createDataFrame([(r, "daily", None, None) for r in "ab"], "run_id string, granularity string, date_from date, date_to date")
    _file(root, "a", "1[x] {y}", range(1, 4))
    _file(root, "b", "1", range(1, 30))
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 300)
    try:
        for _ in range(2):
            STREAM.run_ingest(spark, str(root), runs, f"{base}/exports", f"{base}/ckpt", limit=300)
            _file(root, "a", "2", range(1, 6))
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    log = {(r["run_id"], r["row_count"], r["error_code"], r["trusted"]) for r in STREAM.export_log(spark, f"{base}/exports").collect()}
    assert log == {("a", 3, None, True), ("a", 5, None, True), ("b", None, "CSV_FORMAT", False)}
    assert [(r["run_id"], r["content"], r["reason"]) for r in STREAM.quarantined(spark, f"{base}/exports").collect()] == [("b", None, "too_large")]


def test_stored_manifests_follow_the_stream(spark, tmp_path):
    """Documents from the first moment on, rewritten for touched runs only; stored state decides what is pending."""
    import os
    import shutil

    from demandlake.streaming import manifests as MAN

    base, root = str(tmp_path), tmp_path / "landing"
    odd = "d=x [1]"
    runs = spark.createDataFrame([(r, "daily", None, None, "чай", "Москва", 0, "https://reports.example/") for r in ("a", "b", "c", odd)],
                                 "run_id string, granularity string, date_from date, date_to date, phrase string, region string, created_at long, source_url string")
    runs = runs.withColumns({"created_at": F.timestamp_seconds("created_at"), "requested_period": F.lit(None).cast("struct<from:string,to:string>")})

    def drain(**k):
        STREAM.run_ingest(spark, str(root), runs, f"{base}/exports", f"{base}/ckpt", manifests=f"{base}/manifests", datasets=f"{base}/datasets", **k)

    def documents():
        found = SRC.load_manifests(spark, f"{base}/manifests", "*.txt").collect()
        return {r["run_id"]: (sorted((e["view"], e["file"], e["row_count"]) for e in r["exports"]), r["updated_at"], (r["actual_period"] or {}).get("to")) for r in found}

    root.mkdir()
    drain()
    first = documents()
    assert {k: v[0] for k, v in first.items()} == {"a": [], "b": [], "c": [], odd: []}
    assert STREAM.export_log(spark, f"{base}/exports").count() == 0
    assert STREAM.next_wave(runs, STREAM.export_log(spark, f"{base}/exports")).count() == 16
    for run in ("a", "b", "d%3Dx %5B1%5D"):
        _file(root, run, "1", range(1, 4))
    untouched = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "manifests").rglob("*.txt") if "run_id=c" in str(p)}
    before = untouched()
    drain(max_files=2)
    daily = lambda n: [("dynamics", "dynamics_daily.parquet", n)]
    second = documents()
    assert {k: v[0] for k, v in second.items()} == {"a": daily(3), "b": daily(3), "c": [], odd: daily(3)}
    assert second["a"][2] == "03.06.2026" and second["a"][1] > first["a"][1] and untouched() == before
    _file(root, "a", "2", range(1, 6))
    _file(root, "b", "2", [1, 3])  # a gap: what is stored stays
    drain()
    third = documents()
    assert third["a"][0] == daily(5) and third["a"][2] == "05.06.2026" and third["b"] == second["b"]
    # A batch that runs again changes nothing.
    again = spark.read.parquet(f"{base}/exports/batch_id=2")
    MAN.write_datasets(again, f"{base}/datasets")
    MAN.upsert_manifests(runs, again, f"{base}/manifests")
    assert documents() == third
    # A dataset that was deleted, a document that was lost, a dataset of unknown origin.
    shutil.rmtree(tmp_path / "datasets/run_id=a")
    shutil.rmtree(tmp_path / "manifests/run_id=b")
    os.rename(tmp_path / "datasets/run_id=d%3Dx %5B1%5D", tmp_path / "datasets/run_id=c")
    drain()  # writes b's first document again
    states = MAN.resume_state(runs, f"{base}/manifests", f"{base}/datasets", STREAM.export_log(spark, f"{base}/exports"))
    found = {(r["run_id"], r["state"], r["pending"]) for r in states.filter("view = 'dynamics'").collect()}
    assert found == {("a", "stale", True), ("b", "unrecorded", True), ("c", "missing", True), (odd, "stale", True)}
    assert {r["state"] for r in states.filter("view <> 'dynamics'").collect()} == {"missing"}
    assert MAN.prune_manifests(states, f"{base}/manifests", "2030-01-01 00:00:00") == 2
    assert {k: v[0] for k, v in documents().items()} == {"a": [], "b": [], "c": [], odd: []}


def test_snapshots_of_a_folder(spark, tmp_path):
    root, snaps = tmp_path / "landing", str(tmp_path / "snapshots")

    def snap(n):
        L.write_snapshot(SRC.landing_scan(spark, str(root)), snaps, n)

    _file(root, "a", "1", [1])
    _file(root, "b", "1", [1])
    snap(1)
    _file(root, "b", "1", [1, 2])
    _file(root, "c", "1", [1])
    (root / "run_id=a/view=dynamics/1.csv").unlink()
    snap(2)
    snap(2)
    for p in root.rglob("*.csv"):
        p.unlink()
    snap(5)
    got = {(r["snapshot"], r["norm_path"].split("run_id=")[1][0], r["change"]) for r in L.snapshot_changes(spark.read.parquet(snaps)).collect()}
    assert got == {(1, "a", "added"), (1, "b", "added"), (2, "a", "gone"), (2, "b", "changed"), (2, "c", "added"), (5, "b", "gone"), (5, "c", "gone")}


def test_the_gate(spark, tmp_path):
    """Overflow, a gap and an empty series are kept out of the typed table and in the quarantine."""
    day = "Дата;Число запросов\n{}.06.2026;{}\n{}.06.2026;2\n"
    cases = {"ok": day.format("01", "1", "02"), "gap": day.format("01", "1", "03"), "overflow": day.format("01", "9" * 25, "02"), "empty": "Дата;Число запросов\n"}
    df = exports_df(spark, [(k, v.encode()) for k, v in cases.items()]).withColumn("granularity", F.lit("daily"))
    SINK.store_exports(ingest_exports(df, keep_content=True), str(tmp_path), ["export_id"])
    assert {r["export_id"] for r in spark.read.parquet(str(tmp_path / "typed/rows")).collect()} == {"ok"}
    bad = {r["export_id"]: (r["error_code"], r["reason"], bytes(r["content"])) for r in spark.read.parquet(str(tmp_path / "quarantine")).collect()}
    assert bad == {"gap": ("INTERFACE_CHANGED", "gap", cases["gap"].encode()), "overflow": ("OVERFLOW", "overflow", cases["overflow"].encode()),
                   "empty": ("INTERFACE_CHANGED", "empty", cases["empty"].encode())}
    trusted = ingest_exports(df.withColumn("view", F.lit("regions"))).filter("export_id = 'empty'").first()
    assert trusted["trusted"] and trusted["verdict"] == "skipped"


def test_raw_files_are_kept_on_request(spark, tmp_path):
    df = exports_df(spark, [("x", b"1"), ("y", b"2")]).withColumns({"view": F.lit("regions"), "keep_raw": F.col("export_id") == "x"})
    named = {r["export_id"]: r["raw_file"] for r in SINK.write_raw(df, str(tmp_path), ["export_id"]).collect()}
    assert named == {"x": "regions.csv", "y": None}
    assert [bytes(r["content"]) for r in spark.read.parquet(str(tmp_path)).collect()] == [b"1"]


def test_phrases_of_a_batch_keep_their_order(spark):
    inline = spark.createDataFrame([(1, 0, "x"), (1, 1, "x")], "batch_id long, arg_ord int, phrase string")
    lines = spark.createDataFrame([(1, 0, 0, "a"), (1, 0, 1, "x"), (1, 1, 0, "b")], "batch_id long, file_ord int, phrase_ord int, phrase string")
    got = SRC.resolve_phrases(inline, lines).orderBy("batch_id", "source_ord", "o1", "o2").collect()
    assert [r["phrase"] for r in got] == ["x", "x", "a", "x", "b"]


def test_wide_sink_roundtrip(spark, tmp_path):
    df = exports_df(spark, [
        ("x", "Запрос;Показов;Доля\nчай;5 228 679;12,5\nкофе;;3\n".encode()),
        ("y", "Запрос;Показов\n".encode()),
    ])
    typed = ingest_exports(df, with_series=False)
    SINK.write_wide(typed, str(tmp_path / "wide"), ["export_id"])
    back = SINK.read_shape(spark, str(tmp_path / "wide"), ["string", "int64", "float64"], ["export_id"]).orderBy("row_ord").collect()
    assert [(r["c0"], r["c1"], r["c2"]) for r in back] == [("чай", 5228679, 12.5), ("кофе", None, 3.0)]
    schemas = {r["export_id"]: r["shape"] for r in spark.read.parquet(str(tmp_path / "wide" / "schemas")).collect()}
    assert schemas["y"] == "string_string"


def test_an_export_of_5000_columns_beside_small_ones(spark, tmp_path):
    wide = ";".join(f"c{i}" for i in range(5000)) + "\n" + ";".join(str(i) if i % 2 else f"{i},5" for i in range(5000)) + "\n"
    df = exports_df(spark, [("wide", wide.encode()), ("x", "Запрос;Показов\nчай;5\n".encode())])
    SINK.write_wide(ingest_exports(df, with_series=False), str(tmp_path), ["export_id"])
    rows = spark.read.parquet(str(tmp_path / "rows"))
    assert set(rows.columns) == {"export_id", "row_ord", "cells", "shape"}
    types = ["int64" if i % 2 else "float64" for i in range(5000)]
    cells = rows.filter("export_id = 'wide'").first()["cells"]
    assert [c["as_long"] if t == "int64" else c["as_double"] for c, t in zip(cells, types)] == [i if i % 2 else i + 0.5 for i in range(5000)]
    got = SINK.read_shape(spark, str(tmp_path), types, ["export_id"], [0, 4999]).select("c0", "c4999").collect()
    assert [tuple(r) for r in got] == [(0.5, 4999)]
