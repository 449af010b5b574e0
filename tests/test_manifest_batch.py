"""Manifest, batch and landing rules (cases from the reference's storage/batch/CLI tests)."""

from pyspark.sql import functions as F

from demandlake.functions.text import slugify
from demandlake.operators import batch as B
from demandlake.operators import landing as L
from demandlake.operators import manifest as M


def _log(spark, rows):
    return spark.createDataFrame(rows, "run_id string, view string, seq long, file string, row_count long")


def test_missing_empty_status(spark):
    log = _log(spark, [
        ("one", "top_popular", 1, "top_popular.parquet", 5),
        *[("all", v, 1, f"{v}.parquet", 3) for v in ("top_popular", "top_related", "dynamics", "regions")],
        ("empty", "top_popular", 1, "top_popular.parquet", 0),
    ])
    runs = spark.createDataFrame([("one",), ("all",), ("none",), ("empty",)], "run_id string")
    merged = M.merge_exports(log)
    ent = M.manifest_entries(merged.select("run_id", "view_ord", "view", "file", "row_count"))
    man = runs.join(ent, "run_id", "left").withColumn(
        "exports", F.coalesce("exports", F.array().cast(ent.schema["exports"].dataType)))
    st = {r["run_id"]: (r["status"], list(r["missing_views"]), list(r["empty_views"]))
          for r in M.run_status(man).collect()}
    assert st["one"] == ("incomplete", ["top_related", "dynamics", "regions"], [])
    assert st["all"] == ("complete", [], [])
    assert st["none"][0] == "incomplete" and len(st["none"][1]) == 4
    assert st["empty"][2] == ["top_popular"]


def test_merge_newest_wins_and_pending(spark):
    log = _log(spark, [("r", "dynamics", 1, "dynamics.parquet", 1), ("r", "dynamics", 2, "dynamics.parquet", 7),
                       ("r", "regions", 1, "regions.parquet", 2)])
    merged = M.merge_exports(log)
    rows = {r["view"]: r["row_count"] for r in merged.collect()}
    assert rows == {"dynamics": 7, "regions": 2}
    runs = spark.createDataFrame([("r",)], "run_id string")
    files = spark.createDataFrame([("r", "dynamics.parquet")], "run_id string, file string")
    pending = [r["view"] for r in M.pending_views(runs, merged, files).orderBy("view_ord").collect()]
    assert pending == ["top_popular", "top_related", "regions"]
    missing = [r["view"] for r in M.missing_views(runs, merged).orderBy("view_ord").collect()]
    assert missing == ["top_popular", "top_related"]


def test_duplicate_views(spark):
    raw = spark.createDataFrame([("r", "dynamics"), ("r", "dynamics"), ("s", "regions")], "run_id string, view string")
    got = {r["run_id"]: r["duplicate"] for r in M.duplicate_views(raw).collect()}
    assert got == {"r": True, "s": False}


def test_resume_match(spark):
    man = spark.createDataFrame([("r", "чай", "Россия", "monthly")], "run_id string, phrase string, region string, granularity string") \
        .withColumn("requested_period", F.lit(None).cast("struct<from:string,to:string>"))
    req = spark.createDataFrame([("r", "  чай ", "Россия", "monthly"), ("r", "кофе", "Россия", "monthly"),
                                 ("r", "чай", "Москва", "monthly"), ("q", "чай", "Россия", "monthly"),
                                 ("r", "чай", "Россия", "daily")],
                                "run_id string, phrase string, region string, granularity string") \
        .withColumn("requested_period", F.lit(None).cast("struct<from:string,to:string>"))
    got = [r["match"] for r in M.resume_match(req, man).collect()]
    assert sorted(got) == sorted(["ok", "phrase_region_mismatch", "phrase_region_mismatch", "missing_manifest",
                                  "period_mismatch"])


VIEWS = ["top_popular", "top_related", "dynamics", "regions"]


def _batch(spark, runs, attempts, stored=()):
    requests = spark.createDataFrame(runs, "batch_id long, phrase_ord long, run_id string")
    tried = spark.createDataFrame(list(attempts), "run_id string, view string, fail_code string, fail_message string")
    held = spark.createDataFrame(list(stored), "run_id string, view string")
    told = B.view_outcomes(requests, tried, held)
    # The verdicts from the logs alone are those from the views.
    key = lambda df: sorted(map(str, df.collect()))
    assert key(B.run_outcomes(requests, tried, held)) == key(B.phrase_outcome(told))
    return told


def test_first_failure_cut(spark):
    views = _batch(spark, [(1, 0, "p")], [("p", "top_popular", None, None), ("p", "top_related", "DOWNLOAD_TIMEOUT", "boom")])
    cut = {r["view"]: (r["outcome"], r["view_error"]) for r in views.collect()}
    assert cut["top_popular"] == ("stored", None)
    assert cut["top_related"] == ("failed", "DownloadTimeoutError: boom")
    assert cut["dynamics"] == ("not_attempted", "не пробовался: сбой на виде top_related")
    out = B.phrase_outcome(views).first()
    assert (out["outcome"], out["partial"]) == ("result", True)


def test_nothing_stored_is_a_failure_with_its_error(spark):
    views = _batch(spark, [(1, 0, "p")], [("p", "top_popular", "CSV_FORMAT", "bad")])
    out = B.phrase_outcome(views).first()
    assert (out["outcome"], out["error_code"], out["partial"]) == ("failure", "CSV_FORMAT", False)


def test_a_resumed_run_that_fails_again_is_a_result(spark):
    views = _batch(spark, [(1, 0, "p")], [("p", "regions", "DOWNLOAD_TIMEOUT", "boom")], [("p", v) for v in VIEWS[:3]])
    assert {r["view"]: r["outcome"] for r in views.collect()} == dict.fromkeys(VIEWS[:3], "kept") | {"regions": "failed"}
    assert B.phrase_outcome(views).first()["outcome"] == "result"


def test_auth_abort_and_summary(spark):
    attempts = [("p0", v, None, None) for v in VIEWS] + [("p1", "top_popular", "AUTH_REQUIRED", "gone")]
    views = _batch(spark, [(1, i, f"p{i}") for i in range(3)], attempts)
    s = B.batch_summary(B.phrase_outcome(views)).first()
    assert (s["total"], s["collected"], s["failed"], s["skipped"], s["exit_code"]) == (3, 1, 1, 1, 1)


def test_report_is_in_order_and_has_the_warnings(spark):
    views = _batch(spark, [(1, 0, "p"), (1, 1, "q")], [("p", "top_popular", None, None), ("p", "top_related", "CSV_FORMAT", "bad"), ("q", "regions", "CSV_FORMAT", "x")])
    warnings = spark.createDataFrame([("p", "/b.csv"), ("p", "/a.csv"), ("q", "/c.csv")], "run_id string, path string")
    lines = B.incomplete_report(views, warnings).orderBy("batch_id", "phrase_ord", "line_ord").collect()
    assert [(r["run_id"], r["view"] or r["path"]) for r in lines] == [("p", x) for x in ("dynamics", "regions", "top_related", "/a.csv", "/b.csv")]


def test_entries_are_in_view_order(spark):
    log = _log(spark, [("r", v, 1, v, 1) for v in ("regions", "dynamics", "top_popular", "odd")])
    entries = M.manifest_entries(M.merge_exports(log)).first()["exports"]
    assert [e["view"] for e in entries] == ["top_popular", "dynamics", "regions", "odd"]
    assert entries[-1]["view_ord"] is None


def test_stale_entries_bump_their_manifest(spark):
    merged = M.merge_exports(_log(spark, [("r", "dynamics", 1, "d", 1), ("r", "regions", 1, "g", 1), ("s", "regions", 1, "g", 1)]))
    files = spark.createDataFrame([("r", "d"), ("s", "g")], "run_id string, file string")
    runs = spark.createDataFrame([("r", 1), ("s", 1), ("t", 1)], "run_id string, updated_at long")
    got = {r["run_id"]: (r["n_before"], r["n_after"], r["updated_at"]) for r in M.pruned_runs(runs, M.prune_stale(merged, files), F.lit(9)).collect()}
    assert got == {"r": (2, 1, 9), "s": (1, 1, 1), "t": (0, 0, 1)}


def test_slugify(spark):
    df = spark.createDataFrame([("  Купить чай!  ",), ("???",), ("ёлка 2026",), ("a" * 80,)], "t string")
    got = [r["s"] for r in df.select(slugify(F.col("t")).alias("s")).collect()]
    assert got == ["купить-чай", "query", "лка-2026", "a" * 64]


def test_containment_and_verdict(spark):
    df = spark.createDataFrame([("/out/d/a.csv",), ("/out/d/../../home/x.csv",), ("/home/u/Downloads/y.csv",)], "p string")
    roots = F.array(F.lit("/out/x/../d/"))
    got = [r["c"] for r in df.select(L.contained(F.col("p"), roots).alias("c")).collect()]
    assert got == [True, False, False]
    ticks = spark.createDataFrame([
        ("r", "v", 1, "/out/d/a.csv", 10, True), ("r", "v", 1, "/home/x.csv", 5, False),
        ("r", "v", 2, "/out/d/b.csv", 10, True), ("r", "v", 2, "/out/d/c.CSV", 10, True),
        ("r", "v", 3, "/home/z.csv", 5, False), ("r", "v", 4, "/out/d/e.csv", 0, True),
    ], "run_id string, view string, tick int, path string, length long, inside boolean")
    v = {r["tick"]: (r["verdict"], r["warning"]) for r in L.download_verdict(ticks).collect()}
    assert v == {1: ("ok", True), 2: ("too_many", False), 3: ("escaped", False), 4: ("waiting", False)}


def test_run_keys_skew_safe_numbering(spark):
    from demandlake.operators.requests import run_keys

    rows = [(i, "чай" if i % 3 else "кофе") for i in range(200)]
    df = spark.createDataFrame(rows, "ord long, phrase string").withColumn(
        "now", F.to_timestamp(F.lit("2026-08-21 10:00:00")))
    got = {r["ord"]: r["run_key"] for r in run_keys(df, order="ord", bucket_size=4).collect()}
    n_tea = n_coffee = 0
    for i, p in rows:
        if p == "чай":
            n_tea += 1
            n = n_tea
        else:
            n_coffee += 1
            n = n_coffee
        base = "20260821T100000Z-" + ("чай" if p == "чай" else "кофе")
        assert got[i] == (base if n == 1 else f"{base}-{n}")


def test_run_keys_never_meet(spark):
    from demandlake.operators.requests import run_keys

    def keys(phrases, existing=None):
        df = spark.createDataFrame(list(enumerate(phrases)), "ord long, phrase string").withColumn("now", F.lit("2026-08-21 10:00:00").cast("timestamp"))
        held = spark.createDataFrame([(f"20260821T100000Z-{k}",) for k in existing], "run_key string") if existing else None
        return [r["run_key"][17:] for r in run_keys(df, order="ord", existing=held, bucket_size=2).orderBy("ord").collect()]

    assert keys(["foo", "foo", "foo 2"]) == ["foo", "foo-3", "foo-2"]
    assert keys(["base", "base"], ["base", "base-3"]) == ["base-2", "base-4"]
    assert keys(["base"] * 5, ["base-3"]) == ["base", "base-2", "base-4", "base-5", "base-6"]
    many = keys(["a", "a 2", "a", "a 3", "a", "a 2", "a 2 2"] * 3, ["a-4", "a-2-3"])
    assert len(set(many)) == len(many) and not {"a-4", "a-2-3"} & set(many)


def _brute_keys(phrases, existing):
    """k-th request of a base gets the k-th number whose key is neither held nor another request's base."""
    taken, counts, out = set(existing) | {p.replace(" ", "-") for p in phrases}, {}, []
    for p in phrases:
        base = p.replace(" ", "-")
        n, free = counts.get(base, (0, None))
        k = n + 1
        while (base if k == 1 else f"{base}-{k}") in (set(existing) if k == 1 else taken):
            k += 1
        counts[base] = (k, None)
        out.append(base if k == 1 else f"{base}-{k}")
    return out


def test_run_keys_equal_brute_force(spark):
    import random

    from demandlake.operators.requests import run_keys

    rng = random.Random(4)
    for size in (2, 5):
        phrases = [rng.choice(["a", "a 2", "a 7", "b", "b 3", "b 3 2"]) for _ in range(120)]
        existing = sorted({f"{rng.choice(['a', 'b', 'a-2', 'b-3'])}-{rng.randint(2, 90)}" for _ in range(60)} | {"b"})
        df = spark.createDataFrame(list(enumerate(phrases)), "ord long, phrase string").withColumn("now", F.lit("2026-08-21 10:00:00").cast("timestamp"))
        held = spark.createDataFrame([(f"20260821T100000Z-{k}",) for k in existing], "run_key string")
        got = [r["run_key"][17:] for r in run_keys(df, order="ord", existing=held, bucket_size=size).orderBy("ord").collect()]
        assert got == _brute_keys(phrases, existing)


def test_run_keys_of_a_base_with_many_taken_numbers(spark):
    """Every second number to 200,000 is taken; 50,000 requests get the odd ones, and no row holds the numbers."""
    from demandlake.operators.requests import run_keys

    df = spark.range(50_000).select(F.col("id").alias("ord"), F.lit("a").alias("phrase"), F.lit("2026-08-21 10:00:00").cast("timestamp").alias("now"))
    held = spark.range(1, 100_001).select(F.concat(F.lit("20260821T100000Z-a-"), (F.col("id") * 2).cast("string")).alias("run_key"))
    keys = run_keys(df, order="ord", existing=held)
    assert not [f for f in keys.schema.fields if f.dataType.typeName() == "array"]
    assert keys.filter(F.col("collision_n") != F.col("ord") * 2 + 1).count() == 0 and keys.count() == 50_000


def test_attempts_fold_in_their_order(spark):
    from itertools import product

    from demandlake.operators.landing import attempt_outcomes

    def brute(steps, view):
        empties = 0
        for i, s in enumerate(steps):
            if s == "error":
                return "failed", i, empties, "DOWNLOAD_TIMEOUT"
            if s == "rows" or view != "dynamics":
                return "stored", i, empties, None
            empties += 1
            if empties == 2:
                return "failed", i, 2, "INTERFACE_CHANGED"
        return "pending", None, empties, None

    cases = [(f"{v}-{'-'.join(s)}", v, s) for v in ("dynamics", "regions") for n in (1, 2, 3, 4) for s in product(("empty", "rows", "error"), repeat=n)]
    rows = [(k, v, i, 0 if s == "empty" else 5 if s == "rows" else None, "DOWNLOAD_TIMEOUT" if s == "error" else None) for k, v, steps in cases for i, s in enumerate(steps)]
    df = spark.createDataFrame(rows, "run_id string, view string, seq int, row_count long, error_code string").orderBy("row_count")
    got = {r["run_id"]: (r["outcome"], r["decided_at"], r["n_empty"], r["error_code"]) for r in attempt_outcomes(df, ["run_id", "view"]).collect()}
    assert got == {k: brute(steps, v) for k, v, steps in cases}


def test_downloads_are_decided_at_the_first_look_that_tells(spark):
    inside, out = "/d/a.csv", "/home/a.csv"
    looks = {
        "ok": [[], ["/d/x.tmp"], [inside]], "grows": [[], [(inside, 0)], [inside]], "old": [[inside], [inside], [inside]], "two": [[], [], [inside, "/d/b.csv"]],
        "late two": [[], [inside], [inside, "/d/b.csv"]], "escaped": [[], [out], [out, inside]], "both": [[], [inside, out]], "old escape": [[out], [out], [out, inside]],
        "same": [[], [inside, "/d/./a.csv"]], "never": [[], [(inside, 0)], [(inside, 0)]],
    }
    rows = [(k, "dynamics", t, *((f, 9) if isinstance(f, str) else f)) for k, ticks in looks.items() for t, files in enumerate(ticks) for f in files]
    df = spark.createDataFrame(rows, "run_id string, view string, tick int, path string, length long").withColumn("inside", F.col("path").startswith("/d/"))
    begun = spark.createDataFrame([(k, "dynamics") for k in looks], "run_id string, view string")
    got = {r["run_id"]: (r["verdict"], r["decided_at"], r["warning"], r["error_code"]) for r in L.download_outcomes(begun, df).collect()}
    late, gone = "DOWNLOAD_TIMEOUT", "DOWNLOAD_ESCAPED"
    assert got == {"ok": ("ok", 2, False, None), "grows": ("ok", 2, False, None), "old": ("timeout", None, False, late), "two": ("too_many", 2, False, late), "late two": ("ok", 1, False, None),
                   "escaped": ("escaped", 1, False, gone), "both": ("ok", 1, True, None), "old escape": ("ok", 2, False, None), "same": ("ok", 1, False, None), "never": ("timeout", None, False, late)}
