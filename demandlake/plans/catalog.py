"""Registered queries: one per operator group of the inventory.

Each takes (spark, sf_dir) and reads the given tables (or data Spark derives
from them), so its work grows with the tables.  Column names and types match
the oracle SQL in ``demandlake.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.functions.numbers import parse_number
from demandlake.functions.text import split_lines
from demandlake.operators.parse import decode_exports, export_cells, parse_exports
from demandlake.operators.typing import column_profile, type_exports, typed_cells
from demandlake.plans import derive
from demandlake.plans.derive import table
from demandlake.plans.ingest import ingest_exports

def delimiter_name(d):
    return F.when(d == ";", "semicolon").when(d == "\t", "tab").when(d == ",", "comma")


# ------------------------------------------------------------------ P1, P2
def parse_localized_number(spark: SparkSession, sf: str) -> DataFrame:
    texts = derive.localized_amounts(table(spark, sf, "orders"))
    p = parse_number(F.col("text"))
    return texts.select("o_orderkey", p["kind"].alias("kind"), p["as_long"].alias("as_long"),
                        p["as_double"].alias("as_double"))


# ------------------------------------------------------------------ A1, A2, P3, J7
def _typed_parts(spark: SparkSession, sf: str) -> DataFrame:
    return type_exports(parse_exports(derive.part_exports(table(spark, sf, "part"))))


def infer_column_types(spark: SparkSession, sf: str) -> DataFrame:
    prof = column_profile(_typed_parts(spark, sf), ["export_id"])
    return prof.select("export_id", "col_ord", "header", "dtype")


def merge_column_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """A1 across exports: one dtype per column position over every part block,
    from additive kind counts (partial aggregation before the shuffle)."""
    from demandlake.operators.typing import merge_profiles

    prof = column_profile(_typed_parts(spark, sf), ["export_id"])
    merged = merge_profiles(prof, ["col_ord", "header"])
    return merged.select("col_ord", "header", "dtype", "n_exports", "n_text", "n_frac", "n_int")


def typed_cells_query(spark: SparkSession, sf: str) -> DataFrame:
    return typed_cells(_typed_parts(spark, sf), ["export_id"])


# ------------------------------------------------------------------ S2, S3
def decode_exports_query(spark: SparkSession, sf: str) -> DataFrame:
    dec = decode_exports(derive.document_exports(table(spark, sf, "documents")))
    return dec.select(
        "doc_id",
        "encoding",
        F.length("text").cast("bigint").alias("n_chars"),
        F.size(split_lines(F.col("text"))).alias("n_lines"),
        F.md5(F.encode("text", "UTF-8")).alias("text_md5"),
    )


def split_records(spark: SparkSession, sf: str) -> DataFrame:
    dec = decode_exports(derive.document_exports(table(spark, sf, "documents")))
    return dec.select("doc_id", F.posexplode_outer(split_lines(F.col("text"))).alias("line_ord", "line")).filter(
        F.col("line_ord").isNotNull()
    )


# ------------------------------------------------------------------ S4, S5, S6, F1, P14, O2, A3
def _parsed_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return parse_exports(derive.supplier_exports(table(spark, sf, "supplier"), table(spark, sf, "nation")))


def elect_delimiter(spark: SparkSession, sf: str) -> DataFrame:
    p = _parsed_suppliers(spark, sf)
    return p.select("export_id", delimiter_name(F.col("delimiter")).alias("delimiter"))


def validate_headers(spark: SparkSession, sf: str) -> DataFrame:
    p = _parsed_suppliers(spark, sf)
    return p.select(
        "export_id",
        F.coalesce("error_reason", F.lit("ok")).alias("header_status"),
        F.when(F.col("headers").isNotNull(), F.size("headers")).alias("n_headers"),
    )


def parse_records(spark: SparkSession, sf: str) -> DataFrame:
    return export_cells(_parsed_suppliers(spark, sf).filter("error_code is null"), ["export_id"]).select(
        "export_id", "row_ord", "col_ord", "text"
    )


def export_row_count(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed_suppliers(spark, sf).select("export_id", "row_count")


# ------------------------------------------------------------------ series: P6, P7, W1, W2, F8, F9, A4
def _series(spark: SparkSession, sf: str, granularity: str, by_user: bool) -> DataFrame:
    ex = derive.series_exports(table(spark, sf, "events"), granularity, by_user)
    return ingest_exports(ex)


def typed_daily_series(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: typed daily series per event type and month, with verdicts."""
    s = _series(spark, sf, "daily", False)
    rows = s.select(
        "export_id", "verdict", "rows", "columns", F.posexplode_outer("parsed_rows").alias("row_ord", "pr")
    ).filter(F.col("row_ord").isNotNull())

    def typed(j, kind):
        dtype = F.get(F.col("columns"), j)["dtype"]
        cell = F.get(F.col("pr"), j)
        if kind == "long":
            return F.when(dtype == "int64", cell["as_long"])
        return F.when(dtype == "float64", F.coalesce(cell["as_double"], cell["as_long"].cast("double")))

    return rows.select(
        "export_id",
        "row_ord",
        F.get(F.get(F.col("rows"), F.col("row_ord")), 0).alias("period"),
        typed(1, "long").alias("n"),
        typed(2, "double").alias("share"),
        "verdict",
    )


def _all_series(spark: SparkSession, sf: str) -> DataFrame:
    """Daily (per type and per user), weekly and monthly exports, landed
    together and ingested in one pass."""
    events = table(spark, sf, "events")
    return ingest_exports(derive.all_series_exports(events))


def series_contiguity(spark: SparkSession, sf: str) -> DataFrame:
    s = _all_series(spark, sf)
    return s.select(
        "export_id",
        (F.col("verdict") != "gap").alias("contiguous"),
        "gap_from",
        "gap_to",
    )


def series_containment(spark: SparkSession, sf: str) -> DataFrame:
    s = _all_series(spark, sf)
    return s.select(
        "export_id",
        "verdict",
        F.date_format("date_from", "yyyy-MM-dd").alias("date_from"),
        F.date_format("date_to", "yyyy-MM-dd").alias("date_to"),
        F.date_format("series_first", "yyyy-MM-dd").alias("series_first"),
        F.date_format("series_last", "yyyy-MM-dd").alias("series_last"),
    )


def actual_period_query(spark: SparkSession, sf: str) -> DataFrame:
    s = _all_series(spark, sf)
    return s.select(
        "export_id",
        F.col("actual_period.field").alias("field"),
        F.col("actual_period.from").alias("period_from"),
        F.col("actual_period.to").alias("period_to"),
        "row_count",
    )



# ------------------------------------------------------------------ F2, P5, P11, P12, F3
from demandlake.functions import dates as D  # noqa: E402
from demandlake.operators import batch as B  # noqa: E402
from demandlake.operators import landing as L  # noqa: E402
from demandlake.operators import manifest as M  # noqa: E402
from demandlake.operators import requests as R  # noqa: E402
from demandlake.constants import MONTHS_GENITIVE  # noqa: E402


def _requests(spark, sf):
    return derive.order_requests(table(spark, sf, "orders"))


def validate_period(spark: SparkSession, sf: str) -> DataFrame:
    v = R.validate_periods(_requests(spark, sf), derive.TODAY)
    return v.select(
        "o_orderkey", "granularity",
        D.iso_text(F.col("date_from")).alias("date_from"), D.iso_text(F.col("date_to")).alias("date_to"),
        F.col("period_reason").alias("reason"), F.col("error_message").alias("message"),
    )


def _iso_texts(spark, sf):
    r = _requests(spark, sf)
    k = F.col("o_orderkey") % 4
    d = F.col("date_from")
    text = (
        F.when(k == 0, D.iso_text(d))
        .when(k == 1, F.concat_ws("-", F.year(d).cast("string"), F.month(d).cast("string"), F.dayofmonth(d).cast("string")))
        .when(k == 2, F.concat(F.date_format(d, "yyyy-MM"), F.lit("-31")))
        .otherwise(F.date_format(d, "dd.MM.yyyy"))
    )
    return r.select("o_orderkey", F.when(d.isNotNull(), text).alias("text"))


def parse_iso_date(spark: SparkSession, sf: str) -> DataFrame:
    t = _iso_texts(spark, sf)
    return t.select("o_orderkey", "text", D.iso_text(D.parse_iso_date(F.col("text"))).alias("parsed"),
                    D.iso_date_error(F.col("text")).alias("error_message"))


def requested_period(spark: SparkSession, sf: str) -> DataFrame:
    r = _requests(spark, sf)
    p = D.requested_period(F.col("date_from"), F.col("date_to"))
    return r.select("o_orderkey", p["from"].alias("req_from"), p["to"].alias("req_to"),
                    D.iso_text(D.min_monthly_end(F.col("date_from"))).alias("min_monthly_end"))


def validate_batch(spark: SparkSession, sf: str) -> DataFrame:
    r = _requests(spark, sf)
    req = r.select(
        F.col("o_custkey").alias("batch_id"),
        F.col("o_orderkey").alias("phrase_ord"),
        F.when(F.col("o_orderkey") % 23 == 0, F.lit("  ")).otherwise(F.col("o_orderpriority")).alias("phrase"),
        F.when(F.col("o_custkey") % 29 == 0, F.lit(" ")).otherwise(F.lit("Россия")).alias("region"),
        "granularity", "date_from", "date_to",
        F.when(F.col("o_custkey") % 31 == 0, F.lit("run-x")).alias("resume_run"),
    )
    v = R.validate_batches(req, derive.TODAY)
    return v.select("batch_id", "n_phrases", "reason", "error_code", "error_message")


# ------------------------------------------------------------------ P4, S12, W3, P8, P9, P10, S11
from demandlake.functions.text import slugify as _slugify  # noqa: E402
from demandlake.session import dealt, spread  # noqa: E402


def slugify_query(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents")).select("doc_id", _slugify(F.col("text")).alias("slug"))


def run_key(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents")).select(
        "doc_id", "text", F.to_timestamp(F.lit("2026-08-21 10:00:00")).alias("now"))
    return R.run_keys(docs, order="doc_id", now="now", phrase="text").select("doc_id", "run_key")


def period_label(spark: SparkSession, sf: str) -> DataFrame:
    r = _requests(spark, sf)
    return r.select("o_orderkey", "granularity", D.period_label(F.col("granularity"), F.col("date_from")).alias("label"))


def label_granularity(spark: SparkSession, sf: str) -> DataFrame:
    r = _requests(spark, sf)
    d = F.col("date_from")
    gen = F.array(*[F.lit(m) for m in MONTHS_GENITIVE])
    mon = D.week_monday(d)
    sun = F.date_add(mon, 6)

    def day_gen_year(x):
        return F.concat_ws(" ", F.dayofmonth(x).cast("string"), F.element_at(gen, F.month(x)), F.year(x).cast("string"))

    k = F.col("o_orderkey") % 4
    label = (
        F.when(k == 0, D.period_label(F.lit("daily"), d))
        .when(k == 1, F.concat(day_gen_year(mon), F.lit(" – "), day_gen_year(sun)))
        .when(k == 2, D.period_label(F.lit("monthly"), d))
        .otherwise(F.date_format(d, "dd.MM.yyyy"))
    )
    return r.select("o_orderkey", F.when(d.isNotNull(), label).alias("label")).select(
        "o_orderkey", "label", D.label_granularity(F.col("label")).alias("granularity"))


def dataset_name(spark: SparkSession, sf: str) -> DataFrame:
    from demandlake.constants import VIEWS

    r = _requests(spark, sf)
    view = F.element_at(F.array(*[F.lit(v) for v in VIEWS]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    keep_raw = F.col("o_orderkey") % 2 == 0
    return r.select(
        "o_orderkey", view.alias("view"), "granularity", keep_raw.alias("keep_raw"),
    ).select(
        "o_orderkey", "view", "granularity",
        M.dataset_file(F.col("view"), F.col("granularity")).alias("file"),
        SINK.raw_name(F.col("view"), F.col("keep_raw")).alias("raw_file"),
    )


# ------------------------------------------------------------------ manifests
def _runs(spark, sf, region=False):
    # Each run is some writes of the log, and the sort before their first aggregate holds a task's share of these.
    return derive.customer_runs(dealt(table(spark, sf, "customer")), table(spark, sf, "nation") if region else None)


def _log(spark, sf):
    return derive.export_log(_runs(spark, sf))


def _merged(spark, sf):
    log = _log(spark, sf).drop("c_custkey", "view_ord")
    return M.merge_exports(log)


def merge_exports_query(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf).select("run_id", "view", "view_ord", "seq", "row_count", "file", "n_writes")


def missing_views_query(spark: SparkSession, sf: str) -> DataFrame:
    return M.missing_views(_runs(spark, sf), _merged(spark, sf)).select("run_id", "view", F.col("view_ord").cast("int"))


def _files(merged):
    return merged.filter(F.col("file_present")).select("run_id", "file")


def pending_views_query(spark: SparkSession, sf: str) -> DataFrame:
    merged = _merged(spark, sf)
    return M.pending_views(_runs(spark, sf), merged, _files(merged)).select(
        "run_id", "view", F.col("view_ord").cast("int"))


CREATED = 1787270400
STALE_AT = 1790000000


def _created(runs):
    """Every run's manifest is first written, without entries, when its folder is made."""
    return runs.withColumns({"created_at": F.timestamp_seconds(F.lit(CREATED) + F.col("c_custkey") * 60),
                             "source_url": F.concat(F.lit("https://reports.example/?run="), F.col("c_custkey").cast("string"))})


def prune_stale_query(spark: SparkSession, sf: str) -> DataFrame:
    merged = _merged(spark, sf)
    runs = _created(_runs(spark, sf)).select("run_id", F.col("created_at").alias("updated_at"))
    marked = M.prune_stale(merged, _files(merged))
    out = M.pruned_runs(runs, marked, F.timestamp_seconds(F.lit(STALE_AT)))
    return out.select("run_id", "n_before", "n_after", (F.unix_seconds("updated_at") == STALE_AT).alias("bumped"))


def _manifests(spark, sf):
    runs = _runs(spark, sf)
    entries = M.manifest_entries(_merged(spark, sf).select("run_id", "view_ord", "view", "file", "row_count"))
    return runs.join(entries, "run_id", "left").withColumn(
        "exports", F.coalesce(F.col("exports"), F.array().cast(entries.schema["exports"].dataType)))


def run_status_query(spark: SparkSession, sf: str) -> DataFrame:
    st = M.run_status(_manifests(spark, sf))
    return st.select(
        "run_id",
        F.size("missing_views").alias("n_missing"),
        F.size("empty_views").alias("n_empty"),
        "status",
        F.array_join("missing_views", ",").alias("missing"),
        F.array_join("empty_views", ",").alias("empty"),
    )


def duplicate_views_query(spark: SparkSession, sf: str) -> DataFrame:
    d = M.duplicate_views(_log(spark, sf).select("run_id", "view"))
    return d.select("run_id", "duplicate", F.array_join("dup_views", ",").alias("dup_views"))


def manifest_timestamps_query(spark: SparkSession, sf: str) -> DataFrame:
    t = M.manifest_timestamps(_created(_runs(spark, sf)), _log(spark, sf))
    return t.select("run_id", F.unix_seconds("created_at").alias("created_at"),
                    F.unix_seconds("updated_at").alias("updated_at"), "source_url")


def resume_match_query(spark: SparkSession, sf: str) -> DataFrame:
    runs = _runs(spark, sf, region=True)
    k = F.col("c_custkey")
    other_g = F.when(F.col("granularity") == "daily", F.lit("weekly")).otherwise(F.lit("daily"))
    req = runs.select(
        F.when(k % 13 == 6, F.concat(F.lit("run-"), (k + 1000000).cast("string"))).otherwise(F.col("run_id")).alias("run_id"),
        F.when(k % 5 == 1, F.concat(F.lit("  "), F.col("phrase"), F.lit(" ")))
        .when(k % 5 == 2, F.concat(F.col("phrase"), F.lit("x"))).otherwise(F.col("phrase")).alias("phrase"),
        F.when(k % 7 == 3, F.lit("Other")).otherwise(F.col("region")).alias("region"),
        F.when(k % 11 == 4, other_g).otherwise(F.col("granularity")).alias("granularity"),
        "requested_period",
    )
    return M.resume_match(req, runs).select("run_id", "match")


# ------------------------------------------------------------------ batches
def _views(spark, sf):
    requests, attempts, stored, _ = derive.batch_logs(table(spark, sf, "conversations"))
    return B.view_outcomes(requests, attempts, stored)


def auth_abort_cut_query(spark: SparkSession, sf: str) -> DataFrame:
    """What became of each phrase of a batch that lost its login."""
    o = _outcomes(spark, sf)
    state = F.when(F.col("error_code") == "AUTH_REQUIRED", "auth_failed").when(F.col("outcome") == "skipped", "skipped").otherwise("attempted")
    return o.select("batch_id", "phrase_ord", state.alias("phrase_state"))


def first_failure_cut_query(spark: SparkSession, sf: str) -> DataFrame:
    return _views(spark, sf).select("run_id", "view", "outcome", "view_error")


def phrase_outcome_query(spark: SparkSession, sf: str) -> DataFrame:
    return B.phrase_outcome(_views(spark, sf)).select("run_id", "outcome", "error_code", "partial")


def _outcomes(spark, sf):
    requests, attempts, stored, _ = derive.batch_logs(table(spark, sf, "conversations"))
    return B.run_outcomes(requests, attempts, stored)


def batch_summary_query(spark: SparkSession, sf: str) -> DataFrame:
    o = _outcomes(spark, sf)
    return B.batch_summary(o).select("batch_id", "total", "collected", "failed", "partial", "skipped", "exit_code")


def incomplete_report_query(spark: SparkSession, sf: str) -> DataFrame:
    requests, attempts, stored, warnings = derive.batch_logs(table(spark, sf, "conversations"))
    return B.incomplete_report(B.view_outcomes(requests, attempts, stored), warnings).select("run_id", "line_ord", "view", "path", "reason")


def _phrase_files(spark, sf):
    """documents as phrase files; every 50th has a byte that neither encoding knows."""
    files = derive.document_exports(table(spark, sf, "documents"))
    bad = F.col("doc_id") % 50 == 7
    return files.select(F.col("doc_id").alias("file_ord"), F.when(bad, F.concat("content", F.unhex(F.lit("98")))).otherwise(F.col("content")).alias("content"))


def phrase_list(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of every phrase file; a file that cannot be decoded has one row with an error."""
    lines = SRC.phrase_lines(_phrase_files(spark, sf))
    return lines.select(F.col("file_ord").alias("doc_id"), "phrase_ord", "phrase", "error_code")


def phrase_union(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of eight documents: their sources as inline phrases, then the lines of their files."""
    docs = table(spark, sf, "documents")
    batch = lambda c: F.expr(f"{c} div 8")
    inline = docs.select(batch("doc_id").alias("batch_id"), F.col("doc_id").alias("arg_ord"), F.col("source").alias("phrase"))
    lines = SRC.phrase_lines(_phrase_files(spark, sf)).filter("error_code is null").withColumn("batch_id", batch("file_ord"))
    return SRC.resolve_phrases(inline, lines).select("batch_id", "source_ord", "o1", "o2", "phrase")


# ------------------------------------------------------------------ landing
def _page_files(spark, sf):
    return derive.page_files(table(spark, sf, "pages"))


def _roots():
    return F.array(*[F.lit(r) for r in derive.LANDING_ROOTS])


def landing_scan(spark: SparkSession, sf: str) -> DataFrame:
    f = _page_files(spark, sf)
    return f.select("page_id", "path", L.is_csv(F.col("path")).alias("is_csv"),
                    L.accepted(F.col("path"), F.col("length")).alias("accepted"))


def path_containment(spark: SparkSession, sf: str) -> DataFrame:
    f = _page_files(spark, sf)
    return f.select("page_id", L.normalise_path(F.col("path")).alias("norm_path"),
                    L.contained(F.col("path"), _roots()).alias("contained"))


def new_files_query(spark: SparkSession, sf: str) -> DataFrame:
    f = _page_files(spark, sf).withColumn("norm_path", L.normalise_path(F.col("path")))
    before = f.filter(F.col("page_id") % 5 == 0)
    return L.new_files(before, f).select("page_id", "norm_path")


def download_verdict_query(spark: SparkSession, sf: str) -> DataFrame:
    f = _page_files(spark, sf).select(
        (F.col("page_id") / 3).cast("bigint").alias("run_id"), F.lit("dynamics").alias("view"), F.lit(1).alias("tick"),
        "path", "length", L.contained(F.col("path"), _roots()).alias("inside"))
    v = L.download_verdict(f)
    return v.select(F.col("run_id").alias("tick_id"), "n_csv", "n_escaped", "verdict", "warning")


def untrusted_empty_query(spark: SparkSession, sf: str) -> DataFrame:
    from demandlake.constants import VIEWS

    p = table(spark, sf, "pages").select(
        "page_id",
        F.element_at(F.array(*[F.lit(v) for v in VIEWS]), (F.col("page_id") % 4 + 1).cast("int")).alias("view"),
        F.when(F.length("html") % 4 == 0, F.lit(0)).otherwise((F.length("html") / 100).cast("bigint")).alias("row_count"),
        F.lit(None).cast("string").alias("error_code"),
    )
    return L.untrusted_empty(p).select("page_id", "view", "row_count", "untrusted")


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    ex = derive.supplier_exports(table(spark, sf, "supplier"), table(spark, sf, "nation"))
    _, bad = L.split_quarantine(parse_exports(ex))
    return bad.select("export_id", "file_name", "error_code", "error_message")



# ------------------------------------------------------------------ sinks: S8, S9, S10, S11, S13
from demandlake.session import dealt, fresh_dir, spread  # noqa: E402
from demandlake.sources import files as SRC  # noqa: E402
from demandlake.sources import sinks as SINK  # noqa: E402
from demandlake.sources.small_files import small_files  # noqa: E402


def typed_parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """All series (daily, weekly, monthly; by type and by user) written (zstd) and read back: the trusted ones, whatever their types."""
    base = fresh_dir(spark, "typed")
    exports = derive.all_series_exports(table(spark, sf, "events"))
    SINK.store_exports(ingest_exports(exports, keep_content=True), base, ["export_id"])
    cells = F.col("cells")  # weekly and daily exports have a fourth, empty column
    return spark.read.parquet(f"{base}/typed/rows").select(
        "export_id", "row_ord", F.get(cells["text"], F.lit(0)).alias("period"), F.get(cells["as_long"], F.lit(1)).alias("n"), F.get(cells["as_double"], F.lit(2)).alias("share"))


def _stored_customers(spark, sf):
    base = fresh_dir(spark, "customers")
    SINK.store_exports(ingest_exports(derive.damaged_exports(table(spark, sf, "customer"), "c_custkey"), keep_content=True), base, ["run_id", "file_name"])
    return base


def stored_exports(spark: SparkSession, sf: str) -> DataFrame:
    """The gate: of exports damaged in eleven ways, only the sound ones are in the typed table."""
    wide = SINK.read_shape(spark, f"{_stored_customers(spark, sf)}/typed", ["string", "int64", "float64"], ["run_id"])
    return wide.select("run_id", "row_ord", F.col("c0").alias("period"), F.col("c1").alias("n"), F.col("c2").alias("share"))


def quarantine_store(spark: SparkSession, sf: str) -> DataFrame:
    """The gate's other side: every other export with its bytes, code and reason."""
    back = spark.read.parquet(f"{_stored_customers(spark, sf)}/quarantine")
    return back.select("run_id", "file_name", "error_code", "reason", F.md5("content").alias("content_md5"), F.col("message").isNotNull().alias("has_message"))


def raw_retention(spark: SparkSession, sf: str) -> DataFrame:
    """Part exports as raw files; the even blocks keep theirs."""
    base = fresh_dir(spark, "raw")
    exports = derive.part_exports(table(spark, sf, "part")).withColumns(
        {"view": F.lit("regions"), "keep_raw": F.substring_index("export_id", "-", -1).cast("bigint") % 2 == 0})
    named = SINK.write_raw(exports, base, ["export_id"])
    kept = spark.read.parquet(base).select("export_id", F.md5("content").alias("content_md5"))
    return named.select("export_id", "raw_file").join(kept, "export_id", "left")


def file_scan(spark: SparkSession, sf: str) -> DataFrame:
    """S1 over written files: suppliers' exports land as .csv files and are scanned, decoded and parsed."""
    base = fresh_dir(spark, "scan")
    ex = derive.supplier_exports(table(spark, sf, "supplier"), table(spark, sf, "nation"))
    derive.land(derive.landed_lines(ex.select(F.col("export_id").alias("run_id"), F.lit("regions").alias("view"), "content")), base)
    found = SRC.landing_scan(spark, base).withColumn("export_id", SRC.path_part(F.col("path"), "run_id"))
    parsed = parse_exports(found.select("export_id", "accepted", "file_name", "content"))
    return parsed.select("export_id", "accepted", F.lower("file_name").endswith(".csv").alias("is_csv"), "row_count",
                         F.coalesce("error_reason", F.lit("ok")).alias("header_status"))


def manifest_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Manifests written as indented JSON files with derived fields, loaded back (S9, S10): every field."""
    base = fresh_dir(spark, "manifests")
    runs = _created(_runs(spark, sf, region=True))
    entries = M.manifest_entries(_merged(spark, sf).select(
        "run_id", "view_ord", "view", "file", F.when(F.col("seq") == 2, F.concat("view", F.lit(".csv"))).alias("raw_file"), "row_count",
        F.create_map(F.lit("Запрос"), F.lit("string"), F.lit("Число запросов"), F.lit("int64")).alias("dtypes"), "ts"))
    m = runs.join(entries, "run_id", "left").withColumn("exports", F.coalesce("exports", F.array().cast(entries.schema["exports"].dataType)))
    period = lambda c: F.when(c.isNotNull(), F.create_map(F.lit("from"), c["from"], F.lit("to"), c["to"]))
    dynamics = F.exists("exports", lambda e: e["view"] == "dynamics")
    m = m.select(
        "run_id", "phrase", "region", "created_at", F.array_max(F.transform("exports", lambda e: e["ts"])).alias("updated_at"), "source_url",
        F.transform("exports", lambda e: e.dropFields("view_ord", "ts")).alias("exports"), "granularity",
        period(F.col("requested_period")).alias("requested_period"),
        F.when(dynamics, F.create_map(F.lit("field"), F.lit("Дата"), F.lit("from"), F.lit("01.06.2026"), F.lit("to"), F.lit("30.06.2026"))).alias("actual_period"),
    )
    SINK.write_manifests(m, f"{base}/json")
    back = M.run_status(SRC.load_manifests(spark, f"{base}/json", "*.txt"))
    shown = lambda e: F.concat_ws("/", e["view"], e["file"], F.coalesce(e["raw_file"], F.lit("-")), e["row_count"].cast("string"), F.array_join(F.map_keys(e["dtypes"]), ","), F.array_join(F.map_values(e["dtypes"]), ","))
    return back.select(
        "run_id", "phrase", "region", F.unix_seconds("created_at").alias("created_at"), F.unix_seconds("updated_at").alias("updated_at"), "source_url",
        F.array_join(F.transform("exports", shown), " ").alias("exports"), "granularity",
        F.col("requested_period")["from"].alias("req_from"), F.col("requested_period")["to"].alias("req_to"),
        F.col("actual_period")["field"].alias("act_field"), F.col("actual_period")["to"].alias("act_to"), "error_code",
        F.array_join("missing_views", ",").alias("missing"), F.array_join("empty_views", ",").alias("empty"), "status",
    )


def manifest_errors(spark: SparkSession, sf: str) -> DataFrame:
    """One damaged manifest document for each customer, by ``c_custkey % 10``; one verdict a document."""
    k = F.col("c_custkey") % 10
    entry = F.lit('{"view": "regions", "file": "regions.parquet", "raw_file": null, "row_count": 3, "dtypes": {"a": "int64"}}')
    exports = (
        F.when(k == 1, F.concat(entry, F.lit(", "), entry)).when(k == 2, F.replace(entry, F.lit('"regions",'), F.lit('"maps",')))
        .when(k == 3, F.replace(entry, F.lit('"file": "regions.parquet", '), F.lit(""))).when(k == 4, F.replace(entry, F.lit('{"a": "int64"}'), F.lit("null")))
        .otherwise(entry)
    )
    head = F.concat(F.lit('{\n  "phrase": "'), F.col("c_name"), F.lit('",\n  "region": "x",\n'))
    rest = F.concat(
        F.when(k == 5, F.lit("")).otherwise(F.lit('  "created_at": "2026-08-21T10:00:00Z",\n')), F.lit('  "source_url": "https://reports.example/",\n  "exports": ['), exports,
        F.when(k == 6, F.lit('],\n  "granularity": "hourly"\n}\n')).when(k == 7, F.lit('],\n  "granularity": "daily"\n}\n')).when(k == 8, F.lit("]\n")).otherwise(F.lit("]\n}\n")))
    docs = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.concat(head, rest).alias("document"))
    return SRC.parse_manifests(docs).select("key", "error_code", "granularity", "phrase", F.size("exports").alias("n_exports"))


# ------------------------------------------------------------------ streaming: T1-T4
from demandlake.streaming import ingest as STREAM  # noqa: E402


def _series_landing(spark, sf):
    """Daily exports by type as files, a run each, with their requests; ``stream_all_exports`` lands the others too."""
    ex = derive.all_series_exports(table(spark, sf, "events")).filter("granularity = 'daily' and series_key not like '%/%'")
    return ex.withColumns({"run_id": F.col("export_id"), "view": F.lit("dynamics")})


def _streamed_series(spark: SparkSession, base: str, ex: DataFrame) -> DataFrame:
    """``ex`` landed as files in two waves and drained by two availableNow runs to
    ``base``/exports: the typed series of trusted exports."""
    runs = ex.select("run_id", "granularity", "date_from", "date_to")
    for wave in (F.col("series_key") < "p", F.col("series_key") >= "p"):
        derive.land(derive.landed_lines(ex.filter(wave)), f"{base}/landing")
        STREAM.run_ingest(spark, f"{base}/landing", runs, f"{base}/exports", f"{base}/checkpoint")
    cells = STREAM.latest_cells(spark, f"{base}/exports")
    wide = cells.groupBy("run_id", "verdict", "row_ord").agg(
        F.max(F.when(F.col("col_ord") == 0, F.col("text"))).alias("period"),
        F.max(F.when(F.col("col_ord") == 1, F.col("as_long"))).alias("n"),
        F.max(F.when(F.col("col_ord") == 2, F.col("as_double"))).alias("share"),
    )
    return wide.select(F.col("run_id").alias("export_id"), "row_ord", "period", "n", "share", "verdict")


def stream_ingest_equals_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Daily exports by type landed as files in two waves, drained by two availableNow
    runs; the typed series are those of a batch ingest, trusted exports only."""
    return _streamed_series(spark, fresh_dir(spark, "stream"), _series_landing(spark, sf))


def stream_all_exports(spark: SparkSession, sf: str) -> DataFrame:
    """All exports of events (daily by type and by user, weekly, monthly), a file
    each, through the same stream, which so grows with the users: the verdict of
    each, and what is stored of the trusted ones."""
    base = fresh_dir(spark, "stream-all")
    ex = derive.all_series_exports(table(spark, sf, "events")).withColumns({"run_id": F.col("export_id"), "view": F.lit("dynamics")})
    stored = _streamed_series(spark, base, ex).groupBy("export_id").agg(F.count("period").alias("n_stored"), F.sum("n").alias("volume"))
    log = STREAM.newest(STREAM.export_log(spark, f"{base}/exports")).select(F.col("run_id").alias("export_id"), "granularity", "verdict", "row_count")
    return log.join(stored, "export_id", "left")


def _supplier_stream(spark, sf):
    base = fresh_dir(spark, "stream-runs")
    ex = derive.damaged_exports(table(spark, sf, "supplier"), "s_suppkey")
    runs = ex.select("run_id", "granularity", "date_from", "date_to", F.timestamp_seconds(F.lit(CREATED)).alias("created_at"))
    return base, ex, runs


def stream_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """One file for each supplier, damaged in eleven ways, in one wave; the log
    has every file's verdict, the undecodable ones' too, and every run has a manifest.
    Files without a byte don't land, so their runs have only the manifest of their creation."""
    base, ex, runs = _supplier_stream(spark, sf)
    derive.land(derive.landed_lines(ex), f"{base}/landing")
    STREAM.run_ingest(spark, f"{base}/landing", runs, f"{base}/exports", f"{base}/checkpoint")
    log = STREAM.export_log(spark, f"{base}/exports")
    manifests = M.run_status(STREAM.run_manifests(runs, log))
    last = STREAM.newest(log).select("run_id", "verdict", F.coalesce("error_code", "check_code").alias("error_code"))
    return manifests.join(last, "run_id", "left").select(
        "run_id", F.size("exports").alias("n_exports"), "verdict", "error_code", F.array_join("missing_views", ",").alias("missing"), "status",
        (F.col("updated_at") >= F.col("created_at")).alias("updated"))


def late_tail(spark: SparkSession, sf: str) -> DataFrame:
    """A first wave lands only the first two rows of every sound file;
    the runs still pending after it get nothing more, a second wave lands the
    whole file and, in the same wave, an older copy of one row.  Newest wins,
    nothing is padded or doubled."""
    base, ex, runs = _supplier_stream(spark, sf)
    lines = derive.landed_lines(ex)
    derive.land(lines.filter("ord <= 2"), f"{base}/landing")
    STREAM.run_ingest(spark, f"{base}/landing", runs, f"{base}/exports", f"{base}/checkpoint")
    pending = STREAM.next_wave(runs, STREAM.export_log(spark, f"{base}/exports")).filter("view = 'dynamics'").select("run_id")
    whole = lines.join(pending, "run_id", "left_anti")
    derive.land(whole.filter("ord <= 1"), f"{base}/landing")
    derive.land(whole, f"{base}/landing")
    STREAM.run_ingest(spark, f"{base}/landing", runs, f"{base}/exports", f"{base}/checkpoint")
    cells = STREAM.latest_cells(spark, f"{base}/exports").filter("col_ord = 0")
    writes = STREAM.newest(STREAM.export_log(spark, f"{base}/exports")).select("run_id", "n_writes")
    return cells.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_rows"), F.max_by("text", "row_ord").alias("last")).join(writes, "run_id")


# ------------------------------------------------------------------ long cells and long files: S3, S6 on byte ranges
from demandlake.sources import long_files as LONG  # noqa: E402

LONG_CELL = 20_000
RANGE_BYTES = 256 << 10


def long_cells(spark: SparkSession, sf: str) -> DataFrame:
    """S6 in one row: every 500th order as an export of three records, of which one has a cell of some 400,000 characters."""
    records = derive.order_records(dealt(table(spark, sf, "orders").filter("o_orderkey % 500 = 0")), LONG_CELL)
    small = F.lit("1;x;2;3")
    text = F.concat_ws("\n", F.lit(derive.LONG_HEADER), small, "record", small)
    parsed = parse_exports(records.select(F.col("o_orderkey").cast("string").alias("file_name"), F.encode(text, "UTF-8").alias("content")))
    # An inner generator would have the parse copied into a filter below it.
    rows = parsed.select("file_name", "delimiter", F.posexplode_outer("rows").alias("row_ord", "cells")).filter(F.col("row_ord").isNotNull())
    return rows.select("file_name", "delimiter", "row_ord", F.get("cells", 0).alias("number"), F.length(F.get("cells", 1)).alias("n_chars"),
                       F.md5(F.get("cells", F.lit(1))).alias("note_md5"), F.get("cells", 3).alias("day"))


def _order_files(spark, sf):
    base = fresh_dir(spark, "orders")
    derive.land(derive.order_file_lines(table(spark, sf, "orders"), LONG_CELL // 20), base)
    return base


def long_file_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """S1-S6 in long form: all orders in five export files (cp1251; quoted line breaks, cells
    that span ranges, short and blank records), parsed by byte ranges of 256 KB."""
    _, rows = LONG.parse_long(spark, _order_files(spark, sf), RANGE_BYTES)
    c = F.col("cells")
    return rows.select(SRC.path_part(SRC.unescaped(F.col("path")), "view").alias("priority"), "row_ord", F.get(c, F.lit(0)).alias("number"),
                       F.md5(F.get(c, F.lit(1))).alias("note_md5"), F.get(c, F.lit(2)).alias("amount"), F.get(c, F.lit(3)).alias("day"))


def long_file_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """A1, A3 in long form: the same files' row counts, encodings and column types."""
    exports, rows = LONG.parse_long(spark, _order_files(spark, sf), RANGE_BYTES)
    types = LONG.long_profiles(rows).groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col_ord", "dtype"))), lambda x: x["dtype"]), ",").alias("types"))
    out = exports.join(types, "path", "left")
    return out.select(SRC.path_part(SRC.unescaped(F.col("path")), "view").alias("priority"), "encoding", "delimiter", F.array_join("headers", "|").alias("headers"),
                      "row_count", "error_code", "types")


def series_checks_long(spark: SparkSession, sf: str) -> DataFrame:
    """W2, F4, F8, F9 on long cells: exports of customers damaged in twelve ways."""
    from demandlake.operators.parse import export_cells
    from demandlake.operators.series import series_checks_long as checks

    parsed = parse_exports(derive.damaged_exports(table(spark, sf, "customer"), "c_custkey"))
    exports = parsed.select("run_id", "view", "granularity", "date_from", "date_to", "error_code")
    return checks(export_cells(parsed, ["run_id"]), exports, "run_id").select("run_id", "verdict", "check_code", F.date_format("series_first", "yyyy-MM-dd").alias("series_first"))


# ------------------------------------------------------------------ F4, W3, J5 + U4, T1-T3 over stored state
from demandlake.streaming import manifests as MAN  # noqa: E402


def attempt_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """the events of a user in a month are the fetches of one export; a click is an
    empty one, a purchase has rows, and every 7th event fails."""
    ev = table(spark, sf, "events")
    failed = F.col("event_id") % 7 == 3
    attempts = ev.select(
        F.concat_ws("/", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM")).alias("run_id"), F.when(F.col("user_id") % 4 == 0, "regions").otherwise("dynamics").alias("view"),
        F.struct("ts", "event_id").alias("seq"), F.when(F.col("event_type") == "purchase", 5).otherwise(0).cast("long").alias("row_count"), F.when(failed, F.lit("DOWNLOAD_TIMEOUT")).alias("error_code"))
    got = L.attempt_outcomes(attempts, ["run_id", "view"])
    return got.select("run_id", "view", "outcome", F.col("decided_at.event_id").alias("decided_at"), "n_empty", "error_code")


def download_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """The download of each user's day, decided at the first look that tells."""
    seen = derive.download_sightings(table(spark, sf, "events"))
    got = L.download_outcomes(seen.select("run_id", "view"), seen)
    return got.select("run_id", "verdict", "decided_at", F.element_at(F.split("path", "/"), -1).alias("file"), "warning", "error_code")


def run_key_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """W3 where numbers are taken: a run for each event, named by its type (two types share
    a name); of that name, the numbers of all even order keys are taken."""
    kind = F.col("event_type")
    requests = table(spark, sf, "events").select(F.col("event_id").alias("ord"), F.when(kind.isin("click", "view"), "груз").otherwise(kind).alias("phrase"),
                                                 F.to_timestamp(F.lit("2026-08-21 10:00:00")).alias("now"))
    held = table(spark, sf, "orders").filter("o_orderkey % 2 = 0").select(F.concat(F.lit("20260821T100000Z-груз-"), F.col("o_orderkey").cast("string")).alias("run_key"))
    return R.run_keys(requests, order="ord", existing=held).select("ord", "run_key", "collision_n")


def landing_changes(spark: SparkSession, sf: str) -> DataFrame:
    """J5 + U4: three snapshots of a real folder of suppliers' files: a first wave without every
    5th run, a second one that adds these, rewrites every 3rd run and removes every 7th."""
    base = fresh_dir(spark, "waves")
    k = F.col("s_suppkey")
    lines = table(spark, sf, "supplier").select(k, F.concat(F.lit("run-"), k.cast("string")).alias("run_id"), F.lit("dynamics").alias("view"),
                                                F.explode(F.sequence(F.lit(0), F.lit(3))).alias("ord"))
    lines = lines.withColumn("line", F.concat_ws(";", F.col("run_id"), F.col("ord").cast("string")))
    snap = lambda n: L.write_snapshot(SRC.landing_scan(spark, f"{base}/wave{min(n, 2)}").withColumn("path", F.regexp_replace("path", "/wave[0-9]/", "/")), f"{base}/snapshots", n)
    derive.land(lines.filter(k % 5 != 0), f"{base}/wave1")
    snap(1)
    derive.land(lines.filter((k % 7 != 0) & ((k % 3 != 0) | (F.col("ord") < 3))), f"{base}/wave2")
    snap(2)
    snap(3)
    run = SRC.path_part(F.col("norm_path"), "run_id")
    # A file's name holds the job that wrote it: files are told by their run here.
    kept = spark.read.parquet(f"{base}/snapshots").select("snapshot", run.alias("norm_path"), "length", F.when(run.isNotNull(), F.lit(0)).cast("timestamp").alias("modificationTime"))
    return L.snapshot_changes(kept).select("snapshot", F.col("norm_path").alias("run_id"), "change", "length_before", "length")


def _stored_runs(spark, sf):
    """Suppliers' runs with all fields of a manifest, and their damaged exports as lines."""
    base, ex, runs = _supplier_stream(spark, sf)
    runs = runs.withColumns({"phrase": F.col("run_id"), "region": F.lit("Москва"), "source_url": F.lit("https://reports.example/"),
                             "requested_period": D.requested_period(F.col("date_from"), F.col("date_to"))})
    lines = derive.landed_lines(ex).withColumn("k", F.substring_index("run_id", "-", -1).cast("long"))
    drain = lambda **more: STREAM.run_ingest(spark, f"{base}/landing", runs, f"{base}/exports", f"{base}/checkpoint", manifests=f"{base}/manifests", datasets=f"{base}/datasets", **more)
    return base, runs, lines, drain


def stream_too_large(spark: SparkSession, sf: str) -> DataFrame:
    """A file for each supplier, every 9th above the limit of 64 KB; the stream drains, its log has the reason."""
    base, _, runs = _supplier_stream(spark, sf)
    rows = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k")).withColumn("n", F.when(F.col("k") % 9 == 0, 6000).otherwise(3))
    run = F.concat(F.lit("run-"), F.col("k").cast("string"))
    day = F.date_format(F.date_add(F.lit("2026-06-01").cast("date"), F.col("ord") - 1), "dd.MM.yyyy")
    lines = rows.select(run.alias("run_id"), F.lit("dynamics").alias("view"), F.explode(F.sequence(F.lit(0), "n")).alias("ord"))
    lines = lines.withColumn("line", F.when(F.col("ord") == 0, F.lit("date;requests")).otherwise(F.concat(day, F.lit(";7"))))
    derive.land(lines, f"{base}/landing")
    STREAM.run_ingest(spark, f"{base}/landing", runs.withColumns({"date_from": F.lit(None).cast("date"), "date_to": F.lit(None).cast("date")}), f"{base}/exports", f"{base}/checkpoint", limit=64 << 10)
    log = STREAM.export_log(spark, f"{base}/exports")
    reasons = STREAM.quarantined(spark, f"{base}/exports").select("run_id", "reason", F.col("content").isNull().alias("unread"))
    return log.select("run_id", "row_count", "verdict", "error_code", "trusted").join(reasons, "run_id", "left")


def stored_manifests(spark: SparkSession, sf: str) -> DataFrame:
    """The documents on disk before the first file, after a first wave (two rows of every
    file of an even run) and after a second one (all files whole), of all runs.

    A wave's last micro-batch is written once more before its documents are read."""
    base, runs, lines, drain = _stored_runs(spark, sf)
    parts = []

    def keep(wave):
        docs = SRC.load_manifests(spark, f"{base}/manifests", "*.txt").withColumn("wave", F.lit(wave))
        docs.write.parquet(f"{base}/seen/{wave}")
        parts.append(spark.read.schema(docs.schema).parquet(f"{base}/seen/{wave}"))

    derive.land(lines.limit(0), f"{base}/landing")
    drain()
    keep(0)
    for wave, landed in ((1, lines.filter("k % 2 = 0 and ord <= 2")), (2, lines)):
        derive.land(landed, f"{base}/landing")
        drain()
        last = STREAM.stored_exports(spark, f"{base}/exports").agg(F.max("batch_id")).first()[0]
        if last is not None:
            MAN.upsert_manifests(runs, spark.read.parquet(f"{base}/exports/batch_id={last}").withColumn("batch_id", F.lit(last)), f"{base}/manifests")
        keep(wave)
    docs = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return docs.select("wave", "run_id", "phrase", F.array_join(F.transform("exports", lambda e: F.concat_ws("/", e["view"], e["file"], e["row_count"].cast("string"))), " ").alias("exports"),
                       F.col("actual_period")["to"].alias("period_to"), F.col("requested_period")["from"].alias("requested_from"), (F.col("updated_at") >= F.col("created_at")).alias("updated"), "error_code")


def resume_state(spark: SparkSession, sf: str) -> DataFrame:
    """After a stream of all suppliers' files, every run's views as the stored
    documents, the stored datasets and the stream's log tell them: the datasets of every
    24th run are gone, the documents of every 36th were lost."""
    base, runs, lines, drain = _stored_runs(spark, sf)
    derive.land(lines, f"{base}/landing")
    drain()
    k = F.substring_index("run_id", "-", -1).cast("long")
    left = small_files(spark).read.parquet(f"{base}/datasets").filter(k % 24 != 0)
    MAN.write_cells(left, f"{base}/datasets-left")
    MAN.write_first_manifests(runs.filter(k % 36 == 0), f"{base}/manifests-left")
    docs = SRC.load_manifests(spark, f"{base}/manifests", "*.txt").filter(k % 36 != 0)
    MAN.write_documents(docs.drop("path"), f"{base}/manifests-left")
    states = MAN.resume_state(runs, f"{base}/manifests-left", f"{base}/datasets-left", STREAM.export_log(spark, f"{base}/exports"))
    return states.select("run_id", "view_ord", "view", "state", "pending")


QUERIES = {
    "long_cells": long_cells,
    "long_file_ranges": long_file_ranges,
    "long_file_profiles": long_file_profiles,
    "series_checks_long": series_checks_long,
    "attempt_outcomes": attempt_outcomes,
    "download_outcomes": download_outcomes,
    "run_key_gaps": run_key_gaps,
    "landing_changes": landing_changes,
    "stream_too_large": stream_too_large,
    "stored_manifests": stored_manifests,
    "resume_state": resume_state,
    "parse_localized_number": parse_localized_number,
    "infer_column_types": infer_column_types,
    "typed_cells": typed_cells_query,
    "merge_column_profiles": merge_column_profiles,
    "decode_exports": decode_exports_query,
    "split_records": split_records,
    "elect_delimiter": elect_delimiter,
    "validate_headers": validate_headers,
    "parse_records": parse_records,
    "export_row_count": export_row_count,
    "typed_daily_series": typed_daily_series,
    "series_contiguity": series_contiguity,
    "series_containment": series_containment,
    "actual_period": actual_period_query,
    "validate_period": validate_period,
    "parse_iso_date": parse_iso_date,
    "requested_period": requested_period,
    "validate_batch": validate_batch,
    "slugify": slugify_query,
    "run_key": run_key,
    "period_label": period_label,
    "label_granularity": label_granularity,
    "dataset_name": dataset_name,
    "merge_exports": merge_exports_query,
    "missing_views": missing_views_query,
    "pending_views": pending_views_query,
    "prune_stale": prune_stale_query,
    "run_status": run_status_query,
    "duplicate_views": duplicate_views_query,
    "manifest_timestamps": manifest_timestamps_query,
    "resume_match": resume_match_query,
    "auth_abort_cut": auth_abort_cut_query,
    "first_failure_cut": first_failure_cut_query,
    "phrase_outcome": phrase_outcome_query,
    "batch_summary": batch_summary_query,
    "incomplete_report": incomplete_report_query,
    "phrase_list": phrase_list,
    "landing_scan": landing_scan,
    "path_containment": path_containment,
    "new_files": new_files_query,
    "download_verdict": download_verdict_query,
    "untrusted_empty": untrusted_empty_query,
    "quarantine": quarantine,
    "typed_parquet_roundtrip": typed_parquet_roundtrip,
    "manifest_roundtrip": manifest_roundtrip,
    "stream_ingest_equals_batch": stream_ingest_equals_batch,
    "stream_all_exports": stream_all_exports,
    "stream_manifest": stream_manifest,
    "late_tail": late_tail,
    "phrase_union": phrase_union,
    "stored_exports": stored_exports,
    "quarantine_store": quarantine_store,
    "raw_retention": raw_retention,
    "file_scan": file_scan,
    "manifest_errors": manifest_errors,
}
