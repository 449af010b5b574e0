"""Manifest operators over an append-only export log (S9/S10 helpers,
J1-J4, A5, A8, W4, W7, F7, O1, U2).

``export_log(run_id, view, seq, ts, file, raw_file, row_count, dtypes?,
source_url)`` records every successful write; the manifest is derived from
it, never stored on its own.  Per-run reductions partially aggregate; the
view dimension is four fixed rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.constants import RESUME_MISMATCH, VIEWS
from demandlake.functions.text import strip


def view_ord(view: Column) -> Column:
    """Position of a view in declaration order (null for unknown views)."""
    return (F.nullif(F.array_position(all_views(), view), F.lit(0)) - 1).cast("int")


def dataset_file(view: Column, granularity: Column) -> Column:
    """P10: dynamics.parquet (monthly) / dynamics_<g>.parquet; <view>.parquet otherwise."""
    return (
        F.when((view == "dynamics") & (granularity == "monthly"), F.lit("dynamics.parquet"))
        .when(view == "dynamics", F.concat(F.lit("dynamics_"), granularity, F.lit(".parquet")))
        .otherwise(F.concat(view, F.lit(".parquet")))
    )


def all_views() -> Column:
    return F.array(*[F.lit(v) for v in VIEWS])


def merge_exports(log: DataFrame) -> DataFrame:
    """Newest entry per (run, view) wins; one row per stored view."""
    entry_cols = [c for c in log.columns if c not in ("run_id", "view", "seq")]
    latest = log.groupBy("run_id", "view").agg(
        F.max_by(F.struct(*entry_cols, "seq"), "seq").alias("e"),
        F.count(F.lit(1)).alias("n_writes"),
    )
    return latest.select("run_id", "view", view_ord(F.col("view")).alias("view_ord"), "e.*", "n_writes")


def manifest_entries(merged: DataFrame) -> DataFrame:
    """Per run: ``exports`` ARRAY<STRUCT> in view declaration order (O1); unknown views last."""
    cols = ["view_ord", *[c for c in merged.columns if c not in ("run_id", "view_ord")]]
    place = lambda e: F.coalesce(e["view_ord"], F.lit(len(VIEWS)))
    return merged.groupBy("run_id").agg(
        F.array_sort(F.collect_list(F.struct(*cols)), lambda x, y: place(x) - place(y)).alias("exports")
    )


def run_status(manifests: DataFrame) -> DataFrame:
    """A5 + J3/U2: missing_views (enum order), empty_views (stored order), status."""
    present = F.transform("exports", lambda e: e["view"])
    missing = F.filter(all_views(), lambda v: ~F.array_contains(present, v))
    empty = F.transform(F.filter("exports", lambda e: e["row_count"] == 0), lambda e: e["view"])
    return (
        manifests.withColumn("missing_views", missing)
        .withColumn("empty_views", empty)
        .withColumn("status", F.when((F.size("missing_views") > 0) | (F.size("empty_views") > 0), F.lit("incomplete"))
                    .otherwise(F.lit("complete")))
    )


def missing_views(runs: DataFrame, merged: DataFrame) -> DataFrame:
    """(run, view) pairs with no entry, via the fixed four-view fan-out and an anti join."""
    expanded = runs.select("run_id", F.posexplode(all_views()).alias("view_ord", "view"))
    return expanded.join(merged.select("run_id", "view"), ["run_id", "view"], "left_anti")


def pending_views(runs: DataFrame, merged: DataFrame, files: DataFrame) -> DataFrame:
    """Views lacking an entry *whose file still exists* (resume work list)."""
    done = merged.join(files.select("run_id", "file"), ["run_id", "file"], "left_semi").select("run_id", "view")
    expanded = runs.select("run_id", F.posexplode(all_views()).alias("view_ord", "view"))
    return expanded.join(done, ["run_id", "view"], "left_anti")


def prune_stale(merged: DataFrame, files: DataFrame) -> DataFrame:
    """Entries with ``stale``: their file (run_id, file) is gone, so the view is pending again."""
    present = files.select("run_id", "file", F.lit(True).alias("_present")).distinct()
    return merged.join(present, ["run_id", "file"], "left").withColumn("stale", F.col("_present").isNull()).drop("_present")


def pruned_runs(runs: DataFrame, marked: DataFrame, now: Column) -> DataFrame:
    """``runs`` with n_before, n_after, and ``updated_at`` moved to ``now`` where an entry was dropped."""
    counts = marked.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_before"), F.count_if(~F.col("stale")).alias("n_after"))
    out = runs.join(counts, "run_id", "left").fillna(0, ["n_before", "n_after"])
    return out.withColumn("updated_at", F.when(F.col("n_after") < F.col("n_before"), now).otherwise(F.col("updated_at")))


def reconcile(runs: DataFrame, entries: DataFrame, files: DataFrame, log: DataFrame) -> DataFrame:
    """One row for each run and view from what three places say of it.

    ``entries(run_id, view, file)`` are those of the stored manifests, ``files(run_id,
    file)`` what lies on disk, ``log(run_id, view, file)`` the trusted exports that
    the stream has processed.  The disk decides over the manifest, the manifest over
    the stream's log:

    * ``done``: an entry whose file is there;
    * ``stale``: an entry whose file is gone (it is to be dropped, J2);
    * ``unrecorded``: no entry, but a file that the log knows (a crash between the two writes);
    * ``lost``: in the log only;
    * ``missing``: nowhere.

    ``pending`` (J1) is all but ``done``.  A file that belongs to no view's entry and
    to no log row changes nothing.
    """
    stored = entries.select("run_id", "view", F.col("file").alias("entry_file")).dropDuplicates(["run_id", "view"])
    seen = log.select("run_id", "view", F.col("file").alias("log_file")).dropDuplicates(["run_id", "view"])
    expanded = runs.select("run_id", F.posexplode(all_views()).alias("view_ord", "view"))
    told = expanded.join(stored.join(seen, ["run_id", "view"], "full"), ["run_id", "view"], "left").withColumn("file", F.coalesce("entry_file", "log_file"))
    there = files.select("run_id", "file", F.lit(True).alias("on_disk")).distinct()
    both = told.join(there, ["run_id", "file"], "left")
    disk = F.coalesce("on_disk", F.lit(False))
    state = (
        F.when(F.col("entry_file").isNotNull(), F.when(disk, "done").otherwise("stale"))
        .when(F.col("log_file").isNotNull(), F.when(disk, "unrecorded").otherwise("lost")).otherwise("missing")
    )
    return both.select("run_id", "view_ord", "view", "file", state.alias("state"), (state != "done").alias("pending"))


def duplicate_views(raw_entries: DataFrame) -> DataFrame:
    """Runs whose stored entry list names a view more than once (invalid manifest)."""
    return (
        raw_entries.groupBy("run_id", "view").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("run_id")
        .agg(F.bool_or(F.col("n") > 1).alias("duplicate"),
             F.array_sort(F.collect_list(F.when(F.col("n") > 1, F.col("view")))).alias("dup_views"))
    )


def manifest_timestamps(runs: DataFrame, writes: DataFrame) -> DataFrame:
    """W7 per run of ``runs(run_id, created_at, source_url)``: its creation is the
    first write of its manifest, so a run without a stored view has both times;
    updated_at and source_url are those of the last write."""
    last = writes.groupBy("run_id").agg(F.max_by(F.struct("ts", "source_url"), F.struct("ts", "seq", "source_url")).alias("w"))
    return runs.join(last, "run_id", "left").select(
        "run_id", "created_at", F.coalesce("w.ts", "created_at").alias("updated_at"),
        F.coalesce("w.source_url", runs["source_url"]).alias("source_url"))


def resume_match(requests: DataFrame, manifests: DataFrame) -> DataFrame:
    """J4 + F7: left join resume requests to stored manifests and check the match."""
    m = manifests.select(
        "run_id",
        F.col("phrase").alias("m_phrase"),
        F.col("region").alias("m_region"),
        F.col("granularity").alias("m_granularity"),
        F.col("requested_period").alias("m_period"),
    )
    j = requests.join(m, "run_id", "left")
    status = (
        F.when(F.col("m_phrase").isNull(), F.lit("missing_manifest"))
        .when((strip(F.col("m_phrase")) != strip(F.col("phrase"))) | (strip(F.col("m_region")) != strip(F.col("region"))),
              F.lit("phrase_region_mismatch"))
        .when((F.col("m_granularity") != F.col("granularity")) | ~F.col("m_period").eqNullSafe(F.col("requested_period")),
              F.lit("period_mismatch"))
        .otherwise(F.lit("ok"))
    )
    return j.withColumn("match", status).withColumn(
        "error_code",
        F.when(F.col("match").isin("missing_manifest", "phrase_region_mismatch"), F.lit(RESUME_MISMATCH))
        .when(F.col("match") == "period_mismatch", F.lit("INVALID_REQUEST")),
    )
