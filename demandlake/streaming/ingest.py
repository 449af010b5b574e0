"""Incremental ingest of landed files (T1-T4) with Structured Streaming.

Files land as ``<root>/run_id=<run>/view=<view>/<anything>.csv``.  A stream reads
lists of what has newly landed, which tasks make, or, where the landing folder isn't
mounted, a ``binaryFile`` source, whose driver holds the names of all files.  A file
of the same run and view that lands later supersedes the earlier one (by micro-batch,
then modification time, then path).
Each micro-batch is parsed once, by the batch plan, and written as one table of
exports under ``batch_id=<n>``: rows, types and verdict of each, and the bytes of
those that aren't trusted.  Re-running a batch overwrites that partition only, so
``foreachBatch`` is idempotent; the checkpoint makes every landed file count
exactly once, and ``availableNow`` drains what has landed and stops.  Typed cells,
export log, manifests and quarantine are views of that table.  No watermark drops
late files, and a short tail is never padded (T4).
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake import messages
from demandlake.constants import CSV_FORMAT
from demandlake.functions.text import file_name
from demandlake.operators.manifest import all_views, view_ord
from demandlake.operators.typing import typed_cells
from demandlake.plans.ingest import ingest_exports
from demandlake.session import dealt
from demandlake.sources.files import BINARY_FILE_LIMIT, CSV_GLOB, LANDING_SCHEMA, path_part
from demandlake.sources.small_files import mounted, note_arrivals, small_files, with_content
from demandlake.streaming.manifests import upsert_manifests, write_datasets, write_first_manifests

KEYS = ["run_id", "view"]
LOG = [*KEYS, "granularity", "file_name", "path", "modificationTime", "batch_id", "verdict", "row_count", "error_code", "check_code", "trusted", "dtypes", "actual_period"]


def admitted_files(spark: SparkSession, landing_dir: str, limit: int, max_files: int | None = None) -> DataFrame:
    """The stream of landed files: those of at most ``limit`` bytes with their content, larger
    ones without it (null).

    Two branches over one source (a folder is listed once for both), each with its own
    filter on the length; the reader applies it before it opens a file, so no content above the limit is ever
    loaded, and a file that can't be held in a row doesn't stop the stream.  A file
    that vanishes between listing and reading is passed over.
    """
    stream = (
        small_files(spark).readStream.format("binaryFile").schema(LANDING_SCHEMA).option("recursiveFileLookup", "true")
        .option("pathGlobFilter", CSV_GLOB).option("ignoreMissingFiles", "true")
    )
    if max_files:
        stream = stream.option("maxFilesPerTrigger", max_files)
    files = stream.load(landing_dir)
    held, large = files.filter(F.col("length") <= limit), files.filter(F.col("length") > limit)
    listed = [f.name for f in LANDING_SCHEMA.fields if f.name != "content"]
    return held.select(*listed, "content").unionByName(large.select(*listed, F.lit(None).cast("binary").alias("content")))


def _lists(spark: SparkSession, landing_dir: str, checkpoint_dir: str) -> str | None:
    """Where the lists of landed files lie: None if a folder isn't mounted, or if the checkpoint is that of a stream without lists."""
    own = mounted(spark, checkpoint_dir)
    if not (own and mounted(spark, landing_dir)):
        return None
    return f"{own}/arrivals" if os.path.isdir(f"{own}/arrivals") or not os.path.isdir(f"{own}/offsets") else None


def arrived_files(spark: SparkSession, landing_dir: str, lists: str, max_files: int | None = None) -> DataFrame:
    """The stream of landed files without their content, by lists of them: each file is listed once, however often the stream starts."""
    note_arrivals(spark, mounted(spark, landing_dir), CSV_GLOB, lists, max_files)
    stream = spark.readStream.schema("path string, modificationTime timestamp, length long")
    return (stream.option("maxFilesPerTrigger", 1) if max_files else stream).parquet(f"file://{lists}")


def _as_too_large(ingested: DataFrame) -> DataFrame:
    """Files without content get the reason they weren't read."""
    unread = F.col("unread")
    message = F.concat_ws(" ", "file_name", F.lit(messages.EXPORT["too_large"]))
    return ingested.withColumns({
        "error_code": F.when(unread, F.lit(CSV_FORMAT)).otherwise(F.col("error_code")),
        "error_reason": F.when(unread, F.lit("too_large")).otherwise(F.col("error_reason")),
        "error_message": F.when(unread, message).otherwise(F.col("error_message")),
    }).drop("unread")


def _batch_writer(runs: DataFrame, out_dir: str, manifests: str | None, datasets: str | None, read=None):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = read(batch) if read else batch
        keyed = batch.withColumns({k: path_part(F.col("path"), k) for k in KEYS}).withColumn("file_name", file_name(F.col("path")))
        keyed = keyed.withColumn("unread", F.col("content").isNull())
        # Requests are small beside the files' bytes; a file of no known run has no window and no granularity.
        landed = keyed.join(runs.select("run_id", "granularity", "date_from", "date_to"), "run_id", "left")
        ingested = _as_too_large(ingest_exports(landed, keep_content=True))
        kept = ingested.withColumn("content", F.when(~F.col("trusted"), F.col("content")))
        target = f"{out_dir}/batch_id={batch_id}"
        kept.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option("compression", "zstd").parquet(target)
        if manifests or datasets:
            stored = batch.sparkSession.read.schema(kept.withColumn("batch_id", F.lit(0).cast("long")).schema).parquet(target)
            if datasets:
                write_datasets(stored, datasets)
            if manifests:
                upsert_manifests(runs, stored, manifests)

    return write


def run_ingest(spark: SparkSession, landing_dir: str, runs: DataFrame, out_dir: str, checkpoint_dir: str, max_files: int | None = None,
               limit: int = BINARY_FILE_LIMIT, manifests: str | None = None, datasets: str | None = None) -> None:
    """Drain everything landed so far (trigger availableNow) and stop.

    ``runs`` (run_id, granularity, date_from, date_to) are the requests.
    ``max_files`` caps the files of one micro-batch; unset, one micro-batch takes
    all that has landed, and its size is set by Spark's partitions alone.  A file
    above ``limit`` bytes is logged with the reason too_large and never read.

    ``manifests``: a folder that holds one manifest document for each run (S9), first
    written before any file is read and rewritten, for the runs it touches, with
    every micro-batch (T2; ``runs`` then also has phrase, region, created_at,
    source_url and requested_period).  ``datasets``: a folder for the typed rows of
    each run and view, replaced by every trusted export of it.
    """
    if manifests:
        write_first_manifests(runs, manifests)
    if lists := _lists(spark, landing_dir, checkpoint_dir):
        files, read = arrived_files(spark, landing_dir, lists, max_files), lambda batch: with_content(dealt(batch, "path"), limit)
    else:
        files, read = admitted_files(spark, landing_dir, limit, max_files), None
    q = (
        files.writeStream.foreachBatch(_batch_writer(runs, out_dir, manifests, datasets, read))
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def stored_exports(spark: SparkSession, out_dir: str) -> DataFrame:
    """The exports of all micro-batches; none before the first, with the same columns."""
    found = spark.read.option("recursiveFileLookup", "true")
    try:
        return found.parquet(out_dir)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    return spark.createDataFrame([], _export_schema(spark))


def _export_schema(spark: SparkSession):
    """Columns of a table of exports, from the plan that makes them."""
    none = spark.createDataFrame([], LANDING_SCHEMA).withColumns({**{k: F.lit("") for k in KEYS}, "file_name": F.lit(""), "unread": F.lit(False), "granularity": F.lit(""),
                                                                 "date_from": F.lit(None).cast("date"), "date_to": F.lit(None).cast("date")})
    return _as_too_large(ingest_exports(none, keep_content=True)).withColumn("batch_id", F.lit(0).cast("long")).schema


def export_log(spark: SparkSession, out_dir: str) -> DataFrame:
    """Every export that was ever landed, with its verdict (columns ``LOG``)."""
    return stored_exports(spark, out_dir).select(*LOG)


def fetch_attempts(log: DataFrame) -> DataFrame:
    """the landed files of each run and view as attempts for ``operators.landing.attempt_outcomes``:
    a first empty dynamics export waits for a second fetch, a second one is a failure."""
    failed = F.coalesce("error_code", F.when(F.col("verdict") != "empty", F.col("check_code")))
    return log.select(*KEYS, F.struct("batch_id", "modificationTime", "path").alias("seq"), "row_count", failed.alias("error_code"))


def newest(log: DataFrame) -> DataFrame:
    """The newest landed file of each run and view, and ``n_writes``."""
    order = F.struct("batch_id", "modificationTime", "path")
    rest = [c for c in log.columns if c not in KEYS]
    return log.groupBy(*KEYS).agg(F.max_by(F.struct(*rest), order).alias("e"), F.count(F.lit(1)).alias("n_writes")).select(*KEYS, "e.*", "n_writes")


def newest_trusted(log: DataFrame) -> DataFrame:
    """The entries of a manifest: the newest trusted file of each run and view.

    A later file that fails its checks doesn't take back what is stored."""
    return newest(log.filter("trusted"))


def latest_cells(spark: SparkSession, out_dir: str) -> DataFrame:
    """Typed cells of the entries.  The entries come from the small log; the cells are scanned once."""
    stored = stored_exports(spark, out_dir)
    entries = newest_trusted(stored.select(*LOG)).select("path", "batch_id")
    return typed_cells(stored.join(entries, ["path", "batch_id"], "left_semi"), [*KEYS, "granularity", "verdict"])


def quarantined(spark: SparkSession, out_dir: str) -> DataFrame:
    """Landed files that aren't trusted, with their bytes and reason."""
    return stored_exports(spark, out_dir).filter(~F.col("trusted")).select(
        *KEYS, "path", "content", F.coalesce("error_code", "check_code").alias("error_code"), F.coalesce("error_reason", "verdict").alias("reason"))


def run_manifests(runs: DataFrame, log: DataFrame) -> DataFrame:
    """T2 per run: a manifest after any micro-batch, complete so far.

    Every run has one from its creation on (``runs`` with created_at), with no
    entries until something trusted lands (W7: updated_at is the newest entry's
    time, or the creation).  Entries are in view order.
    """
    entries = newest_trusted(log).select(
        "run_id", F.struct(view_ord(F.col("view")).alias("view_ord"), "view", F.col("file_name").alias("file"), "row_count", "dtypes", "actual_period").alias("e"),
        "modificationTime")
    per = entries.groupBy("run_id").agg(F.array_sort(F.collect_list("e")).alias("exports"), F.max("modificationTime").alias("written"))
    out = runs.join(per, "run_id", "left")
    empty = F.array().cast(per.schema["exports"].dataType)
    return out.withColumn("exports", F.coalesce("exports", empty)).withColumn("updated_at", F.greatest("created_at", "written")).drop("written")


def next_wave(runs: DataFrame, log: DataFrame) -> DataFrame:
    """(run_id, view) still to be collected: no trusted file has landed."""
    expanded = runs.select("run_id", F.posexplode(all_views()).alias("view_ord", "view"))
    return expanded.join(newest_trusted(log).select(*KEYS), KEYS, "left_anti")
