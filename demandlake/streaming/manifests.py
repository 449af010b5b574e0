"""Stored state of a stream (T2, T3): one manifest document and the datasets of each run.

A micro-batch rewrites the documents of the runs it touches and no others: their
paths follow from the run, so neither the folder of all runs is listed nor the log
of earlier batches read.  On a mounted file system tasks open them, by the run.  What a batch brings takes precedence over what the
document holds, and a batch that runs again writes the same documents again.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlake.operators.manifest import dataset_file, reconcile, view_ord
from demandlake.operators.typing import typed_cells
from demandlake.session import dealt, fresh_dir
from demandlake.sources import sinks
from demandlake.sources.files import MANIFEST_SCHEMA, load_manifests, parse_documents, path_part
from demandlake.sources.sinks import manifest_documents
from demandlake.sources.small_files import folder_name, mounted, read_files, read_folders, small_files, write_parquet

#: Characters that have a meaning in a path that is read.
GLOB = re.compile(r"[{}\[\]*?\\]")


def run_folder(run_id: str) -> str:
    return GLOB.sub(lambda m: "\\" + m[0], folder_name("run_id", run_id))


def _write(documents: DataFrame, path: str) -> None:
    """One document a run; the folders of other runs stay as they are."""
    sinks.write_documents(documents, path, "partitions")


def write_documents(manifests: DataFrame, path: str) -> None:
    """The documents of ``manifests`` (fields of ``files.MANIFEST_SCHEMA`` and run_id), in place of their runs' earlier ones."""
    _write(manifest_documents(manifests), path)


def _stored_runs(spark: SparkSession, path: str) -> DataFrame:
    """Runs that have a document, from the listing alone."""
    return _listed(spark, path, "*.txt").select(path_part(F.col("path"), "run_id").alias("run_id")).distinct()


def _listed(spark: SparkSession, path: str, glob: str) -> DataFrame:
    if folder := mounted(spark, path):
        return read_files(spark, folder, glob, content=False).select("path")
    return small_files(spark).read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path")


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def write_first_manifests(runs: DataFrame, path: str) -> None:
    """An empty manifest for each run that has none, with updated_at = created_at."""
    spark = runs.sparkSession
    new = runs.join(_stored_runs(spark, path), "run_id", "left_anti") if _exists(spark, path) else runs
    fields = {f.name: f.dataType for f in MANIFEST_SCHEMA.fields}
    period = F.col("requested_period")
    first = new.select(
        "run_id", "phrase", "region", "created_at", F.col("created_at").alias("updated_at"), "source_url", F.array().cast(fields["exports"]).alias("exports"),
        "granularity", F.when(period.isNotNull(), F.create_map(F.lit("from"), period["from"], F.lit("to"), period["to"])).alias("requested_period"),
        F.lit(None).cast(fields["actual_period"]).alias("actual_period"))
    _write(manifest_documents(first), path)


def _entries(stored: DataFrame) -> DataFrame:
    """The newest trusted export of each run and view in one batch, as manifest entries."""
    order = F.struct("modificationTime", "path")
    entry = F.struct(
        view_ord(F.col("view")).alias("view_ord"), "view", dataset_file(F.col("view"), F.col("granularity")).alias("file"), F.lit(None).cast("string").alias("raw_file"), "row_count",
        F.map_from_entries("dtypes").alias("dtypes"), "modificationTime", "actual_period")
    sound = stored.filter(F.col("trusted") & view_ord(F.col("view")).isNotNull() & F.col("granularity").isNotNull())
    return sound.groupBy("run_id", "view").agg(F.max_by(entry, order).alias("e")).select("run_id", "e")


def upsert_manifests(runs: DataFrame, stored: DataFrame, path: str) -> None:
    """T2 after one micro-batch: the documents of the runs that it brought trusted exports of.

    ``stored`` are the batch's exports.  W4: a new entry replaces the view's old one;
    entries stay in view order.  W7: updated_at is the newest entry's time, if later.
    Just the documents of the touched runs (at most the files of a micro-batch) are
    read and replaced; for a store that isn't mounted they are named to the driver.
    """
    spark = stored.sparkSession
    per = _entries(stored).groupBy("run_id").agg(F.collect_list("e").alias("new")).join(runs.select("run_id"), "run_id", "left_semi")  # at most four views
    if folder := mounted(spark, path):
        before = parse_documents(read_folders(dealt(per.select("run_id"), "run_id"), folder, "*.txt"))
    else:
        touched = [r.run_id for r in per.select("run_id").collect()]
        if not touched:
            return
        before = load_manifests(spark, [f"{path}/{run_folder(r)}" for r in touched], "*.txt")
    both = before.filter("error_code IS NULL").join(per, "run_id")
    views = F.transform("new", lambda e: e["view"])
    fresh = F.transform("new", lambda e: F.struct(*[e[f].alias(f) for f in ("view", "file", "raw_file", "row_count", "dtypes")]))
    place = lambda e: view_ord(e["view"])
    merged = F.array_sort(F.concat(F.filter("exports", lambda e: ~F.array_contains(views, e["view"])), fresh), lambda a, b: place(a) - place(b))
    dynamics = F.get(F.filter("new", lambda e: e["view"] == "dynamics"), 0)["actual_period"]
    period = F.create_map(F.lit("field"), dynamics["field"], F.lit("from"), dynamics["from"], F.lit("to"), dynamics["to"])
    out = both.withColumns({
        "exports": merged, "updated_at": F.greatest("updated_at", F.array_max(F.transform("new", lambda e: e["modificationTime"]))),
        "actual_period": F.when(dynamics.isNotNull(), period).otherwise(F.col("actual_period"))})
    _write(manifest_documents(out.drop("new")), path)


def write_datasets(stored: DataFrame, path: str) -> None:
    """The typed cells of each run and view that a batch brought a trusted export of, in ``run_id=/file=`` (P10)."""
    newest = F.row_number().over(Window.partitionBy("run_id", "view").orderBy(F.desc("modificationTime"), F.desc("path")))
    sound = stored.filter(F.col("trusted") & F.col("granularity").isNotNull()).withColumn("_n", newest).filter("_n = 1")
    cells = typed_cells(sound.withColumn("file", dataset_file(F.col("view"), F.col("granularity"))), ["run_id", "file"])
    write_cells(cells, path)


def write_cells(cells: DataFrame, path: str) -> None:
    """A Parquet file for each run_id and file of ``cells``, in place of earlier ones."""
    cells = dealt(cells, "run_id", "file")
    if folder := mounted(cells.sparkSession, path):
        write_parquet(cells.sortWithinPartitions("run_id", "file"), folder, ["run_id", "file"], "partitions")
        return
    (cells.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy("run_id", "file").parquet(path))


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, file): the datasets that lie under ``path``, from the listing alone."""
    found = _listed(spark, path, "*.parquet")
    return found.select(path_part(F.col("path"), "run_id").alias("run_id"), path_part(F.col("path"), "file").alias("file")).distinct()


def resume_state(runs: DataFrame, manifests: str, datasets: str, log: DataFrame) -> DataFrame:
    """``operators.manifest.reconcile`` over the stored documents, the stored datasets and the stream's log."""
    spark = runs.sparkSession
    stored = load_manifests(spark, manifests, "*.txt").filter("error_code IS NULL")
    entries = stored.select("run_id", F.explode("exports").alias("e")).select("run_id", "e.view", "e.file")
    seen = log.filter(F.col("trusted") & F.col("granularity").isNotNull()).select("run_id", "view", dataset_file(F.col("view"), F.col("granularity")).alias("file"))
    return reconcile(runs, entries, stored_files(spark, datasets), seen)


def prune_manifests(states: DataFrame, manifests: str, now) -> int:
    """Drops the entries that ``resume_state`` calls stale from their documents, and moves updated_at to ``now``.

    Returns the number of documents rewritten."""
    spark = states.sparkSession
    stale = states.filter("state = 'stale'").groupBy("run_id").agg(F.collect_set("view").alias("gone"))  # at most four
    # All stale runs at once: their documents are met by key, not by path.
    both = load_manifests(spark, manifests, "*.txt").filter("error_code IS NULL").join(stale, "run_id")
    out = both.withColumns({"exports": F.filter("exports", lambda e: ~F.array_contains("gone", e["view"])), "updated_at": F.lit(now).cast("timestamp")}).drop("gone")
    documents = manifest_documents(out)
    path = fresh_dir(spark, "pruned")
    documents.write.parquet(path)  # the folder that is read is the one that is rewritten
    documents = spark.read.schema(documents.schema).parquet(path)
    _write(documents, manifests)
    return documents.count()
