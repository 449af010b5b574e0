"""Sinks: S8 typed Parquet, S9 manifest JSON, S11 raw retention, S13 quarantine.

One gate for all of them: an export that is not ``trusted`` (see
``plans.ingest``) goes to the quarantine with its bytes and its reason, never
into a typed table.  Spark's commit protocol makes each write atomic per job;
every writer takes a target path and never reads a clock.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake import messages
from demandlake.messages import sentence
from demandlake.operators.manifest import run_status
from demandlake.session import dealt
from demandlake.sources.small_files import mounted, write_lines

#: A longer signature of column types is named by its hash.
SHAPE_CHARS = 120


def signature(columns_col: str = "columns") -> Column:
    return F.concat_ws("_", F.transform(F.col(columns_col), lambda c: c["dtype"]))


def write_wide(typed: DataFrame, path: str, keys: list[str]) -> None:
    """All trusted exports as one Parquet table, in one job, partitioned by ``shape``.

    ``<path>/rows`` has one row for each data row, its values as a list of typed cells
    (``as_long``, ``as_double``, ``text``: the one of its column's type is filled), so
    neither the schema nor the plan grows with the columns of the widest export.
    ``shape`` is the signature of the types (its hash where it is long); ``read_shape``
    turns the rows of one shape back into columns.  ``<path>/schemas`` keeps headers
    and types of every export, also of one without rows.
    """
    sound = typed.filter(F.col("trusted"))
    sig = signature()
    shape = F.when(sig == "", F.lit("none")).when(F.length(sig) <= SHAPE_CHARS, sig).otherwise(F.md5(sig))
    sound.select(*keys, shape.alias("shape"), "headers", "columns").write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/schemas")
    rows = sound.select(*keys, shape.alias("shape"), F.transform("columns", lambda c: c["dtype"]).alias("types"),
                        F.posexplode_outer(F.arrays_zip("rows", "parsed_rows")).alias("row_ord", "r")).filter(F.col("row_ord").isNotNull())

    def cell(z):
        of, p = z["types"], z["parsed_rows"]
        return F.struct(
            F.when(of == "int64", p["as_long"]).alias("as_long"),
            F.when(of == "float64", F.coalesce(p["as_double"], p["as_long"].cast("double"))).alias("as_double"),
            F.when(of == "string", F.coalesce(z["rows"], F.lit(""))).alias("text"))

    cells = F.transform(F.arrays_zip("types", F.col("r.rows"), F.col("r.parsed_rows")), cell)
    rows.select(*keys, "shape", "row_ord", cells.alias("cells")).write.mode("overwrite").option("compression", "zstd").partitionBy("shape").parquet(f"{path}/rows")


def read_shape(spark: SparkSession, path: str, types: list[str], keys: list[str], positions: list[int] | None = None) -> DataFrame:
    """The rows of all exports in ``<path>/rows`` whose columns have these types, as
    columns ``c0``, ``c1``, ... of these types (``positions``: only these).  Only this
    shape's files are read, and of the cells only the field that its type fills."""
    sig = "_".join(types) or "none"
    shape = sig if len(sig) <= SHAPE_CHARS else hashlib.md5(sig.encode()).hexdigest()
    of = {"int64": "as_long", "float64": "as_double", "string": "text"}
    cells = [F.get(F.col("cells")[of[types[i]]], F.lit(i)).alias(f"c{i}") for i in (range(len(types)) if positions is None else positions)]
    return spark.read.parquet(f"{path}/rows").filter(F.col("shape") == shape).select(*keys, "row_ord", *cells)


def write_quarantine(ingested: DataFrame, path: str, keys: list[str]) -> None:
    """Every export that isn't trusted, with its bytes, name, code, reason and message.

    ``ingested`` has ``content``; rows of ``landing_scan`` that were never read
    (too_large) may be given as they are, without bytes.
    """
    has = lambda c: F.col(c) if c in ingested.columns else F.lit(None).cast("string")
    bad = ingested.filter(~F.col("trusted")) if "trusted" in ingested.columns else ingested.filter(F.col("error_code").isNotNull())
    bad.select(
        *keys, "content",
        F.coalesce(has("error_code"), has("check_code")).alias("error_code"),
        F.coalesce(has("error_reason"), has("verdict")).alias("reason"),
        F.coalesce(has("error_message"), has("check_message"), sentence(has("error_reason"), messages.EXPORT)).alias("message"),
    ).write.mode("append").option("compression", "zstd").parquet(path)


def store_exports(ingested: DataFrame, path: str, keys: list[str]) -> None:
    """Ingested exports (with content) written once, then dealt out: ``<path>/typed``, ``<path>/quarantine``."""
    ingested.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/ingested")
    stored = ingested.sparkSession.read.schema(ingested.schema).parquet(f"{path}/ingested")
    write_quarantine(stored, f"{path}/quarantine", keys)
    write_wide(stored, f"{path}/typed", keys)


def manifest_documents(manifests: DataFrame) -> DataFrame:
    """(run_id, document): the manifest as indented JSON, with its derived fields.

    ``manifests`` has the fields of ``files.MANIFEST_SCHEMA`` (``dtypes`` a map
    in header order); nulls are written as null.
    """
    whole = run_status(manifests)
    order = ["phrase", "region", "created_at", "updated_at", "source_url", "exports", "granularity", "requested_period", "actual_period",
             "missing_views", "empty_views", "status"]
    return whole.select("run_id", F.to_json(F.struct(*order), {"pretty": "true", "ignoreNullFields": "false"}).alias("document"))


def write_manifests(manifests: DataFrame, path: str) -> None:
    """One document file for each run, in its ``run_id=`` folder (UTF-8, Cyrillic unescaped)."""
    write_documents(manifest_documents(manifests), path, "overwrite")


def write_documents(documents: DataFrame, path: str, mode: str) -> None:
    """``documents`` (run_id, document) as files; mode "overwrite" puts them in place of the whole folder, "partitions" of the folders of their runs."""
    documents = dealt(documents, "run_id")
    if folder := mounted(documents.sparkSession, path):
        write_lines(documents.sortWithinPartitions("run_id"), folder, ["run_id"], "txt", mode, "UTF-8", blank_lines=True)
        return
    writer = documents.write.mode("overwrite").option("partitionOverwriteMode", "static" if mode == "overwrite" else "dynamic")
    writer.partitionBy("run_id").text(path)


def raw_name(view: Column, keep_raw: Column) -> Column:
    """S11: '<view>.csv' when the raw export is kept, else null."""
    return F.when(keep_raw, F.concat(view, F.lit(".csv")))


def write_raw(exports: DataFrame, path: str, keys: list[str], keep_raw: str = "keep_raw") -> DataFrame:
    """Bytes of the exports to keep go to ``path``; ``exports`` with ``raw_file`` and without the bytes."""
    named = exports.withColumn("raw_file", raw_name(F.col("view"), F.col(keep_raw)))
    named.filter(F.col("raw_file").isNotNull()).select(*keys, "raw_file", "content").write.mode("overwrite").option("compression", "zstd").parquet(path)
    return named.drop("content")
