"""Sources: S1 landing scan, S7 phrase lists, S10 manifest source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlake.constants import CSV_FORMAT, GRANULARITIES, INVALID_REQUEST, RESUME_MISMATCH, VIEWS
from demandlake.functions.hof import let
from demandlake.functions.text import decode_bytes, file_name, split_lines, strip
from demandlake.operators.landing import accepted, is_csv
from demandlake.sources.small_files import mounted, read_files, small_files

#: binaryFile reads a file whole into one row; above this Spark cannot hold it.
BINARY_FILE_LIMIT = 2**31 - 1

LANDING_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])
CSV_GLOB = "*.[cC][sS][vV]"


def path_part(path: Column, key: str) -> Column:
    """The value of a ``key=value`` folder in a path (null if there is none)."""
    found = F.regexp_extract(path, rf"/{key}=([^/]*)/", 1)
    return F.when(found != "", unescaped(found))


def unescaped(text: Column) -> Column:
    """%XX escapes resolved, once; a plus sign is itself."""
    return F.call_function("url_decode", F.replace(text, F.lit("+"), F.lit("%2B")))


def landing_scan(spark: SparkSession, root: str, limit: int = BINARY_FILE_LIMIT) -> DataFrame:
    """Every regular file under ``root`` whose name ends in .csv (any case).

    Columns: path, modificationTime, length, content, file_name, accepted,
    error_code, error_reason.  ``accepted`` = size > 0; Spark's file scan never
    yields zero-length files, so a file still being written (size 0) is simply
    not seen here.  A file above ``limit`` bytes is listed without its content
    and with the reason too_large, for the quarantine; the ``length`` filter is
    applied by the reader before it loads any content.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", CSV_GLOB)
        .load(root)
        .filter(is_csv(F.col("path")))
    )
    name = file_name(F.col("path")).alias("file_name")
    ok = accepted(F.col("path"), F.col("length")).alias("accepted")
    none = F.lit(None).cast("string")
    held = listing.filter(F.col("length") <= limit).select(
        "path", "modificationTime", "length", "content", name, ok, none.alias("error_code"), none.alias("error_reason"))
    large = listing.filter(F.col("length") > limit).select(
        "path", "modificationTime", "length", F.lit(None).cast("binary").alias("content"), name, ok,
        F.lit(CSV_FORMAT).alias("error_code"), F.lit("too_large").alias("error_reason"))
    return held.unionByName(large)


def phrase_lines(files: DataFrame, source_ord: int = 1) -> DataFrame:
    """Phrase-file bytes -> (source_ord, file_ord, phrase_ord, phrase, error_code).

    UTF-8 (BOM dropped) then cp1251; blank lines dropped, no trim, no dedup;
    ``phrase_ord`` numbers the lines that stay, inside the file's own array.  A
    file that cannot be decoded gives one row with an error and no phrase.
    ``files`` has ``file_ord`` and ``content``.
    """
    text, encoding = decode_bytes(F.col("content"))
    decoded = files.select("file_ord", text.alias("text"), encoding.alias("encoding"))
    kept = F.filter(split_lines(F.col("text")), lambda x: strip(x) != "")
    lines = decoded.select("file_ord", F.col("text").isNull().alias("bad"), F.posexplode_outer(kept).alias("phrase_ord", "phrase"))
    return lines.filter(F.col("bad") | F.col("phrase").isNotNull()).select(
        F.lit(source_ord).alias("source_ord"), "file_ord", "phrase_ord", "phrase",
        F.when(F.col("bad"), F.lit(INVALID_REQUEST)).alias("error_code"),
    )


def resolve_phrases(inline: DataFrame, file_phrases: DataFrame) -> DataFrame:
    """Inline phrases first, then file lines, order kept, no dedup
    (the same phrase twice gives two runs).  ``inline(batch_id, arg_ord, phrase)``,
    ``file_phrases(batch_id, file_ord, phrase_ord, phrase)``.  Returns batch_id,
    source_ord, o1, o2, phrase; the three order the batch."""
    a = inline.select("batch_id", F.lit(0).alias("source_ord"), F.col("arg_ord").cast("long").alias("o1"),
                      F.lit(0).cast("long").alias("o2"), "phrase")
    b = file_phrases.select("batch_id", F.lit(1).alias("source_ord"), F.col("file_ord").cast("long").alias("o1"),
                            F.col("phrase_ord").cast("long").alias("o2"), "phrase")
    return a.unionByName(b)


_TEXT = T.StringType()
_PERIOD = T.MapType(_TEXT, _TEXT)
MANIFEST_SCHEMA = T.StructType([
    T.StructField("phrase", _TEXT),
    T.StructField("region", _TEXT),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("source_url", _TEXT),
    T.StructField("exports", T.ArrayType(T.StructType([
        T.StructField("view", _TEXT),
        T.StructField("file", _TEXT),
        T.StructField("raw_file", _TEXT),
        T.StructField("row_count", T.LongType()),
        T.StructField("dtypes", T.MapType(_TEXT, _TEXT)),
    ]))),
    T.StructField("granularity", _TEXT),
    T.StructField("requested_period", _PERIOD),
    T.StructField("actual_period", _PERIOD),
    T.StructField("_corrupt", _TEXT),
])


def parse_manifests(documents: DataFrame, document: str = "document") -> DataFrame:
    """One manifest document a row (JSON text, indented or not) -> its fields.

    RESUME_MISMATCH in ``error_code``: not JSON, a required field missing (phrase,
    region, created_at, source_url, exports; of an export: view, file, row_count,
    dtypes), an unknown view or granularity, or a view listed twice (A8).  An
    absent ``updated_at`` or period stays null, an absent granularity is monthly.
    The other fields of a document with an error are null.
    """
    parsed = F.from_json(F.col(document), MANIFEST_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    views = lambda m: F.transform(F.coalesce(m["exports"], F.array()), lambda e: e["view"])
    known = F.array(*[F.lit(v) for v in VIEWS])

    def check(m):
        entries = F.coalesce(m["exports"], F.array())
        bad = (
            m.isNull() | m["_corrupt"].isNotNull()
            | m["phrase"].isNull() | m["region"].isNull() | m["created_at"].isNull() | m["source_url"].isNull() | m["exports"].isNull()
            | F.exists(entries, lambda e: e["view"].isNull() | ~F.array_contains(known, e["view"]) | e["file"].isNull()
                       | e["row_count"].isNull() | e["dtypes"].isNull())
            | (m["granularity"].isNotNull() & ~m["granularity"].isin(*GRANULARITIES))
            | (F.size(F.array_distinct(views(m))) < F.size(entries))
        )
        return F.struct(F.coalesce(bad, F.lit(True)).alias("bad"), m.alias("m"))

    staged = documents.withColumn("_c", let(parsed, check))
    fields = [f.name for f in MANIFEST_SCHEMA.fields if f.name != "_corrupt"]
    good = {f: F.col("_c.m")[f] for f in fields}
    good["granularity"] = F.coalesce(good["granularity"], F.lit(GRANULARITIES[0]))
    keep = [c for c in documents.columns if c not in (*fields, "error_code", document)]
    return staged.select(*keep, *[F.when(~F.col("_c.bad"), v).alias(k) for k, v in good.items()],
                         F.when(F.col("_c.bad"), F.lit(RESUME_MISMATCH)).alias("error_code"))


def load_manifests(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """Every file below ``path`` (or several paths) whose name fits ``glob`` is one manifest: path, run_id
    (of a run_id= folder) and the fields of ``parse_manifests``."""
    if isinstance(path, str) and not set(glob + path) & set("{}[]\\") and (folder := mounted(spark, path)):
        return parse_documents(read_files(spark, folder, glob))
    files = small_files(spark).read.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return parse_documents(files.select(unescaped(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("content")))


def parse_documents(files: DataFrame) -> DataFrame:
    """S10 over ``files`` (path, content): path, run_id (of a run_id= folder) and the fields of ``parse_manifests``."""
    documents = files.select("path", F.col("content").cast("string").alias("document"), path_part(F.col("path"), "run_id").alias("run_id"))
    return parse_manifests(documents)
