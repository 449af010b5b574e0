"""Exports of any length, read as byte ranges (S1-S6, F1, P14, O2 in long form).

``landing_scan`` holds a file in one row; here a row is a line, and no task holds
more of a file than its byte range.  What a parser carries from line to line is
summed up for each range and composed over the ranges of a file:

* encoding: every line is valid UTF-8, or none has a byte that cp1251 leaves undefined;
* quotes: a line sets, keeps or swaps 'inside quotes' (``records.line_effect``), so
  does a range, and the state at its start is the effect of all ranges before it;
* records and rows: their number in a range, added up.

A record that spans lines is put together by its number, whatever ranges they lie
in; all others never leave their range.  The result is that of the one-row parse.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlake import messages
from demandlake.constants import CSV_FORMAT, SNIFF_SAMPLE_CHARS
from demandlake.functions.dialect import combine_dialect, consistency_guess, doublequote_seen, quote_guess, sample_of
from demandlake.functions.hof import let
from demandlake.functions.numbers import parse_number
from demandlake.functions.records import header_error, is_filled, line_effect, normalise_record, record_fields
from demandlake.functions.text import INNER_BREAK, file_name, from_cp1251, has_undefined_cp1251, strip
from demandlake.messages import sentence
from demandlake.operators.typing import KINDS, merge_profiles
from demandlake.session import fresh_dir
from demandlake.sources.files import CSV_GLOB, unescaped

FILE, RANGE = ["path"], ["path", "block"]
#: The sample's characters lie within so many bytes.
SAMPLE_BYTES = 4 * SNIFF_SAMPLE_CHARS + 16


@contextmanager
def _split_at(spark: SparkSession, split_bytes: int | None):
    """Files are read in ranges of ``split_bytes``; unset, as the session says."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        if split_bytes:
            spark.conf.set(names[0], split_bytes)
            spark.conf.set(names[1], min(split_bytes, 4 << 20))
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = fresh_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def raw_lines(spark: SparkSession, root: str) -> DataFrame:
    """(path, block, place, raw): the bytes of every line below ``root`` (ended by LF, CR or
    CRLF), the start of the byte range it begins in, and its order inside."""
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", CSV_GLOB).text(root)
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("place"), F.col("value").cast("binary").alias("raw"))


def _dialects(lines: DataFrame) -> DataFrame:
    """One row for each range: its file's encoding and dialect."""
    ranges = lines.groupBy(*RANGE).agg(
        F.bool_and(F.is_valid_utf8(F.col("raw").cast("string"))).alias("utf8"), F.bool_or(has_undefined_cp1251(F.col("raw"))).alias("undefined"), F.count(F.lit(1)).alias("n"))
    # The head of a file: lines that begin in its first bytes, each cut to what the sample can hold.
    head = lines.filter(F.col("block") < SAMPLE_BYTES).select(*RANGE, "place", F.substring("raw", 1, SAMPLE_BYTES).alias("raw"))
    before = F.sum(F.length("raw") + 1).over(Window.partitionBy("path").orderBy("block", "place").rowsBetween(Window.unboundedPreceding, -1))
    head = head.withColumn("before", before).filter(F.coalesce("before", F.lit(0)) < SAMPLE_BYTES)
    first = head.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("block", "place", "raw"))).alias("head"))  # some 16 KB
    files = ranges.groupBy("path").agg(F.bool_and("utf8").alias("utf8"), F.bool_or("undefined").alias("undefined"), F.sum("n").alias("n")).join(first, "path")
    encoding = F.when(F.col("utf8"), "utf-8").when(~F.col("undefined"), "cp1251")
    files = files.withColumn("encoding", encoding)
    shown = F.transform("head", lambda h: _decoded(h["raw"], F.col("encoding")))
    text = F.concat(F.array_join(shown, "\n"), F.lit("\n"))

    def elected(t):
        sample = sample_of(t)
        inner = F.split(F.regexp_replace(t, r"\n\z", ""), rf"\n|{INNER_BREAK}", -1)
        guesses = F.struct(quote_guess(sample).alias("q"), consistency_guess(sample).alias("c"))
        n = F.greatest(F.col("n"), F.size(inner).cast("long"))
        return let(guesses, lambda g: combine_dialect(n, F.get(inner, 0), g["q"], g["c"], doublequote_seen(sample, g["q"]), sample))

    files = files.select("path", "encoding", let(text, elected).alias("dialect"))
    return ranges.select(*RANGE).join(_stored(files, "long-dialects"), "path")


def _decoded(raw: Column, encoding: Column) -> Column:
    return F.when(encoding == "cp1251", from_cp1251(raw)).otherwise(raw.cast("string"))


def _after(effect_col: str, window, entered: int) -> Column:
    """State after each line of a range that is entered in state ``entered``: the last
    effect that sets it, and the swaps since then (column ``swaps`` counts them)."""
    sets = F.last(F.when(F.col(effect_col).isin("0", "1"), F.struct(F.col(effect_col).cast("int").alias("to"), F.col("swaps").alias("at"))), True).over(window)
    return F.pmod(F.coalesce(sets["to"], F.lit(entered)) + F.col("swaps") - F.coalesce(sets["at"], F.lit(0)), F.lit(2)).cast("int")


def _states(rows: DataFrame, effect_col: str, part: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``after0`` and ``after1``: the state after each, where ``part`` is entered in 0 or in 1."""
    upto = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = rows.withColumn("swaps", F.sum((F.col(effect_col) == "s").cast("long")).over(upto))
    return counted.withColumns({f"after{e}": _after(effect_col, upto, e) for e in (0, 1)}).drop("swaps")


def parse_long(spark: SparkSession, root: str, split_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """All exports below ``root`` as (exports, rows), parsed by byte ranges.

    exports: path, file_name, encoding, delimiter, headers, row_count, error_code,
    error_reason, error_message, as ``parse_exports`` gives them.  rows: path,
    row_ord, cells (trimmed, as many as headers), of exports without an error.
    Lines are read twice and written once; ``split_bytes`` sets the ranges' size.
    The line reader drops a byte-order mark, so ``encoding`` is 'utf-8' with and without.
    An empty file has no lines and doesn't appear.
    """
    with _split_at(spark, split_bytes):
        ranges = _stored(_dialects(raw_lines(spark, root)), "long-ranges")
        lines = raw_lines(spark, root).join(ranges, RANGE).filter(F.col("encoding").isNotNull())
        text = _decoded(F.col("raw"), F.col("encoding"))
        inner = lines.select(*RANGE, "place", "dialect", F.posexplode(F.split(text, INNER_BREAK, -1)).alias("sub", "line"))
        d = F.col("dialect")
        effect = line_effect(F.col("line"), d["delimiter"], d["quotechar"], d["doublequote"], d["skipinitialspace"])
        marked = _states(inner.select(*RANGE, "place", "sub", "line", effect.alias("effect")), "effect", RANGE, ["place", "sub"])
        earlier = Window.partitionBy(*RANGE).orderBy("place", "sub")
        marked = marked.withColumns({f"before{e}": F.coalesce(F.lag(f"after{e}").over(earlier), F.lit(e)) for e in (0, 1)})
        lines = _stored(marked.drop("effect"), "long-lines")

    # What a range does to the state, and the records that begin in it, for either entry.
    last = lambda c: F.max_by(c, F.struct("place", "sub"))
    sums = lines.groupBy(*RANGE).agg(*[last(f"after{e}").alias(f"exit{e}") for e in (0, 1)], *[F.sum(1 - F.col(f"before{e}")).alias(f"starts{e}") for e in (0, 1)])
    both = F.concat(F.col("exit0").cast("string"), F.col("exit1").cast("string"))
    sums = sums.withColumn("effect", F.when(both == "11", "1").when(both == "10", "s").when(both == "01", "k").otherwise("0"))
    before = Window.partitionBy("path").orderBy("block")
    sums = _states(sums, "effect", FILE, ["block"]).withColumn("entry", F.coalesce(F.lag("after0").over(before), F.lit(0)))
    sums = sums.withColumn("starts", F.when(F.col("entry") == 0, F.col("starts0")).otherwise(F.col("starts1")))
    sums = sums.select(*RANGE, "entry", F.coalesce(F.sum("starts").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("records"))
    sums = _stored(sums.join(ranges, RANGE), "long-entries")

    known = lines.join(sums, RANGE)
    state = lambda c: F.when(F.col("entry") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1"))
    known = known.withColumns({"inside": state("before"), "open": state("after")})
    upto = Window.partitionBy(*RANGE).orderBy("place", "sub").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = known.withColumn("record", F.col("records") + F.sum(1 - F.col("inside")).over(upto))
    d = F.col("dialect")
    fields = lambda c: record_fields(c, d["delimiter"], d["quotechar"], d["doublequote"], d["skipinitialspace"])
    plain = known.filter("inside = 0 AND open = 0").select("path", "block", "record", "dialect", F.col("line").alias("text"))
    at = F.struct("block", "place", "sub")
    spread = known.filter("inside = 1 OR open = 1").groupBy("path", "record").agg(
        F.min("block").alias("block"), F.first("dialect").alias("dialect"), F.array_sort(F.collect_list(F.struct(at.alias("at"), "line"))).alias("lines"))
    whole = spread.select("path", "block", "record", "dialect", F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("text"))
    records = _stored(plain.unionByName(whole).select("path", "block", "record", fields(F.col("text")).alias("fields")), "long-records")

    header = records.filter("record = 1").select("path", F.col("fields").alias("raw_header"))
    files = ranges.select("path", "encoding", d["delimiter"].alias("delimiter")).distinct().join(header, "path", "left")
    names = F.transform("raw_header", lambda h: strip(F.coalesce(h, F.lit(""))))
    reason = F.when(F.col("encoding").isNull(), F.lit("undecodable")).otherwise(header_error(F.col("raw_header"), F.col("names")))
    files = _stored(files.withColumn("names", names).withColumn("error_reason", reason), "long-headers")
    widths = sums.select(*RANGE).join(files.filter("error_reason IS NULL").select("path", F.size("names").alias("width")), "path")
    cells = records.filter("record > 1").join(widths, RANGE).filter(F.size("fields") > 0)
    cells = cells.select(*RANGE, "record", normalise_record(F.col("fields"), F.col("width")).alias("cells")).filter(is_filled(F.col("cells")))
    # Rows are numbered in their ranges, after those of the ranges before.
    counts = cells.groupBy(*RANGE).agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.withColumn("rows", F.coalesce(F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    rank = F.row_number().over(Window.partitionBy(*RANGE).orderBy("record"))
    rows = _stored(cells.join(offsets, RANGE).select("path", (F.col("rows") + rank - 1).alias("row_ord"), "cells"), "long-rows")

    n_rows = rows.groupBy("path").agg(F.count(F.lit(1)).alias("row_count"))
    failed = F.col("error_reason").isNotNull()
    name = file_name(unescaped(F.col("path")))
    exports = files.join(n_rows, "path", "left").select(
        "path", name.alias("file_name"), "encoding", "delimiter", F.when(~failed, F.col("names")).alias("headers"),
        F.when(~failed, F.coalesce("row_count", F.lit(0))).alias("row_count"), F.when(failed, F.lit(CSV_FORMAT)).alias("error_code"), "error_reason",
        F.when(failed, F.concat_ws(" ", name, sentence(F.col("error_reason"), messages.EXPORT))).alias("error_message"))
    return exports, rows


def long_profiles(rows: DataFrame) -> DataFrame:
    """A1 over ``rows`` of ``parse_long``: the type of each column (path, col_ord), from counts that are added up before the shuffle."""
    kinds = rows.select("path", F.posexplode("cells").alias("col_ord", "text")).select("path", "col_ord", parse_number(F.col("text"))["kind"].alias("kind"))
    names = dict(zip(KINDS, ("n_text", "n_frac", "n_int", "n_wide", "n_overflow", "n_empty")))
    counts = kinds.groupBy("path", "col_ord").agg(*[F.count_if(F.col("kind") == k).alias(n) for k, n in names.items()])
    return merge_profiles(counts, ["path", "col_ord"])
