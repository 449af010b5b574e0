"""Export parsing: bytes -> text -> dialect -> header -> rows.

One export is one row, and the whole chain is a single narrow projection of
built-in expressions: no shuffle, no Python.  Exports are report-sized, so
the per-row arrays stay small; a landing table of millions of exports
parallelises across files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake import messages
from demandlake.constants import CSV_FORMAT
from demandlake.functions.dialect import (
    combine_dialect,
    consistency_guess,
    doublequote_seen,
    quote_guess,
    sample_of,
)
from demandlake.functions.records import header_error, normalise_rows, parse_fields
from demandlake.functions.hof import cached_expr, let
from demandlake.messages import sentence
from demandlake.functions.text import decode_bytes, split_lines, strip


def decode_exports(df: DataFrame, content: str = "content") -> DataFrame:
    """Add ``text`` (LF-folded) and ``encoding``; undecodable -> CSV_FORMAT."""
    text, encoding = decode_bytes(F.col(content))
    return df.withColumn("text", text).withColumn("encoding", encoding)


def parse_struct(content: Column, name: Column) -> Column:
    """The whole S2-S6/F1 chain for one export as a single expression.

    Every stage is bound once (``let``), so the expression grows linearly with
    the number of stages; a filter pushed down onto it stays small.
    Returns STRUCT<encoding, delimiter, quotechar, dialect_method, headers,
    rows, row_count, error_code, error_reason, error_message>.
    """
    text_c, encoding_c = decode_bytes(content)

    def with_decoded(dec):
        text = dec["text"]

        def with_lines(ls):
            lines = ls["lines"]

            def with_dialect(dia):
                def with_records(recs):
                    raw_header = F.try_element_at(recs, F.lit(1))

                    def with_headers(hs):
                        reason = F.when(text.isNull(), F.lit("undecodable")).otherwise(
                            header_error(raw_header, hs)
                        )

                        def finish(rsn):
                            ok = rsn.isNull()
                            rows = F.when(ok, normalise_rows(recs, F.size(hs)))
                            message = F.concat_ws(" ", F.when(~ok, name), sentence(rsn, messages.EXPORT))

                            def out(rw):
                                return F.struct(
                                    dec["encoding"].alias("encoding"),
                                    dia["delimiter"].alias("delimiter"),
                                    dia["quotechar"].alias("quotechar"),
                                    dia["method"].alias("dialect_method"),
                                    F.when(ok, hs).alias("headers"),
                                    rw.alias("rows"),
                                    F.when(ok, F.size(rw).cast("bigint")).alias("row_count"),
                                    F.when(~ok, F.lit(CSV_FORMAT)).alias("error_code"),
                                    rsn.alias("error_reason"),
                                    F.when(~ok, message).alias("error_message"),
                                )

                            return let(rows, out)

                        return let(reason, finish)

                    return let(F.transform(raw_header, lambda h: strip(F.coalesce(h, F.lit("")))), with_headers)

                return let(parse_fields(lines, dia["delimiter"], dia["quotechar"], dia["doublequote"],
                                        dia["skipinitialspace"]), with_records)

            def dialect(g):
                return F.when(
                    text.isNotNull(),
                    combine_dialect(F.size(lines), F.coalesce(F.try_element_at(lines, F.lit(1)), F.lit("")),
                                    g["q"], g["c"], doublequote_seen(ls["sample"], g["q"]), ls["sample"]),
                )

            guesses = F.struct(quote_guess(ls["sample"]).alias("q"), consistency_guess(ls["sample"]).alias("c"))
            return let(let(guesses, dialect), with_dialect)

        return let(F.struct(split_lines(text).alias("lines"), sample_of(text).alias("sample")), with_lines)

    return let(F.struct(text_c.alias("text"), encoding_c.alias("encoding")), with_decoded)


PARSE_FIELDS = ("encoding", "delimiter", "quotechar", "dialect_method", "headers", "rows", "row_count",
                "error_code", "error_reason", "error_message")


def parse_exports(df: DataFrame, content: str = "content", name: str = "file_name") -> DataFrame:
    """Parse every export of ``df`` into headers and rows.

    Adds: encoding, delimiter, quotechar, dialect_method, headers ARRAY<STRING>,
    rows ARRAY<ARRAY<STRING>>, row_count, error_code, error_reason, error_message.
    Rows are in file order; cells are trimmed, blank rows dropped.
    """
    name_c = F.col(name) if name in df.columns else F.lit("export.csv")
    keep = [c for c in df.columns if c not in PARSE_FIELDS]
    key = ("parse", content, name if name in df.columns else None)
    staged = df.withColumn("_p", cached_expr(key, lambda: parse_struct(F.col(content), name_c)))
    return staged.select(*keep, *[F.col("_p")[f].alias(f) for f in PARSE_FIELDS])


def export_cells(parsed: DataFrame, keys: list[str]) -> DataFrame:
    """Long form ``cells(keys..., row_ord, col_ord, header, text)``."""
    rows = parsed.select(*keys, "headers", F.posexplode_outer("rows").alias("row_ord", "cells")).filter(
        F.col("row_ord").isNotNull()
    )
    return rows.select(
        *keys,
        "row_ord",
        F.posexplode_outer("cells").alias("col_ord", "text"),
        "headers",
    ).filter(F.col("col_ord").isNotNull()).select(
        *keys, "row_ord", "col_ord", F.try_element_at("headers", F.col("col_ord") + 1).alias("header"), "text"
    )
