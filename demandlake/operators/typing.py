"""Column typing (A1, A2, A3), typed values (P3, J7) and profile merging.

Per export the rule runs inside the export's row (no shuffle).  Across
exports, ``merge_profiles`` sums the additive kind counts per group, so
partial aggregation applies and a hot group never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake import messages
from demandlake.constants import OVERFLOW
from demandlake.functions.hof import cached_expr, let
from demandlake.functions.numbers import (
    EMPTY,
    FRAC,
    INT,
    INT_OVERFLOW,
    INT_WIDE,
    TEXT,
    dtype_from_counts,
    overflows,
    parse_number,
)

KINDS = (TEXT, FRAC, INT, INT_WIDE, INT_OVERFLOW, EMPTY)


def _count_kind(kinds, kind: str):
    return F.size(F.filter(kinds, lambda k: k == F.lit(kind)))


def type_struct(rows: Column, headers: Column) -> Column:
    """A1 inside one export: STRUCT<parsed_rows, columns, bad>.

    ``columns`` is ARRAY<STRUCT<col_ord, header, dtype, n_text, n_frac, n_int,
    n_wide, n_overflow, overflow>> in header order; ``bad`` is true when a
    typed column cannot be written (int64 overflow or inexact float64)."""

    def with_parsed(pr_all):
        def column(j):
            kinds = F.transform(pr_all, lambda pr: F.get(pr, j)["kind"])

            def with_counts(n):
                dtype = dtype_from_counts(n["text"], n["frac"], n["int"], n["int_wide"], n["int_overflow"])

                def build(dt):
                    return F.struct(
                        j.alias("col_ord"),
                        F.get(headers, j).alias("header"),
                        dt.alias("dtype"),
                        n["text"].alias("n_text"),
                        n["frac"].alias("n_frac"),
                        n["int"].alias("n_int"),
                        n["int_wide"].alias("n_wide"),
                        n["int_overflow"].alias("n_overflow"),
                        overflows(dt, n["int_wide"], n["int_overflow"]).alias("overflow"),
                    )

                return let(dtype, build)

            return let(kinds, lambda ks: let(F.struct(*[_count_kind(ks, k).alias(k) for k in KINDS]), with_counts))

        cols = F.when(F.size(headers) > 0, F.transform(F.sequence(F.lit(0), F.size(headers) - 1), column))

        def finish(cs):
            bad = F.coalesce(F.exists(cs, lambda c: c["overflow"]), F.lit(False))
            return F.struct(pr_all.alias("parsed_rows"), cs.alias("columns"), bad.alias("bad"))

        return let(cols, finish)

    return let(F.transform(rows, lambda r: F.transform(r, lambda c: parse_number(c))), with_parsed)


def typed_fields(p: Column, t: Column, file_name: Column) -> dict[str, Column]:
    """Typing outputs plus the error fields raised to OVERFLOW when needed."""
    bad = t["bad"] & p["error_code"].isNull()
    return {
        "parsed_rows": t["parsed_rows"],
        "columns": t["columns"],
        "error_code": F.when(bad, F.lit(OVERFLOW)).otherwise(p["error_code"]),
        "error_reason": F.when(bad, F.lit("overflow")).otherwise(p["error_reason"]),
        "error_message": F.when(bad, F.concat(file_name, F.lit(" " + messages.EXPORT["overflow"]))).otherwise(
            p["error_message"]),
    }


def type_exports(parsed: DataFrame) -> DataFrame:
    """Add ``parsed_rows`` and ``columns`` (see ``type_struct``) to parsed exports
    and raise an export whose typed column cannot be written to ``OVERFLOW``."""
    name = F.col("file_name") if "file_name" in parsed.columns else F.lit("export.csv")
    staged = parsed.withColumn("_t", cached_expr(("type",), lambda: type_struct(F.col("rows"), F.col("headers"))))
    p = F.struct(F.col("error_code").alias("error_code"), F.col("error_reason").alias("error_reason"),
                 F.col("error_message").alias("error_message"))
    fields = typed_fields(p, F.col("_t"), name)
    keep = [c for c in parsed.columns if c not in fields]
    return staged.select(*keep, *[v.alias(k) for k, v in fields.items()])


def column_profile(typed: DataFrame, keys: list[str]) -> DataFrame:
    """One row per (export, column): the A1 verdict with its counts."""
    return typed.select(*keys, F.inline_outer("columns")).filter(F.col("col_ord").isNotNull())


def typed_cells(typed: DataFrame, keys: list[str]) -> DataFrame:
    """J7 + P3 in long form: each cell with its column's dtype and typed value.

    Only trusted exports have cells (``trusted``; where the series weren't
    checked, those without an error): a value that its column cannot hold is
    never turned into null.

    The dtype is looked up by position inside the export's row, so the
    'join' of cells to their profile costs no shuffle."""
    sound = F.col("trusted") if "trusted" in typed.columns else F.col("error_code").isNull()
    # Inside the generator: as a filter the condition would be pushed down, and the parse be done twice.
    rows = typed.select(
        *keys, "columns", "parsed_rows", F.posexplode_outer(F.when(sound, F.col("rows"))).alias("row_ord", "cells")
    ).filter(F.col("row_ord").isNotNull())
    cells = rows.select(
        *keys,
        "row_ord",
        "columns",
        F.get(F.col("parsed_rows"), F.col("row_ord")).alias("parsed"),
        F.posexplode_outer("cells").alias("col_ord", "text"),
    )
    cells = cells.filter(F.col("col_ord").isNotNull())
    col = F.get(F.col("columns"), F.col("col_ord"))
    dtype = col["dtype"]
    p = F.get(F.col("parsed"), F.col("col_ord"))
    return cells.select(
        *keys,
        "row_ord",
        "col_ord",
        col["header"].alias("header"),
        "text",
        dtype.alias("dtype"),
        F.when(dtype == "int64", p["as_long"]).alias("as_long"),
        F.when(dtype == "float64", F.coalesce(p["as_double"], p["as_long"].cast("double"))).alias("as_double"),
    )


def merge_profiles(profiles: DataFrame, group: list[str]) -> DataFrame:
    """A1 across many exports: additive counts summed per group, then the rule.

    ``profiles`` has n_text, n_frac, n_int, n_wide, n_overflow per export and
    column; the sums are partial-aggregated before the shuffle."""
    agg = profiles.groupBy(*group).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("n_text", "n_frac", "n_int", "n_wide", "n_overflow")],
        F.count(F.lit(1)).alias("n_exports"),
    )
    dtype = dtype_from_counts(F.col("n_text"), F.col("n_frac"), F.col("n_int"), F.col("n_wide"), F.col("n_overflow"))
    return agg.withColumn("dtype", dtype).withColumn(
        "overflow", overflows(F.col("dtype"), F.col("n_wide"), F.col("n_overflow"))
    )
