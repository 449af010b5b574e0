"""Localized numbers (P2), column typing rule (A1) and coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandlake.constants import FLOAT64_EXACT_INT
from demandlake.functions.hof import let
from demandlake.functions.text import remove_whitespace

# Only a comma is a decimal separator; no exponent, no '+', no '.', no '_'.
NUMBER_PATTERN = r"^-?[0-9]+(,[0-9]+)?$"

# kinds of one cell
EMPTY, TEXT, FRAC, INT, INT_WIDE, INT_OVERFLOW = "empty", "text", "frac", "int", "int_wide", "int_overflow"


def parse_number(text: Column) -> Column:
    """One cell -> STRUCT<kind STRING, as_long BIGINT, as_double DOUBLE>.

    kind: 'empty' (null value), 'text' (not a number), 'frac', 'int',
    'int_wide' (int64 but not exact in float64), 'int_overflow' (beyond int64).
    """
    def with_compact(compact):
        numeric = compact.rlike(NUMBER_PATTERN)
        has_comma = F.instr(compact, ",") > 0
        as_long = F.when(numeric & ~has_comma, compact.try_cast("bigint"))
        as_double = F.when(numeric & has_comma, F.replace(compact, F.lit(","), F.lit(".")).try_cast("double"))

        def with_long(lv):
            kind = (
                F.when(F.coalesce(compact, F.lit("")) == "", F.lit(EMPTY))
                .when(~numeric, F.lit(TEXT))
                .when(has_comma, F.lit(FRAC))
                .when(lv.isNull(), F.lit(INT_OVERFLOW))
                .when((lv > F.lit(FLOAT64_EXACT_INT)) | (lv < F.lit(-FLOAT64_EXACT_INT)), F.lit(INT_WIDE))
                .otherwise(F.lit(INT))
            )
            return F.struct(kind.alias("kind"), lv.alias("as_long"), as_double.alias("as_double"))

        return let(as_long, with_long)

    return let(remove_whitespace(text), with_compact)


def dtype_from_counts(n_text: Column, n_frac: Column, n_int: Column, n_wide: Column, n_overflow: Column) -> Column:
    """Column type from additive kind counts (so profiles of many files merge).

    Any non-number -> string; no number at all -> string; any fractional ->
    float64; else int64.
    """
    n_numbers = n_frac + n_int + n_wide + n_overflow
    return (
        F.when(n_text > 0, F.lit("string"))
        .when(n_numbers == 0, F.lit("string"))
        .when(n_frac > 0, F.lit("float64"))
        .otherwise(F.lit("int64"))
    )


def overflows(dtype: Column, n_wide: Column, n_overflow: Column) -> Column:
    """True when the typed column cannot be written (int64 overflow, or an
    integer not exact in float64)."""
    return ((dtype == "int64") & (n_overflow > 0)) | ((dtype == "float64") & ((n_wide + n_overflow) > 0))
