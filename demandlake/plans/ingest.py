"""Batch ingest plan: landed export bytes -> parsed, typed, checked exports.

landing(export keys..., file_name, content[, granularity, date_from, date_to])
  -> parse (S2-S6, F1) -> type (A1-A3, P2) -> series checks (W1, W2, F8, F9)
  -> actual period (A4).

The whole chain is ONE projection: every stage is bound once with ``let`` and
the outputs are fields of a single struct.  One export is one row, so the
ingest needs no shuffle, and the plan is analysed once instead of per stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.functions.hof import cached_expr, let
from demandlake.operators.parse import PARSE_FIELDS, parse_struct
from demandlake.operators.series import SERIES_FIELDS, actual_period_struct, series_struct
from demandlake.operators.typing import typed_fields, type_struct


def ingest_exports(landing: DataFrame, with_series: bool = True, content: str = "content",
                   name: str = "file_name", keep_content: bool = False) -> DataFrame:
    """``landing`` with all parsing, typing and checking outputs, and ``trusted``.

    ``trusted``: no parse or typing error, no failed series check, and not an
    empty dynamics export.  Sinks store trusted exports only.  A ``view``
    column other than 'dynamics' makes an empty export an honest answer.
    """
    cols = landing.columns
    name_c = F.col(name) if name in cols else F.lit("export.csv")
    series = with_series and "granularity" in cols
    d_from = F.col("date_from") if "date_from" in cols else F.lit(None).cast("date")
    d_to = F.col("date_to") if "date_to" in cols else F.lit(None).cast("date")

    def with_parse(p):
        def with_type(t):
            fields = {f: p[f] for f in PARSE_FIELDS}
            fields.update(typed_fields(p, t, name_c))
            fields["dtypes"] = F.transform(
                t["columns"], lambda c: F.struct(c["header"].alias("header"), c["dtype"].alias("dtype")))
            if not series:
                fields["trusted"] = fields["error_code"].isNull()
                return F.struct(*[v.alias(k) for k, v in fields.items()])

            def with_series(s):
                for f in SERIES_FIELDS:
                    fields[f] = s[f]
                fields["actual_period"] = actual_period_struct(p["headers"], p["rows"])
                fields["trusted"] = fields["error_code"].isNull() & s["check_code"].isNull()
                return F.struct(*[v.alias(k) for k, v in fields.items()])

            trust_empty = F.col("view") != "dynamics" if "view" in cols else F.lit(False)
            return let(series_struct(p["rows"], F.col("granularity"), d_from, d_to, trust_empty), with_series)

        return let(type_struct(p["rows"], p["headers"]), with_type)

    key = ("ingest", content, name if name in cols else None, series, "date_from" in cols, "date_to" in cols, "view" in cols)
    expr = cached_expr(key, lambda: let(parse_struct(F.col(content), name_c), with_parse))
    staged = landing.withColumn("_i", expr)
    out_fields = [f.name for f in staged.schema["_i"].dataType.fields]
    keep = [c for c in cols if c not in out_fields and (keep_content or c != content)]
    return staged.select(*keep, *[F.col("_i")[f].alias(f) for f in out_fields])
