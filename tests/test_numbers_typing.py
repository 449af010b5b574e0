"""Localized numbers and column typing (cases from the reference's dtype tests)."""

import pytest
from pyspark.sql import functions as F

from conftest import exports_df
from demandlake.functions.numbers import parse_number
from demandlake.operators.parse import parse_exports
from demandlake.operators.typing import column_profile, type_exports, typed_cells

NUMBERS = [
    ("5\u00a0228\u00a0679", "int", 5228679, None), ("5\u202f228\u202f679", "int", 5228679, None),
    ("5\u2009228\u2009679", "int", 5228679, None), ("5\u2007228\u2007679", "int", 5228679, None),
    ("7 000", "int", 7000, None), ("2026", "int", 2026, None), ("-5", "int", -5, None),
    ("12,5", "frac", None, 12.5), ("", "empty", None, None), ("   ", "empty", None, None),
    ("август 2024", "text", None, None), ("22.06.2026", "text", None, None), ("1e5", "text", None, None),
    ("1_000", "text", None, None), ("inf", "text", None, None), ("nan", "text", None, None),
    ("3.1", "text", None, None), ("12,5%", "text", None, None), ("2026-01", "text", None, None),
    ("н/д", "text", None, None), ("Москва", "text", None, None), ("+5", "text", None, None),
    ("99999999999999999999", "int_overflow", None, None), ("9007199254740993", "int_wide", 9007199254740993, None),
]


def test_parse_number(spark):
    df = spark.createDataFrame([(t,) for t, *_ in NUMBERS], "t string")
    got = [tuple(r) for r in df.select(parse_number(F.col("t")).alias("p")).select("p.*").collect()]
    assert got == [(k, lv, dv) for _, k, lv, dv in NUMBERS]


COLUMNS = [
    (["5 228 679", "1 020", ""], "int64"),
    (["12,5", "3", ""], "float64"),
    (["100", "200", "н/д"], "string"),
    (["12,5%", "3,1%", "1"], "string"),
    (["", "", ""], "string"),
]


@pytest.mark.parametrize("values,dtype", COLUMNS)
def test_column_inference(spark, values, dtype):
    text = "h;k\n" + "\n".join(f"{v};x" for v in values) + "\n"
    df = exports_df(spark, [("e", text.encode())])
    prof = column_profile(type_exports(parse_exports(df)), ["export_id"]).filter("col_ord = 0").first()
    assert prof["dtype"] == dtype


def test_zero_row_export_is_string(spark):
    df = exports_df(spark, [("e", "Запрос;Показов".encode())])
    prof = column_profile(type_exports(parse_exports(df)), ["export_id"]).collect()
    assert [p["dtype"] for p in prof] == ["string", "string"]


def test_typed_values_and_overflow(spark):
    df = exports_df(spark, [
        ("ok", "Запрос;Показов;Доля\nчай;5 228 679;12,5%\nкофе;;3,1%\n".encode()),
        ("big", "a;b\nx;99999999999999999999\n".encode()),
        ("wide", "a;b\nx;9007199254740993\ny;1,5\n".encode()),
    ])
    typed = type_exports(parse_exports(df))
    errs = {r["export_id"]: r["error_code"] for r in typed.select("export_id", "error_code").collect()}
    assert errs == {"ok": None, "big": "OVERFLOW", "wide": "OVERFLOW"}
    cells = typed_cells(typed.filter("export_id = 'ok'"), ["export_id"]).orderBy("row_ord", "col_ord").collect()
    assert [(c["dtype"], c["as_long"], c["text"]) for c in cells if c["col_ord"] == 1] == [
        ("int64", 5228679, "5 228 679"), ("int64", None, "")]
    assert {c["dtype"] for c in cells if c["col_ord"] == 2} == {"string"}


def test_the_smallest_integer_is_a_number(spark):
    from demandlake.functions.numbers import parse_number

    got = spark.createDataFrame([("-9223372036854775808",), ("9007199254740992",), ("-9007199254740993",)], "t string").select(parse_number(F.col("t")).alias("p")).collect()
    assert [(r["p"]["kind"], r["p"]["as_long"]) for r in got] == [("int_wide", -(2**63)), ("int", 2**53), ("int_wide", -(2**53) - 1)]
