"""Decode, dialect, header and record rules (cases from the reference's CSV tests)."""

import csv

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import exports_df
from demandlake.operators.parse import parse_exports

CASES = [
    ("cp1251", "Запрос;Число запросов\nчай;5 228 679\n".encode("cp1251"),
     ";", ["Запрос", "Число запросов"], [["чай", "5 228 679"]], None),
    ("tab", "Запрос\tЧисло запросов\nчай\t5228679\n".encode(), "\t", ["Запрос", "Число запросов"],
     [["чай", "5228679"]], None),
    ("header_only", "Запрос;Показы;Динамика, Россия, 2026".encode(), ";",
     ["Запрос", "Показы", "Динамика, Россия, 2026"], [], None),
    ("bom_cr", ("﻿" + "a;b;c, d\r").encode(), ";", ["a", "b", "c, d"], [], None),
    ("header_only_tab", "a\tb\tc, d".encode(), "\t", ["a", "b", "c, d"], [], None),
    ("two_rows", "Запрос;Число запросов\nчай;5\nкофе;3\n".encode(), ";", ["Запрос", "Число запросов"],
     [["чай", "5"], ["кофе", "3"]], None),
    ("duplicate", b"query,query\none,two\n", ",", None, None, "duplicate_header"),
    ("undecodable", b"\x98\xff", None, None, None, "undecodable"),
    ("blank_first", b"\na;b\n1;2\n", ";", None, None, "no_header"),
    ("empty", b"", ";", None, None, "no_header"),
    ("empty_name", b"a; ;c\n1;2;3\n", ";", None, None, "empty_header"),
    ("tab_in_header", b"a;b\tc\n1;2\n", None, None, None, "unparsed_delimiter"),
    ("short_long_blank", b"a;b;c\n1\n\n;;\n1;2;3;4\n", ";", ["a", "b", "c"], [["1", "", ""], ["1", "2", "3"]], None),
    ("quoted", b'a;b\n"x;y";"z""w"\n"multi\nline";2\n', ";", ["a", "b"], [["x;y", 'z"w'], ["multiline", "2"]], None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = exports_df(spark, [(c[0], c[1]) for c in CASES])
    return {r["export_id"]: r for r in parse_exports(df).collect()}


@pytest.mark.parametrize("case", CASES, ids=[c[0] for c in CASES])
def test_parse_cases(parsed, case):
    key, _, delim, headers, rows, reason = case
    r = parsed[key]
    if delim is not None:
        assert r["delimiter"] == delim
    assert r["error_reason"] == reason
    if reason is None:
        assert r["headers"] == headers
        assert [list(x) for x in r["rows"]] == rows
        assert r["row_count"] == len(rows)
    else:
        assert r["error_code"] == "CSV_FORMAT"
        assert r["rows"] is None


def test_cp1251_and_bom_decoding(parsed):
    assert parsed["cp1251"]["encoding"] == "cp1251"
    assert parsed["bom_cr"]["encoding"] == "utf-8-sig"
    assert parsed["tab"]["encoding"] == "utf-8"


def _stdlib_delimiter(text: str) -> str:
    """The election rule, expressed with the standard library's sniffer."""
    lines = text.splitlines()

    def header_rule(h):
        d = max((";", "\t"), key=h.count)
        return d if h.count(d) else ";"

    if len(lines) < 2:
        return header_rule(lines[0] if lines else "")
    try:
        return csv.Sniffer().sniff(text[:4096], delimiters=";,\t").delimiter
    except csv.Error:
        return header_rule(lines[0])


cell = st.text(alphabet="ab1,; \t", min_size=0, max_size=6)
line = st.lists(cell, min_size=1, max_size=5).map(lambda cs: ";".join(cs))


@settings(max_examples=25, deadline=None)
@given(st.lists(line, min_size=1, max_size=25))
def test_delimiter_matches_stdlib_sniffer(spark, lines):
    text = "\n".join(lines)
    df = exports_df(spark, [("x", text.encode())])
    got = parse_exports(df).select("delimiter").first()["delimiter"]
    assert got == _stdlib_delimiter(text)


def _stdlib_parse(text: str):
    """Full parse by the rule, expressed with the standard library's sniffer
    and DictReader: (delimiter, header error, (headers, rows))."""
    lines = text.splitlines()

    def header_rule(h):
        d = max((";", "\t"), key=h.count)
        return d if h.count(d) else ";"

    class Fallback(csv.excel):
        delimiter = header_rule(lines[0] if lines else "")

    dialect = Fallback
    if len(lines) >= 2:
        try:
            dialect = csv.Sniffer().sniff(text[:4096], delimiters=";,\t")
        except csv.Error:
            pass
    reader = csv.DictReader(lines, dialect=dialect)
    raw = list(reader.fieldnames or [])
    hs = [h.strip() if h else "" for h in raw]
    if not raw:
        return dialect.delimiter, "no_header", None
    if not all(hs):
        return dialect.delimiter, "empty_header", None
    if any(d in h for h in hs for d in ";\t"):
        return dialect.delimiter, "unparsed_delimiter", None
    if len(set(hs)) != len(hs):
        return dialect.delimiter, "duplicate_header", None
    rows = [[(row.get(k) or "").strip() for k in raw] for row in reader]
    return dialect.delimiter, None, (hs, [r for r in rows if any(v.strip() for v in r)])


def test_full_parse_matches_stdlib_on_quoted_texts(spark):
    """Random texts full of quotes, doubled quotes, spaces and three delimiters."""
    import random

    rnd = random.Random(11)
    alpha = ["a", "b", "1", ",", ";", "\t", " ", '"', "'", '""']
    texts = []
    for _ in range(300):
        lines = []
        for _ in range(rnd.randint(1, 8)):
            cells = ["".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 4))) for _ in range(rnd.randint(1, 4))]
            lines.append((rnd.choice([";", ",", "\t"]) if rnd.random() < 0.3 else ";").join(cells))
        texts.append("\n".join(lines))
    df = exports_df(spark, [(str(i), t.encode()) for i, t in enumerate(texts)])
    got = {int(r["export_id"]): r for r in parse_exports(df).collect()}
    for i, text in enumerate(texts):
        want = _stdlib_parse(text)
        r = got[i]
        mine = (r["delimiter"], r["error_reason"],
                (list(r["headers"]), [list(x) for x in r["rows"]]) if r["error_reason"] is None else None)
        assert mine == want, repr(text)


def test_cells_of_any_length(spark):
    """Cells of 10 million characters, quoted, open, full of doubled quotes or of blanks."""
    n = 10_000_000
    cases = {
        "quoted": b'a;b\n"' + b"x" * n + b'";2\n3;4\n', "doubled": b'a;b\n"' + b'""' * (n // 2) + b'";2\n3;4\n', "open": b'a;b\n1;2\n"' + b'x""' * (n // 3),
        "blanks": b"a;b\n" + b" " * n + b"x" + b" " * n + b";2\n3;4\n", "lines": b'a;b\n"' + b"x\n" * 300_000 + b'";2\n3;4\n',
    }
    got = {r["export_id"]: r["rows"] for r in parse_exports(exports_df(spark, list(cases.items()))).select("export_id", "rows").collect()}
    assert got["quoted"] == [["x" * n, "2"], ["3", "4"]]
    assert got["doubled"] == [['"' * (n // 2), "2"], ["3", "4"]]
    assert got["open"][1][0][:3] == 'x"x' and len(got["open"]) == 2
    assert got["blanks"] == [["x", "2"], ["3", "4"]]
    assert got["lines"] == [["x" * 300_000, "2"], ["3", "4"]]


def test_strip_is_linear_and_equals_str_strip(spark):
    cases = ["  a b\x1c\n", "", " \t ", "x" + " " * 2_000_000 + "y", " " * 2_000_000, "﻿a﻿", "\x85a\x0b", None]
    from pyspark.sql import functions as F

    from demandlake.functions.text import strip

    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    got = {r["i"]: r["s"] for r in df.select("i", strip(F.col("t")).alias("s")).collect()}
    assert got == {i: t if t is None else t.strip() for i, t in enumerate(cases)}
