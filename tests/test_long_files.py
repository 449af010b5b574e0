"""The parse by byte ranges equals the parse of a whole file in one row."""

import random

from pyspark.sql import functions as F

from demandlake.operators.parse import parse_exports
from demandlake.operators.typing import column_profile, type_exports
from demandlake.sources import files as SRC
from demandlake.sources import long_files as LONG


def _random_text(rng):
    d = rng.choice(";,\t")
    eol = rng.choice(["\n", "\r\n", "\r", "\n", "\x0b", "\x85"])

    def cell():
        kind = rng.random()
        body = "".join(rng.choice("ab1 ,.;é") for _ in range(rng.randint(0, 6)))
        if kind < 0.25:
            return '"' + body + rng.choice(["", '""', eol, d, eol + eol, '""' + eol]) + '"'
        if kind < 0.29:
            return rng.choice(['"', '"' + body, body + '"', '"' + body + '"x"' + body, ' "' + body + '"'])
        return body.replace(d, "")

    head = d.join(f"h{i}" for i in range(rng.randint(1, 4)))
    lines = [d.join(cell() for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 40))]
    return eol.join([head, *lines]) + rng.choice(["", eol])


def _write(root, seed, n):
    rng = random.Random(seed)
    cases = {f"r{i}": _random_text(rng).encode(rng.choice(["utf-8", "utf-8-sig", "cp1251"]), "replace") for i in range(n)}
    cases |= {
        "bad98": b"a;b\n" + b"1;2\n" * 30 + b"\x98\xff;3\n", "cp": "Запрос;Число\n".encode("cp1251") + "чай;5 228\n".encode("cp1251") * 40,
        "open": b'a;b\n1;2\n"x' + b"y\n" * 60, "blank": b"\n\na;b\n1;2\n", "dup": b"a;a\n" + b"1;2\n" * 20, "head": b"a;b", "semi": b"a;b\n" + b";;\n" * 20 + b"1;2;3\n",
        "long": b'a;b\n"' + b'x""y;' * 4000 + b'";2\n3;4\n',
    }
    for name, content in cases.items():
        (root / f"{name}.csv").write_bytes(content)
    return cases


def test_ranges_equal_the_one_row_parse(spark, tmp_path):
    _write(tmp_path, 7, 14)
    whole = parse_exports(SRC.landing_scan(spark, str(tmp_path)).select("file_name", "content"))
    want = {r["file_name"]: r for r in whole.collect()}
    for split in (211, None):
        exports, rows = LONG.parse_long(spark, str(tmp_path), split)
        got = {r["file_name"]: r for r in exports.collect()}
        assert got.keys() == want.keys()
        cells = {}
        for r in rows.withColumn("n", F.element_at(F.split("path", "/"), -1)).orderBy("row_ord").collect():
            cells.setdefault(r["n"], []).append((r["row_ord"], r["cells"]))
        for name, w in want.items():
            g = got[name]
            assert g["encoding"] == (w["encoding"] and w["encoding"].removesuffix("-sig"))
            for f in ("headers", "row_count", "error_code", "error_reason", "error_message"):
                assert g[f] == w[f], (split, name, f)
            assert cells.get(name, []) == list(enumerate(w["rows"] or [])), (split, name)


def test_ranges_hold_no_file(spark, tmp_path):
    """A file of many ranges: no row holds more than a line, and the types come from added counts."""
    body = "".join(f'{i};"text {i}";{i},5\n' for i in range(20_000))
    (tmp_path / "one.csv").write_text("id;name;share\n" + body, encoding="utf-8")
    with LONG._split_at(spark, 64 << 10):
        lines = LONG.raw_lines(spark, str(tmp_path))
        assert lines.select("block").distinct().count() > 5 and lines.rdd.getNumPartitions() > 5
        assert lines.agg(F.max(F.length("raw"))).first()[0] < 40
    exports, rows = LONG.parse_long(spark, str(tmp_path), 64 << 10)
    assert exports.first()["row_count"] == 20_000
    assert rows.filter("row_ord = 19999").first()["cells"] == ["19999", "text 19999", "19999,5"]
    assert [r["dtype"] for r in LONG.long_profiles(rows).orderBy("col_ord").collect()] == ["int64", "string", "float64"]
    typed = type_exports(parse_exports(SRC.landing_scan(spark, str(tmp_path)).select("file_name", "content")))
    assert [r["dtype"] for r in column_profile(typed, ["file_name"]).orderBy("col_ord").collect()] == ["int64", "string", "float64"]


def test_records_of_one_key_keep_their_lines_together(spark, tmp_path):
    """Rows of orders may repeat, and need not come in key order: each record stays whole, in the order of the keys."""
    from pyspark.sql import functions as F

    from demandlake.plans import catalog

    keys = [9, 3, 3, 9, 1, 3]
    rows = spark.createDataFrame([(k,) for k in keys], "o_orderkey long").coalesce(1)
    rows.select("o_orderkey", F.lit("1-URGENT").alias("o_orderpriority"), F.lit(12.5).alias("o_totalprice"), F.lit("1996-01-02").cast("date").alias("o_orderdate")).write.parquet(str(tmp_path / "orders.parquet"))
    got = catalog.long_file_ranges(spark, str(tmp_path)).orderBy("row_ord").collect()
    assert [r["number"] for r in got] == [str(k) for k in sorted(keys)]
