"""Every kind of export goes through the stream, by user too."""

from pathlib import Path

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")
def test_all_kinds_of_exports_are_streamed(spark):
    import __spark_entry__ as e
    from oracle_harness import compare, duck
    from pyspark.sql import functions as F

    name = "stream_all_exports"
    con, kept = duck(SF), []

    def run(spark, sf):
        kept.append(e.queries()[name](spark, sf).cache())
        return kept[0]

    assert compare(spark, con, name, run, e.oracle_sql()[name], SF)
    kinds = {(r["g"], r["u"]) for r in kept[0].select(F.substring_index("export_id", "|", 1).alias("g"), F.contains("export_id", F.lit("/")).alias("u")).distinct().collect()}
    assert kinds == {("daily", False), ("daily", True), ("weekly", False), ("monthly", False)}
