"""The correctness gate in miniature: entry() and a sample of registered
queries against their DuckDB oracle SQL on the sf0.001 tables."""

from pathlib import Path

import pytest

SF = "/root/testdata/sf0.001"
SAMPLE = ["parse_localized_number", "infer_column_types", "parse_records", "series_containment",
          "validate_period", "run_status", "batch_summary", "path_containment", "stored_exports", "quarantine_store",
          "manifest_errors", "incomplete_report", "phrase_union", "file_scan", "raw_retention", "late_tail", "stream_manifest"]


@pytest.fixture(scope="module")
def duck():
    if not Path(SF).exists():
        pytest.skip("test tables not present")
    from oracle_harness import duck as make

    return make(SF)


def test_entry_schema(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["export_id", "row_ord", "period", "n", "share", "verdict"]
    assert df.count() > 0
    from demandlake.plans.catalog import QUERIES

    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as e
    from oracle_harness import compare

    assert compare(spark, duck, name, e.queries()[name], e.oracle_sql()[name], SF)
