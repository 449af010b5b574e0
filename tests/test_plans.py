"""Plan hygiene: column pruning and pushdown reach the scans; the ingest
adds no shuffle."""

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_number_parse_reads_two_columns(spark):
    from demandlake.plans.catalog import QUERIES

    plan = _plan(QUERIES["parse_localized_number"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "Exchange" not in plan


def test_series_reads_only_needed_event_columns(spark):
    from demandlake.plans.catalog import QUERIES

    plan = _plan(QUERIES["typed_daily_series"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan
    assert "props" not in plan


def test_all_series_scan_events_once(spark):
    from demandlake.plans.catalog import QUERIES

    df = QUERIES["series_containment"](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1


def test_ingest_is_narrow(spark, tmp_path):
    from conftest import exports_df
    from demandlake.plans.ingest import ingest_exports

    df = exports_df(spark, [("a", b"x;y\n1;2\n")])
    df.write.parquet(str(tmp_path / "landing"))
    plan = _plan(ingest_exports(spark.read.parquet(str(tmp_path / "landing")), with_series=False))
    assert "Exchange" not in plan


def test_landing_length_filter_is_pushed(spark, tmp_path):
    from demandlake.sources.files import landing_scan

    (tmp_path / "a.csv").write_bytes(b"a;b\n1;2\n")
    plan = _plan(landing_scan(spark, str(tmp_path)))
    assert "length" in plan and "PushedFilters" in plan
