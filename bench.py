"""Headline bench: prints one JSON line with per-query seconds and operator rates.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
``queries``: each query is run once as warm-up, then timed as the median of 3
full materialisations (a write to noop); the inputs that it renders from the
given tables are part of its time.  ``rates``: operators alone, over inputs that
were rendered and written before, per second.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "parse_localized_number",   # cells parsed
    "infer_column_types",       # columns typed
    "typed_cells",
    "typed_daily_series",       # exports ingested (bytes -> typed series -> verdict)
    "series_containment",
    "parse_records",
    "decode_exports",
    "run_status",               # runs rolled up
    "batch_summary",
]


def seconds(make) -> float:
    runs = []
    for i in range(4):
        t0 = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        if i:
            runs.append(time.perf_counter() - t0)
    return statistics.median(runs)


def rates(spark, sf_dir: str) -> dict:
    """Rates over written inputs: cells parsed, columns typed, exports ingested, runs rolled up."""
    from pyspark.sql import functions as F

    from demandlake.functions.numbers import parse_number
    from demandlake.operators import manifest as M
    from demandlake.operators.parse import parse_exports
    from demandlake.operators.typing import column_profile, type_exports
    from demandlake.plans import derive
    from demandlake.plans.ingest import ingest_exports
    from demandlake.session import fresh_dir

    base = fresh_dir(spark, "bench")

    def written(df, name, parts=None):
        (df.repartition(parts) if parts else df).write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    table = lambda name: derive.table(spark, sf_dir, name)
    parts = spark.sparkContext.defaultParallelism
    lines = table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("o_totalprice"))
    amounts = written(derive.localized_amounts(lines.unionByName(table("orders").select("o_orderkey", "o_totalprice"))), "amounts", parts)
    tables = written(derive.part_exports(table("part")), "part", parts)
    series = written(derive.all_series_exports(table("events")), "series", parts)
    log = written(derive.export_log(derive.customer_runs(table("customer"))).drop("c_custkey", "view_ord"), "log", parts)

    def rolled_up():
        return M.run_status(M.manifest_entries(M.merge_exports(log).select("run_id", "view_ord", "view", "file", "row_count")))

    todo = {
        "cells_parsed": (amounts.count(), lambda: amounts.select(parse_number(F.col("text")).alias("p"))),
        "columns_typed": (6 * tables.count(), lambda: column_profile(type_exports(parse_exports(tables)), ["export_id"])),
        "exports_ingested": (series.count(), lambda: ingest_exports(series)),
        "runs_rolled_up": (log.select("run_id").distinct().count(), rolled_up),
    }
    return {f"{k}_per_s": round(n / seconds(make), 1) for k, (n, make) in todo.items()}


def main() -> None:
    from demandlake.plans.catalog import QUERIES
    from demandlake.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus) * 2)
    times = {name: round(seconds(lambda n=name: QUERIES[n](spark, sf_dir)), 3) for name in HEADLINE}
    sf = sf_dir.rstrip("/").split("sf")[-1]
    print(json.dumps({
        "metric": "median_query_seconds_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rates": rates(spark, sf_dir),
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
