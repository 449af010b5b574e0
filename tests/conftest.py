import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from demandlake.session import build_session

    s = build_session("local[4]", 4, app="demandlake-tests")
    yield s
    s.stop()


def exports_df(spark, cases):
    """cases: list of (export_id, bytes) -> landing DataFrame."""
    return spark.createDataFrame(
        [(k, f"{k}.csv", bytearray(v)) for k, v in cases], "export_id string, file_name string, content binary"
    )
