"""Written intermediate tables in the shared folder that the cluster names.

Operators that read one thin table several times write it once here instead of
recomputing it; the files survive the loss of any executor.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.  Only a local-mode session
    (tests) that leaves it unset gets a folder of its own; anywhere else the
    missing setting is an error, as executors would not see a local folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local[") and master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def importable(spark: SparkSession) -> SparkSession:
    """``spark``, whose Python workers find this package where the driver found it.

    A cluster on which the package is installed or shipped needs no such path;
    a local session started elsewhere does.
    """
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a fresh shared folder and read back."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
