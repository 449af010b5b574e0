"""Session helpers: a tuned local session for tests/bench and a shared scratch root."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Session setting: partitions that CPU-heavy per-row work on texts is dealt over.
#: Unset (the default) leaves an input as the scan splits it; set it where a small
#: table is stored as a single row group, as the given tables are.
SPREAD = "demandlake.spread.partitions"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "demandlake") -> SparkSession:
    """Session for tests and the bench.  On a cluster, use the cluster's session."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Exports are small in bytes but CPU-heavy to parse: let AQE keep
        # enough post-shuffle partitions to use every core.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(SPREAD, str(shuffle_partitions))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written tables: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session (tests) that leaves it unset gets a folder of its
    own; anywhere else a missing setting is an error, as executors would each
    write to their own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local[") and master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="demandlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, never reused sub-folder of the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over the session's shuffle partitions, for work whose cost isn't in bytes.

    Making folders and files, or parsing long texts, takes time by the row; adaptive
    execution, which goes by bytes, would merge such rows into one task.  It leaves a
    number of partitions alone that is given."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over as many partitions as the session's ``SPREAD`` says, if it says so."""
    n = df.sparkSession.conf.get(SPREAD, None)
    return df.repartition(int(n)) if n else df
