"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def local_session(cores: int = 8, partitions: int = 8, app: str = "tessera") -> SparkSession:
    """Local session used by tests and ``bench.py`` (UI off, UTC, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared (distributed) folder and is used as
    is. Only when it is unset and the master is local (tests) a scratch folder is
    created here; elsewhere executors could not share it, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` as a table into the shared checkpoint folder and read it back:
    cuts lineage, survives executor loss, and gives every later reader the same
    rows without computing them again. ``schema`` names another reading of the columns."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def staged_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """As :func:`staged`, in buckets by ``key`` (as many as shuffle partitions): groups,
    windows and joins on ``key`` read it without an exchange. The buckets are known
    to the session's catalog only; the files lie in the shared checkpoint folder."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{table}"
    df.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)


#: Rows up to which a small side is broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 500_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows (checked by a
    bounded count), else unchanged."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
