"""Incremental form of the flagged-row sessionization (F6, first stage) for a
growing input: ``session_window`` with a watermark, so state for a session is
dropped once no later row can extend it. The batch operator remains
:func:`tessera.operators.timeseries.gap_sessions`; a gap of exactly ``gap``
stays in one session in both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flagged_sessions(stream: DataFrame, keys: Sequence[str], flag: str, ts: str, value: str,
                     gap: str = "30 minutes", watermark: str = "1 hour") -> DataFrame:
    """Per key, sessions of flagged rows split by gaps longer than ``gap``:
    start, end (last row, not ``session_window.end``), row count and peak value."""
    flagged = stream.filter(F.coalesce(F.col(flag), F.lit(False))).withWatermark(ts, watermark)
    g = flagged.groupBy(*keys, F.session_window(F.col(ts), gap).alias("_sw")).agg(
        F.min(ts).alias("start"), F.max(ts).alias("end"), F.count(F.lit(1)).alias("n_flagged"),
        F.max(value).alias("value_max"))
    return g.drop("_sw")


def read_parquet_stream(spark: SparkSession, path: str, schema: T.StructType,
                        max_files_per_trigger: int = 16) -> DataFrame:
    """File-source stream of parquet files with an explicit schema."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))
