"""Stand-in inputs built from the driver tables (see FIXTURES.md section 2).

These functions only select and rename rows into the schema an operator
expects; the operators do all the work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import table

# events as a sensor series: machine = user_id, clock = (ts, event_id),
# sensor = value, failure-signature flag = event_type 'error'.
SPLIT_TS = "2024-01-16 00:00:00"
KEYS = ["user_id"]
ORDER = ["ts", "event_id"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def sensor_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    return ev.select("event_id", "user_id", "ts", "value",
                     F.coalesce(F.col("event_type") == "error", F.lit(False)).alias("flag"))


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_rows(spark, sf_dir).filter(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz"))


def test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_rows(spark, sf_dir).filter(F.col("ts") >= F.lit(SPLIT_TS).cast("timestamp_ntz"))


def train_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-row frame ``ref_max`` = maximum sensor value of the training half."""
    return train_rows(spark, sf_dir).agg(F.max("value").alias("ref_max"))


# SQL fragments for the oracle side (same stand-in, written independently).
SQL_ROWS = ("SELECT event_id, user_id, ts, value, coalesce(event_type = 'error', false) AS flag "
            "FROM events")
SQL_TEST = f"SELECT * FROM ({SQL_ROWS}) WHERE ts >= TIMESTAMP '{SPLIT_TS}'"
SQL_TRAIN = f"SELECT * FROM ({SQL_ROWS}) WHERE ts < TIMESTAMP '{SPLIT_TS}'"
SQL_REF = f"SELECT max(value) AS ref_max FROM ({SQL_TRAIN})"
