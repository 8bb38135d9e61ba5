"""Sources and sinks (A1-A5): explicit-schema reads, timestamp parsing,
prediction frames, CSV sink and shape profiles."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.nulls import normalize_missing

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str | None = None) -> DataFrame:
    """A1: read a table. CSV is read with a header and an explicit schema (no
    inference pass over the data); parquet carries its own schema. NaN is missing:
    it becomes NULL in every floating-point column."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        return normalize_missing(reader.option("header", True).option("mode", "PERMISSIVE").csv(path))
    return normalize_missing(reader.format(fmt).load(path))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables ``{sf_dir}/{name}.parquet``; NaN becomes NULL."""
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """A1: a CSV with a header and an explicit schema as ``(rows, rejects)``. A line that
    does not fit (text where a number or time belongs, too few or too many fields) is no row
    with silent NULLs but a reject ``(file, line)``. Every line is parsed whole whatever
    columns a query takes, so the same lines are rejected each time. NaN becomes NULL."""
    typed = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    bad = "_rejected_line"
    raw = (spark.read.schema(T.StructType([*typed.fields, T.StructField(bad, T.StringType())]))
           .option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad)
           .option("columnPruning", False).csv(path))
    # the parser converts the fields a query asks for: this asks for all, and is always true
    parsed = F.xxhash64(*typed.names).bitwiseOR(F.lit(1)) != 0
    rows = normalize_missing(raw.filter(F.col(bad).isNull() & parsed).drop(bad))
    rejects = raw.filter(F.col(bad).isNotNull() & parsed).select(F.col("_metadata.file_path").alias("file"), F.col(bad).alias("line"))
    return rows, rejects


def parse_ts(df: DataFrame, col: str, fmt: str | None = None) -> DataFrame:
    """A2: timestamp text -> TIMESTAMP_NTZ after the read; unparsable text -> NULL.
    A column that already is a timestamp is only cast."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return df.withColumn(col, F.col(col).cast("timestamp_ntz"))
    text = F.col(col).cast("string")
    if fmt:
        # read as an instant of UTC and written down again without a zone, so that the
        # session's zone and its clock changes have no say
        instant = F.unix_micros(F.try_to_timestamp(F.concat(text, F.lit("Z")), F.lit(f"{fmt}X")))
        seconds = (instant.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
        parsed = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    else:
        parsed = text.try_cast("timestamp_ntz")
    return df.withColumn(col, parsed)


def prediction_frame(df: DataFrame, id_col: str, value: Column | str, value_name: str) -> DataFrame:
    """A4: ``(id as long, value)`` sorted by id (the sort is the output order;
    it is a range-partitioned sort, no single task)."""
    v = F.col(value) if isinstance(value, str) else value
    return df.select(F.col(id_col).cast("long").alias(id_col), v.alias(value_name)).orderBy(id_col)


def write_predictions(df: DataFrame, path: str, single_file: bool = False) -> None:
    """A3: CSV sink with a header, no index column. Writes a folder of part files;
    ``single_file`` is only for small outputs (it funnels rows through one task)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def profile_shape(df: DataFrame) -> DataFrame:
    """A5: one row ``(n_rows, n_cols)``; the count is a distributed aggregate."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def preview(df: DataFrame, n: int = 5, order: Iterable[str] | None = None) -> DataFrame:
    """A5: first ``n`` rows (by ``order`` when given, so it is deterministic)."""
    return (df.orderBy(*order) if order else df).limit(n)
