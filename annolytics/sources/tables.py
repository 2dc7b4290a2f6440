"""Typed readers of the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clean_key(col: Column | str) -> Column:
    """Lower case without blanks, tabs or line ends around it; blank becomes null."""
    c = F.col(col) if isinstance(col, str) else col
    t = F.lower(F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    return F.when(t != "", t)


def micros(col: Column | str) -> Column:
    """Microseconds since 1970-01-01 UTC of a zone-less timestamp, read as UTC (null stays null)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(F.convert_timezone(F.lit("UTC"), F.lit("UTC"), c.cast("timestamp_ntz")).cast("timestamp"))
