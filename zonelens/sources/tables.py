"""Access to the parquet tables of a data folder (one file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Read one table; naming columns keeps the scan's ReadSchema narrow."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df
