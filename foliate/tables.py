"""Access to the tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliate.session import ship_package


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The table `name` of the folder; the named columns only, so that the scan reads no others."""
    ship_package(spark)
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df
