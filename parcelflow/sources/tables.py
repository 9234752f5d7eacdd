"""Stored tables: Parquet folders of a warehouse root, or a live database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_source(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A database table read by ``partitions`` parallel range queries.

    The bounds only shape the ranges; rows outside them are read too. Needs the
    database's driver on the class path.
    """
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, **options)
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )


def declare_table(spark: SparkSession, database: str, name: str, path: str, columns: str) -> None:
    """Declare a database, kept beside the table's folder, and an external Parquet table; no-op for what exists."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{path.rstrip('/')}__database'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet LOCATION '{path}'")
