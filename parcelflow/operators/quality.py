"""Constraint checks. Each returns the violations; an empty result is a pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ConstraintViolation(ValueError):
    """A write gate found rows that break a constraint."""


def _any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows where any of the columns is NULL."""
    return df.filter(_any_null(columns))


def check_unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once, with their ``row_count``.

    As under SQL UNIQUE, a key with a NULL part never repeats. Counting combines
    map-side, so a key that fills the table is no hot spot.
    """
    counts = df.filter(~_any_null(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.filter(F.col("row_count") > 1)


def check_rule(df: DataFrame, rule: str) -> DataFrame:
    """Rows for which the SQL expression is false; NULL passes, as under SQL CHECK."""
    return df.filter(~F.expr(rule))


def check_primary_key(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that are incomplete or repeated, with their ``row_count``."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.filter((F.col("row_count") > 1) | _any_null(columns))


def check_relationship(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    keys = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti").select(child.columns)


def require(name: str, violations: DataFrame) -> None:
    """Write gate: raise if there is any violation."""
    sample = violations.take(1)
    if sample:
        raise ConstraintViolation(f"{name}: {sample[0].asDict()}")
