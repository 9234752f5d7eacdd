"""Insert-or-ignore: the first row per key wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def insert_ignore(rows: DataFrame, key: str, position: str, target: DataFrame | None = None) -> DataFrame:
    """The rows of a batch that an insert with ``ON CONFLICT (key) DO NOTHING`` adds.

    ``position`` is a unique column giving the input order. Rows with a NULL key never
    conflict, as under SQL UNIQUE. Picking the first row is an aggregate, so a
    key that holds most of the rows is reduced before the shuffle.
    """
    slot = F.when(F.col(key).isNull(), F.col(position))
    first = (
        rows.groupBy(F.col(key).alias("_key"), slot.alias("_slot"))
        .agg(F.min_by(F.struct(*rows.columns), F.col(position)).alias("_row"))
        .select("_row.*")
    )
    return first if target is None else first.join(target.select(key), key, "left_anti").select(rows.columns)
