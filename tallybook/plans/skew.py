"""Joins that stay splittable where a key has very many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

PLAIN, SPLIT = "plain", "split"


def left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, layout: str = SPLIT) -> DataFrame:
    """LEFT JOIN on two columns; both layouts give the same rows.

    ``plain`` is one outer join: AQE splits a hot key of the left side, but not one of the right.
    ``split`` takes the matches from an inner join, which AQE splits on either side, and the rest
    from an anti join with the distinct keys of the right, for one more reading of each side.
    """
    if layout not in (PLAIN, SPLIT):
        raise ValueError(f"no such layout: {layout}")
    on = F.col(left_key) == F.col(right_key)
    right = right.where(F.col(right_key).isNotNull())
    if layout == PLAIN:
        return left.join(right, on, "left")
    keys = right.select(F.col(right_key).alias("_key")).distinct()
    alone = left.join(keys, F.col(left_key) == F.col("_key"), "left_anti")
    blanks = [F.lit(None).cast(field.dataType).alias(field.name) for field in right.schema]
    return left.join(right, on).union(alone.select("*", *blanks))
