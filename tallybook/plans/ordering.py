"""Global and per-group order without sending a large group to one task.

A window over few large groups, or over no group at all, runs in as many tasks as there are
groups. Here rows are range-partitioned by the full sort key instead, so that a group of any size
spreads over many tasks, and what must cross a task boundary (counts, running sums, the last row)
is passed on in a table with about one row per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallybook.plans.durable import written_table

SEGMENT = "_segment"
OFFSET_IN_SEGMENT = "_offset"
_POSITION_BITS = 33  # monotonically_increasing_id keeps the position in the low 33 bits


def in_ranges(df: DataFrame, order: list[Column], label: str, ranges: int | None = None) -> DataFrame:
    """``df`` written in ``order``, each row with its range number and its place in the range.

    ``order`` should end in a unique column: equal keys cannot be split over ranges.
    """
    spread = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    place = F.monotonically_increasing_id()
    placed = (
        spread.sortWithinPartitions(*order)
        .withColumn("_place", place)
        .withColumn(SEGMENT, F.shiftright("_place", _POSITION_BITS).cast("int"))
        .withColumn(OFFSET_IN_SEGMENT, F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
        .drop("_place")
    )
    return written_table(placed, label)


def number_rows(
    df: DataFrame, groups: list[str], order: list[Column], name: str = "position", ranges: int | None = None
) -> DataFrame:
    """ROW_NUMBER within ``groups`` by ``order``, for groups of any size."""
    ranged = in_ranges(df, [*[F.col(g) for g in groups], *order], "numbered", ranges)
    # One row per range and group in it: at most ranges + groups rows.
    pieces = ranged.groupBy(SEGMENT, *groups).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(OFFSET_IN_SEGMENT).alias("_first")
    )
    earlier = Window.partitionBy(*groups).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        F.col(SEGMENT).alias("_s"),
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same = F.col(SEGMENT) == F.col("_s")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    # Written, so that its size is known and the rows need no further shuffle if it is small.
    return ranged.join(written_table(starts, "starts"), same).select(
        *df.columns, (F.col(OFFSET_IN_SEGMENT) + F.col("_shift")).cast("bigint").alias(name)
    )


def overall_rank(df: DataFrame, value: str, name: str = "overall_rank", ranges: int | None = None) -> DataFrame:
    """RANK over all rows by ``value`` DESC, as one row per distinct value.

    Rows are counted per value first, so only distinct values are shuffled and a value shared by
    many rows costs no more than any other. NULL ranks last.
    """
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_rows"))
    ranged = in_ranges(counts, [F.col(value).desc_nulls_last()], "ranked", ranges)
    # One row per range, so there are no more than there are shuffle partitions.
    totals = ranged.groupBy(SEGMENT).agg(F.sum("_rows").alias("_total"))
    before = Window.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col(SEGMENT).alias("_s"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before")
    )
    higher = (
        Window.partitionBy(SEGMENT).orderBy(OFFSET_IN_SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = ranged.withColumn("_higher", F.coalesce(F.sum("_rows").over(higher), F.lit(0)))
    return local.join(written_table(starts, "starts"), F.col(SEGMENT) == F.col("_s")).select(
        value, (F.col("_before") + F.col("_higher") + 1).cast("bigint").alias(name)
    )


def previous_value(
    df: DataFrame, key: str, order: list[Column], value: str, name: str, ranges: int | None = None
) -> DataFrame:
    """LAG of ``value`` per ``key`` by ``order``, for keys with any number of rows."""
    ranged = in_ranges(df, [F.col(key), *order], "lagged", ranges)
    within = Window.partitionBy(SEGMENT, key).orderBy(OFFSET_IN_SEGMENT)
    local = ranged.withColumn("_local", F.lag(value).over(within))
    # The last row of the range before: one row per range, so no more than shuffle partitions.
    lasts = ranged.groupBy(SEGMENT).agg(
        F.max_by(F.struct(F.col(key).alias("k"), F.col(value).alias("v")), OFFSET_IN_SEGMENT).alias("_last")
    )
    carried = lasts.select(
        F.col(SEGMENT).alias("_s"), F.lag("_last").over(Window.orderBy(SEGMENT)).alias("_carry")
    )
    from_before = F.when(
        (F.col(OFFSET_IN_SEGMENT) == 0) & F.col("_carry.k").eqNullSafe(F.col(key)), F.col("_carry.v")
    )
    previous = F.when(F.col(OFFSET_IN_SEGMENT) == 0, from_before).otherwise(F.col("_local"))
    carried = written_table(carried, "carried")
    return local.join(carried, F.col(SEGMENT) == F.col("_s")).select(*df.columns, previous.alias(name))
