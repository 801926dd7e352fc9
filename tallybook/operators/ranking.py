"""Change from one period to the next, ranks, and numbering of stacked sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallybook.functions.numbers import percent
from tallybook.plans.durable import written_table
from tallybook.plans.ordering import number_rows, overall_rank, previous_value

# How groups are laid out: a window task per group, or ranges of the sort order for groups of any size.
WINDOW, RANGES = "window", "ranges"


def _check(layout: str) -> None:
    if layout not in (WINDOW, RANGES):
        raise ValueError(f"no such layout: {layout}")


def with_previous(
    hist: DataFrame,
    entity: str,
    moment: str,
    tie: str,
    value: str,
    name: str = "previous_value",
    layout: str = RANGES,
    ranges: int | None = None,
) -> DataFrame:
    """Each row's value one step earlier for the same entity.

    Ranges of the sort order stand entities of any size and write the rows once. ``window`` is
    cheaper, and for entities whose rows fit a task.
    """
    _check(layout)
    if layout == RANGES:
        return previous_value(hist, entity, [F.col(moment), F.col(tie)], value, name, ranges)
    return hist.withColumn(name, F.lag(value).over(Window.partitionBy(entity).orderBy(moment, tie)))


def period_increase(
    hist: DataFrame,
    dim: DataFrame,
    entity: str,
    moment: str,
    tie: str,
    value: str,
    dim_key: str,
    layout: str = RANGES,
    ranges: int | None = None,
) -> DataFrame:
    """Rows that rose over the entity's row before, with the rise in percent, largest first."""
    known = hist.where(F.col(entity).isNotNull()).select(entity, moment, tie, value)
    rises = (
        with_previous(known, entity, moment, tie, value, "previous_value", layout, ranges)
        .where(F.col(value) > F.col("previous_value"))
        .withColumn(
            "increase_percent",
            F.round(percent(F.col(value) - F.col("previous_value"), F.col("previous_value")), 1),
        )
    )
    # A global sort samples its input before it sorts, and would run the windows twice.
    rises = written_table(rises, "rises")
    return rises.join(dim, F.col(entity) == F.col(dim_key)).orderBy(
        F.col("increase_percent").desc_nulls_last(), tie
    )


def group_leaders(
    t: DataFrame, group: str, value: str, k: int, tie: str, name: str = "group_rank",
    layout: str = WINDOW, ranges: int | None = None,
) -> DataFrame:
    """The values with RANK <= k in their group, as (group, value, rank), at most k per group.

    A value ranks within k exactly if it is among the first k rows, however ties fall, and its
    rank is the first of its places there. ROW_NUMBER keeps k rows per group and task before the
    shuffle, where RANK would keep all ties, as long as k is small beside a group. For a large k
    take ``ranges``: rows are numbered through ranges of the sort order.
    """
    _check(layout)
    down = F.col(value).desc_nulls_last()
    if layout == WINDOW:
        place = F.row_number().over(Window.partitionBy(group).orderBy(down))
        placed = t.select(group, value).withColumn("_place", place)
    else:
        placed = number_rows(t.select(group, value, tie), [group], [down, F.col(tie)], "_place", ranges)
    first = placed.where(F.col("_place") <= k)
    return first.groupBy(group, value).agg(F.min("_place").cast("bigint").alias(name))


def top_k_and_overall_rank(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, value: str, k: int, tie: str,
    sort: str, layout: str = WINDOW, ranges: int | None = None,
) -> DataFrame:
    """Rows ranked within ``k`` in their group (ties included), with their rank over all rows.

    The leading values are written before the rows are matched with them: the planner then knows
    their size and can keep the rows where they are. Values below all leaders come after them and
    are left out of the ranking, but for a missing leader, which comes last itself.
    """
    rows = fact.join(dim, F.col(fact_key) == F.col(dim_key))
    leaders = group_leaders(rows, fact_key, value, k, tie, layout=layout, ranges=ranges).select(
        F.col(fact_key).alias("_group"), F.col(value).alias("_value"), "group_rank"
    )
    leaders = written_table(leaders, "leaders")
    lowest = leaders.agg(F.when(F.count_if(F.col("_value").isNull()) == 0, F.min("_value"))).scalar()
    counted = rows.select(value).where(lowest.isNull() | (F.col(value) >= lowest))
    ranks = overall_rank(counted, value, ranges=ranges).select(
        F.col(value).alias("_ranked"), "overall_rank"
    )
    leaders = leaders.join(ranks, F.col("_value").eqNullSafe(F.col("_ranked"))).drop("_ranked")
    leaders = written_table(leaders, "leader-ranks")
    is_leader = F.col(fact_key).eqNullSafe(F.col("_group")) & F.col(value).eqNullSafe(F.col("_value"))
    return rows.join(leaders, is_leader).drop("_group", "_value").orderBy(sort, "group_rank", tie)


def union_lesson_sets(
    sets: dict[int, DataFrame], order: list[str], ranges: int | None = None
) -> DataFrame:
    """Sets stacked under their round id, rows numbered from 1 in each; key (round, position)."""
    tagged = [df.withColumn("round_id", F.lit(round_id).cast("int")) for round_id, df in sets.items()]
    stacked = reduce(lambda a, b: a.unionByName(b), tagged)
    return number_rows(stacked, ["round_id"], [F.col(c) for c in order], "position", ranges)


def numbered_sets(rows: DataFrame, round_id: Column, order: list[str], ranges: int | None = None) -> DataFrame:
    """The same for sets that lie in one table: ``round_id`` tells them apart, and one scan serves all."""
    tagged = rows.withColumn("round_id", round_id)
    return number_rows(tagged, ["round_id"], [F.col(c) for c in order], "position", ranges)
