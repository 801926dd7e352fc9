"""Look-ups, outer joins and group reports over joined tables.

Facts are aggregated by join key before they meet the dimension, so the shuffle carries partial
results and a hot key arrives as one row. No side is forced to broadcast: the planner does that by
its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallybook.functions.numbers import shown_average
from tallybook.plans.durable import written_table
from tallybook.plans.skew import SPLIT, left_join


def join_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Inner equi join of a fact with its dimension."""
    return fact.join(dim, F.col(fact_key) == F.col(dim_key))


def group_count_keep_empty(
    dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str, counted: str, name: str = "row_count",
    on: Column | None = None,
) -> DataFrame:
    """Every dimension row with the number of its fact rows; 0 where there is none.

    ``on`` is a further condition of the join: facts that fail it are not counted.
    """
    fact = fact if on is None else fact.where(on)
    counts = fact.groupBy(fact_key).agg(F.count(counted).alias(name))
    return dim.join(counts, F.col(dim_key) == F.col(fact_key), "left").select(
        *dim.columns, F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)
    )


def join_average(
    dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str, value: str, name: str = "avg_value"
) -> DataFrame:
    """Dimension rows that have facts, with their average, highest first."""
    averages = fact.groupBy(fact_key).agg(shown_average(F.avg(value)).alias(name))
    return (
        dim.join(averages, F.col(dim_key) == F.col(fact_key))
        .select(*dim.columns, name)
        .orderBy(F.col(name).desc_nulls_last(), dim_key)
    )


def three_way_join(
    fact: DataFrame, dim: DataFrame, opt: DataFrame, fact_dim: str, dim_key: str, fact_key: str, opt_key: str,
    on: Column | None = None, layout: str = SPLIT,
) -> DataFrame:
    """Facts with their dimension, and with each optional match or NULL where there is none.

    ``on`` is a further condition a match must meet; for ``layout`` see ``left_join``.
    """
    opt = opt if on is None else opt.where(on)
    return left_join(join_lookup(fact, dim, fact_dim, dim_key), opt, fact_key, opt_key, layout)


def distinct_groups_keep_empty(
    dim: DataFrame, pairs: DataFrame, dim_key: str, pair_key: str, member: str, name: str = "group_count",
    on: Column | None = None,
) -> DataFrame:
    """Every dimension row with its number of distinct members; 0 where there is none.

    ``on`` is a further condition that pairs must meet. Distinct pairs are made first, combined before the shuffle and spread by (key, member).
    """
    pairs = pairs if on is None else pairs.where(on)
    unique = pairs.select(pair_key, member).distinct()
    return group_count_keep_empty(dim, unique, dim_key, pair_key, member, name)


def shared_project_count(
    dept: DataFrame, pairs: DataFrame, dept_key: str, pair_dept: str, project: str, name: str = "shared_projects"
) -> DataFrame:
    """Per department, its distinct projects that some other department works on too.

    That is all its projects less those it has to itself. A project of one department names that
    department as its MIN, so the pairs need not be joined back to the project counts.
    """
    unique = (
        pairs.select(F.col(pair_dept).alias("_dept"), F.col(project).alias("_project"))
        .where(F.col("_dept").isNotNull() & F.col("_project").isNotNull())
        .distinct()
    )
    all_projects = unique.groupBy("_dept").agg(F.count(F.lit(1)).alias("_n"))
    own = (
        unique.groupBy("_project")
        .agg(F.count(F.lit(1)).alias("_depts"), F.min("_dept").alias("_dept"))
        .where(F.col("_depts") == 1)
        .groupBy("_dept")
        .agg((-F.count(F.lit(1))).alias("_n"))
    )
    shared = all_projects.unionByName(own).groupBy("_dept").agg(F.sum("_n").alias(name))
    return (
        dept.join(shared, F.col(dept_key) == F.col("_dept"), "left")
        .select(*dept.columns, F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name))
        .orderBy(F.col(name).desc(), dept_key)
    )


def shared_project_exists(
    dept: DataFrame, pairs: DataFrame, dept_key: str, pair_dept: str, project: str, name: str = "shared_projects"
) -> DataFrame:
    """``shared_project_count`` asked as it is said: projects for which a pair of another department exists.

    The subquery is correlated by the project, which is the key of a semi-join, and by departments being
    different, which is a condition of that join; neither needs a nested loop.
    """
    unique = written_table(
        pairs.select(F.col(pair_dept).alias("_dept"), F.col(project).alias("_project"))
        .where(F.col("_dept").isNotNull() & F.col("_project").isNotNull()).distinct(),
        "pairs",
    )
    others = unique.alias("_b").where(
        (F.col("_b._project") == F.col("_a._project").outer()) & (F.col("_b._dept") != F.col("_a._dept").outer())
    )
    shared = unique.alias("_a").where(others.exists()).groupBy("_dept").agg(F.count(F.lit(1)).alias(name))
    return (
        dept.join(shared, F.col(dept_key) == F.col("_dept"), "left")
        .select(*dept.columns, F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name))
        .orderBy(F.col(name).desc(), dept_key)
    )


def cte_group_filter_join(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, value: str, least: float, tie: str
) -> DataFrame:
    """Detail rows, with names, of the groups whose average is at least ``least``, highest first.

    The passing groups are written first: the planner then knows how few they are and need not
    shuffle the facts to find out.
    """
    groups = (
        fact.groupBy(F.col(fact_key).alias("_group"))
        .agg(F.avg(value).alias("_avg"))
        .where(F.col("_avg") >= F.lit(least))
    )
    groups = written_table(groups.select("_group"), "groups")
    kept = fact.join(groups, F.col(fact_key) == F.col("_group"), "left_semi")
    return join_lookup(kept, dim, fact_key, dim_key).orderBy(F.col(value).desc_nulls_last(), tie)
