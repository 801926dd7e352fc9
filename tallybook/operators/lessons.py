"""Everyday query shapes, from projection to ranking.

Sorted results end in a unique key (``tie``): the order is then total, and a value shared by very
many rows can still be split over sort ranges. Columns that are not sorted by are computed after the
sort: the shuffle is narrower, and a sort's sampling pass does not compute them a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallybook.functions.numbers import shown_average
from tallybook.functions.times import month_text, months_30d, year_text


def project(t: DataFrame, *cols: str) -> DataFrame:
    """The named columns, or all of them in table order; duplicates stay."""
    return t.select(*(cols or ["*"]))


def filter_equal(t: DataFrame, col: str, value) -> DataFrame:
    return t.where(F.col(col) == F.lit(value))


def filter_at_least(t: DataFrame, col: str, least) -> DataFrame:
    return t.where(F.col(col) >= F.lit(least))


def filter_both(t: DataFrame, equal_col: str, value, least_col: str, least) -> DataFrame:
    return t.where((F.col(equal_col) == F.lit(value)) & (F.col(least_col) >= F.lit(least)))


def count_by_group(t: DataFrame, key: str, name: str = "row_count") -> DataFrame:
    return t.groupBy(key).agg(F.count(F.lit(1)).alias(name)).orderBy(key)


def groups_above_average(t: DataFrame, key: str, value: str, least: float, name: str = "avg_value") -> DataFrame:
    """Groups whose average is at least ``least`` (HAVING)."""
    averages = t.groupBy(key).agg(F.avg(value).alias(name)).where(F.col(name) >= F.lit(least))
    return averages.withColumn(name, shown_average(F.col(name)))


def max_by_group(t: DataFrame, key: str, value: str, name: str = "max_value") -> DataFrame:
    return t.groupBy(key).agg(F.max(value).alias(name)).orderBy(F.col(name).desc_nulls_last(), key)


def bucket_high_low(t: DataFrame, value: str, cut: float, sort: str, tie: str, name: str = "level") -> DataFrame:
    """Label rows High from ``cut`` upwards, else Low (NULL included)."""
    level = F.when(F.col(value) >= F.lit(cut), "High").otherwise("Low")
    return t.orderBy(sort, tie).withColumn(name, level)


def date_parts(t: DataFrame, moment: str, tie: str) -> DataFrame:
    """Add four-digit year and two-digit month as text, sorted by the date."""
    col = F.col(moment)
    return t.orderBy(moment, tie).withColumns({"year": year_text(col), "month": month_text(col)})


def tenure_months(t: DataFrame, name: str, since: str, as_of: Column, tie: str) -> DataFrame:
    """Upper-case names and the 30-day months from ``since`` to ``as_of``, longest first."""
    return (
        t.withColumn("months_30d", months_30d(F.col(since), as_of))
        .orderBy(F.col("months_30d").desc_nulls_last(), tie)
        .withColumn(name, F.upper(F.col(name)))
    )
