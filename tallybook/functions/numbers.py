"""Arithmetic that gives the same digits whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


AVERAGE_PLACES = 6


def shown_average(average: Column, places: int = AVERAGE_PLACES) -> Column:
    """An average rounded after it was taken, so that it has the same digits for any partitioning."""
    return F.round(average.cast("double"), places)


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, NULL where there is no whole."""
    return part * 100.0 / F.nullif(whole, F.lit(0).cast("double"))
