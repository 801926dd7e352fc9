"""Cutting lineage with a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallybook.session import new_location


def written_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Later steps then see one fixed layout, column pruning works on it, its size is known to the
    planner, and a lost executor costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    location = new_location(spark, label)
    df.write.parquet(location)
    return spark.read.schema(df.schema).parquet(location)
