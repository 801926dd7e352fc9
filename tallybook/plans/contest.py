"""A contest: consecutive rounds of equal length, each with the same number of problems."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallybook.functions.times import moment


@dataclass(frozen=True)
class Contest:
    """Rounds are half-open: a round ends where the next one starts."""

    start: datetime
    round_days: int = 3
    rounds: int = 7
    problems_per_round: int = 3

    @property
    def problem_count(self) -> int:
        return self.rounds * self.problems_per_round

    def round_at(self, at: datetime) -> int:
        return (at - self.start) // timedelta(days=self.round_days) + 1

    def round_of_time(self, at: Column) -> Column:
        """Number of the round that holds ``at``, by arithmetic instead of a range join."""
        since_midnight = self.start - self.start.replace(hour=0, minute=0, second=0, microsecond=0)
        seconds = F.lit(since_midnight.total_seconds()).cast("decimal(18,6)")
        shifted = at - F.make_dt_interval(secs=seconds)
        days = F.date_diff(F.to_date(shifted), F.lit(self.start.date()))
        return (F.floor(days / self.round_days) + 1).cast("bigint")

    def round_of_problem(self, problem: Column) -> Column:
        return F.ceil(problem / self.problems_per_round).cast("bigint")

    def starts_at(self, round_number: Column) -> Column:
        days = ((round_number - 1) * self.round_days).cast("int")
        return moment(self.start) + F.make_dt_interval(days=days)

    def calendar(self, spark: SparkSession) -> DataFrame:
        """One row per round with its window."""
        number = F.col("id")
        return spark.range(1, self.rounds + 1, 1, 1).select(
            number.alias("round_number"),
            self.starts_at(number).alias("starts_at"),
            self.starts_at(number + 1).alias("ends_at"),
        )

    def problems(self, spark: SparkSession) -> DataFrame:
        """One row per problem with the round it belongs to."""
        number = F.col("id")
        return spark.range(1, self.problem_count + 1, 1, 1).select(
            number.alias("problem_id"), self.round_of_problem(number).alias("round_number")
        )
