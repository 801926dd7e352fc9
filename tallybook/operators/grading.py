"""Comparing result sets in bulk, and showing them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallybook.functions.cells import CELL_SEPARATOR, cell_text, normalised, row_cells, row_line

# Fixed value: what is shown for a result without rows.
NO_ROWS = "결과가 없습니다."


def normalise_cells(df: DataFrame, cols: list[str] | None = None, scale: int | None = None) -> DataFrame:
    """Every cell as lower-case text without outer white space, NULL as empty text."""
    names = cols or df.columns
    return df.select(*[normalised(cell_text(df, n, scale)).alias(n) for n in names])


def result_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of which one side has more copies, with the side and the number of extra copies.

    Columns are matched by place and take the left names. One aggregate over both sides counts
    copies before the shuffle, so a row repeated very often is no hot spot; extra copies are
    given as a number instead of being written out.
    """
    names = left.columns
    both = left.select("*", F.lit(1).alias("_side")).union(right.select("*", F.lit(-1).alias("_side")))
    extra = both.groupBy(*names).agg(F.sum("_side").alias("_extra")).where(F.col("_extra") != 0)
    return extra.select(
        *names,
        F.when(F.col("_extra") > 0, "left").otherwise("right").alias("side"),
        F.abs("_extra").alias("copies"),
    )


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row telling whether two results are equal as bags of rows."""
    return result_diff(left, right).agg(
        (F.count(F.lit(1)) == 0).alias("equal"), F.coalesce(F.sum("copies"), F.lit(0)).alias("differing_rows")
    )


def long_form(df: DataFrame, submission: str, row_no: str, cols: list[str], scale: int | None = None) -> DataFrame:
    """Result rows as (submission_id, row_no, cells), the form that is graded."""
    return df.select(
        F.col(submission).alias("submission_id"), F.col(row_no).alias("row_no"),
        row_cells(df, cols, scale).alias("cells"),
    )


def grade_ordered_results(
    submitted: DataFrame, expected: DataFrame, submissions: DataFrame | None = None
) -> DataFrame:
    """Compare very many results with their keys row by row, in order.

    Both sides are in long form. A place agrees if each side has exactly one row there with the
    same cells. Work is spread by (submission, row), so one huge result is no hot spot. A list of
    ``submissions`` adds those where both sides are empty; they pass.
    """
    both = submitted.select("submission_id", "row_no", "cells", F.lit(1).alias("_s"), F.lit(0).alias("_e")).union(
        expected.select("submission_id", "row_no", "cells", F.lit(0).alias("_s"), F.lit(1).alias("_e"))
    )
    # Different cells of a place are counted where the place lies: two hash aggregates, one shuffle.
    kinds = both.repartition("submission_id", "row_no").groupBy("submission_id", "row_no", "cells").agg(
        F.sum("_s").alias("_s"), F.sum("_e").alias("_e")
    )
    places = kinds.groupBy("submission_id", "row_no").agg(
        F.sum("_s").alias("_s"), F.sum("_e").alias("_e"), F.count(F.lit(1)).alias("_kinds")
    )
    agrees = (F.col("_s") == 1) & (F.col("_e") == 1) & (F.col("_kinds") == 1)
    places = places.select("submission_id", "_s", "_e", F.coalesce(agrees, F.lit(False)).alias("_agrees"))
    if submissions is not None:
        none = F.lit(0).cast("bigint")
        places = places.union(submissions.select("submission_id", none, none, F.lit(True)))
    return (
        places.groupBy("submission_id")
        .agg(
            F.sum("_s").alias("submitted_rows"),
            F.sum("_e").alias("expected_rows"),
            F.count_if(~F.col("_agrees")).alias("mismatches"),
        )
        .withColumn("passed", F.col("mismatches") == 0)
    )


def render_rows(df: DataFrame, cols: list[str] | None = None, scale: int | None = None) -> DataFrame:
    """One delimited line per row."""
    return df.select(row_line(df, cols or df.columns, scale).alias("line"))


def heading_lines(cols: list[str]) -> list[str]:
    """Column names and the rule below them."""
    names = CELL_SEPARATOR.join(cols)
    return [names, "-" * len(names)]


def render_table(df: DataFrame, order: list[Column], cols: list[str] | None = None, scale: int | None = None) -> DataFrame:
    """A whole result as sorted lines: heading, rule, rows; or one message if there are no rows."""
    names = cols or df.columns
    sort_names = [f"_o{i}" for i in range(len(order))]
    body = df.select(
        F.lit(2).alias("_part"), row_line(df, names, scale).alias("line"),
        *[c.alias(n) for c, n in zip(order, sort_names)],
    )
    # One row tells whether there is anything to show.
    found = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    above = F.when(F.col("n") > 0, F.array(*[F.lit(line) for line in heading_lines(names)])).otherwise(
        F.array(F.lit(NO_ROWS))
    )
    head = found.select(F.posexplode(above).alias("_part", "line"))
    return (
        body.unionByName(head, allowMissingColumns=True)
        .orderBy("_part", *sort_names)
        .select("line")
    )
