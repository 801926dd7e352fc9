"""Cells as text: the forms used to compare results and to show them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# How results are shown.
CELL_SEPARATOR = " | "
NULL_WORD = "None"
EMPTY_WORD = "null"  # how a missing cell is written in a text block

# Every character that counts as white space, and the same as a pattern class. Named classes are
# several times faster than a list of characters.
WHITE_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_SPACE = r"[\s\x1c-\x1f]"
_UNICODE = "(?U)"

_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def strip_space(text: Column) -> Column:
    """Drop white space of every kind, not only blanks, from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def words(stripped: Column) -> Column:
    """The parts of a stripped line between runs of white space; one empty part for an empty line."""
    return F.split(stripped, f"{_UNICODE}{_SPACE}+")


def count_words(text: Column) -> Column:
    """How many words a text has, without making an array of them."""
    return F.regexp_count(text, F.lit(_UNICODE + _SPACE.replace("[", "[^") + "+"))


def has_at_most(stripped: Column, most_words: int) -> Column:
    """Whether a stripped line has 1 to ``most_words`` words, without splitting long lines."""
    word = _SPACE.replace("[", "[^") + "+"
    return F.rlike(stripped, F.lit(f"{_UNICODE}^{word}(?:{_SPACE}+{word}){{0,{most_words - 1}}}$"))


def plain_number(col: Column) -> Column:
    """Every digit of a fraction as plain text: 1e7 is 10000000.0; NaN and the infinities are words.

    Numbers that need more than 38 digits keep their exponent.
    """
    text = col.cast("string")
    digits = col.try_cast(T.DecimalType(38, 12))
    exact = digits.cast("double") == col.cast("double")
    short = F.regexp_replace(digits.cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(F.contains(text, F.lit("E")) & exact, short).otherwise(text)


def cell_text(df: DataFrame, name: str, scale: int | None = None) -> Column:
    """One column as text with all its digits, or rounded to ``scale`` places where that is asked for."""
    col = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, _FRACTIONAL):
        if scale is None:
            return plain_number(col)
        col = col.cast(T.DecimalType(38, scale))
    return col.cast("string")


def normalised(text: Column) -> Column:
    """The form cells are compared in: lower case, no outer white space, NULL as empty text."""
    return F.coalesce(F.lower(strip_space(text)), F.lit(""))


def row_cells(df: DataFrame, names: list[str], scale: int | None = None) -> Column:
    """Normalised cells of a row as an array, in column order."""
    return F.array(*[normalised(cell_text(df, n, scale)) for n in names])


def row_line(df: DataFrame, names: list[str], scale: int | None = None) -> Column:
    """One display line per row; a missing cell shows as a word."""
    shown = [F.coalesce(cell_text(df, n, scale), F.lit(NULL_WORD)) for n in names]
    return F.concat_ws(CELL_SEPARATOR, *shown)
