"""Problem files: JSON arrays of problems, each with its test data, column types and result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Cells mix numbers and text, so they are read as text and cast by the column types beside them.
_CELLS = T.ArrayType(T.ArrayType(T.StringType()))

PROBLEM = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("question", T.StringType()),
    T.StructField("solution", T.StringType()),
    T.StructField("test_data", T.StructType([
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("data", _CELLS),
    ])),
    T.StructField("schema", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
    ]))),
    T.StructField("expected_result", _CELLS),
])

# Type names used in problem files.
SPARK_TYPES = {"INTEGER": "bigint", "REAL": "double", "TEXT": "string"}


def read_problem_files(spark: SparkSession, path: str) -> DataFrame:
    """Whole-file JSON; each file is one array, so many files are read in parallel."""
    return spark.read.schema(PROBLEM).option("multiLine", True).json(path)


def parse_problems(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Problems held as JSON text, one per row."""
    return df.select(*keep, F.from_json(text, PROBLEM).alias("p")).select(*keep, "p.*")


def test_cells(problems: DataFrame, keys: list[str]) -> DataFrame:
    """One row per cell: place, column, type name, and the value as text, number or integer."""
    rows = problems.select(
        *keys, F.col("schema").alias("_schema"), F.posexplode("test_data.data").alias("_row", "_cells")
    )
    cells = rows.select(*keys, "_row", F.posexplode(F.arrays_zip("_schema", "_cells")).alias("_col", "_cell"))
    word, kind = F.col("_cell._cells"), F.col("_cell._schema.type")
    return cells.select(
        *keys,
        (F.col("_row") + 1).alias("row_no"),
        (F.col("_col") + 1).alias("col_no"),
        F.col("_cell._schema.name").alias("name"),
        kind.alias("type"),
        F.when(kind == "INTEGER", word.try_cast("bigint")).alias("integer_value"),
        F.when(kind == "REAL", word.try_cast("double")).alias("real_value"),
        F.when(kind == "TEXT", word).alias("text_value"),
    )


def test_rows(problems: DataFrame, keys: list[str], fields: dict[str, str]) -> DataFrame:
    """The test data as flat rows of typed columns, found by name in each problem's schema.

    ``fields`` maps a column to its type name.
    """
    rows = problems.select(
        *keys, F.col("schema.name").alias("_names"), F.posexplode("test_data.data").alias("_row", "_cells")
    )

    def cell(name: str, kind: str) -> Column:
        at = F.array_position(F.col("_names"), F.lit(name)).cast("int")
        return F.get(F.col("_cells"), F.nullif(at, F.lit(0)) - 1).try_cast(SPARK_TYPES[kind]).alias(name)

    return rows.select(*keys, (F.col("_row") + 1).alias("row_no"), *[cell(n, k) for n, k in fields.items()])
