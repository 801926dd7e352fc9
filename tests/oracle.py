"""Compare a Spark result with DuckDB's answer to the query's SQL: names, types and values."""

import math
from collections import Counter
from pathlib import Path

import duckdb

DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def connect(folder):
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def compare(df, con, sql):
    """A list of differences; empty if both sides agree."""
    described = [(r[0], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()]
    ours = sorted((n, DUCK_TYPES.get(t, t)) for n, t in df.dtypes)
    problems = []
    if ours != sorted(described):
        problems.append(f"schema: {ours} != {sorted(described)}")
    names = sorted(df.columns)
    spark_rows = Counter(tuple(_cell(r[n]) for n in names) for r in df.collect())
    at = {n: i for i, (n, _) in enumerate(described)}
    if sorted(at) != names:
        return problems
    duck_rows = Counter(tuple(_cell(r[at[n]]) for n in names) for r in con.execute(sql).fetchall())
    if spark_rows != duck_rows:
        extra, missing = spark_rows - duck_rows, duck_rows - spark_rows
        problems.append(
            f"rows: {sum(spark_rows.values())} and {sum(duck_rows.values())}; "
            f"only in Spark {list(extra)[:3]}; only in SQL {list(missing)[:3]}"
        )
    return problems
