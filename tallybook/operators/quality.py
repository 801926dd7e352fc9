"""Rules a table should keep, counted instead of enforced."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _report(counted: DataFrame, rule: str, subject: str) -> DataFrame:
    return counted.select(
        F.lit(rule).alias("rule"), F.lit(subject).alias("subject"),
        F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("violations"),
    )


def not_null_violations(t: DataFrame, label: str, cols: list[str]) -> DataFrame:
    """Rows with NULL, per column; one scan for all columns."""
    counts = F.array(
        *[F.struct(F.lit(f"{label}.{c}").alias("subject"), F.count_if(F.col(c).isNull()).alias("n")) for c in cols]
    )
    return t.agg(counts.alias("c")).select(F.explode("c").alias("c")).select(
        F.lit("not_null").alias("rule"), F.col("c.subject").alias("subject"), F.col("c.n").alias("violations")
    )


def unique_violations(t: DataFrame, label: str, cols: list[str]) -> DataFrame:
    """Rows beyond the first of each key; keys with a NULL part are not compared."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    extra = t.where(complete).groupBy(*cols).agg((F.count(F.lit(1)) - 1).alias("_extra"))
    return _report(extra.agg(F.sum("_extra").alias("_n")), "unique", f"{label}.{'+'.join(cols)}")


def foreign_key_violations(t: DataFrame, label: str, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Rows whose key has no parent; rows are counted per key before the join."""
    keys = t.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    orphans = keys.join(parent, F.col("_key") == F.col(parent_col), "left_anti")
    return _report(orphans.agg(F.sum("_rows").alias("_n")), "foreign_key", f"{label}.{col}")


@dataclass(frozen=True)
class Rules:
    """What one table should keep: columns without NULL, keys without a second row, columns with a parent."""

    label: str
    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: tuple[tuple[str, DataFrame, str], ...] = ()  # column, parent table, parent's column


def table_report(t: DataFrame, rules: Rules) -> DataFrame:
    """All rules of a table counted in one pass: one scan of it, one of each parent, and one shuffle.

    Grouping sets over the keys of all rules count rows per key, combined before the shuffle. Parents come
    along as rows that are counted apart, so that a key without one shows in its own group, without a
    join. NULL parts of a key, and NULL references, break no rule.
    """
    singles = [(c,) for c, _, _ in rules.foreign]
    sets = list(dict.fromkeys([*rules.unique, *singles, ()]))
    cols = list(dict.fromkeys(c for s in sets for c in s))
    read = list(dict.fromkeys([*cols, *rules.not_null]))
    rows = t.select(*read, F.lit(0).alias("_parent"))
    for column, parent, key in rules.foreign:
        blanks = [
            (F.col(key).cast(t.schema[c].dataType) if c == column else F.lit(None).cast(t.schema[c].dataType)).alias(c)
            for c in read
        ]
        number = 1 + singles.index((column,))
        rows = rows.union(parent.where(F.col(key).isNotNull()).select(*blanks, F.lit(number).alias("_parent")))
    nulls = [F.count_if((F.col("_parent") == 0) & F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(rules.not_null)]
    parents = [F.count_if(F.col("_parent") == i + 1).alias(f"_parents_{i}") for i in range(len(singles))]
    counted = rows.groupingSets([list(s) for s in sets], *cols).agg(
        F.grouping_id().alias("_set"), F.count_if(F.col("_parent") == 0).alias("_rows"), *nulls, *parents
    )

    def in_set(keys: tuple[str, ...]) -> Column:
        """Groups of one grouping set: a bit is set for each column left out of it."""
        left_out = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in keys)
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys], F.lit(True))
        return (F.col("_set") == left_out) & whole

    none = F.lit(0).cast("bigint")
    found = [
        ("not_null", f"{rules.label}.{c}", F.sum(F.when(in_set(()), F.col(f"_null_{i}")))) for i, c in enumerate(rules.not_null)
    ] + [
        ("unique", f"{rules.label}.{'+'.join(keys)}", F.sum(F.when(in_set(keys) & (F.col("_rows") > 1), F.col("_rows") - 1)))
        for keys in rules.unique
    ] + [
        ("foreign_key", f"{rules.label}.{keys[0]}", F.sum(F.when(in_set(keys) & (F.col(f"_parents_{i}") == 0), F.col("_rows"))))
        for i, keys in enumerate(singles)
    ]
    report = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(subject).alias("subject"), F.coalesce(n, none).cast("bigint").alias("violations"))
        for rule, subject, n in found
    ])
    return counted.agg(report.alias("_r")).select(F.explode("_r").alias("_r")).select("_r.*")


def constraint_report(parts: list[DataFrame]) -> DataFrame:
    """The counts of several rules as one table."""
    return reduce(lambda a, b: a.unionByName(b), parts)
