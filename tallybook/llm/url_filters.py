"""Allow and block rules on URL prefixes: a sort-merge range join, in DataFrame operations only.

A rule is a host, which stands for all its subdomains too, and the start of a path. The key of a
rule is its host with the labels reversed, an end mark, and its path; a URL has one such key for
every domain its host belongs to, so that a rule fits exactly if its key starts one of them, and
every rule is one interval of keys. Rules and URL keys are sorted together into ranges and swept in
order: the last rule at or before a key, with the rules that enclose it, is the stack of rules that
can still be open there. The innermost one that holds the key is that domain's; of a URL's domains
the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallybook.llm.blocks import written_table
from tallybook.plans.ordering import OFFSET_IN_SEGMENT, SEGMENT, in_ranges

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Sorts before everything that can follow, so that a domain's keys lie together.
_END = "\u0001"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _reversed(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), ".")


def _keyed(rules: DataFrame) -> DataFrame:
    """``key``, ``rule``: one per host and path; block beats allow where both are given."""
    host = F.translate(F.col("host"), _UPPER, _LOWER)
    path = F.coalesce(F.col("path"), F.lit(""))
    cleaned = rules.where("host IS NOT NULL AND verdict IS NOT NULL").select(
        host.alias("host"), path.alias("path"), F.col("verdict").alias("verdict")
    )
    cleaned = cleaned.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    key = F.concat(_reversed(F.split("host", r"\.")), F.lit(_END), "path")
    rule = F.struct(
        F.length(F.concat("host", "path")).alias("size"), F.length("host").alias("host_size"), key.alias("key"),
        F.concat("host", "path").alias("text"), "verdict",
    )
    return cleaned.select(key.alias("key"), F.length("path").alias("path_size"), rule.alias("rule"))


def _stacks(rules: DataFrame) -> DataFrame:
    """Each rule's key with the rules that enclose it, itself included."""
    head = F.length("key") - F.col("path_size")
    starts = F.transform(F.sequence(head, F.length("key")), lambda n: F.left("key", n))
    outer = rules.select("key", F.explode(starts).alias("start"))
    inner = rules.select(F.col("key").alias("start"), "rule")
    return outer.join(inner, "start").groupBy("key").agg(F.collect_list("rule").alias("stack"))


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url",
    default: str = "allow", ranges: int | None = None,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` for every row of ``pages``.

    ``rules`` has ``host``, ``path``, ``verdict`` (allow or block). A rule fits its host and all
    subdomains if the path starts with its own; the longest (host and path, then host) wins. Where
    none fits, ``rule`` is null and the verdict is ``default``. A null URL, or one without ``://``,
    has an empty host and path. Rows that repeat an id, or have none, are judged each. Rules with a
    null host or verdict do not count; of rules for the same host and path, block wins. Other
    columns are ignored; an empty table gives no rows.
    """
    host, path = host_and_path(F.col(f"`{url_column}`"))
    base = pages.select(F.col(f"`{id_column}`").alias("page_id"), host.alias("host"), path.alias("path"))
    base = written_table(base.withColumn("row", F.monotonically_increasing_id()), "urls")
    labels = F.split("host", r"\.")
    count = F.size(labels)
    domains = F.transform(
        F.sequence(F.lit(1), count), lambda n: F.concat(_reversed(F.slice(labels, count - n + 1, n)), F.lit(_END), F.col("path"))
    )
    stacks = _stacks(_keyed(rules))
    empty = F.lit(None).cast(stacks.schema["stack"].dataType)
    keys = base.select("row", F.explode(domains).alias("key"), empty.alias("stack"))
    swept = in_ranges(
        stacks.select(F.lit(-1).cast("bigint").alias("row"), "key", "stack").unionByName(keys),
        [F.col("key"), F.col("row")], "sweep", ranges,
    )
    within = Window.partitionBy(SEGMENT).orderBy(OFFSET_IN_SEGMENT)
    local = swept.withColumn("open", F.last("stack", ignorenulls=True).over(within))
    # The last rule before each range: one row a range.
    lasts = swept.where(F.col("stack").isNotNull()).groupBy(SEGMENT).agg(F.max_by("stack", OFFSET_IN_SEGMENT).alias("last"))
    lasts = written_table(swept.select(SEGMENT).distinct().join(lasts, SEGMENT, "left"), "range-ends")
    before = Window.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select(SEGMENT, F.last("last", ignorenulls=True).over(before).alias("carried"))
    opened = local.where("row >= 0").join(carried, SEGMENT).withColumn("open", F.coalesce("open", "carried"))
    holds = F.filter("open", lambda rule: F.startswith(F.col("key"), rule["key"]))
    inner = F.array_max(holds)
    best = opened.select("row", inner.alias("rule")).where("rule IS NOT NULL").groupBy("row").agg(F.max("rule").alias("rule"))
    return base.join(best, "row", "left").select(
        "page_id", "host", "path", F.col("rule.text").alias("rule"), F.coalesce("rule.verdict", F.lit(default)).alias("verdict")
    )


# The rules of the query.
QUERY_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def query_rules(spark) -> DataFrame:
    """The query's rules as a table of constants, made by the JVM."""
    rows = F.inline(F.array(*[
        F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in QUERY_RULES
    ]))
    return spark.range(1).select(rows)
