"""Connected components of a table of links, without gathering links or labels anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallybook.llm.blocks import written_table


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for every node of ``links(a, b)``.

    Every round lets each node follow its smallest neighbour twice, then keeps the links between
    nodes that still differ, so the links shrink by a constant factor or more. All steps are
    aggregates that combine before the shuffle, or joins on them; every round is a written table.
    Null ends and self-links are ignored; an empty table gives an empty result.
    """
    links = links.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b"))
    links = written_table(links.where("a != b").distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = nodes.withColumn("component", F.col("node"))
    while not links.isEmpty():
        both = links.union(links.select("b", "a")).groupBy("a").agg(F.min("b").alias("b"))
        step = both.select(F.col("a").alias("v"), F.least("a", "b").alias("m"))
        hop = step.select(F.col("v").alias("m"), F.col("m").alias("mm"))
        step = step.join(hop, "m", "left").select("v", F.coalesce("mm", "m").alias("m"))
        step = written_table(step, "steps")
        labels = labels.join(step, F.col("component") == F.col("v"), "left")
        labels = written_table(labels.select("node", F.coalesce("m", "component").alias("component")), "labels")
        left = step.select(F.col("v").alias("a"), F.col("m").alias("a2"))
        right = step.select(F.col("v").alias("b"), F.col("m").alias("b2"))
        links = links.join(left, "a").join(right, "b").where("a2 != b2")
        links = written_table(
            links.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "links"
        )
    return labels


def joined(named: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` of the links behind ``named`` and of ``links(a, b)``, which must be a written table.

    Only links between components are looked at, under the components' names; without any link,
    ``named`` stays as it is.
    """
    links = links.where("a != b")
    if links.isEmpty():
        return named
    for end in ("a", "b"):
        known = named.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
        links = links.join(known, F.col(end) == F.col("_node"), "left")
        links = links.withColumn(f"c{end}", F.coalesce("_component", end)).drop("_node", "_component")
    links = written_table(links.select("a", "b", "ca", "cb"), "between")
    merged = components(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    # An end that was in no component so far is its own.
    ends = links.select(F.col("a").alias("node"), F.col("ca").alias("component"))
    ends = ends.union(links.select("b", "cb")).where("node = component")
    known = named.union(ends.distinct()).distinct()
    merged = merged.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    known = known.join(merged, F.col("component") == F.col("_node"), "left")
    return written_table(known.select("node", F.coalesce("_component", "component").alias("component")), "named")
