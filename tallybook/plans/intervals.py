"""Which windows hold a point in time, for windows given as rows: of any length, with gaps, overlapping.

A join on ``start <= at < end`` alone compares every point with every window. Here the windows' edges cut
time into spans, each with the list of windows that hold it, and points find their span either by a
sweep over sorted time or, where the spans are few enough to be sent to every task, through time cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallybook.plans.durable import written_table
from tallybook.plans.ordering import OFFSET_IN_SEGMENT, SEGMENT, in_ranges, number_rows, previous_value

SWEEP, CELLS = "sweep", "cells"
_FAN = 16  # spans, or nodes of one level, in a node of the next


def _placed(windows: DataFrame, starts: str, ends: str) -> tuple[DataFrame, DataFrame]:
    """Windows that hold time, with ``_from`` and ``_to``, the numbers of their edges; and all edges."""
    real = windows.where(F.col(starts) < F.col(ends))
    edges = real.select(F.col(starts).alias("edge")).union(real.select(F.col(ends))).distinct()
    edges = written_table(number_rows(edges, [], [F.col("edge")], "edge_no"), "edges")
    low = edges.select(F.col("edge").alias("_low"), F.col("edge_no").alias("_from"))
    high = edges.select(F.col("edge").alias("_high"), F.col("edge_no").alias("_to"))
    placed = real.join(low, F.col(starts) == F.col("_low")).join(high, F.col(ends) == F.col("_high"))
    return placed.select(*windows.columns, "_from", "_to"), edges


def spans(windows: DataFrame, starts: str, ends: str) -> DataFrame:
    """``span_start``, ``span_end`` and the columns of a window, one row per window and span it holds.

    Between two neighbouring edges the same windows are open. An edge's number is its place in the order of
    edges, so that a window holds the spans from the number of its start up to that of its end. Windows
    without a start or end, or that end before they start, hold nothing.
    """
    placed, edges = _placed(windows, starts, ends)
    held = placed.select(*windows.columns, F.explode(F.sequence("_from", F.col("_to") - 1)).alias("_no"))
    bounds = edges.select(F.col("edge_no").alias("_n"), F.col("edge").alias("span_start")).join(
        edges.select((F.col("edge_no") - 1).alias("_n"), F.col("edge").alias("span_end")), "_n"
    )
    return held.join(bounds, F.col("_no") == F.col("_n")).select(*windows.columns, "span_start", "span_end")


def _swept(
    points: DataFrame, at: str, tie: str, edges: DataFrame, ranges: int | None, mark: str = "edge"
) -> DataFrame:
    """``points`` with ``_span``, the last edge at or before them; NULL before all edges.

    ``mark`` is the column of ``edges`` that names an edge, and rises with time.

    Edges and points are sorted together in ranges of time; within a range the last edge so far is
    carried from row to row, and the last edge of all earlier ranges comes from one row per range. A span
    with a third of all points lies over many ranges, and equal times may be split, as ``tie`` orders them.
    """
    names = [F.col(c) for c in points.columns]
    marks = edges.select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in points.schema], F.col("edge").alias("_at"), F.col(mark).alias("_edge")
    )
    both = points.select(*names, F.col(at).alias("_at"), F.lit(None).cast(edges.schema[mark].dataType).alias("_edge")).union(marks)
    # An edge comes before the points of its own time.
    order = [F.col("_at"), F.col("_edge").isNull(), F.col(tie)]
    ranged = in_ranges(both, order, "swept", ranges)
    before = Window.partitionBy(SEGMENT).orderBy(OFFSET_IN_SEGMENT).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_local", F.last("_edge", ignorenulls=True).over(before))
    # One row per range.
    lasts = ranged.groupBy(SEGMENT).agg(F.max("_edge").alias("_last"))
    earlier = Window.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select(F.col(SEGMENT).alias("_s"), F.max("_last").over(earlier).alias("_carry"))
    carried = written_table(carried, "carried")
    return (
        local.where(F.col("_edge").isNull()).join(carried, F.col(SEGMENT) == F.col("_s"))
        .select(*names, F.coalesce("_local", "_carry").alias("_span"))
    )


def _seconds(at: Column) -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), at)


def held_by(
    points: DataFrame, at: str, tie: str, windows: DataFrame, starts: str, ends: str, layout: str = SWEEP,
    ranges: int | None = None, cell_seconds: int = 86_400,
) -> DataFrame:
    """Every point with every window that holds it (``starts <= at < ends``); other points drop out.

    Both tables keep their columns, which must differ in name. ``tie`` is a unique column of the points.
    ``sweep`` sorts points and edges together, for any number of windows. ``cells`` joins on the cell of time
    a point and a span lie in, which leaves the points where they are while the spans are small
    enough for the planner to send them round; a span has a row for every cell it touches.
    """
    if layout not in (SWEEP, CELLS):
        raise ValueError(f"no such layout: {layout}")
    held = written_table(spans(windows, starts, ends), "spans")
    timed = points.where(F.col(at).isNotNull())
    if layout == SWEEP:
        edges = held.select(F.col("span_start").alias("edge")).union(held.select("span_end")).distinct()
        found = _swept(timed, at, tie, edges, ranges)
        # A span is its start; where no window is open the last edge starts no span.
        return found.join(held.withColumnRenamed("span_start", "_start"), F.col("_span") == F.col("_start")).select(
            *points.columns, *windows.columns
        )
    cells = held.withColumn("_cell", F.explode(F.sequence(
        F.floor(_seconds(F.col("span_start")) / cell_seconds), F.floor(_seconds(F.col("span_end")) / cell_seconds)
    )))
    inside = (F.col(at) >= F.col("span_start")) & (F.col(at) < F.col("span_end"))
    place = F.floor(_seconds(F.col(at)) / cell_seconds)
    return timed.withColumn("_place", place).join(cells, (F.col("_place") == F.col("_cell")) & inside).select(
        *points.columns, *windows.columns
    )


def _node(level: int, levels: int, number: Column) -> Column:
    """One number for a node: the ``number``-th of ``_FAN ** level`` spans each."""
    return number * levels + level


def _nodes_of_windows(levels: int) -> Column:
    """The fewest nodes that make up the spans from ``_from`` up to ``_to``: under 2 * ``_FAN`` a level."""
    low, high, found = F.col("_from"), F.col("_to"), []

    def some(first: Column, end: Column, level: int) -> Column:
        numbers = F.when(first < end, F.sequence(first, end - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(numbers, lambda n: _node(level, levels, n))

    for level in range(levels - 1):
        after = F.least(F.ceil(low / _FAN).cast("bigint") * _FAN, high)
        before = F.greatest(F.floor(high / _FAN).cast("bigint") * _FAN, after)
        found += [some(low, after, level), some(before, high, level)]
        low, high = F.ceil(after / _FAN).cast("bigint"), F.floor(before / _FAN).cast("bigint")
    return F.concat(*found, some(low, high, levels - 1))


def _before_marks(weights: DataFrame, marks: DataFrame, ranges: int | None) -> DataFrame:
    """``marks`` with ``_sum``, all weights before them in the order of (``_node``, ``_at``).

    Both are sorted together in ranges; the sums of earlier ranges come from one row per range.
    """
    names = marks.columns
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in marks.schema if f.name not in ("_node", "_at")]
    both = marks.select("_node", "_at", *[c for c in names if c not in ("_node", "_at")], F.lit(0).cast("bigint").alias("_weight")).union(
        weights.select("_node", "_at", *none, F.col("_weight"))
    ).withColumn("_is_mark", F.col("_weight") == 0)
    # A mark comes before the weights of its own place.
    order = [F.col("_node"), F.col("_at"), F.col("_is_mark").desc(), *[F.col(c) for c in names if c not in ("_node", "_at")]]
    ranged = in_ranges(both, order, "weighed", ranges)
    so_far = Window.partitionBy(SEGMENT).orderBy(OFFSET_IN_SEGMENT).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_local", F.sum("_weight").over(so_far))
    totals = ranged.groupBy(SEGMENT).agg(F.sum("_weight").alias("_total"))
    earlier = Window.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(F.col(SEGMENT).alias("_s"), F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_carry"))
    carried = written_table(carried, "carried")
    return local.where("_is_mark").join(carried, F.col(SEGMENT) == F.col("_s")).select(
        *names, (F.col("_local") + F.col("_carry")).alias("_sum")
    )


def counted_in(
    points: DataFrame, at: str, tie: str, who: str, windows: DataFrame, starts: str, ends: str, ranges: int | None = None
) -> DataFrame:
    """``points`` and distinct ``who`` in every window, without pairing points with windows.

    ``windows`` has the columns ``starts`` and ``ends`` alone; equal ones come once, those that hold no time not
    at all. However many windows are open at a time, a point is one row per level of a tree over the spans, and
    a window a few rows per level.

    The points of a window are those before its end less those before its start. Somebody is new to a window
    that starts at edge i where their span is in it and their span before that is before i. Spans are joined to
    nodes of ``_FAN`` spans, these to nodes of as many nodes, and so on: a window is made up of few of them, and in each of
    these the rows whose span before is before i are counted. All sums are differences of one running sum.
    """
    placed, edges = _placed(windows.select(starts, ends).distinct(), starts, ends)
    placed = written_table(placed, "placed")
    longest = placed.agg(F.max(F.col("_to") - F.col("_from"))).first()[0] or 1
    levels = 1
    while _FAN**levels <= longest:
        levels += 1
    timed = points.where(F.col(at).isNotNull())
    found = _swept(timed, at, tie, edges, ranges, "edge_no").where(F.col("_span").isNotNull())
    seen = found.groupBy("_span", F.col(who).alias("_who")).agg(F.count(F.lit(1)).alias("_n"))
    seen = written_table(seen, "seen")
    last = previous_value(seen.where(F.col("_who").isNotNull()).select("_who", "_span"), "_who", [F.col("_span")], "_span", "_last", ranges)
    news = last.groupBy("_span", F.coalesce("_last", F.lit(0)).cast("bigint").alias("_at")).agg(F.count(F.lit(1)).alias("_weight"))
    news = written_table(news, "news")

    def level_rows(level: int) -> DataFrame:
        # Who was in the same node before is new to no window that holds all of it.
        number = F.floor(F.col("_span") / _FAN**level).cast("bigint")
        rows = news.where(F.col("_at") < number * _FAN**level)
        return rows.groupBy(_node(level, levels, number).alias("_node"), "_at").agg(F.sum("_weight").alias("_weight"))

    # Node -1 holds all points by their spans.
    all_points = F.lit(-1).cast("bigint")
    weights = seen.groupBy(F.col("_span").alias("_at")).agg(F.sum("_n").alias("_weight")).select(all_points.alias("_node"), "_at", "_weight")
    for level in range(levels):
        weights = weights.union(level_rows(level).select("_node", "_at", "_weight"))

    def mark(node: Column, place: Column, sign: int) -> Column:
        return F.struct(node.alias("_node"), place.cast("bigint").alias("_at"), F.lit(sign).alias("_sign"))

    ask = F.concat(
        F.array(mark(all_points, F.col("_from"), -1), mark(all_points, F.col("_to"), 1)),
        F.transform(_nodes_of_windows(levels), lambda n: mark(n, F.lit(-1), -1)),
        F.transform(_nodes_of_windows(levels), lambda n: mark(n, F.col("_from"), 1)),
    )
    marks = placed.select("_from", "_to", F.explode(ask).alias("_mark")).select("_mark.*", "_from", "_to")
    sums = _before_marks(weights, marks, ranges)
    part = F.col("_sum") * F.col("_sign")
    counted = sums.groupBy(F.col("_from").alias("_f"), F.col("_to").alias("_t")).agg(
        F.sum(F.when(F.col("_node") < 0, part)).alias("points"), F.sum(F.when(F.col("_node") >= 0, part)).alias(who)
    )
    return placed.join(counted, (F.col("_from") == F.col("_f")) & (F.col("_to") == F.col("_t"))).select(
        starts, ends, "points", who
    )
