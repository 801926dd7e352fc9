"""One large JSON array of objects, read by as many tasks as its file has ranges.

The multi-line reader takes a whole file in one task, since it cannot know where in an array a byte
range starts. Here the file is read as pieces that end with a closing brace, in byte ranges. Whether a
piece starts inside a string is the parity of the quotes before it, and how deep it lies is the sum
of the brackets before it; both are prefix sums over pieces, within a range first, then over the few ranges
of a file. A record ends with each brace that closes an element of the outer array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tallybook.plans.durable import written_table

_END = "}"
# The parts of JSON text that tell strings from structure.
_ESCAPE = r"\\(?s:.)"
_STRING = '"[^"]*"'


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, range_start, place, piece, quotes, change_0, change_1``, written once.

    ``quotes`` is the parity of the quotes in a piece; ``change_0`` and ``change_1`` tell how many brackets it
    opens more than it closes, if it starts outside or inside a string.
    """
    raw = spark.read.option("lineSep", _END).text(path).select(
        F.col("value").alias("piece"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range_start"),
        # A range is read in order by one task.
        F.monotonically_increasing_id().alias("place"),
    )
    # Escapes occur in strings only, and a brace is never escaped, so no escape is cut.
    plain = F.regexp_replace("piece", _ESCAPE, "")
    outside = F.regexp_replace(F.regexp_replace("_plain", _STRING, ""), '"[^"]*$', "")
    inside = F.regexp_replace(F.regexp_replace(F.concat(F.lit('"'), "_plain"), _STRING, ""), '"[^"]*$', "")

    def change(text: Column) -> Column:
        return _count(text, "[{") - _count(text, "]}")

    return written_table(
        raw.withColumn("_plain", plain).select(
            "file", "range_start", "place", "piece", F.pmod(_count(F.col("_plain"), '"'), F.lit(2)).alias("quotes"),
            change(outside).alias("change_0"), change(inside).alias("change_1"),
        ),
        "json-pieces",
    )


def _count(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def _before(pieces: DataFrame, value: Column, name: str) -> DataFrame:
    """``pieces`` with the sum of ``value`` over all earlier pieces of the file."""
    earlier = Window.partitionBy("file", "range_start").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    valued = pieces.withColumn("_value", value)
    local = valued.withColumn("_local", F.coalesce(F.sum("_value").over(earlier), F.lit(0)))
    # One row per byte range.
    totals = valued.groupBy("file", "range_start").agg(F.sum("_value").alias("_total"))
    ranges = Window.partitionBy("file").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col("file").alias("_f"), F.col("range_start").alias("_r"),
        F.coalesce(F.sum("_total").over(ranges), F.lit(0)).alias("_start"),
    )
    joined = local.join(written_table(starts, "starts"), (F.col("file") == F.col("_f")) & (F.col("range_start") == F.col("_r")))
    return joined.withColumn(name, F.col("_local") + F.col("_start")).drop("_value", "_local", "_f", "_r", "_start")


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, record_no, record``: the elements of each file's array, as JSON text, numbered from 1.

    Files hold one array of objects each, on one line or many; other elements are not records. Records are
    put together from their pieces, so one of them must fit a task.
    """
    with_quotes = _before(_pieces(spark, path), F.col("quotes"), "_quotes")
    inside = F.pmod(F.col("_quotes"), F.lit(2)) == 1
    string_open = F.pmod(F.col("_quotes") + F.col("quotes"), F.lit(2)) == 1
    # The brace that ends a piece is structure unless a string is open; the last piece of a file has none, but
    # there only the outer array is closed.
    closes = F.when(string_open, 0).otherwise(1)
    stepped = with_quotes.select(
        "file", "range_start", "place", "piece", closes.alias("_closes"),
        (F.when(inside, F.col("change_1")).otherwise(F.col("change_0"))).alias("_change"),
    )
    deep = _before(stepped, F.col("_change") - F.col("_closes"), "_depth")
    # Depth 1 is the outer array.
    ends = (F.col("_closes") == 1) & (F.col("_depth") + F.col("_change") - F.col("_closes") == 1)
    numbered = _before(deep.withColumn("_ends", ends.cast("int")), F.col("_ends"), "_no")
    pieces = F.sort_array(F.collect_list(F.struct("range_start", "place", "piece")))
    gathered = numbered.groupBy("file", (F.col("_no") + 1).alias("record_no")).agg(
        pieces.alias("_pieces"), F.max("_ends").alias("_whole")
    )
    text = F.concat(F.array_join(F.transform("_pieces", lambda p: p["piece"]), _END), F.lit(_END))
    # In front of a record stand the outer bracket or a comma.
    record = F.regexp_replace(text, r"^[\s,\[\uFEFF]+", "")
    return gathered.where("_whole = 1").select("file", "record_no", record.alias("record"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The elements of JSON arrays as typed rows, without an order; what cannot be parsed is a row of NULLs."""
    return json_records(spark, path).select(F.from_json("record", schema).alias("_r")).select("_r.*")
