"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructType

from tallybook.llm.blocks import lean, release, small_batches

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a document is never learned from: crc32 of its id as text is divisible by five."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> list[tuple[bytes, int]]:
    """At most ``rows`` (text, label) of labelled documents that are not held out.

    Which ones depends on hashes of their ids alone, not on the order of the rows. ``docs`` has
    ``doc_id`` and ``text``; ids without a 0 or 1 are not used, of several labels the highest is.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("_id"), F.col(f"`{label}`").cast("int").alias("_label"))
    known = known.where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out(F.col("_id")))
    known = known.groupBy("_id").agg(F.max("_label").alias("_label"))
    # At most ``rows`` of them, so small enough to send to every task.
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    found = docs.join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
    found = found.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows)
    rows = found.select("text", "_label").collect()[::-1]
    sample = []
    while rows:  # so that no text is there twice
        text, label = rows.pop()
        sample.append(((text or "").encode("utf-8", "replace"), label))
    return sample


def learned(fit: Callable, docs: DataFrame, labels: DataFrame, label: str, rows: int):
    """What ``fit`` makes of the sample; the driver's memory that both took goes back to the system."""
    lean()
    try:
        return fit(labelled_sample(docs, labels, label, rows))
    finally:
        release()


def with_scores(rows: DataFrame, text_column: str, name: str, scorer: Callable) -> DataFrame:
    """``rows`` with a column ``name``: what ``scorer()`` returns, called with each batch's texts."""
    small_batches(rows)

    def run(batches):
        lean()
        scores = scorer()
        for batch in batches:
            found = scores(batch.column(batch.schema.get_field_index(text_column)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, name]
            )
        release()

    return rows.mapInArrow(run, StructType([*rows.schema.fields]).add(name, DoubleType()))


def accepted(rows: DataFrame, text_column: str, scorer: Callable, keep: Callable[[Column], Column]) -> DataFrame:
    """The rows whose score passes ``keep``, with their columns as they were."""
    name = "_score"
    while name in rows.columns:
        name += "_"
    return with_scores(rows, text_column, name, scorer).where(keep(F.col(name))).drop(name)
