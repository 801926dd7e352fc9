"""Helpers the operators share: packed arrays, hashes over text buffers, run tables.

Many small values travel as packed arrays in binary columns, so that a shuffle moves a few bytes a
value and a task works on whole arrays.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tallybook.plans.durable import written_table
from tallybook.plans.ordering import number_rows

# A text batch is cut to about this many bytes, so that the 8-byte arrays over it stay small.
BATCH_BYTES = 1 << 19
BATCH_TRANSFER = 4 << 20  # bytes between the JVM and a task's Python at a time

_TRIM_THRESHOLD, _MMAP_THRESHOLD = -1, -3  # fixed values: names of settings in the C library

_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x *= _MIX_1
    x ^= x >> np.uint64(27)
    x *= _MIX_2
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, out=out)


_tables: dict[str, np.ndarray] = {}


def powers(count: int, inverse: bool = False) -> np.ndarray:
    """Powers of the rolling hash's base (or of its inverse) modulo 2**64."""
    base = pow(int(_MULTIPLIER), -1, 1 << 64) if inverse else int(_MULTIPLIER)
    key = f"{inverse}"
    if key not in _tables or len(_tables[key]) < count:
        _tables[key] = _powers(base, max(count, BATCH_BYTES + 2))
    return _tables[key][:count]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash of a byte array; ``span_hashes`` reads any span off it."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(BYTE_VALUES[data] * powers(len(data)), out=out[1:])
    return out


def span_hashes(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end): equal for equal bytes, wherever they are."""
    back = powers(len(running), inverse=True)
    return mix((running[ends] - running[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def pack(values: np.ndarray) -> bytes:
    """An array as compressed bytes, planes of equal significance together."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(blob: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(dtype)


def pack_sorted(values: np.ndarray) -> bytes:
    """A sorted uint64 array, as differences."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint64), dtype=np.uint64)


def text_array(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty. Nothing is decoded."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(column) else np.empty(0, np.uint8)
    return data, offsets - (offsets[0] if len(column) else 0)


def cut_batch(offsets: np.ndarray, limit: int = BATCH_BYTES):
    """Row ranges of about ``limit`` bytes each; a longer text is a range of its own."""
    start = 0
    while start < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), len(offsets) - 1)
        yield start, end
        start = end


def lean() -> None:
    """Let every array of a megabyte or more go back to the system as soon as it is freed.

    For the start of a task: left alone, the C library keeps ever larger ones for itself once a large one was freed.
    """
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(_MMAP_THRESHOLD, 1 << 20)
        libc.mallopt(_TRIM_THRESHOLD, 1 << 20)
    except (AttributeError, OSError):  # not with this C library
        pass


def release() -> None:
    """Give memory that is free back to the system; a process lives on from task to task, and from stage to stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not with this C library
        pass


def releasing(run):
    """A function of one group's table that releases what it took."""

    def one(table: pa.Table) -> pa.Table:
        lean()
        try:
            return run(table)
        finally:
            release()

    return one


def text_batches(batches, id_column: str = "doc_id", text_column: str = "text"):
    """(ids, bytes, offsets) of batches of bounded size; rows without an id are skipped."""
    lean()
    for batch in batches:
        ids = batch.column(id_column)
        if ids.null_count:
            batch = batch.filter(ids.is_valid())
            ids = batch.column(id_column)
        if not batch.num_rows:
            continue
        data, offsets = text_array(batch.column(text_column))
        ids = ids.to_numpy(zero_copy_only=False)
        for a, b in cut_batch(offsets):
            yield ids[a:b], data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
    release()


def table_rows(batch_columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(batch_columns[f.name], type=f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def partitions(df: DataFrame) -> int:
    """Number of shuffle partitions, which the session sets in proportion to the input."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def small_batches(df: DataFrame) -> None:
    """Let tasks hand texts over in batches of a few megabytes, however many rows those are."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key) != str(BATCH_TRANSFER):
        conf.set(key, str(BATCH_TRANSFER))


def documents(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The two columns the operators read, under fixed names; other columns may be called anything."""
    small_batches(df)
    return df.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))


def zipped(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``ztext``: texts compressed before they are shuffled; null is empty."""

    def run(batches):
        lean()
        pack_text = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data, offsets = text_array(batch.column("text"))
            view = memoryview(np.ascontiguousarray(data))
            texts = [pack_text.compress(view[a:b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.binary())], names=["doc_id", "ztext"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ztext binary")


def unzip(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def unique_ids(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with every row under an id of its own, and the ids' names where new ones were needed.

    Only if an id is missing or repeated are rows numbered, by (id, text); the names then hold
    ``doc_id`` and the id it stands for, ``outer_id``.
    """
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.where("n > 1 OR doc_id IS NULL").isEmpty():
        return docs, None
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    numbered = written_table(number_rows(docs, [], order, "_key"), "numbered")
    return (
        numbered.select(F.col("_key").alias("doc_id"), "text"),
        numbered.select(F.col("_key").alias("doc_id"), F.col("doc_id").alias("outer_id")),
    )


def outer_ids(result: DataFrame, names: DataFrame | None, *columns: str) -> DataFrame:
    """The ids the caller knows, in ``columns``."""
    if names is None:
        return result
    for column in columns:
        named = names.select(F.col("doc_id").alias("_key"), F.col("outer_id").alias("_name"))
        order = [F.col("_name").alias(column) if c == column else F.col(c) for c in result.columns]
        result = result.join(named, F.col(column) == F.col("_key"), "left").select(*order)
    return result
