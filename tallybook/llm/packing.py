"""Packing documents into sequences of a fixed number of tokens, first fit decreasing.

Texts become token ids in the task that reads them; ids are cut at multiples of the sequence
length, and only sizes go on from there. Pieces are dealt at random into groups of bounded size,
and each group is packed on its own: pieces from the largest to the smallest, each into the first
sequence that has room for it. A tournament tree over the free room of all sequences finds that
one in a logarithmic number of steps.
"""

from __future__ import annotations

import os
import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallybook.llm.blocks import documents, lean, partitions, release, releasing, written_table
from tallybook.llm.parts import PLAIN_WORD, PartTable, folded_parts, slices, spelled

END_OF_DOCUMENT = 2  # fixed value: the id after each document
GROUP_PIECES = 4096  # pieces packed together on average
_TOGETHER = 1000  # new parts encoded in one call

_tables: dict[str, PartTable] = {}


def id_table(path: str) -> PartTable:
    """A table from distinct parts of texts to their ids; one per task process.

    The vocabulary drops white space and joins nothing over it, so that a text's ids are those of its
    parts. New parts of plain letters go straight to the vocabulary's merges; others are encoded many at a
    time, with a special token between, which ends a part as white space does.
    """
    if path not in _tables:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(path)
        between = "<|endoftext|>"
        mark = tokenizer.token_to_id(between)

        def encoded(text: str) -> list[int]:
            return tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

        merged = tokenizer.model.tokenize

        def learn(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            found: list[list[int]] = [[]] * len(parts)
            others = []
            for i, part in enumerate(parts):
                if PLAIN_WORD(part):
                    found[i] = [token.id for token in merged(spelled(part))]
                elif "<|" in part or "|>" in part:
                    # What may hold something of a special token is encoded by itself.
                    found[i] = encoded(part)
                else:
                    others.append(i)
            for low in range(0, len(others), _TOGETHER):
                some = others[low : low + _TOGETHER]
                ids = encoded(between.join([parts[i] for i in some]))
                ends = [i for i, id in enumerate(ids) if id == mark] + [len(ids)]
                for i, start, end in zip(some, [0, *(e + 1 for e in ends)], ends):
                    found[i] = ids[start:end]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

        _tables[path] = PartTable(learn, np.uint32)
    return _tables[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, length: int = 4096, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens`` (and ``ids``, as bytes) per piece.

    A null or empty text is the end id alone.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    schema = pa.schema([(n, pa.int64()) for n in names] + [("ids", pa.binary())] * keep_ids)
    end = struct.pack("<I", END_OF_DOCUMENT)

    def run(batches):
        lean()
        table = id_table(vocabulary or default_vocabulary())
        for batch in batches:
            for first, texts in slices(batch.column("text")):
                found, bounds = table.gather(*folded_parts(texts))
                raw = memoryview(found.astype("<u4", copy=False)).cast("B")
                rows: dict[str, list] = {n: [] for n in schema.names}
                for doc, a, b in zip(batch.column("doc_id").slice(first, len(texts)).to_pylist(), bounds, bounds[1:]):
                    ids = raw[4 * a : 4 * b].tobytes() + end
                    total = len(ids) // 4
                    for start in range(0, total, length):
                        piece = ids[4 * start : 4 * (start + length)]
                        row = (doc, start, len(piece) // 4, zlib.crc32(piece), total, piece)
                        for name, value in zip(schema.names, row):
                            rows[name].append(value)
                yield pa.RecordBatch.from_pydict(rows, schema=schema)
                pa.default_memory_pool().release_unused()
        release()

    kinds = ", ".join(f"{n} long" for n in names) + (", ids binary" if keep_ids else "")
    return docs.mapInArrow(run, kinds)


def first_fit_decreasing(sizes: list[int], room: int) -> tuple[list[int], list[int]]:
    """(bin, offset in it) for each size, in the given order of sizes, which must not increase.

    Leaves of the tree are bins, from left to right in the order they are opened; a node holds the
    most free room below it.
    """
    width = 1
    while width < max(1, len(sizes)):
        width *= 2
    tree = [room] * (2 * width)
    bins, offsets = [], []
    for size in sizes:
        node = 1
        while node < width:
            node *= 2
            if tree[node] < size:
                node += 1
        bins.append(node - width)
        offsets.append(room - tree[node])
        tree[node] -= size
        while node > 1:
            node //= 2
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left >= right else right
    return bins, offsets


def pack(
    docs: DataFrame, length: int = 4096, vocabulary: str | None = None, keep_ids: bool = False,
    group_pieces: int = GROUP_PIECES, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per piece: ``pieces`` with ``sequence_id`` and ``offset`` in the sequence.

    Offsets of a sequence have no gaps; what is left of its ``length`` is padding. Null and empty
    texts are one end id. Rows that repeat an id, or have none, are documents of their own. Other
    columns are ignored; an empty table gives no rows.
    """
    cut = pieces(documents(docs, id_column, text_column), length, vocabulary, keep_ids)
    # Fixed by writing: the deal into groups must not change when a lost task is run again.
    cut = written_table(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, cut.count() // group_pieces)

    def run(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        sizes = table.column("length").to_numpy()
        order = np.lexsort((table.column("row").to_numpy(), -sizes))
        bins, offsets = first_fit_decreasing(sizes[order].tolist(), length)
        found = table.take(pa.array(order)).drop_columns(["group", "row"])
        found = found.append_column("sequence_id", pa.array(np.array(bins, np.int64) + (group << 32)))
        return found.append_column("offset", pa.array(np.array(offsets, np.int64)))

    group = F.pmod(F.xxhash64("row"), F.lit(groups)).alias("group")
    kinds = ", ".join(f"{n} {t}" for n, t in cut.dtypes if n != "row")
    dealt = cut.select(group, "*").repartition(partitions(cut), "group")
    return dealt.groupBy("group").applyInArrow(releasing(run), f"{kinds}, sequence_id long, offset long")


def sequences(packed: DataFrame, length: int = 4096, padding: int = 0) -> DataFrame:
    """``sequence_id``, ``ids`` (``length`` of them, padded) from ``pack(..., keep_ids=True)``."""

    def run(table: pa.Table) -> pa.Table:
        ids = np.full(length, padding, np.int32)
        for at, piece in zip(table.column("offset").to_pylist(), table.column("ids").to_pylist()):
            ids[at : at + len(piece) // 4] = np.frombuffer(piece, "<u4")
        number = table.column("sequence_id")[0].as_py()
        return pa.table({"sequence_id": [number], "ids": pa.array([ids.tolist()], pa.list_(pa.int32()))})

    return packed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(
        run, "sequence_id long, ids array<int>"
    )
