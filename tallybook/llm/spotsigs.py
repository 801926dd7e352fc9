"""Document fingerprints from spot signatures.

Common words (anchors) are followed by content words; each anchor with the next two content words
after it is a spot signature, and a document's set of them is its fingerprint. Boilerplate without
sentences has few anchors, so a change there moves the fingerprint little. Marks without letters
and the starts of lines count as anchors as well, so that tables and lists have signatures too; a
text that still has none has its checksum as its only one.

``compare`` gives the Jaccard similarity of two documents' sets; a bound from their sizes comes
first. ``similar_pairs`` partitions sets by size, so that a set meets only those of its own and the
next partition, and indexes only the rarest members.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallybook.llm.blocks import (
    documents, mix, outer_ids, partitions, prefix_hashes, span_hashes, text_array, text_batches, unique_ids, unzip,
    written_table,
)
from tallybook.llm.shingles import LOWER, words

# Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to a in is it that was for on with as be by this from at are or an have not you "
    "der die und das von zu den des ist ein eine im mit auf nicht es dem sich als "
    "le la les de du un une et est que qui dans pour par sur au ne se pas il "
    "el los las y en por con una su al lo del se no para como más"
).split()
CHAIN = 2  # content words per signature

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
_NEWLINE = 10


def _text_hashes(texts: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    return span_hashes(prefix_hashes(data), ends - [len(t) for t in texts], ends)


_ANCHOR_HASHES = np.unique(_text_hashes([a.encode() for a in ANCHORS]))


def signature_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Each text's distinct spot signatures, sorted; never empty."""
    low = LOWER[data]
    starts, ends, owner = words(low, offsets)
    letters = np.concatenate([[0], np.cumsum(_ALNUM[low])])
    some = letters[ends] > letters[starts]
    # A word without the marks around it; marks inside stay.
    alnum = np.flatnonzero(_ALNUM[low])
    first, last = starts.copy(), ends.copy()
    if len(alnum):
        first[some] = alnum[letters[starts[some]]]
        last[some] = alnum[letters[ends[some]] - 1] + 1
    hashes = span_hashes(prefix_hashes(low), first, last)
    common = ~some | (_ANCHOR_HASHES[np.minimum(np.searchsorted(_ANCHOR_HASHES, hashes), len(_ANCHOR_HASHES) - 1)] == hashes)
    content = np.flatnonzero(~common)
    lines = np.concatenate([[0], np.cumsum(data == _NEWLINE)])
    opens = np.ones(len(starts), bool)
    opens[1:] = (owner[1:] != owner[:-1]) | (lines[starts[1:]] != lines[starts[:-1]])
    # Anchors: (place of the first word that may follow, hash); a line start comes before its word.
    where = np.concatenate([np.flatnonzero(common) + 1, np.flatnonzero(opens)])
    anchor = np.concatenate([hashes[common], np.full(int(opens.sum()), 7, np.uint64)])
    text_of = np.concatenate([owner[common], owner[opens]])
    chain = mix(anchor + np.uint64(1))
    at = np.searchsorted(content, where)
    there = np.zeros(len(where), bool)
    padded = np.concatenate([content, np.full(CHAIN, len(starts), np.int64)])
    owners, found = np.append(owner, -1), np.append(hashes, np.uint64(0))
    for i in range(CHAIN):
        follows = padded[at + i] if len(at) else at
        inside = owners[follows] == text_of
        there |= inside if i == 0 else False
        chain = mix(chain * np.uint64(31) + np.where(inside, found[follows], np.uint64(0)))
    chain, text_of = chain[there], text_of[there]
    order = np.argsort(text_of, kind="stable")
    chain, bounds = chain[order], np.searchsorted(text_of[order], np.arange(len(offsets)))
    out = []
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        if b > a:
            out.append(np.unique(chain[a:b]))
        else:
            whole = hashlib.sha256(data[offsets[i] : offsets[i + 1]].tobytes()).digest()[:8]
            out.append(np.frombuffer(whole, np.uint64))
    return out


def _sets_of(texts: list[bytes]) -> list[np.ndarray]:
    """The same for texts given one by one, in batches."""
    out, held, size = [], [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size > 1 << 19:
            out += _batch_sets(held)
            held, size = [], 0
    return out + (_batch_sets(held) if held else [])


def _batch_sets(texts: list[bytes]) -> list[np.ndarray]:
    data = np.frombuffer(b"".join(texts), np.uint8)
    return signature_sets(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))


def compare(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; 0 where their sizes alone keep it below ``least``."""
    small, large = sorted((len(a), len(b)))
    if not small or small < least * large:
        return 0.0
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    both = int((a[at] == b).sum())
    return both / (len(a) + len(b) - both)


def digest(signatures: np.ndarray) -> str:
    """A fingerprint as text: the set's size, and a checksum of it."""
    return f"{len(signatures)}:{hashlib.sha256(signatures.tobytes()).hexdigest()[:32]}"


def signatures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``signatures`` (array of long) for every row; null texts are empty."""

    def run(batches):
        for ids, data, offsets in text_batches(batches):
            sets = [s.view(np.int64) for s in signature_sets(data, offsets)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "signatures"]
            )

    return documents(docs, id_column, text_column).mapInArrow(run, "doc_id long, signatures array<long>")


def similar_pairs(sets: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``a``, ``b``, ``similarity`` of all pairs of different sets at ``threshold`` or more, a < b.

    ``sets`` is the output of ``signatures``; equal sets are one class, named by its smallest id.
    Partition p holds the sizes from threshold**-p up to the next power, so that similar sets lie in
    the same partition or in neighbours. Only as many members as could all be missing from a partner
    are indexed, rarest first. Rows without an id are ignored.
    """
    classes = sets.where("doc_id IS NOT NULL").groupBy("signatures").agg(F.min("doc_id").alias("doc_id"))
    classes = classes.withColumn("size", F.size("signatures"))
    step = F.floor(F.log("size") / -np.log(threshold) + 1e-9).cast("int")
    classes = written_table(classes.withColumn("part", step), "classes")
    members = classes.select("doc_id", "size", "part", F.explode("signatures").alias("member"))
    counts = members.groupBy("member").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = members.join(counts, "member")
    ranked = shared.groupBy("doc_id", "size", "part").agg(F.sort_array(F.collect_list(F.struct("df", "member"))).alias("m"))
    room = F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1 - (F.col("size") - F.size("m"))
    prefix = ranked.where(room > 0).select("doc_id", "size", "part", F.explode(F.slice("m", 1, room.cast("int"))).alias("m"))
    entries = prefix.select("doc_id", "size", "part", F.col("m.member").alias("member"))
    left = entries.select("member", F.col("doc_id").alias("a"), F.col("size").alias("sa"), "part")
    right = entries.select("member", F.col("doc_id").alias("b"), F.col("size").alias("sb"), F.explode(F.array(F.col("part") - 1, "part", F.col("part") + 1)).alias("part"))
    fits = (F.col("a") < F.col("b")) & (F.least("sa", "sb") >= F.greatest("sa", "sb") * threshold)
    pairs = left.join(right, ["member", "part"]).where(fits).select("a", "b").distinct()
    one = classes.select(F.col("doc_id").alias("a"), F.col("signatures").alias("x"))
    two = classes.select(F.col("doc_id").alias("b"), F.col("signatures").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    scored = pairs.join(one, "a").join(two, "b")
    scored = scored.withColumn("similarity", both / (F.size("x") + F.size("y") - both))
    return scored.where(F.col("similarity") >= threshold).select("a", "b", "similarity")


# Comparison with an edited copy and with the next document


def _dealt(docs: DataFrame, firsts: np.ndarray) -> DataFrame:
    """``part``, ``tail``, ``doc_id``, ``ztext``: texts by range of ids; the first of each range also
    goes to the end of the range before it."""
    import zstandard

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            data, offsets = text_array(batch.column("text"))
            view = memoryview(np.ascontiguousarray(data))
            texts = [squeeze.compress(view[a:b]) for a, b in zip(offsets, offsets[1:])]
            part = np.searchsorted(firsts, ids, "right") - 1
            lead = np.flatnonzero(firsts[part] == ids)
            rows = np.concatenate([np.arange(len(ids)), lead])
            parts = np.concatenate([part, (part[lead] - 1) % len(firsts)])
            tail = np.arange(len(rows)) >= len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), pa.array(tail), pa.array(ids[rows]), pa.array([texts[r] for r in rows], pa.binary())],
                names=["part", "tail", "doc_id", "ztext"],
            )

    return docs.mapInArrow(run, "part int, tail boolean, doc_id long, ztext binary")


_COMPARED = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("n_signatures", pa.int64()),
])


def _edited(text: str, following: str) -> str:
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _compared(ids: list, blobs: list) -> pa.RecordBatch:
    """Rows for all documents but the last, which only follows."""
    texts = [unzip(b) for b in blobs]
    plain = [t.decode("utf-8", "replace") for t in texts]
    edited = [_edited(a, b).encode() for a, b in zip(plain, plain[1:])]
    sets, changed = _sets_of(texts), _sets_of(edited)
    return pa.RecordBatch.from_pydict({
        "doc_id": ids[:-1], "n_chars": [len(t) for t in plain[:-1]],
        "edited_sha256": [hashlib.sha256(t).hexdigest() for t in edited],
        "fingerprint": [digest(s) for s in sets[:-1]], "edited_fingerprint": [digest(s) for s in changed],
        "near_edited": [compare(a, b) for a, b in zip(sets, changed)],
        "near_next": [compare(a, b) for a, b in zip(sets, sets[1:])], "n_signatures": [len(s) for s in sets[:-1]],
    }, schema=_COMPARED)


def edit_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document's fingerprint against that of an edited copy and of the next document.

    The edited copy has the last quarter of the code points (rounded down) replaced by as many of
    the next document by id, or all it has; the first document follows the last, and a single one
    follows itself. ``near_edited`` and ``near_next`` are Jaccard similarities. Null texts are
    empty. Rows that repeat an id, or have none, are documents of their own, in the order of their
    texts. Other columns are ignored; an empty table gives no rows.
    """
    docs, names = unique_ids(documents(docs, id_column, text_column))
    ranges = partitions(docs)
    cuts = [i / ranges for i in range(ranges)]
    found = docs.agg(F.min("doc_id"), F.percentile_approx("doc_id", cuts, 10_000)).first()
    firsts = np.unique(np.array([found[0], *found[1]], np.int64)) if found[0] is not None else np.zeros(1, np.int64)
    # One boundary a range, all of them ids that occur.

    def run(table: pa.Table) -> pa.Table:
        # The next range's first document comes last.
        table = table.sort_by([("tail", "ascending"), ("doc_id", "ascending")])
        ids, blobs = table.column("doc_id").to_pylist(), table.column("ztext").to_pylist()
        parts = [_compared(ids[i : i + 501], blobs[i : i + 501]) for i in range(0, len(ids) - 1, 500)]
        return pa.Table.from_batches(parts, schema=_COMPARED)

    kinds = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_signatures long"
    report = _dealt(docs, firsts).groupBy("part").applyInArrow(run, kinds)
    return outer_ids(report, names, "doc_id")
