"""Removing repeated passages by bytes: a suffix array over sampled positions, in groups.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier (in a document with
a smaller id, or earlier in the same one). A suffix array of every position is not needed for that.
Of any ``length`` bytes, the smallest hash among the strings of ``length // 2`` bytes marks the same
places wherever those bytes occur: the anchors. Strings that are equal share an anchor, at the same
distance from their start, so the array holds the suffixes at anchors only, about one in 26 bytes.

1. Every anchor has the hash of its string and of its context: all bytes of all strings of
   ``length`` that hold it. Of equal contexts, all but the first are repeats throughout. A task
   sends only its first of each.
2. Contexts that share an anchor but differ are the ends of repeated passages. Their suffixes are
   sorted from the anchor to the right, and from the anchor to the left, deep-shallow: multikey
   quicksort to a shallow depth, then a blind trie for each group that is still together. Common
   lengths of neighbours give classes of equal strings, and in each class the first one stays.
   An anchor with more than ``HOT_CONTEXTS`` contexts is not sorted in one place: its strings are
   compared by an aggregate on their checksums.
3. The places found come back to their documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallybook.llm.blocks import (
    documents, lean, mix, outer_ids, pack, pack_sorted, partitions, powers, prefix_hashes, release, releasing, span_hashes, text_batches,
    unique_ids, unpack, unpack_sorted, unzip, written_table, zipped,
)
from tallybook.plans.ordering import number_rows

_FLUSH = 200_000  # anchors a task gathers before it sends them off
HOT_CONTEXTS = 20_000
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_SHALLOW_WORDS = 7  # eight bytes each
_HELD_BYTES = 4 << 20  # of texts a task gathers before it sends them off


def _sliding(values: np.ndarray, width: int, pick, filler) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` neighbours, from running values in blocks."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, filler, values.dtype)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = pick.accumulate(rows, axis=1).reshape(-1)
    behind = pick.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return pick(behind[:count], ahead[width - 1 : width - 1 + count])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int):
    """(document number, place, hash of the anchor, hash of its context) for a batch of texts."""
    gram = length // 2
    width = length - gram + 1
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, np.empty(0, np.uint64), np.empty(0, np.uint64)
    running = prefix_hashes(data)
    count = len(data) - gram + 1
    hashes = running[gram:] - running[:count]
    hashes *= powers(len(running), inverse=True)[:count]
    hashes = mix(hashes)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = owner[: len(data) - length + 1] == owner[length - 1 :]
    least = _sliding(hashes, width, np.minimum, _NONE)
    least[~inside] = 0
    # A place is an anchor if it is the least of some string inside its document.
    edge = np.zeros(width - 1, np.uint64)
    best = _sliding(np.concatenate([edge, least, edge]), width, np.maximum, np.uint64(0))
    at = np.flatnonzero((best == hashes) & (best != 0))
    doc = owner[at]
    start = np.maximum(offsets[doc], at - (length - gram))
    end = np.minimum(offsets[doc + 1], at + length)
    sides = (at - start).astype(np.uint64) * np.uint64(length + 1) + (end - at).astype(np.uint64)
    context = mix(span_hashes(running, start, end) + sides)
    return doc, at - offsets[doc], hashes[at], context


def _firsts(h, c, doc, place):
    """(sorted order, whether first of its anchor and context, whether first of its anchor)."""
    order = np.lexsort((place, doc, c, h))
    h, c = h[order], c[order]
    new_h = np.ones(len(h), bool)
    new_h[1:] = h[1:] != h[:-1]
    new = new_h.copy()
    new[1:] |= c[1:] != c[:-1]
    return order, new, new_h


def _sent(h, c, doc, place, buckets: int) -> pa.RecordBatch:
    order, new, _ = _firsts(h, c, doc, place)
    first, again = order[new], order[~new]
    bucket = (mix(h[first].copy()) % np.uint64(buckets)).astype(np.int32)
    by_bucket = np.argsort(bucket, kind="stable")
    first, cuts = first[by_bucket], np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
    # A row for each bucket that gets anchors, so that there are never more rows than values.
    there = np.flatnonzero(np.diff(cuts))
    share = np.array_split(again[np.lexsort((place[again], doc[again]))], max(1, len(there)))
    rows = {"bucket": there.astype(np.int32), "h": [], "c": [], "doc": [], "place": [], "again_doc": [], "again_place": []}
    for k, others in zip(there, share):
        mine = first[cuts[k] : cuts[k + 1]]
        rows["h"].append(pack_sorted(h[mine]))
        rows["c"].append(pack(c[mine]))
        rows["doc"].append(pack(doc[mine]))
        rows["place"].append(pack(place[mine].astype(np.int32)))
        rows["again_doc"].append(pack(doc[others]))
        rows["again_place"].append(pack(place[others].astype(np.int32)))
    return pa.RecordBatch.from_pydict(rows)


_NOTES = "doc_id long, whole array<int>, edges array<int>, anchors array<long>, hot array<boolean>"


def _per_document(doc, place, kind, h, hot) -> pa.Table:
    """One row per document: places repeated throughout (kind 0), and ends to look at (kind 1)."""
    order = np.lexsort((place, doc))
    doc, place, kind, h, hot = doc[order], place[order].astype(np.int32), kind[order], h[order].view(np.int64), hot[order]
    ids, at = np.unique(doc, return_index=True)
    bounds = np.append(at, len(doc))

    def lists(values, mask):
        cuts = np.concatenate([[0], np.cumsum(mask)])[bounds].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(cuts), pa.array(values[mask]))

    ends = kind == 1
    return pa.table({
        "doc_id": ids, "whole": lists(place, ~ends), "edges": lists(place, ends),
        "anchors": lists(h, ends), "hot": lists(hot, ends),
    })


def _notes(docs: DataFrame, length: int, hot_contexts: int) -> DataFrame:
    """Per document, which anchors repeat an earlier context, and which are ends to look at."""
    buckets = 2 * partitions(docs)

    def send(batches):
        held, count = [], 0
        for ids, data, offsets in text_batches(batches):
            doc, place, h, c = anchors(data, offsets, length)
            held.append((h, c, ids[doc], place))
            count += len(h)
            if count > _FLUSH:
                yield _sent(*[np.concatenate(x) for x in zip(*held)], buckets)
                held, count = [], 0
        if count:
            yield _sent(*[np.concatenate(x) for x in zip(*held)], buckets)

    def judge(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        h = np.concatenate([unpack_sorted(b) for b in rows["h"]])
        c = np.concatenate([unpack(b, np.uint64) for b in rows["c"]])
        doc = np.concatenate([unpack(b, np.int64) for b in rows["doc"]])
        place = np.concatenate([unpack(b, np.int32) for b in rows["place"]])
        order, new, new_h = _firsts(h, c, doc, place)
        group = np.cumsum(new_h) - 1
        contexts = np.bincount(group[new], minlength=group[-1] + 1 if len(group) else 0)
        end = new & (contexts[group] > 1) if len(group) else new
        keep = end | ~new
        again = np.concatenate([unpack(b, np.int64) for b in rows["again_doc"]])
        again_place = np.concatenate([unpack(b, np.int32) for b in rows["again_place"]])
        none = np.zeros(len(again), bool)
        picked = order[keep]
        return _per_document(
            np.concatenate([doc[picked], again]), np.concatenate([place[picked], again_place]),
            np.concatenate([end[keep], none]), np.concatenate([h[picked], none.astype(np.uint64)]),
            np.concatenate([(contexts[group] > hot_contexts)[keep] if len(group) else keep[keep], none]),
        )

    sent = docs.mapInArrow(
        send, "bucket int, h binary, c binary, doc binary, place binary, again_doc binary, again_place binary"
    )
    judged = sent.groupBy("bucket").applyInArrow(releasing(judge), _NOTES)
    return judged.groupBy("doc_id").agg(
        *[F.flatten(F.collect_list(c)).alias(c) for c in ("whole", "edges", "anchors", "hot")]
    )


# Deep-shallow sorting


def _blind_trie(texts: list[bytes]) -> tuple[list[int], list[int]]:
    """(order, common length with the one before) of texts, by a blind (Patricia) trie.

    A node knows the length up to which all below it agree, and branches on the byte there; a text
    that ends branches on -1. Going down looks at branching bytes only; one comparison with the
    leaf reached then gives the place to insert.
    """
    root: list | int = 0
    for i in range(1, len(texts)):
        text, node = texts[i], root
        while not isinstance(node, int):
            depth, children = node
            branch = text[depth] if depth < len(text) else -1
            node = children[branch] if branch in children else next(iter(children.values()))
        other = texts[node if not isinstance(node, list) else node[0]]
        shared, most = 0, min(len(text), len(other))
        if text[:most] == other[:most]:
            shared = most
        else:
            low, high = 0, most
            while low < high:
                middle = (low + high) // 2
                if text[: middle + 1] == other[: middle + 1]:
                    low = middle + 1
                else:
                    high = middle
            shared = low
        mine = text[shared] if shared < len(text) else -1
        theirs = other[shared] if shared < len(other) else -1
        above, branch, node = None, None, root
        while not isinstance(node, int) and node[0] < shared:
            depth, children = node
            above, branch = node, (text[depth] if depth < len(text) else -1)
            node = children[branch]
        if mine == theirs:  # equal texts: one leaf below another, under the end branch
            fresh = (shared + 1, {-2 - i: i, -1: node}) if isinstance(node, int) else None
            if fresh is None:
                node[1][-2 - i] = i
                continue
        elif not isinstance(node, int) and node[0] == shared:
            node[1][mine] = i
            continue
        else:
            fresh = (shared, {mine: i, theirs: node})
        if above is None:
            root = fresh
        else:
            above[1][branch] = fresh
    order, common, stack = [], [], [(root, 0)]
    while stack:
        node, lcp = stack.pop()
        if isinstance(node, int):
            order.append(node)
            common.append(lcp)
            continue
        depth, children = node
        keys = sorted(children)
        for k in reversed(keys):
            stack.append((children[k], lcp if k == keys[0] else depth))
    return order, common


def deep_shallow(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(order, common length with the one before) of texts in byte order; ends sort first.

    Shallow: three-way partitions on eight bytes at a time, all groups of one depth together.
    Deep: a blind trie for each group that eight bytes times the shallow depth did not part.
    """
    count = len(texts)
    sizes = np.array([len(x) for x in texts], np.int64)
    width = 8 * _SHALLOW_WORDS
    heads = np.frombuffer(b"".join(x[:width].ljust(width, b"\0") for x in texts), ">u8").reshape(count, -1)
    order, group = np.arange(count), np.zeros(count, np.int64)
    common = np.zeros(count, np.int64)
    fresh = np.zeros(count, bool)  # whether the boundary before this rank is known
    fresh[:1] = True
    for word in range(_SHALLOW_WORDS):
        if not count or fresh.all():
            break
        # Within a group, by the next eight bytes, then texts that end in them before others.
        key, ended = heads[order, word], np.minimum(sizes[order] - 8 * word, 8)
        by = np.lexsort((ended, key, group))
        order, key, ended = order[by], key[by], ended[by]
        apart = np.zeros(count, bool)
        apart[1:] = ~fresh[1:] & ((key[1:] != key[:-1]) | (ended[1:] != ended[:-1]))
        at = np.flatnonzero(apart)
        differ = key[at] ^ key[at - 1]
        equal = np.full(len(at), 8, np.int64)
        for byte in range(8):
            equal = np.where((equal == 8) & ((differ >> np.uint64(56 - 8 * byte)) & np.uint64(255) != 0), byte, equal)
        common[at] = 8 * word + np.minimum(equal, np.maximum(0, np.minimum(ended[at], ended[at - 1])))
        fresh |= apart
        group = np.cumsum(fresh)
    bounds = np.append(np.flatnonzero(fresh), count)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a > 1:
            deep, lcp = _blind_trie([texts[i] for i in order[a:b]])
            order[a:b] = order[a:b][deep]
            common[a + 1 : b] = np.minimum(lcp[1:], np.minimum(sizes[order[a : b - 1]], sizes[order[a + 1 : b]]))
    return order, common


def repeated_windows(left: list[bytes], right: list[bytes], age: np.ndarray, length: int, gram: int):
    """For each context (bytes before an anchor, reversed; bytes from it on) the strings of
    ``length`` that an older context has at the same place, as (least, most) bytes before the
    anchor; (0, -1) for none."""
    count = len(age)
    sides = []
    for texts in (left, right):
        order, common = deep_shallow(texts)
        rank = np.empty(count, np.int64)
        rank[order] = np.arange(count)
        sides.append((rank, common, np.array([len(x) for x in texts], np.int64)))
    least, most = np.zeros(count, np.int64), np.full(count, -1, np.int64)
    for before in range(length - gram + 1):
        classes, there = [], np.ones(count, bool)
        for (rank, common, size), depth in zip(sides, (before, length - before)):
            classes.append(np.cumsum(common < depth)[rank] if depth else np.zeros(count, np.int64))
            there &= size >= depth
        at = np.flatnonzero(there)
        order = at[np.lexsort((age[at], classes[0][at], classes[1][at]))]
        again = np.zeros(len(order), bool)
        again[1:] = (classes[0][order][1:] == classes[0][order][:-1]) & (classes[1][order][1:] == classes[1][order][:-1])
        hit = order[again]
        least[hit] = np.where(most[hit] < 0, before, least[hit])
        most[hit] = before
    return least, most


def _contexts(ends: DataFrame, length: int) -> DataFrame:
    """One row per end: its anchor, document, place, and the bytes around it."""
    reach = length - length // 2
    schema = pa.schema([
        ("anchor", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int32()), ("before", pa.int32()),
        ("context", pa.binary()), ("hot", pa.bool_()),
    ])

    def run(batches):
        for batch in batches:
            rows = {"anchor": [], "doc_id": [], "place": [], "before": [], "context": [], "hot": []}
            for i in range(batch.num_rows):
                doc, blob, places, found, hot = [batch.column(c)[i].as_py() for c in ("doc_id", "ztext", "edges", "anchors", "hot")]
                text = unzip(blob)
                for p, h, much in zip(places, found, hot):
                    rows["anchor"].append(h)
                    rows["doc_id"].append(doc)
                    rows["place"].append(p)
                    rows["before"].append(min(p, reach))
                    rows["context"].append(text[max(0, p - reach) : p + length])
                    rows["hot"].append(much)
                if len(rows["anchor"]) > 20_000:
                    yield pa.RecordBatch.from_pydict(rows, schema=schema)
                    rows = {c: [] for c in rows}
            if rows["anchor"]:
                yield pa.RecordBatch.from_pydict(rows, schema=schema)

    return ends.mapInArrow(run, "anchor long, doc_id long, place int, before int, context binary, hot boolean")


def _sorted_ends(contexts: DataFrame, length: int) -> DataFrame:
    """``doc_id``, ``start``, ``end`` of what is repeated around the ends, by sorting."""
    gram = length // 2

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        doc, place = np.array(rows["doc_id"], np.int64), np.array(rows["place"], np.int64)
        age = np.empty(len(doc), np.int64)
        age[np.lexsort((place, doc))] = np.arange(len(doc))
        left = [x[:b][::-1] for x, b in zip(rows["context"], rows["before"])]
        right = [x[b:] for x, b in zip(rows["context"], rows["before"])]
        least, most = repeated_windows(left, right, age, length, gram)
        hit = most >= 0
        return pa.table({
            "doc_id": doc[hit], "start": (place - most)[hit].astype(np.int32),
            "end": (place + length - least)[hit].astype(np.int32),
        })

    bucket = F.pmod(F.xxhash64("anchor"), F.lit(4 * partitions(contexts))).alias("bucket")
    return contexts.select(bucket, "doc_id", "place", "before", "context").groupBy("bucket").applyInArrow(
        releasing(run), "doc_id long, start int, end int"
    )


def _aggregated_ends(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many contexts: each string by its checksum, the first stays."""
    starts = F.sequence(F.lit(0), F.octet_length("context") - length)
    long_enough = contexts.where(F.octet_length("context") >= length)
    each = long_enough.select("doc_id", "place", "before", "context", F.explode(starts).alias("skip"))
    each = each.select(
        "doc_id", (F.col("place") - F.col("before") + F.col("skip")).alias("start"),
        F.md5(F.substring(F.col("context"), F.col("skip") + 1, F.lit(length))).alias("string"),
    )
    first = each.groupBy("string").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    again = each.join(first, "string").where(F.struct("doc_id", "start") != F.col("first"))
    return again.select("doc_id", F.col("start").cast("int"), (F.col("start") + length).cast("int").alias("end"))


def repeated_spans(docs: DataFrame, length: int = 100, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """``doc_id``, ``whole`` (anchors whose whole context is repeated), ``starts``, ``ends`` (spans)."""
    notes = written_table(_notes(docs, length, hot_contexts), "notes")
    ends = notes.where(F.size("edges") > 0).select("doc_id", "edges", "anchors", "hot")
    contexts = written_table(_contexts(zipped(docs).join(ends, "doc_id"), length), "contexts")
    found = _sorted_ends(contexts.where("NOT hot"), length)
    found = found.unionByName(_aggregated_ends(contexts.where("hot"), length).distinct())
    spans = found.groupBy("doc_id").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    return notes.select("doc_id", "whole").join(spans, "doc_id", "left")


def _covered(size: int, whole, starts, ends, length: int) -> list[tuple[int, int]]:
    """Maximal removed runs of a text."""
    reach = length - length // 2
    spans = [(max(0, p - reach), min(size, p + length)) for p in whole or ()]
    spans = sorted([s for s in spans if s[1] - s[0] >= length] + list(zip(starts or (), ends or ())))
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(
    docs: DataFrame, length: int = 100, id_column: str = "doc_id", text_column: str = "text",
    hot_contexts: int = HOT_CONTEXTS,
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``spans`` (start and end of removed runs), ``kept`` (binary), one row a document.

    Texts are UTF-8 bytes and ``kept`` is what stays of them, so that a removed run may cut a
    character in two. Null texts are empty. Texts shorter than ``length`` keep everything. Rows
    that repeat an id, or have none, are documents of their own, in the order of their texts.
    Other columns are ignored; an empty table gives no rows.
    """
    def row(doc, size, spans, kept):
        return doc, size, [{"start": a, "end": b} for a, b in spans], kept

    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()),
    ])
    kinds = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    return _cut(docs, length, id_column, text_column, hot_contexts, row, schema, kinds)


def _cut(docs, length, id_column, text_column, hot_contexts, row, schema: pa.Schema, kinds: str) -> DataFrame:
    """What ``row`` makes of each document's id, size, removed runs and kept bytes."""
    docs, names = unique_ids(documents(docs, id_column, text_column))
    found = written_table(repeated_spans(docs, length, hot_contexts), "repeats")

    def run(batches):
        lean()
        for batch in batches:
            rows, held = [], 0
            for i in range(batch.num_rows):  # row by row: as lists, the places of a batch take ten times its size
                doc, blob, whole, starts, ends = [batch.column(c)[i].as_py() for c in ("doc_id", "ztext", "whole", "starts", "ends")]
                text = unzip(blob)
                spans = _covered(len(text), whole, starts, ends, length)
                cuts = [0, *[x for span in spans for x in span], len(text)]
                rows.append(row(doc, len(text), spans, b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2]))))
                held += len(text)
                if held > _HELD_BYTES:
                    yield _record_batch(rows, schema)
                    rows, held = [], 0
            if rows:
                yield _record_batch(rows, schema)
        release()

    kept = zipped(docs).join(found, "doc_id", "left").mapInArrow(run, kinds)
    return outer_ids(kept, names, "doc_id")


def _record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*rows)))), schema=schema)


def removal_digest(kept: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of ``remove_repeats``."""
    return kept.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def _spare_name(name: str, docs: DataFrame) -> str:
    """``name``, made longer until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def without_repeats(docs: DataFrame, length: int = 100, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with what ``remove_repeats`` keeps as text, and all other columns as they were.

    Bytes left of a character that was cut in two go with it. A column ``n_chars`` is counted anew.
    Every row stays, also one whose text is empty now. Of rows that repeat an id, or have none, each
    is a document of its own.
    """
    ids = docs.groupBy(id_column).agg(F.count(F.lit(1)).alias("_n"))
    key, columns = id_column, docs.columns
    if not ids.where(f"_n > 1 OR `{id_column}` IS NULL").isEmpty():
        key = _spare_name("_key", docs)
        order = [F.col(id_column).asc_nulls_first(), F.col(text_column).asc_nulls_first()]
        docs = written_table(number_rows(docs, [], order, key), "numbered")

    def row(doc, size, spans, kept):
        return doc, kept.decode("utf-8", "ignore")

    # Texts come out of the pass that cuts them: a second one would double the Python processes of the stage.
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    kept = _cut(docs, length, key, text_column, HOT_CONTEXTS, row, schema, "doc_id long, text string")
    own, text = _spare_name("_doc", docs), _spare_name("_text", docs)
    kept = kept.select(F.col("doc_id").alias(own), F.col("text").alias(text))
    joined = docs.drop(text_column).join(kept, F.col(f"`{key}`") == F.col(own))
    replaced = {text_column: F.col(text), "n_chars": F.length(text).cast("bigint")}
    return joined.select(*[replaced.get(c, F.col(f"`{c}`")).alias(c) for c in columns])
