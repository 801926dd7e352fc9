"""A prefix trie over conversations, by burst tries.

A conversation is the string of its turns, each turn a symbol of fixed width (a digest of role and
text, then the words of the text), so that the order of bytes is the order of sequences. Equal
conversations are counted once, with their number. Conversations start in one container below the
root. A container with too many turns bursts: its trie head is the run of turns that all of it
shares, and what follows is dealt into new containers by the next turn. That goes on until all
containers are of bounded size; each round costs a few aggregates, and heads are few. What remains
is sorted by container and symbols and swept into nodes with a stack of open ones, in the shard that
holds the container. Totals of containers then flow up through the heads, round by round.

The turns of one conversation are one row (20 bytes a turn), and the ids of equal conversations pass
through one task as a sorted stream of which only the state of the hash is held.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallybook.llm.blocks import partitions, small_batches
from tallybook.plans.durable import written_table
from tallybook.plans.ordering import number_rows

ID_BYTES, WORD_BYTES = 16, 4
WIDTH = ID_BYTES + WORD_BYTES
CONTAINER_TURNS = 4096  # a container with more turns bursts
_WORD = r"[^\x20\x09-\x0D]+"
_NODE = (
    "parent string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
_SCHEMA = pa.schema([
    (name, pa.string() if kind == "string" else pa.int64()) for name, kind in (c.split(" ") for c in _NODE.split(", "))
])


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``position`` (from 1), ``symbol`` (hexadecimal) of every turn with a conversation.

    Turns go by ``turn``, null first, then by their digests; a null role or text is empty.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, F.lit(":"), text), 256)
    words = F.lpad(F.hex(F.regexp_count(text, F.lit(_WORD)).cast("bigint")), 2 * WORD_BYTES, "0")
    slim = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("turn"),
        F.concat(F.substring(digest, 1, 2 * ID_BYTES), words).alias("symbol"),
        # Only so that rows equal in everything may lie in different ranges.
        F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("symbol"), F.col("tie")]
    return number_rows(slim, ["conv_id"], order).select("conv_id", "position", "symbol")


def rebuilt(turns: DataFrame, family: int = 20) -> DataFrame:
    """``numbered_turns`` of conversations that begin as the head of their family.

    The first h turns are those of conversation c - c % family (none if there is none), the others c's own after
    its first h; h = crc32 of c in decimal % 4. A conversation has a row without a symbol, at position 0.
    """
    numbered = written_table(numbered_turns(turns), "turns")
    borrowed = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4))
    convs = numbered.select("conv_id").distinct().withColumn("h", borrowed)
    heads = numbered.where((F.col("position") <= 3) & (F.col("conv_id") % family == 0))
    own = numbered.where(F.col("position") > borrowed)
    taken = convs.join(
        heads.withColumnRenamed("conv_id", "head"), F.col("conv_id") - F.col("conv_id") % family == F.col("head")
    ).where("position <= h")
    empty = convs.select("conv_id", F.lit(0).cast("bigint").alias("position"), F.lit(None).cast("string").alias("symbol"))
    return own.unionByName(taken.select("conv_id", "position", "symbol")).unionByName(empty)


def sequences(numbered: DataFrame) -> DataFrame:
    """``conv_id``, ``path``: the symbols of each conversation in order, as bytes."""
    listed = F.sort_array(F.collect_list(F.struct("position", "symbol")))
    gathered = numbered.groupBy("conv_id").agg(listed.alias("turns"))
    symbols = F.filter(F.transform("turns", lambda t: t["symbol"]), lambda s: s.isNotNull())
    return gathered.select("conv_id", F.unhex(F.array_join(symbols, "")).alias("path"))


def _streamed_digests(rows: DataFrame) -> DataFrame:
    """``first``, ``digest``: per ``key`` the smallest id, and SHA-256 of its ids, ascending, with commas."""

    def run(batches):
        key, first, state = None, None, None
        for batch in batches:
            done: dict[str, list] = {"first": [], "digest": []}
            for k, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if k != key:
                    if key is not None:
                        done["first"].append(first)
                        done["digest"].append(state.hexdigest())
                    key, first, state = k, conv, hashlib.sha256(str(conv).encode())
                else:
                    state.update(b",%d" % conv)
            yield pa.RecordBatch.from_pydict(done, schema=schema)
        if key is not None:
            yield pa.RecordBatch.from_pydict({"first": [first], "digest": [state.hexdigest()]}, schema=schema)

    schema = pa.schema([("first", pa.int64()), ("digest", pa.string())])
    return (
        rows.repartition(partitions(rows), "key").sortWithinPartitions("key", "conv_id")
        .mapInArrow(run, "first long, digest string")
    )


def entries(paths: DataFrame) -> DataFrame:
    """Distinct conversations: ``path``, ``n`` (how many are equal), ``first`` (smallest id), ``ends`` (digest of all ids)."""
    distinct = paths.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"))
    distinct = written_table(distinct, "paths")
    # Only conversations with equals send their ids on.
    repeated = distinct.where("n > 1").select(F.sha2("path", 256).alias("key"))
    members = paths.select(F.sha2("path", 256).alias("key"), "conv_id").join(repeated, "key", "left_semi")
    several = _streamed_digests(members).withColumnRenamed("first", "_first")
    alone = F.sha2(F.col("first").cast("string"), 256)
    return distinct.join(several, F.col("first") == F.col("_first"), "left").select(
        "path", "n", "first", F.coalesce("digest", alone).alias("ends")
    )


def _common(a: bytes, b: bytes, known: int = 0) -> int:
    """How many symbols two paths share at their start, ``known`` of them for certain."""
    size, step = min(len(a), len(b)) // WIDTH, 64
    while known + step <= size and a[known * WIDTH : (known + step) * WIDTH] == b[known * WIDTH : (known + step) * WIDTH]:
        known += step
    while known < size and a[known * WIDTH : (known + 1) * WIDTH] == b[known * WIDTH : (known + 1) * WIDTH]:
        known += 1
    return known


def _words(path: bytes, depth: int) -> int:
    """Words of the turn that ends at ``depth``; the root has none."""
    return int.from_bytes(path[depth * WIDTH - WORD_BYTES : depth * WIDTH], "big") if depth else 0


_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _sweep(container: list[tuple], depth: int, parent: str, out: dict[str, list]) -> None:
    """The nodes of one container, whose sorted entries (path, n, first, ends) share ``depth`` turns.

    Open nodes are a stack of [smallest id, conversations, children, leaves, saved tokens, ends, rows of
    children in ``out``]. A node is closed, and its children learn its smallest id, when a path leaves it.
    """

    def close(path: bytes) -> list:
        node, at = stack.pop(), depth + len(stack)
        node[3] = node[3] or 1
        node[4] += (node[1] - 1) * _words(path, at)
        for row in node[6]:
            out["parent_conv_id"][row] = node[0]
        values = (None, node[0], at, None, node[1], node[2], node[3], node[4], node[5])
        for name, value in zip(out, values):
            out[name].append(value)
        return node

    def leave(path: bytes, to: int) -> None:
        while len(stack) - 1 + depth > to:
            node, above = close(path), stack[-1]
            above[0] = node[0] if above[0] is None else min(above[0], node[0])
            above[1] += node[1]
            above[2] += 1
            above[3] += node[3]
            above[4] += node[4]
            above[6].append(len(out["depth"]) - 1)

    stack: list[list] = [[None, 0, 0, 0, 0, _NO_ENDS, []]]
    before = container[0][0]
    for path, n, first, ends in container:
        leave(before, _common(before, path, depth))
        for _ in range(len(path) // WIDTH - depth - len(stack) + 1):
            stack.append([None, 0, 0, 0, 0, _NO_ENDS, []])
        top = stack[-1]
        top[0], top[1], top[5] = first if top[0] is None else min(first, top[0]), top[1] + n, ends
        before = path
    leave(before, depth)
    close(before)
    out["parent"][-1] = parent


def _swept(containers: DataFrame) -> DataFrame:
    """Nodes of all containers; their top nodes have a ``parent`` and no ``parent_conv_id`` yet."""

    def run(batches):
        container: list[tuple] = []
        head = depth = parent = None
        for batch in batches:
            out: dict[str, list] = {name: [] for name in _SCHEMA.names}
            columns = [batch.column(c).to_pylist() for c in ("head", "depth", "parent", "path", "n", "first", "ends")]
            for h, d, p, *entry in zip(*columns):
                if h != head:
                    if container:
                        _sweep(container, depth, parent, out)
                    container, head, depth, parent = [], h, d, p
                container.append(tuple(entry))
            yield pa.RecordBatch.from_pydict(out, schema=_SCHEMA)
        if container:
            out = {name: [] for name in _SCHEMA.names}
            _sweep(container, depth, parent, out)
            yield pa.RecordBatch.from_pydict(out, schema=_SCHEMA)

    dealt = containers.repartition(partitions(containers), "head").sortWithinPartitions("head", "path")
    return dealt.mapInArrow(run, _NODE)


def _burst(sizes: DataFrame) -> DataFrame:
    """Trie heads of oversized containers: the turns all entries share, and the words of those it adds."""

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            shared = [_common(r["least"], r["most"], r["depth"]) for r in rows]
            words = [[_words(r["least"], d) for d in range(r["depth"], s + 1)] for r, s in zip(rows, shared)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("head"), batch.column("parent"), batch.column("depth"), pa.array(shared, pa.int64()),
                    pa.array(words, pa.list_(pa.int64())),
                ],
                names=["head", "parent", "depth", "shared", "words"],
            )

    return sizes.mapInArrow(run, "head string, parent string, depth long, shared long, words array<long>")


def _head_nodes(heads: DataFrame, ended: DataFrame, tops: DataFrame) -> DataFrame:
    """The nodes along each trie head, from the totals of the containers right below it."""
    below = tops.groupBy(F.col("parent").alias("_head")).agg(
        F.min("conv_id").alias("low"), F.sum("n_convs").alias("n"), F.count(F.lit(1)).alias("children"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
    )
    own = ended.select(F.col("head").alias("_own"), F.col("n").alias("own_n"), F.col("first").alias("own_first"), "ends")
    joined = heads.join(below, F.col("head") == F.col("_head"), "left").join(own, F.col("head") == F.col("_own"), "left")

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ["head", *_SCHEMA.names]}
            for r in batch.to_pylist():
                first = min(i for i in (r["low"], r["own_first"]) if i is not None)
                n, saved = (r["n"] or 0) + (r["own_n"] or 0), r["saved"] or 0
                children, ends = r["children"] or 0, r["ends"] or _NO_ENDS
                for depth, words in zip(range(r["shared"], r["depth"] - 1, -1), reversed(r["words"])):
                    saved += (n - 1) * words
                    top = depth == r["depth"]
                    values = (
                        r["head"], r["parent"] if top else None, first, depth, None if top else first, n, children,
                        r["leaves"] or 1, saved, ends,
                    )
                    for name, value in zip(out, values):
                        out[name].append(value)
                    children, ends = 1, _NO_ENDS
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("head", pa.string()), *_SCHEMA]))

    return joined.mapInArrow(run, f"head string, {_NODE}")


def trie(found: DataFrame, container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """The nodes of the trie over ``entries``, one row each; a node is known by ``conv_id`` and ``depth``.

    ``conv_id``: smallest member; ``parent_conv_id``: the parent's (null for the root); ``n_convs``:
    members; ``n_children``; ``n_leaves``: childless nodes below, itself included; ``saved_tokens``: over
    the node and all below, members beyond the first times words of the node's turn; ``ends_sha256``: of
    the ids of members that end here, ascending, with commas. No conversations give no nodes.
    """
    none = F.lit("")
    pending = found.select(
        none.alias("head"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("bigint").alias("depth"), "path", "n",
        "first", "ends",
    )
    pending = written_table(pending, "container")
    whole, rounds = [], []
    while True:
        turns = F.sum(F.octet_length("path").cast("bigint") / WIDTH - F.col("depth"))
        sizes = pending.groupBy("head", "parent", "depth").agg(
            turns.alias("turns"), F.count(F.lit(1)).alias("paths"), F.min("path").alias("least"), F.max("path").alias("most")
        )
        heads = written_table(_burst(sizes.where((F.col("turns") > container_turns) & (F.col("paths") > 1))), "heads")
        if heads.isEmpty():
            whole.append(pending)
            break
        marked = written_table(pending.join(heads.select("head", "shared"), "head", "left"), "container")
        at, size = F.col("shared").cast("int") * WIDTH, F.octet_length("path")
        whole.append(marked.where("shared IS NULL").drop("shared"))
        rounds.append((heads, marked.where(size == at)))
        pending = marked.where(size > at).select(
            F.sha2(F.substring(F.col("path"), F.lit(1), at + WIDTH), 256).alias("head"), F.col("head").alias("parent"),
            (F.col("shared") + 1).alias("depth"), "path", "n", "first", "ends",
        )
    containers = whole[0]
    for more in whole[1:]:
        containers = containers.unionByName(more)
    swept = written_table(_swept(containers), "nodes")
    small_tops = swept.where("parent IS NOT NULL")
    found_heads, tops = [], small_tops
    for heads, ended in reversed(rounds):
        nodes = written_table(_head_nodes(heads, ended, tops), "head-nodes")
        found_heads.append(nodes)
        tops = small_tops.unionByName(nodes.where("parent IS NOT NULL").drop("head"))
    nodes = swept
    if found_heads:
        along = found_heads[0]
        for more in found_heads[1:]:
            along = along.unionByName(more)
        # Top nodes learn their parent's smallest id from the head above them.
        named = along.groupBy("head").agg(F.min("conv_id").alias("_above")).withColumnRenamed("head", "_head")
        every = swept.unionByName(along.drop("head"))
        nodes = every.join(named, F.col("parent") == F.col("_head"), "left").withColumn(
            "parent_conv_id", F.coalesce("parent_conv_id", "_above")
        )
    return nodes.select(*[c for c in _SCHEMA.names if c != "parent"])


def prefix_trie(turns: DataFrame, container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """``trie`` over the conversations of a table of turns as they are.

    Rows without a conversation take no part; a null turn comes first, a null role or text is empty,
    and turns of equal number go by their content, also if rows are repeated. Other columns are ignored.
    """
    small_batches(turns)
    return trie(entries(written_table(sequences(numbered_turns(turns)), "sequences")), container_turns)


def rebuilt_trie(turns: DataFrame, container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """``trie`` over conversations that begin as the head of their family (``rebuilt``)."""
    small_batches(turns)
    return trie(entries(written_table(sequences(rebuilt(turns)), "sequences")), container_turns)
