"""Repairing conversations whose turns do not alternate, by the cheapest edits.

The roles of a repaired conversation are nothing, or user and assistant in turn behind at most one
system turn. An automaton of four states reads them (nothing yet, behind system, user, assistant). The
vector of a place holds the least cost to go on from each state; it follows from the vector behind the
next turn. Vectors are kept at checkpoints only, a square root of the turns apart: walking forward, the
vectors between two checkpoints are made again, and at each place the first edit, in the order of their
initials, that keeps the cost is taken. That gives the ASCII-least of the cheapest edits.

Turns are range-partitioned by conversation and place, so that a conversation of any length spreads. One
that lies inside a range is repaired where it is read. The others, which touch the edge of a range or have
very many turns, are cut into pieces of bounded size: a piece is a 4 x 4 table of costs from entry to exit
state, the tables give the vectors at the piece edges (checkpoints again), each piece walks from every
state it may be entered in, and the walks that fit are chained.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallybook.llm.blocks import partitions, small_batches
from tallybook.plans.durable import written_table

# Costs of edits, and of a turn without an end that stays.
REROLE, DELETE, INSERT, UNENDED = 3, 4, 3, 3
PIECE_BITS = 10  # pieces of long conversations have up to 2 ** PIECE_BITS turns
PIECE_BYTES = 4 << 20  # of text that is held of one conversation before it is treated as long
_SPACE = " \t\n\x0b\x0c\r"
_INFINITE = 1 << 60

# States, and the state an inserted or reroled turn leads to: user, but assistant behind a user.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
# Turn codes: the initial of the role (0: another one), then whether it must go, then whether it lacks an end.
_GO, _LACKS = 4, 8
_KEEP = {(NOTHING, 1): SYSTEM, (NOTHING, 2): USER, (SYSTEM, 2): USER, (ASSISTANT, 2): USER, (USER, 3): ASSISTANT}
_LEGAL = {(1, 2), (2, 3), (3, 2)}
# Behind the last turn: an open conversation is ended by inserting.
END = (0, 2 * INSERT, INSERT, 0)


def vector_before(code: int, after: tuple) -> tuple:
    """Least costs in front of a turn, from those behind it; inserted turns come in front."""
    nothing, system, user, assistant = (cost + DELETE for cost in after)
    if not code & _GO:
        stay = UNENDED if code & _LACKS else 0
        to_user, to_assistant = after[USER] + stay, after[ASSISTANT] + stay
        initial = code & 3
        kept = initial == 2
        if initial == 1:
            nothing = min(nothing, after[SYSTEM] + stay)
        by_user = to_user if kept else to_user + REROLE
        nothing, system, assistant = min(nothing, by_user), min(system, by_user), min(assistant, by_user)
        user = min(user, to_assistant if initial == 3 else to_assistant + REROLE)
    user, assistant = min(user, assistant + INSERT), min(assistant, user + INSERT)
    return min(nothing, user + INSERT), min(system, user + INSERT), user, assistant


def vector_of(codes: list[int], end: tuple) -> tuple:
    for code in reversed(codes):
        end = vector_before(code, end)
    return end


def transfer(codes: list[int]) -> list[int]:
    """Costs of a piece from each entry state to each state behind its last turn, row by row."""
    columns = [vector_of(codes, tuple(0 if s == t else _INFINITE for s in range(4))) for t in range(4)]
    return [min(columns[t][s], _INFINITE) for s in range(4) for t in range(4)]


def walk(codes: list[int], state: int, end: tuple, last: bool) -> tuple[str, int]:
    """(the ASCII-least tight edits, the state behind them), with vectors stored at checkpoints only."""
    size, step = len(codes), isqrt(len(codes)) + 1
    marks, vector = {size: end}, end
    for i in range(size - 1, -1, -1):
        vector = vector_before(codes[i], vector)
        if i % step == 0:
            marks[i] = vector
    edits: list[str] = []
    for low in range(0, size, step):
        high = min(low + step, size)
        vectors = [marks[high]]
        for i in range(high - 1, low - 1, -1):
            vectors.append(vector_before(codes[i], vectors[-1]))
        for i in range(low, high):
            after, here, code = vectors[high - i - 1], vectors[high - i], codes[i]
            stay = UNENDED if code & _LACKS else 0
            while after[state] + DELETE != here[state]:
                to = _NEXT[state]
                if here[to] + INSERT == here[state]:
                    edits.append("I")
                    state = to
                    continue
                kept = _KEEP.get((state, code & 3))
                if kept is not None and after[kept] + stay == here[state]:
                    edits.append("K")
                    state = kept
                else:
                    edits.append("R")
                    state = to
                break
            else:
                edits.append("D")
    while last and state in (SYSTEM, USER):
        edits.append("I")
        state = _NEXT[state]
    return "".join(edits), state


def apply(edits: str, state: int, turns: list[tuple[str, str]]) -> list[dict]:
    """The turns that the edits leave, changed and inserted ones included."""
    out, rest = [], iter(turns)
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(rest)
        if edit == "K":
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
        elif edit != "D":
            state = _NEXT[state]
            role = _ROLE[state]
        if edit != "D":
            out.append({"role": role, "text": text})
    return out


def _structure(codes: list[int], turns: list) -> dict:
    """Counts of a run of turns, and what is needed to put runs together."""
    known = [t for t in turns if t is not None]
    initials = [c & 3 for c in codes]
    return {
        "illegal": sum(pair not in _LEGAL for pair in zip(initials, initials[1:])),
        "distinct": sum(a != b for a, b in zip(known, known[1:])) + bool(known),
        "low": known[0] if known else None, "high": known[-1] if known else None,
        "first": initials[0] if initials else None, "final": initials[-1] if initials else None,
    }


def _gaps(low, high, distinct: int) -> int:
    return 0 if low is None else high - low + 1 - distinct


def damaged(turns: DataFrame) -> DataFrame:
    """A test bed: turns dropped, emptied, bereft of their ends, repeated or given to the user, by CRC-32
    of ``conv_id:turn`` % 20. A null in the name, role or text is one space. Dropped turns stay as rows
    whose ``present`` is false, so that no conversation is forgotten."""
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (F.crc32(name.cast("binary")) % 20).alias("_kind"),
    )
    kind = F.col("_kind")
    return rows.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def _prepared(turns: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    present = F.coalesce("present", F.lit(True)) if "present" in turns.columns else F.lit(True)
    plain = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"),
        text.alias("text"), present.alias("present"),
    )
    cut = F.rtrim(F.col("text"), F.lit(_SPACE))
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    blank = cut == ""
    lacks = ~blank & ~F.right(cut, F.lit(1)).isin(".", "!", "?")
    code = number + F.when(blank, _GO).otherwise(0) + F.when(lacks, _LACKS).otherwise(0)
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", F.lit(":"), "text"), 256)
    return plain.withColumns({"code": code.cast("int"), "digest": F.unhex(digest)})


_TURN = "turn long, role string, text string, present boolean, code int, digest binary, place long"
_STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_PART = f"conv_id long, part long, parts long, {_STATS}, audit string, repaired array<struct<role: string, text: string>>"
_STEP = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_KINDS = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "binary": pa.binary()}


def _arrow(columns: str) -> list[tuple]:
    return [(n, _KINDS[k]) for n, k in (c.split(" ") for c in columns.split(", "))]


_PART_SCHEMA = pa.schema([*_arrow(_PART.split(", repaired")[0]), ("repaired", _STEP)])


def _repaired(conv, rows: list[dict]) -> dict:
    """The one part of a conversation whose turns are all here."""
    seen, codes, there = set(), [], []
    counts = {"blank": 0, "duplicate": 0, "truncated": 0}
    for r in rows:
        if not r["present"]:
            continue
        code, content = r["code"], (r["role"], r["text"])
        if code & _GO:
            counts["blank"] += 1
        elif content in seen:
            code = code & 3 | _GO
            counts["duplicate"] += 1
        elif code & _LACKS:
            counts["truncated"] += 1
        seen.add(content)
        codes.append(code)
        there.append(r)
    shape = _structure(codes, [r["turn"] for r in there])
    audit, _ = walk(codes, NOTHING, END, True)
    return {
        "conv_id": conv, "part": 0, "parts": 1, "gaps": _gaps(shape["low"], shape["high"], shape["distinct"]), **counts,
        "illegal": shape["illegal"], "cost": vector_of(codes, END)[NOTHING], "audit": audit,
        "repaired": apply(audit, NOTHING, [(r["role"], r["text"]) for r in there]),
    }


def _in_place(turns: DataFrame, piece_bits: int) -> DataFrame:
    """Repaired conversations that lie inside a range, and the turns of the others, in one table."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("_tie")]
    # The tie lets rows equal in everything lie in different ranges.
    spread = _prepared(turns).withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order)
    placed = spread.sortWithinPartitions(*order).drop("_tie").withColumn("place", F.monotonically_increasing_id())
    schema = pa.schema([*_PART_SCHEMA, *_arrow(_TURN)])
    names = [n for n, _ in _arrow(_TURN)]
    limit = 1 << piece_bits

    def run(batches):
        held: list[dict] = []
        size, conv, before = 0, None, None
        started = long = False  # whether the turn in front of the conversation was seen; whether it is sent on

        for batch in batches:
            out: list[dict] = []
            for r in batch.to_pylist():
                if before is None or r["conv_id"] != conv:
                    out += held if long or not started else [_repaired(conv, held)] if held else []
                    held, size, conv, started, long = [], 0, r["conv_id"], before is not None, False
                held.append(r)
                size += len(r["text"])
                if len(held) > limit or size > PIECE_BYTES:
                    long = True
                    out += held
                    held, size = [], 0
                before = r["place"]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if held:  # what comes behind is in another range
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    columns = ["conv_id", *names]
    return placed.select(*columns).mapInArrow(run, f"{_PART}, {_TURN}")


def _pieces(turns: DataFrame, piece_bits: int) -> DataFrame:
    """Pieces of long conversations with the codes of their turns, duplicates found over all pieces."""
    firsts = turns.where("present").groupBy("conv_id", "digest").agg(F.min("place").alias("_first"))
    marked = turns.select("conv_id", "place", "turn", "present", "code").join(
        firsts.select("_first"), F.col("place") == F.col("_first"), "left"
    )
    again = F.col("present") & F.col("_first").isNull() & (F.col("code").bitwiseAND(F.lit(_GO)) == 0)
    step = F.struct("place", "turn", "code", again.alias("again"))
    return marked.groupBy("conv_id", F.shiftright("place", piece_bits).alias("block")).agg(
        F.min("place").alias("piece"), F.sort_array(F.collect_list(F.when(F.col("present"), step))).alias("steps")
    ).drop("block")


def _summaries(pieces: DataFrame) -> DataFrame:
    names = ["illegal", "distinct", "low", "high", "first", "final"]
    kinds = "conv_id long, piece long, blank long, duplicate long, truncated long, " + ", ".join(f"{n} long" for n in names)

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                codes = [_code(s) for s in r["steps"]]
                out.append({
                    "conv_id": r["conv_id"], "piece": r["piece"], "codes": codes, "costs": transfer(codes),
                    "blank": sum(s["code"] & _GO > 0 for s in r["steps"]), "duplicate": sum(s["again"] for s in r["steps"]),
                    "truncated": sum(c & _LACKS > 0 for c in codes), **_structure(codes, [s["turn"] for s in r["steps"]]),
                })
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    numbers = pa.list_(pa.int64())
    schema = pa.schema([*_arrow(kinds), ("codes", numbers), ("costs", numbers)])
    return pieces.mapInArrow(run, f"{kinds}, codes array<long>, costs array<long>")


def _code(step: dict) -> int:
    return step["code"] & 3 | _GO if step["again"] else step["code"]


def _edges(summaries: DataFrame) -> DataFrame:
    """Per piece: its number, the costs behind it, and the counts of its conversation with the first one."""
    kinds = f"piece long, part long, parts long, {_STATS}"

    def run(table: pa.Table) -> pa.Table:
        pieces = sorted(table.to_pylist(), key=lambda r: r["piece"])
        vector, out = END, []
        for at in range(len(pieces) - 1, -1, -1):
            out.append({"piece": pieces[at]["piece"], "part": at, "parts": len(pieces), "behind": vector})
            costs = pieces[at]["costs"]
            vector = tuple(min(costs[4 * s + t] + vector[t] for t in range(4)) for s in range(4))
        total = {n: sum(p[n] for p in pieces) for n in ("blank", "duplicate", "truncated", "illegal", "distinct")}
        ends = [(p["first"], p["final"]) for p in pieces if p["first"] is not None]
        total["illegal"] += sum((a[1], b[0]) not in _LEGAL for a, b in zip(ends, ends[1:]))
        known = [p for p in pieces if p["low"] is not None]
        distinct = total.pop("distinct") - sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
        gaps = _gaps(known[0]["low"], known[-1]["high"], distinct) if known else 0
        out[-1] |= total | {"gaps": gaps, "cost": vector[NOTHING]}
        return pa.Table.from_pylist(out, schema=schema)

    schema = pa.schema([*_arrow(kinds), ("behind", pa.list_(pa.int64()))])
    small = summaries.drop("codes")
    return small.groupBy("conv_id").applyInArrow(run, f"{kinds}, behind array<long>")


def _walks(summaries: DataFrame, edges: DataFrame) -> DataFrame:
    """Per piece the edits and exit from every state it may be entered in: a first one in one, others in any."""

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                states = range(1) if r["part"] == 0 else range(4)
                found = [walk(r["codes"], s, tuple(r["behind"]), r["part"] == r["parts"] - 1) for s in states]
                out.append((r["conv_id"], r["piece"], r["part"], [a for a, _ in found], [e for _, e in found]))
            columns = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)

    schema = pa.schema([
        ("conv_id", pa.int64()), ("piece", pa.int64()), ("part", pa.int64()), ("audits", pa.list_(pa.string())),
        ("exits", pa.list_(pa.int64())),
    ])
    joined = summaries.select("conv_id", "piece", "codes").join(edges.select("piece", "part", "parts", "behind"), "piece")
    return joined.mapInArrow(run, "conv_id long, piece long, part long, audits array<string>, exits array<long>")


def _entries(walks: DataFrame) -> DataFrame:
    """The state in which each piece is entered."""

    def run(table: pa.Table) -> pa.Table:
        state, out = NOTHING, []
        for r in sorted(table.to_pylist(), key=lambda r: r["part"]):
            out.append({"piece": r["piece"], "entry": state})
            state = r["exits"][state]
        return pa.Table.from_pylist(out, schema=pa.schema([("piece", pa.int64()), ("entry", pa.int64())]))

    return walks.drop("audits").groupBy("conv_id").applyInArrow(run, "piece long, entry long")


def _long_parts(turns: DataFrame, piece_bits: int) -> DataFrame:
    summaries = written_table(_summaries(_pieces(turns, piece_bits)), "pieces")
    edges = written_table(_edges(summaries), "edges")
    walks = written_table(_walks(summaries, edges), "walks")
    chosen = walks.join(_entries(walks), "piece").select("piece", "entry", F.get("audits", F.col("entry").cast("int")).alias("audit"))
    step = F.when(F.col("present"), F.struct("place", "role", "text"))
    texts = turns.groupBy("conv_id", F.shiftright("place", piece_bits).alias("block")).agg(
        F.min("place").alias("piece"), F.sort_array(F.collect_list(step)).alias("turns")
    ).drop("block")
    joined = texts.join(chosen, "piece").join(edges.drop("behind"), "piece")
    names = [f.name for f in _PART_SCHEMA if f.name != "repaired"]

    def run(batches):
        for batch in batches:
            out = [
                {n: r[n] for n in names}
                | {"repaired": apply(r["audit"], r["entry"], [(t["role"], t["text"]) for t in r["turns"]])}
                for r in batch.to_pylist()
            ]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_PART_SCHEMA)

    return joined.select(*names, "entry", "turns").mapInArrow(run, _PART)


def repair(turns: DataFrame, piece_bits: int = PIECE_BITS) -> DataFrame:
    """Repaired conversations, in parts: nearly all have one, long ones a part for every piece.

    ``conv_id``, ``part`` (from 0), ``parts``; ``audit``: initials of the edits of the part; ``repaired``: its
    turns (role, text); and, with part 0, of the whole conversation before its repair: ``gaps`` in its turn
    numbers, ``blank``, ``duplicate`` and ``truncated`` turns, ``illegal`` neighbours, and the ``cost``.

    Turns go by ``turn``, null first, and turns of equal number by a digest of role and text. A null role or text
    is one space; a role other than system, user, assistant (by its initial) cannot stay. Rows without a
    conversation are one; rows whose ``present`` is false only tell that the conversation exists. Other columns
    are ignored; no rows give no parts.
    """
    small_batches(turns)
    both = written_table(_in_place(turns, piece_bits), "repaired")
    names = _PART_SCHEMA.names
    inside = both.where("part IS NOT NULL").select(*names)
    rest = both.where("part IS NULL").select("conv_id", *[n for n, _ in _arrow(_TURN)])
    return inside.unionByName(_long_parts(rest, piece_bits))


def _lines() -> Column:
    return F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")


def _streamed(parts: DataFrame) -> DataFrame:
    """``conv_id``, ``repaired_sha256`` of conversations of several parts: their lines pass one task in order."""

    def run(batches):
        conv, state, any_line = None, None, False
        for batch in batches:
            done = []
            for r in batch.to_pylist():
                if r["part"] == 0:
                    if state is not None:
                        done.append({"conv_id": conv, "repaired_sha256": state.hexdigest()})
                    conv, state, any_line = r["conv_id"], hashlib.sha256(), False
                if r["turns"]:
                    state.update(("\n" * any_line + r["lines"]).encode())
                    any_line = True
            yield pa.RecordBatch.from_pylist(done, schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": state.hexdigest()}], schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    rows = parts.select("conv_id", "part", F.size("repaired").alias("turns"), _lines().alias("lines"))
    dealt = rows.repartition(partitions(rows), "conv_id").sortWithinPartitions("conv_id", "part")
    return dealt.mapInArrow(run, "conv_id long, repaired_sha256 string")


def report(parts: DataFrame) -> DataFrame:
    """A row a conversation: the counts, ``audit`` in full, and SHA-256 of its repaired lines ``role:text``."""
    stats = [c.split(" ")[0] for c in _STATS.split(", ")]
    one = parts.where("parts = 1").select("conv_id", *stats, "audit", F.sha2(_lines(), 256).alias("repaired_sha256"))
    several = parts.where("parts > 1")
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "audit"))), lambda p: p["audit"]), "")
    whole = several.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in stats], audit.alias("audit"))
    digests = _streamed(several).withColumnRenamed("conv_id", "_conv")
    joined = whole.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    return one.unionByName(joined)


def repair_report(turns: DataFrame, piece_bits: int = PIECE_BITS) -> DataFrame:
    """``report`` of the repair of ``damaged`` conversations, every original one."""
    return report(written_table(repair(damaged(turns), piece_bits), "parts"))
