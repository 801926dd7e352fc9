"""Repair and prefix trie of conversations, against plain versions that take one conversation at a time."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest

from tallybook.llm import prefix_trie, turn_repair
from tests.llm.cases import prose

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, place long, parent string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def content_digest(role, text):
    return sha(f"{len(role)}:{role}:{text}")


def table(spark, rows):
    """Extra columns are called like the operators' own."""
    return spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(3)


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


# Repair


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        out[conv] += []
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        place = ((turn is not None, turn or 0), content_digest(role, text))
        out[conv] += [(place, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {conv: [r[1:] for r in sorted(found, key=lambda r: r[0])] for conv, found in out.items()}


def brute_repair(conv):
    """Forward over the least (cost, audit) of each state."""
    then, names = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}
    seen, counts, best = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, {"": (0, "", [])}

    def put(table, state, cost, audit, lines):
        if state not in table or (cost, audit) < table[state][:2]:
            table[state] = (cost, audit, lines)

    def with_inserts(table):
        for _ in range(4):
            for state, (cost, audit, lines) in list(table.items()):
                put(table, then[state], cost + 3, audit + "I", [*lines, names[then[state]] + ":"])
        return table

    for _, role, text in conv:
        cut = text.rstrip(SPACE)
        fault = "blank" if not cut else "duplicate" if (role, text) in seen else "" if cut[-1] in ".!?" else "truncated"
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        extra, after = 3 * (fault == "truncated"), {}
        for state, (cost, audit, lines) in with_inserts(best).items():
            put(after, state, cost + 4, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            if (state, role[:1]) in [("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")]:
                put(after, role[0], cost + extra, audit + "K", [*lines, f"{role}:{text}"])
            put(after, then[state], cost + 3 + extra, audit + "R", [*lines, f"{names[then[state]]}:{text}"])
        best = after
    cost, audit, lines = min(v for state, v in with_inserts(best).items() if state in ("", "a"))
    turns = [t for t, _, _ in conv if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [role[:1] for _, role, _ in conv]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return gaps, *counts.values(), illegal, cost, audit, sha("\n".join(lines))


def awkward_turns(seed):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", None, "tool", ""]
    texts = ["Hi.", "What? ", "yes!", "no", "", None, " \n", "é日", " "]
    rows = [
        (conv, rnd.choice([t, t, t, t, None, t + 2]), rnd.choice(roles), rnd.choice(texts))
        for conv in [*range(60), None, -3] for t in range(rnd.choice([1, 1, 2, 4, 8]))
    ]
    rows += [(900, t, rnd.choice(roles[:2]), rnd.choice(["x.", f"n {t}.", f"m {t}"])) for t in range(400)]
    return rows + rows[:30] + [(70, 0, "user", prose(5, 30_000)), (71, 2**40, "user", "a."), (71, -5, "assistant", "b.")]


@pytest.mark.parametrize("piece_bits", [turn_repair.PIECE_BITS, 3, 0])
def test_repair(spark, piece_bits):
    rows = awkward_turns(3)
    want = [(conv, *brute_repair(turns)) for conv, turns in damage(rows).items()]
    assert collected(turn_repair.repair_report(table(spark, rows), piece_bits)) == sorted(want, key=str)


def test_repair_of_one_conversation():
    """Every short sequence of kinds of turns, in one walk and cut in two pieces."""
    kinds = [0, 1, 2, 3, turn_repair._GO, 2 | turn_repair._LACKS, 3 | turn_repair._LACKS]
    rnd = random.Random(2)
    for _ in range(2_000):
        codes = [rnd.choice(kinds) for _ in range(rnd.randint(0, 9))]
        cut = rnd.randint(0, len(codes))
        middle = turn_repair.vector_of(codes[cut:], turn_repair.END)
        costs = turn_repair.transfer(codes[:cut])
        whole = turn_repair.vector_of(codes, turn_repair.END)
        assert whole == tuple(min(costs[4 * s + t] + middle[t] for t in range(4)) for s in range(4))
        first, state = turn_repair.walk(codes[:cut], turn_repair.NOTHING, middle, False)
        second, _ = turn_repair.walk(codes[cut:], state, turn_repair.END, True)
        assert first + second == turn_repair.walk(codes, turn_repair.NOTHING, turn_repair.END, True)[0]


def test_repaired_turns_alternate(spark):
    parts = turn_repair.repair(table(spark, awkward_turns(4)), 3)
    whole = defaultdict(list)
    for r in sorted(parts.collect(), key=lambda r: r["part"]):
        whole[r["conv_id"]] += [t["role"][0] for t in r["repaired"]]
        assert r["part"] == 0 or r["cost"] is None
    assert all(re.fullmatch("(s?(ua)+)?", "".join(roles)) for roles in whole.values())


def test_repair_of_no_turns(spark):
    assert collected(turn_repair.repair_report(table(spark, awkward_turns(1)).limit(0))) == []
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    nothing = (5, 0, 0, 0, 0, 0, 0, "", sha(""))
    assert collected(turn_repair.repair_report(table(spark, [(5, dropped, "user", "x")]))) == [nothing]


# Prefix trie


def brute_trie(convs):
    members, children, done, out = defaultdict(list), defaultdict(list), {}, []
    for conv, turns in convs.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    for path in sorted(members, key=len, reverse=True):
        found = members[path]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves = sum(done[c][0] for c in children[path]) or 1
        saved = sum(done[c][1] for c in children[path]) + (len(found) - 1) * words
        done[path] = leaves, saved
        ends = ",".join(str(c) for c in sorted(found) if len(convs[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(found), len(path), parent, len(found), len(children[path]), leaves, saved, sha(ends)))
    return sorted(out, key=str)


def originals(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            found[conv].append(((turn is not None, turn or 0), content_digest(role, text), (role, text)))
    return {conv: [r[2] for r in sorted(turns)] for conv, turns in found.items()}


def rebuilt(convs):
    out = {}
    for conv, own in convs.items():
        taken = zlib.crc32(str(conv).encode()) % 4
        out[conv] = convs.get(conv - int(math.fmod(conv, 20)), [])[:taken] + own[taken:]
    return out


def shared_turns():
    rnd = random.Random(6)
    rows = [
        (conv, rnd.choice([t, t, t, None, 3]), rnd.choice(["user", "assistant", None]), rnd.choice(["a b", "a  c\n", "", None, "x"]))
        for conv in [*range(90), -7, -25] if conv % 23 for t in range(rnd.choice([0, 1, 2, 3, 6]))
    ]
    for conv in range(500, 520):  # a long common beginning, equal conversations among them
        rows += [(conv, t, "user", f"same {t}") for t in range(30)]
        rows += [(conv, 30 + t, "user", f"d {rnd.randrange(2)}") for t in range(3)]
    return rows + rows[:40] + [(None, 1, "user", "q"), (600, 0, "user", prose(5, 30_000)), (601, 0, "user", prose(5, 30_000))]


@pytest.mark.parametrize("container_turns", [prefix_trie.CONTAINER_TURNS, 15, 1])
def test_trie_of_rebuilt_conversations(spark, container_turns):
    rows = shared_turns()
    found = prefix_trie.rebuilt_trie(table(spark, rows), container_turns)
    assert collected(found) == brute_trie(rebuilt(originals(rows)))


def test_trie(spark):
    rows = shared_turns()
    assert collected(prefix_trie.prefix_trie(table(spark, rows), 40)) == brute_trie(originals(rows))
    assert collected(prefix_trie.prefix_trie(table(spark, rows).limit(0))) == []
    # A conversation whose turns all come from a head that is not there has none, and ends at the root.
    conv = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    turnless = prefix_trie.rebuilt_trie(table(spark, [(conv, 0, "user", "x")]))
    assert collected(turnless) == [(conv, 0, None, 1, 0, 1, 0, sha(str(conv)))]
