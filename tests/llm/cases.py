"""Awkward documents every operator has to take, and a wider table with clashing column names."""

import random

_rnd = random.Random(4)
WORDS = ["".join(_rnd.choice("abcdefg") for _ in range(_rnd.randint(2, 7))) for _ in range(300)]


def prose(seed: int, count: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(["the", "of", "and"] + WORDS) for _ in range(count))


LONG = prose(1, 30_000)
BASE = prose(2, 200)
EDITED = BASE.replace(BASE.split()[100], "changed", 1)
TEXTS = [
    None, "", " \n\t", "one", "ONE two", BASE, BASE, EDITED, BASE + " tail", prose(3, 200), LONG, "x" * 500,
    "é ü 日本 🎈 " * 40, prose(5, 60) + " " + BASE[:400], "a\u00a0b \u2003c <|endoftext|> don't 123!!", prose(6, 3),
]


def documents(spark, ids=None):
    """Extra columns are called like the operators' own."""
    ids = list(range(len(TEXTS))) if ids is None else ids
    rows = [(i, t, "x", 1.5, 7, b"k") for i, t in zip(ids, TEXTS)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, component string, score double, row long, kept binary"
    ).repartition(3)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)
