"""Toxicity by a factorization machine over hashed terms.

Terms are a text's distinct lower-cased words and their beginnings, hashed into a fixed number of
buckets. A term has a weight, and a short vector; the score of a text is the sum of the weights of
its terms and of the inner products of all pairs of their vectors, which takes one pass over the
terms: half of (square of the sum less sum of squares). Pairs are what a sum of weights cannot
learn, such as an insult beside the name of a group.

Terms that get a weight are those that tell something by themselves, and those of pairs that tell
more or less than both their terms do, also where each alone is neutral.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallybook.llm.blocks import cut_batch, documents, mix, prefix_hashes, span_hashes, text_array
from tallybook.llm.labelled import accepted, held_out, learned, with_scores
from tallybook.llm.shingles import LOWER, words

BUCKETS = 1 << 20
BEGINNINGS = (4, 5, 6)  # bytes of a word that are a term of their own
SAMPLE_ROWS = 8000  # labelled documents to learn from
TERMS = 4096  # terms that have weights
PAIR_TERMS = 1024  # terms whose pairs are looked at, those that part the sample most evenly
_ALONE, _TOGETHER = 2.5, 5.5  # standard deviations for a term, and for one of half a million pairs
FACTORS = 4
_EPOCHS, _RATE, _DECAY = 12, 0.2, 1e-4
_SLICE = 256  # texts, or terms, of a matrix worked on at a time

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def term_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document number) of all terms of a batch of texts, with repeats."""
    low = np.where(_LETTER[LOWER[data]], LOWER[data], np.uint8(32))
    starts, ends, owner = words(low, offsets)
    running = prefix_hashes(low)
    found, owners = [span_hashes(running, starts, ends)], [owner]
    for size in BEGINNINGS:
        some = ends - starts >= size
        found.append(span_hashes(running, starts[some], starts[some] + size) + np.uint64(size))
        owners.append(owner[some])
    return (mix(np.concatenate(found)) & np.uint64(BUCKETS - 1)).astype(np.int64), np.concatenate(owners)


class Model:
    """``place`` maps a bucket to a row of ``weights`` and ``vectors``, or to -1."""

    def __init__(self, terms: np.ndarray, bias: float):
        self.terms, self.bias = terms, bias
        self.weights = np.zeros(len(terms))
        self.vectors = np.random.default_rng(7).normal(0, 0.02, (len(terms), FACTORS))

    def place(self) -> np.ndarray:
        place = np.full(BUCKETS, -1, np.int32)
        place[self.terms] = np.arange(len(self.terms))
        return place

    def scores(self, place: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability for each text of a batch."""
        count = len(offsets) - 1
        bucket, owner = term_buckets(data, offsets)
        row = place[bucket]
        known = row >= 0
        pairs = np.unique(owner[known] * np.int64(len(self.terms)) + row[known]) if known.any() else np.empty(0, np.int64)
        owner, row = np.divmod(pairs, max(1, len(self.terms)))
        total = self.bias + np.bincount(owner, self.weights[row], count)
        for f in range(FACTORS):
            v = self.vectors[row, f]
            total += 0.5 * (np.bincount(owner, v, count) ** 2 - np.bincount(owner, v * v, count))
        return 1 / (1 + np.exp(-np.clip(total, -60, 60)))


def _pair_scores(texts: list[np.ndarray], labels: np.ndarray, seen: np.ndarray, hits: np.ndarray, share: float) -> np.ndarray:
    """For each bucket the most standard deviations by which a pair with it differs from what its two terms tell.

    Two terms that add up have the log odds of both, less those of all texts.
    """
    spread = np.minimum(seen, len(texts) - seen)
    often = np.flatnonzero(spread >= 4)
    picked = often[np.argsort(-spread[often], kind="stable")[:PAIR_TERMS]]
    place = np.full(BUCKETS, -1, np.int32)
    place[picked] = np.arange(len(picked))
    # Counts, and so exact in any order: a slice of the texts, then of the terms, at a time.
    both = np.zeros((len(picked), len(picked)), np.float32)
    toxic = np.zeros_like(both)
    for first in range(0, len(texts), _SLICE):
        some, label = texts[first : first + _SLICE], labels[first : first + _SLICE]
        there = np.zeros((len(some), len(picked)), np.float32)
        for i, text in enumerate(some):
            row = place[text]
            there[i, row[row >= 0]] = 1
        both += there.T @ there
        there = there[label > 0]
        toxic += there.T @ there
    odds = (hits[picked] + share) / (seen[picked] - hits[picked] + 1 - share)
    out = np.zeros(len(seen))
    for first in range(0, len(picked), _SLICE):
        at = slice(first, first + _SLICE)
        together = odds[at, None] * odds * (1 - share) / share
        expected = together / (1 + together)
        z = np.abs(toxic[at] - both[at] * expected) / np.sqrt(both[at] * expected * (1 - expected) + 1)
        z[np.arange(len(z)), np.arange(first, first + len(z))] = 0
        out[picked[at]] = z.max(axis=1, initial=0)
    return out


def fit(sample: list[tuple[bytes, int]]) -> Model:
    """Learn from (text, label) pairs; without both labels, a constant."""
    labels = np.array([y for _, y in sample], float)
    share = labels.mean() if len(labels) else 0.5
    if len(set(labels.tolist())) < 2:
        return Model(np.empty(0, np.int64), 4.0 * (2 * share - 1))
    texts = []
    for text, _ in sample:
        data = np.frombuffer(text, np.uint8)
        texts.append(np.unique(term_buckets(data, np.array([0, len(data)]))[0]).astype(np.int32))
    seen, hits = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for text, label in zip(texts, labels):  # each term once
        seen[text] += 1
        hits[text] += label
    # Terms that tell the labels apart most, by the z-score of their share of label 1 or of a pair's.
    paired = _pair_scores(texts, labels, seen, hits, share)
    often = np.flatnonzero(seen >= 4)
    seen, hits, paired = seen[often], hits[often], paired[often]
    z = np.abs(hits - share * seen) / np.sqrt(np.maximum(seen, 1) * share * (1 - share))
    told = np.maximum(np.where(z > _ALONE, z, 0), np.where(paired > _TOGETHER, paired, 0))
    best = np.sort(np.argsort(-told, kind="stable")[:TERMS])
    best = best[told[best] > 0]
    model = Model(often[best], float(np.log(share / (1 - share))))
    place = model.place()
    rows = [r[r >= 0] for r in (place[t] for t in texts)]
    w, v = model.weights, model.vectors
    gw, gv, gb = np.full(len(w), 1e-6), np.full(v.shape, 1e-6), 1e-6
    order = np.random.default_rng(11)
    for _ in range(_EPOCHS):
        for i in order.permutation(len(rows)):
            r = rows[i]
            x = v[r]
            total = x.sum(axis=0)
            raw = model.bias + w[r].sum() + 0.5 * float((total * total).sum() - (x * x).sum())
            error = 1 / (1 + np.exp(-np.clip(raw, -60, 60))) - labels[i]
            gb += error * error
            model.bias -= _RATE * error / np.sqrt(gb)
            if len(r):
                g = error + _DECAY * w[r]
                gw[r] += g * g
                w[r] -= _RATE * g / np.sqrt(gw[r])
                g = error * (total - x) + _DECAY * x
                gv[r] += g * g
                v[r] -= 0.1 * _RATE * g / np.sqrt(gv[r])
    return model


def scorer(model: Model):
    """For a task: a function from a column of texts to their scores."""

    def start():
        place = model.place()

        def scores(texts: pa.Array) -> np.ndarray:
            data, offsets = text_array(texts)
            found = [
                model.scores(place, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in cut_batch(offsets)
            ]
            return np.concatenate([np.empty(0), *found])

        return scores

    return start


def keep_clean(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", cut: float = 0.5, sample_rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that score below ``cut``, with all their columns."""
    model = learned(fit, documents(docs, id_column, text_column), labels, label, sample_rows)
    return accepted(docs, text_column, scorer(model), lambda s: s < cut)


def score(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", cut: float = 0.5, sample_rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row of ``docs``.

    The model learns from at most ``sample_rows`` labelled rows that are not held out, and from
    their texts alone. Null and empty texts have the score of no terms at all. Without labels of
    both kinds all scores are the same. Rows that repeat an id, or have none, are scored each.
    Other columns are ignored; an empty table gives no rows.
    """
    docs = documents(docs, id_column, text_column)
    model = learned(fit, docs, labels, label, sample_rows)

    scored = with_scores(docs, "text", "score", scorer(model)).drop("text")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted")
    )
