"""Text quality by a convolutional network over bytes, in numpy.

Each byte has a learned vector. Windows of eight bytes, four apart, also know whether their bytes
repeat those a few places before, which no filter over single bytes can tell. Learned filters look
at every window; chunks of 64 windows, half overlapping, cover the whole text, and each chunk keeps
the largest response of every filter. A learned weighting turns that into the chunk's evidence, and
the mean over all chunks into one probability. Training is plain gradient descent (Adam).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallybook.llm.blocks import documents, text_array
from tallybook.llm.labelled import accepted, held_out, learned, with_scores

WIDTH, HOP = 8, 4  # bytes of a window, and from one to the next
DEPTH, FILTERS = 4, 24
CHUNK, CHUNK_HOP = 64, 32  # windows
LAGS = range(2, 33)  # how far back a repeat is looked for
SAMPLE_ROWS = 3000  # labelled documents to learn from
_EPOCHS, _RATE, _DECAY = 6, 0.01, 1e-4
_PIECE = 1 << 18  # bytes of a long text worked on at a time


def _windows_of(size: int) -> int:
    return max(1, -(-(size - WIDTH) // HOP) + 1)


def _padded(text: np.ndarray) -> np.ndarray:
    """A text with blanks behind it, so that windows and chunks come out even."""
    windows = _windows_of(len(text))
    chunks = max(1, -(-(windows - CHUNK) // CHUNK_HOP) + 1)
    size = ((chunks - 1) * CHUNK_HOP + CHUNK - 1) * HOP + WIDTH
    out = np.full(size, 32, np.uint8)
    out[: len(text)] = text
    return out


def _repeats(text: np.ndarray, windows: int, before: int) -> np.ndarray:
    """Whether each window repeats the bytes some places before; ``before`` bytes precede the first."""
    reach = max(LAGS)
    data = np.concatenate([np.arange(reach - before, dtype=np.uint8) + 128, text]) if before < reach else text[before - reach :]
    here = np.ndarray(windows, "<u8", data, reach, (HOP,))
    out = np.zeros(windows, bool)
    for lag in LAGS:
        out |= here == np.ndarray(windows, "<u8", data, reach - lag, (HOP,))
    out &= here != 0x2020202020202020
    return out


class Network:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.p = {
            "embed": rng.normal(0, 0.5, (256, DEPTH)).astype(np.float32),
            "filters": rng.normal(0, 0.25, (WIDTH * DEPTH + 1, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "out": rng.normal(0, 0.25, FILTERS).astype(np.float32),
            "base": np.zeros(1, np.float32),
        }

    def inputs(self, text: np.ndarray, windows: int, before: int) -> np.ndarray:
        """Windows as rows; ``text`` starts ``before`` bytes ahead of the first."""
        own = text[before : before + (windows - 1) * HOP + WIDTH]
        x = np.empty((windows, WIDTH * DEPTH + 1), np.float32)
        embedded = np.ascontiguousarray(self.p["embed"][own])
        step = embedded.strides[0]
        x[:, :-1] = np.lib.stride_tricks.as_strided(embedded, (windows, WIDTH * DEPTH), (HOP * step, 4))
        x[:, -1] = _repeats(text, windows, before)
        return x

    @staticmethod
    def pooled(response: np.ndarray) -> np.ndarray:
        """Largest response per chunk and filter; chunks overlap by half."""
        halves = response.reshape(-1, CHUNK_HOP, FILTERS).max(axis=1)
        return np.maximum(halves[:-1], halves[1:])

    def evidence(self, text: np.ndarray) -> float:
        """Mean evidence of all chunks of a whole text, however long, a piece at a time."""
        text = _padded(text)
        windows = (len(text) - WIDTH) // HOP + 1
        halves = windows // CHUNK_HOP
        total, last = 0.0, None
        per_piece = _PIECE // (HOP * CHUNK_HOP)
        for first in range(0, halves, per_piece):
            count = min(per_piece, halves - first) * CHUNK_HOP
            at = first * CHUNK_HOP * HOP
            before = min(at, max(LAGS))
            x = self.inputs(text[at - before :], count, before)
            best = (x @ self.p["filters"] + self.p["bias"]).reshape(-1, CHUNK_HOP, FILTERS).max(axis=1)
            best = np.maximum(best, 0) if last is None else np.concatenate([last, np.maximum(best, 0)])
            total += float((np.maximum(best[:-1], best[1:]) @ self.p["out"]).sum())
            last = best[-1:]
        return total / (halves - 1) + float(self.p["base"][0])

    def gradient(self, text: np.ndarray, label: int) -> dict[str, np.ndarray]:
        text = _padded(text)
        windows = (len(text) - WIDTH) // HOP + 1
        x = self.inputs(text, windows, 0)
        z = np.maximum(x @ self.p["filters"] + self.p["bias"], 0).reshape(-1, CHUNK_HOP, FILTERS)
        top = z.argmax(axis=1)
        halves = np.take_along_axis(z, top[:, None, :], axis=1)[:, 0]
        first = halves[:-1] >= halves[1:]
        chunks = np.where(first, halves[:-1], halves[1:])
        mean = chunks.mean(axis=0)
        raw = float(mean @ self.p["out"] + self.p["base"][0])
        error = 1 / (1 + np.exp(-np.clip(raw, -40, 40))) - label
        # Each chunk's share of the error goes to the window that was largest in it.
        share = np.zeros_like(halves)
        share[:-1] += first
        share[1:] += ~first
        share *= error * self.p["out"] / len(chunks) * (halves > 0)
        used = np.flatnonzero(share.any(axis=1))
        at = used[:, None] * CHUNK_HOP + top[used]
        flat, each = at.reshape(-1), share[used].reshape(-1)
        column = np.tile(np.arange(FILTERS), len(used))
        rows = x[flat] * each[:, None]
        filters = np.zeros_like(self.p["filters"])
        for f in range(FILTERS):
            filters[:, f] = rows[column == f].sum(axis=0)
        back = (self.p["filters"][:-1, column].T * each[:, None]).reshape(-1, DEPTH)
        places = (flat[:, None] * HOP + np.arange(WIDTH)).reshape(-1)
        embed = np.stack([np.bincount(text[places], back[:, d], 256) for d in range(DEPTH)], axis=1)
        return {
            "embed": embed, "filters": filters, "bias": np.bincount(column, each, FILTERS),
            "out": error * mean, "base": np.array([error]),
        }


def fit(sample: list[tuple[bytes, int]]) -> Network:
    """Learn from (text, label) pairs; without both labels, a constant."""
    network = Network()
    labels = [y for _, y in sample]
    if len(set(labels)) < 2:
        for value in network.p.values():
            value[:] = 0
        if labels:
            network.p["base"][0] = 4.0 if labels[0] else -4.0
        return network
    first = {k: np.zeros_like(v) for k, v in network.p.items()}
    second = {k: np.zeros_like(v) for k, v in network.p.items()}
    held = {k: np.zeros_like(v) for k, v in network.p.items()}
    rng, step, batch = np.random.default_rng(13), 0, 8
    texts = [np.frombuffer(t, np.uint8) for t, _ in sample]
    for epoch in range(_EPOCHS):
        rate = _RATE * (1 - epoch / _EPOCHS)
        for n, i in enumerate(rng.permutation(len(texts)), 1):
            for k, g in network.gradient(texts[i], labels[i]).items():
                held[k] += g.astype(np.float32)
            if n % batch and n < len(texts):
                continue
            step += 1
            for k, p in network.p.items():
                g = held[k] / batch + _DECAY * p
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                p -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                held[k][:] = 0
    return network


def scorer(network: Network):
    """For a task: a function from a column of texts to their scores."""

    def scores(texts: pa.Array) -> np.ndarray:
        data, offsets = text_array(texts)
        raw = np.array([network.evidence(data[a:b]) for a, b in zip(offsets, offsets[1:])], float)
        return 1 / (1 + np.exp(-np.clip(raw, -60, 60)))

    return lambda: scores


def keep_good(
    docs: DataFrame, labels: DataFrame, label: str = "quality", cut: float = 0.3, sample_rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that score ``cut`` or more, with all their columns."""
    network = learned(fit, documents(docs, id_column, text_column), labels, label, sample_rows)
    return accepted(docs, text_column, scorer(network), lambda s: s >= cut)


def score(
    docs: DataFrame, labels: DataFrame, label: str = "quality", cut: float = 0.3, sample_rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row of ``docs``.

    The network learns from at most ``sample_rows`` labelled rows that are not held out, and from
    their texts alone. Null and empty texts are scored as blanks. Without labels of both kinds all
    scores are the same. Rows that repeat an id, or have none, are scored each. Other columns are
    ignored; an empty table gives no rows.
    """
    docs = documents(docs, id_column, text_column)
    network = learned(fit, docs, labels, label, sample_rows)

    scored = with_scores(docs, "text", "score", scorer(network)).drop("text")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted")
    )
