"""Distinct word shingles of whole texts, as sorted 64-bit hashes, a batch at a time."""

from __future__ import annotations

import numpy as np

from tallybook.llm.blocks import mix, prefix_hashes, span_hashes

# Words are runs of anything but blank, tab, line ends and the like; A-Z is lower-cased.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_ROLE = mix(np.arange(1, 65, dtype=np.uint64) << np.uint64(7)) | np.uint64(1)


def words(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, document number) of all words of a batch of texts."""
    inside = ~SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.empty(len(data), bool)
    before[:1], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(len(data), bool)
    after[-1:], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """(hash of each lower-cased word, its document number)."""
    data = LOWER[data]
    starts, ends, owner = words(data, offsets)
    return span_hashes(prefix_hashes(data), starts, ends), owner


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Each document's distinct shingles of ``size`` words, sorted.

    A document with fewer words has its whole sequence as its only one, a document without words none.
    """
    hashes, owner = word_hashes(data, offsets)
    bounds = np.searchsorted(owner, np.arange(len(offsets)))
    full = max(0, len(hashes) - size + 1)
    rolled = np.zeros(full, np.uint64)
    for i in range(size):
        rolled += hashes[i : i + full] * _ROLE[i]
    rolled = mix(rolled)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            short = (hashes[a:b] * _ROLE[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([short])))
        else:
            out.append(np.empty(0, np.uint64))
    return out
